"""Consolidation across venues, and across spot and swap markets.

Series are aligned on time by a grouped aggregate over their union: the rows of full outer joins
with one shuffle, combined map-side, for any number of venues.

Pass DECIMAL prices and volumes to have the weighted sums exact, hence independent of the
order in which tasks finish; DOUBLE columns are summed as they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.columns import PRICES, base_volume, clamp_high_low, ohlc4, provenance, rounded
from tickloom.functions.timecol import bar_start, from_micros, is_ntz, to_micros, utc_date
from tickloom.plans.dedup import keep_one, others
from tickloom.plans.joins import join_on
from tickloom.timeframe import parse

AGGREGATED = "aggregated"
VENUE_SERIES = ["exchange", "instrument_type", "symbol", "time"]
SYNTHETIC_FIGURES = ("open", "high", "low", "close", "volume", "quote_volume", "twap", "vwap")


def _double(value: Column) -> Column:
    return value.cast("double")


def _mean(value: str) -> Column:
    return F.try_divide(_double(F.sum(value)), F.count(value))


def normalise_inverse_volume(candles: DataFrame) -> DataFrame:
    """Dollar volumes of inverse contracts become base volumes, decided per row."""
    converted = base_volume(F.col("exchange"), F.col("instrument_type"), F.col("symbol"))
    return candles.withColumn("volume", converted)


def aggregate_exchanges(
    candles: DataFrame,
    asset: str = "base_asset",
    order: Sequence[str] | None = None,
    figures_rounded: bool = True,
    distinct: bool = False,
    timeframe: str = "1m",
) -> DataFrame:
    """One candle per (instrument_type, asset, time) over all venues.

    Volume is the sum. Prices are weighted by volume, or the plain mean where the total volume
    is not positive. A missing price still counts its volume in the weight. Of repeated candles
    of one venue the first by ``order`` counts (by all other columns without it); pass
    ``distinct=True`` where a venue's times are unique, which spares a shuffle.
    """
    if not distinct:
        candles = keep_one(candles, VENUE_SERIES, order or others(candles, VENUE_SERIES), "first")
    total = F.coalesce(_double(F.sum("volume")), F.lit(0.0))
    aggregates = [total.alias("volume")]
    for p in PRICES:
        weighted = F.coalesce(_double(F.sum(F.col(p) * F.col("volume"))), F.lit(0.0))
        aggregates += [weighted.alias(f"_w_{p}"), _mean(p).alias(f"_m_{p}")]
    grouped = candles.groupBy("instrument_type", F.col(asset).alias("symbol"), "time").agg(*aggregates)
    result = grouped.withColumns(
        {
            p: F.when(F.col("volume") > 0, F.col(f"_w_{p}") / F.col("volume")).otherwise(
                F.col(f"_m_{p}")
            )
            for p in PRICES
        }
    )
    if figures_rounded:
        result = rounded(result, [*PRICES, "volume"])
    result = result.select("instrument_type", "symbol", "time", *PRICES, "volume")
    return provenance(result, exchange=AGGREGATED, timeframe=timeframe)


def synthesize(
    candles: DataFrame, asset: str = "symbol", figures_rounded: bool = True, timeframe: str = "1m"
) -> DataFrame:
    """Merge the spot and swap candles of each asset into one series.

    Unlike the venue aggregate, a side without a price adds no weight to that price. Prices
    still missing are filled forward, then backward, within the day.
    """
    sides = candles.where(F.col("instrument_type").isin("spot", "swap"))
    aggregates = [F.coalesce(_double(F.sum("volume")), F.lit(0.0)).alias("volume")]
    for p in PRICES:
        weight = F.when(F.col(p).isNotNull(), F.coalesce(F.col("volume"), F.lit(0)))
        aggregates += [
            F.coalesce(_double(F.sum(weight)), F.lit(0.0)).alias(f"_v_{p}"),
            F.coalesce(_double(F.sum(F.col(p) * F.col("volume"))), F.lit(0.0)).alias(f"_w_{p}"),
            _mean(p).alias(f"_m_{p}"),
        ]
    grouped = sides.groupBy(F.col(asset).alias("symbol"), "time").agg(*aggregates)
    priced = grouped.withColumns(
        {
            p: F.when(F.col(f"_v_{p}") > 0, F.col(f"_w_{p}") / F.col(f"_v_{p}")).otherwise(
                F.col(f"_m_{p}")
            )
            for p in PRICES
        }
    ).select("symbol", "time", *PRICES, "volume")
    filled = fill_prices_within_day(priced, ["symbol"])
    enriched = filled.withColumns(
        {
            "twap": ohlc4(),
            "vwap": ohlc4(),
            "quote_volume": ohlc4() * F.col("volume"),
        }
    )
    if figures_rounded:
        enriched = clamp_high_low(rounded(enriched, SYNTHETIC_FIGURES))
    enriched = enriched.select("symbol", "time", *SYNTHETIC_FIGURES)
    return provenance(enriched, exchange=AGGREGATED, instrument_type="synthetic", timeframe=timeframe)


def fill_prices_within_day(candles: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Forward then backward fill of each price. A (series, day) holds at most 1,440 minutes.

    Only minutes before the first known price are left after the forward fill, so the backward
    fill is the first known price of the day.
    """
    day = Window.partitionBy(*keys, "_day").orderBy("time")
    back = day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = day.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return (
        candles.withColumn("_day", utc_date(candles, "time"))
        .withColumns(
            {
                p: F.coalesce(
                    F.last(p, ignorenulls=True).over(back),
                    F.first(p, ignorenulls=True).over(whole),
                )
                for p in PRICES
            }
        )
        .drop("_day")
    )


def price_basis(
    spot: DataFrame, mark: DataFrame, index: DataFrame, keys: Sequence[str] = ("symbol",)
) -> DataFrame:
    """Spot, mark and index closes side by side, with their differences.

    Each side holds one row per series and time. Grouping the union does the work of two full
    outer joins in one shuffle.
    """
    on = [*keys, "time"]
    sides = {"spot": spot, "mark": mark, "index": index}
    named = [
        side.select(*on, F.lit(name).alias("_side"), "close") for name, side in sides.items()
    ]
    closes = [
        F.max(F.when(F.col("_side") == name, F.col("close"))).alias(name) for name in sides
    ]
    together = named[0].unionByName(named[1]).unionByName(named[2])
    return together.groupBy(*on).agg(*closes).withColumns(
        {
            "mark_minus_spot": F.col("mark") - F.col("spot"),
            "mark_minus_index": F.col("mark") - F.col("index"),
        }
    )


def tick_vwap(ticks: DataFrame, width: str, keys: Sequence[str]) -> DataFrame:
    """What was really paid per bar: traded value over traded quantity, null without quantity."""
    bar = bar_start(to_micros(ticks, "time"), parse(width))
    paid = ticks.groupBy(*keys, bar.alias("_bar")).agg(
        _double(F.sum(F.col("price") * F.col("qty"))).alias("_value"), _double(F.sum("qty")).alias("_qty")
    )
    return paid.select(
        *keys,
        from_micros(F.col("_bar"), is_ntz(ticks, "time")).alias("time"),
        F.try_divide(F.col("_value"), F.col("_qty")).alias("tick_vwap"),
    )


def vwap_validation(synthetic: DataFrame, tick_vwap: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How far the synthetic VWAP lies from the traded VWAP, per series."""
    error = F.abs(F.col("vwap") - F.col("tick_vwap"))
    joined = join_on(
        synthetic.select(*keys, "time", "vwap"), tick_vwap.select(*keys, "time", "tick_vwap"), [*keys, "time"]
    )
    return joined.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("bars"),
        F.avg(error).alias("mean_abs_error"),
        F.max(error).alias("max_abs_error"),
        F.avg(F.try_divide(error, F.col("tick_vwap"))).alias("mean_rel_error"),
    )
