"""Trade-level measures. Trades have no bound per day, hence chunks of a minute."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.columns import signed_qty, taker_side
from tickloom.functions.timecol import to_micros, whole_div
from tickloom.plans.chunked import CHUNK, minute_chunks, previous_row, running_sums
from tickloom.plans.joins import join_on
from tickloom.plans.quantiles import exact_quantiles

TICK_ORDER = ("time", "trade_id")
QUARTILES = {"p25": 0.25, "median": 0.5, "p75": 0.75, "p99": 0.99}


def with_flow(ticks: DataFrame) -> DataFrame:
    """Side of the taker, signed quantity and cost of each trade."""
    return ticks.withColumns(
        {
            "side": taker_side(F.col("is_buyer_maker")),
            "signed_qty": signed_qty(F.col("is_buyer_maker"), F.col("qty")),
            "cost": F.col("price") * F.col("qty"),
        }
    )


def trade_flow(
    ticks: DataFrame, keys: Sequence[str], order: Sequence[str] = TICK_ORDER
) -> DataFrame:
    """Cumulative volume delta and cumulative VWAP after each trade of a series."""
    chunked = minute_chunks(with_flow(ticks), order[0])
    sums = {
        "cvd": F.col("signed_qty"),
        "cum_cost": F.col("cost"),
        "cum_qty": F.col("qty"),
    }
    summed = running_sums(chunked, keys, order, sums)
    vwap = F.try_divide(F.col("cum_cost").cast("double"), F.col("cum_qty").cast("double"))
    return summed.withColumn("vwap", vwap).drop(CHUNK)


def inter_arrival(
    ticks: DataFrame, keys: Sequence[str], order: Sequence[str] = TICK_ORDER
) -> DataFrame:
    """Microseconds between consecutive trades: series keys and ``delta_us``."""
    slim = ticks.select(*keys, *order).withColumn("_us", to_micros(ticks, order[0]))
    seen = previous_row(minute_chunks(slim, order[0]), keys, order, {"_before": F.col("_us")})
    return seen.where("_before IS NOT NULL").select(
        *keys, (F.col("_us") - F.col("_before")).alias("delta_us")
    )


def inter_arrival_stats(deltas: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Summary of waiting times in milliseconds, from :func:`inter_arrival`."""
    ms = F.col("delta_us") / F.lit(1000.0)
    plain = deltas.groupBy(*keys).agg(
        F.count("delta_us").alias("n"),
        (F.sum("delta_us") / F.count("delta_us") / F.lit(1000.0)).alias("mean"),
        F.stddev_samp(ms).alias("std"),
        F.min(ms).alias("min"),
        F.max(ms).alias("max"),
        F.count_if(F.col("delta_us") == 0).alias("zero_gaps"),
    )
    quantiles = exact_quantiles(deltas, keys, "delta_us", QUARTILES)
    in_ms = quantiles.select(*keys, *[(F.col(q) / F.lit(1000.0)).alias(q) for q in QUARTILES])
    return join_on(plain, in_ms, keys)


def histogram(df: DataFrame, keys: Sequence[str], value: str, bins: int = 50) -> DataFrame:
    """Counts in equal-width bins of a BIGINT column, empty bins included; the last is closed."""
    edges = df.groupBy(*keys).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    span = F.col("_hi") - F.col("_lo")
    # Whole-number arithmetic: a value on an edge always falls into the bin it opens.
    scaled = (F.col(value) - F.col("_lo")) * F.lit(bins)
    place = F.least(whole_div(scaled, F.nullif(span, F.lit(0))), F.lit(bins - 1)).cast("int")
    index = F.when(span == 0, F.lit(bins // 2)).otherwise(place)
    placed = join_on(df.where(F.col(value).isNotNull()), edges, keys)
    counts = placed.groupBy(*keys, index.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    grid = edges.where("_lo IS NOT NULL").withColumn(
        "bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1)))
    )
    width = span / F.lit(float(bins))
    return join_on(grid, counts, [*keys, "bin"], "left").select(
        *keys,
        "bin",
        (F.col("_lo") + F.col("bin") * width).alias("bin_start"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def tick_stats(ticks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Volume and price figures of each series; the quantity is ``qty`` or ``amount``."""
    qty = "qty" if "qty" in ticks.columns else "amount"
    return ticks.groupBy(*keys).agg(
        F.sum(qty).alias("total_volume"),
        F.try_divide(F.sum(qty).cast("double"), F.count(qty)).alias("avg_trade_size"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        F.try_divide(F.sum("price").cast("double"), F.count("price")).alias("avg_price"),
        F.count(F.lit(1)).alias("trades"),
    )


def buy_sell_ratio(ticks: DataFrame, keys: Sequence[str]) -> DataFrame:
    counts = ticks.groupBy(*keys).agg(
        F.count_if(~F.col("is_buyer_maker")).alias("buys"),
        F.count_if(F.col("is_buyer_maker")).alias("sells"),
    )
    total = F.col("buys") + F.col("sells")
    return counts.withColumns(
        {
            "buy_ratio": F.try_divide(F.col("buys"), total),
            "sell_ratio": F.try_divide(F.col("sells"), total),
        }
    )
