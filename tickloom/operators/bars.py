"""Bars: from trades, and from finer bars to coarser ones."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.columns import clamp_high_low, rounded
from tickloom.functions.timecol import bar_start, from_micros, is_ntz, to_micros, utc_date
from tickloom.plans.dedup import keep_one, others
from tickloom.plans.joins import join_on
from tickloom.timeframe import Timeframe, parse

BAR_FIGURES = ("open", "high", "low", "close", "volume", "quote_volume", "twap", "vwap")


# A time and an id share one number: any 64-bit id, moved up so that none is below zero, has fewer digits than this.
ID_SPAN, ID_SHIFT = Decimal(10**20), Decimal(2**63)


def _position(df: DataFrame, order: Sequence[str]) -> Column:
    """An ordering that stays a primitive where it can, which keeps hash aggregation.

    A time and a whole-number id become one DECIMAL; a missing id comes before all others.
    """
    if len(order) == 1:
        return F.col(order[0])
    if len(order) == 2 and isinstance(df.schema[order[1]].dataType, (T.LongType, T.IntegerType)):
        time = to_micros(df, order[0]).cast("decimal(19,0)") * F.lit(ID_SPAN).cast("decimal(21,0)")
        number = F.col(order[1]).cast("decimal(20,0)") + F.lit(ID_SHIFT).cast("decimal(20,0)")
        return time.cast("decimal(38,0)") + F.coalesce(number, F.lit(0)).cast("decimal(21,0)")
    return F.struct(*order)


def first_value(value: Column, position: Column) -> Column:
    return F.min_by(value, F.when(value.isNotNull(), position))


def last_value(value: Column, position: Column) -> Column:
    return F.max_by(value, F.when(value.isNotNull(), position))


def tick_bars(
    ticks: DataFrame,
    width: str,
    keys: Sequence[str],
    order: Sequence[str] = ("time", "trade_id"),
    price: str = "price",
    qty: str = "qty",
    time: str = "time",
) -> DataFrame:
    """Open, high, low, close and volume per bar; bars without trades do not appear.

    ``order`` settles which trade opens and closes a bar.
    """
    frame = parse(width)
    position = _position(ticks, order)
    bars = ticks.groupBy(*keys, bar_start(to_micros(ticks, time), frame).alias("_bar")).agg(
        first_value(F.col(price), position).alias("open"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        last_value(F.col(price), position).alias("close"),
        F.sum(qty).alias("volume"),
    )
    return bars.where(F.col("open").isNotNull()).select(
        *keys,
        from_micros(F.col("_bar"), is_ntz(ticks, time)).alias("time"),
        "open",
        "high",
        "low",
        "close",
        "volume",
    )


def micro_volatility(bars: DataFrame) -> DataFrame:
    return bars.withColumn("volatility", F.col("high") - F.col("low"))


def last_value_resample(
    df: DataFrame, width: str, keys: Sequence[str], values: Sequence[str], time: str = "time"
) -> DataFrame:
    """Last non-null value of each column per bar."""
    bars = df.groupBy(*keys, bar_start(to_micros(df, time), parse(width)).alias("_bar")).agg(
        *[last_value(F.col(v), F.col(time)).alias(v) for v in values]
    )
    return bars.select(
        *keys, from_micros(F.col("_bar"), is_ntz(df, time)).alias("time"), *values
    )


def _anchored(df: DataFrame, keys: Sequence[str], frames: Sequence[Timeframe]) -> DataFrame:
    """Add the year and the first time of the (series, year) that odd widths count from.

    The first times are one row per series and year; joining them back leaves the choice of
    a broadcast to their measured size.
    """
    with_year = df.withColumn("_year", F.year(utc_date(df, "time")))
    if not any(not f.divides_day and not (f.unit == "w" and f.count == 1) for f in frames):
        return with_year.withColumn("_first", F.lit(None).cast("long"))
    firsts = with_year.groupBy(*keys, "_year").agg(F.min("_us").alias("_first"))
    return join_on(with_year, firsts, [*keys, "_year"])


def resample(
    candles: DataFrame,
    timeframes: Sequence[str],
    keys: Sequence[str] = ("symbol",),
    anchor: str = "year",
    digits: bool = True,
    order: Sequence[str] | None = None,
    distinct: bool = False,
) -> DataFrame:
    """Coarser bars from candles.

    Of repeated times of a series the last by ``order`` counts (by all other columns without
    it); pass ``distinct=True`` where times are unique, which spares a shuffle. Each candle is
    counted towards its bar of every timeframe and combined map-side. Bars are left-labelled and left-closed.
    ``anchor='year'`` restarts odd widths (and splits weeks) at each calendar year, which
    ``anchor_year`` records; ``anchor='epoch'`` lets them run on. Bars without any open are
    dropped. The figures are rounded to two decimals unless ``digits`` is False.
    """
    if anchor not in ("year", "epoch"):
        raise ValueError("anchor must be 'year' or 'epoch'")
    frames = [parse(name) for name in timeframes]
    ntz = is_ntz(candles, "time")
    if not distinct:
        series = [*keys, "time"]
        candles = keep_one(candles, series, order or others(candles, series), "last")
    timed = candles.withColumn("_us", to_micros(candles, "time"))
    if anchor == "year":
        timed = _anchored(timed, keys, frames)
    choices = []
    for frame in frames:
        by_year = anchor == "year" and not frame.divides_day
        first = F.col("_first") if by_year else None
        year = F.col("_year") if by_year else F.lit(None)
        choices.append(
            F.struct(
                F.lit(frame.name).alias("timeframe"),
                bar_start(F.col("_us"), frame, first).alias("bar"),
                year.cast("int").alias("anchor_year"),
            )
        )
    spread = timed.select(*keys, "_us", *BAR_FIGURES, F.explode(F.array(*choices)).alias("_to"))
    at = F.col("_us")
    bars = spread.groupBy(
        *keys,
        F.col("_to.timeframe").alias("timeframe"),
        F.col("_to.bar").alias("_bar"),
        F.col("_to.anchor_year").alias("anchor_year"),
    ).agg(
        first_value(F.col("open"), at).alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        last_value(F.col("close"), at).alias("close"),
        F.coalesce(F.sum("volume").cast("double"), F.lit(0.0)).alias("volume"),
        F.coalesce(F.sum("quote_volume").cast("double"), F.lit(0.0)).alias("quote_volume"),
        F.try_divide(F.sum("twap").cast("double"), F.count("twap")).alias("twap"),
        F.coalesce(F.sum(F.col("vwap") * F.col("volume")).cast("double"), F.lit(0.0)).alias("_pv"),
    )
    weighted = F.when(F.col("volume") == 0, F.col("close").cast("double")).otherwise(
        F.try_divide(F.col("_pv"), F.col("volume"))
    )
    result = bars.where(F.col("open").isNotNull()).withColumn("vwap", weighted)
    if digits:
        result = clamp_high_low(rounded(result, BAR_FIGURES))
    return result.select(
        *keys,
        "timeframe",
        from_micros(F.col("_bar"), ntz).alias("time"),
        *BAR_FIGURES,
        "anchor_year",
    )
