"""Operators that look along a candle series. Chunked by day, so no task holds a series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.timecol import from_micros, is_ntz, seconds_between, to_micros
from tickloom.plans.chunked import CHUNK, day_chunks, last_known, minute_chunks, previous_row
from tickloom.timeframe import DAY_US, micros_of, parse

SERIES = ("exchange", "instrument_type", "symbol", "timeframe")


def fill_open(candles: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A missing open becomes the close of the row before."""
    chunked = day_chunks(candles)
    seen = previous_row(chunked, keys, ["time"], {"_close": F.col("close")})
    return seen.withColumn("open", F.coalesce("open", "_close")).drop("_close", CHUNK)


def time_deltas(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Seconds since the row before, null on the first row of a series."""
    timed = df.withColumn("_us", to_micros(df, "time"))
    seen = previous_row(minute_chunks(timed), keys, ["time"], {"_before": F.col("_us")})
    return seen.withColumn("delta_seconds", seconds_between(F.col("_before"), F.col("_us"))).drop(
        "_before", "_us", CHUNK
    )


def with_continuity(candles: DataFrame, keys: Sequence[str], timeframe: Column) -> DataFrame:
    """Per candle: step since the one before, and the gap and alignment judgements on it.

    A step over 1.5 bars is a gap. Steps of 0.9 to 1.1 bars are consecutive; those whose open
    lies within 0.1% of the previous close are aligned.
    """
    timed = candles.withColumns({"_us": to_micros(candles, "time"), "_tf": timeframe})
    carried = {"_before": F.col("_us"), "_close": F.col("close")}
    seen = previous_row(day_chunks(timed), keys, ["time"], carried).drop(CHUNK)
    # Tenths of a bar in whole numbers: no rounding at the thresholds.
    step = (F.col("_us") - F.col("_before")) * F.lit(10)
    tf = F.col("_tf")
    consecutive = step.between(tf * F.lit(9), tf * F.lit(11))
    near = F.abs(F.col("open") - F.col("_close")) < F.col("open") * F.lit(0.001)
    return seen.withColumns(
        {
            "_is_gap": F.coalesce(step > tf * F.lit(15), F.lit(False)),
            "_consecutive": F.coalesce(consecutive, F.lit(False)),
            "_aligned": F.coalesce(consecutive & near, F.lit(False)),
        }
    )


def candle_gaps(candles: DataFrame, timeframe: str | None, keys: Sequence[str]) -> DataFrame:
    """Gaps between candles: from the candle before to the candle after, with the seconds.

    Without a ``timeframe`` each row's own ``timeframe`` column gives the bar width.
    """
    width = F.lit(parse(timeframe).micros) if timeframe else micros_of(F.col("timeframe"))
    ntz = is_ntz(candles, "time")
    judged = with_continuity(candles, keys, width).where("_is_gap")
    return judged.select(
        *keys,
        from_micros(F.col("_before"), ntz).alias("gap_start"),
        from_micros(F.col("_us"), ntz).alias("gap_end"),
        seconds_between(F.col("_before"), F.col("_us")).alias("gap_seconds"),
    )


def open_close_alignment(
    candles: DataFrame, timeframe: str, keys: Sequence[str]
) -> DataFrame:
    judged = with_continuity(candles, keys, F.lit(parse(timeframe).micros))
    counts = judged.groupBy(*keys).agg(
        F.count_if("_consecutive").alias("consecutive"), F.count_if("_aligned").alias("aligned")
    )
    return counts.withColumn("alignment_score", alignment_score())


def alignment_score() -> Column:
    return F.when(
        F.col("consecutive") > 0, F.col("aligned") / F.col("consecutive") * F.lit(100.0)
    ).otherwise(F.lit(100.0))


def explode_steps(df: DataFrame, start: Column, end: Column, step: int, name: str) -> DataFrame:
    """One row per step in [start, end), in microseconds.

    Split by day first, so that no array holds more than a day of steps or a span of days.
    """
    day = F.lit(max(DAY_US - DAY_US % step, step))
    blocks = F.when(start < end, F.sequence(start, end - F.lit(1), day))
    by_block = df.withColumns({"_end": end, "_block": F.explode(blocks)})
    stop = F.least(F.col("_block") + day, F.col("_end")) - F.lit(1)
    steps = F.sequence(F.col("_block"), stop, F.lit(step).cast("long"))
    return by_block.withColumn(name, F.explode(steps)).drop("_end", "_block")


def asof_fill(
    candles: DataFrame, timeframe: str, keys: Sequence[str], carry_volume: bool = True
) -> DataFrame:
    """Dense grid from the first to the last candle; a missing bar repeats the whole row before.

    ``carry_volume=False`` gives the repeated rows no volume instead. ``is_filled`` marks them.
    """
    step = parse(timeframe).micros
    ntz = is_ntz(candles, "time")
    values = [c for c in candles.columns if c not in (*keys, "time")]
    timed = candles.withColumn("_us", to_micros(candles, "time"))
    carried = {"_from": F.col("_us"), "_row": F.struct(*values)}
    seen = previous_row(day_chunks(timed), keys, ["time"], carried)
    own = F.struct(
        F.col("_us").alias("at"), (F.col("_us") + 1).alias("upto"), F.struct(*values).alias("row"),
        F.lit(False).alias("filled"),
    )
    before = F.struct(
        (F.col("_from") + F.lit(step)).alias("at"), F.col("_us").alias("upto"),
        F.col("_row").alias("row"), F.lit(True).alias("filled"),
    )
    # The row itself, then the missing bars since the row before as copies of that row.
    spans = F.when(F.col("_from").isNull(), F.array(own)).otherwise(F.array(own, before))
    pieces = seen.select(*keys, F.explode(spans).alias("_span"))
    stepped = explode_steps(pieces, F.col("_span.at"), F.col("_span.upto"), step, "_at")
    grid = stepped.select(
        *keys,
        from_micros(F.col("_at"), ntz).alias("time"),
        "_span.row.*",
        F.col("_span.filled").alias("is_filled"),
    )
    if not carry_volume:
        empty = [c for c in ("volume", "quote_volume") if c in values]
        grid = grid.withColumns(
            {c: F.when(F.col("is_filled"), F.lit(0.0)).otherwise(F.col(c)) for c in empty}
        )
    return grid


def last_close_before(
    points: DataFrame, candles: DataFrame, keys: Sequence[str], at: str = "time"
) -> DataFrame:
    """Each point with the close of the latest candle strictly before it, or 0.0.

    Points and candles share one ordered pass; no point is paired with every candle.
    """
    extra = [c for c in points.columns if c not in (*keys, at)]
    asked = points.select(
        *keys,
        F.col(at).alias("_t"),
        F.lit(0).alias("_kind"),
        F.lit(None).cast("double").alias("_close"),
        F.struct(*extra, F.lit(True).alias("_asked")).alias("_point"),
    )
    known = candles.select(
        *keys,
        F.col("time").alias("_t"),
        F.lit(1).alias("_kind"),
        F.col("close").cast("double").alias("_close"),
        F.lit(None).cast(asked.schema["_point"].dataType).alias("_point"),
    )
    # A point sorts before a candle of the same time, so that candle does not count.
    chunked = day_chunks(asked.unionByName(known), "_t")
    filled = last_known(chunked, keys, ["_t", "_kind"], {"_last": F.col("_close")})
    return filled.where("_kind = 0").select(
        *keys,
        F.col("_t").alias(at),
        *[F.col(f"_point.{c}").alias(c) for c in extra],
        F.coalesce("_last", F.lit(0.0)).alias("last_close"),
    )
