"""Filling candle gaps: from a second landing where it has them, with flat bars elsewhere."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.timecol import day_number, from_micros, is_ntz, to_micros
from tickloom.operators.sequence import SERIES, explode_steps, last_close_before
from tickloom.plans.dedup import keep_one
from tickloom.plans.joins import join_on
from tickloom.timeframe import parse

CANDLE_FIGURES = ("open", "high", "low", "close", "volume")


def gap_steps(gaps: DataFrame, candles: DataFrame, timeframe: str, keys: Sequence[str]) -> DataFrame:
    """Every bar time in [gap_start, gap_end) without a stored candle, with the gap it belongs to."""
    ntz = is_ntz(gaps, "gap_start")
    stepped = explode_steps(
        gaps.select(*keys, "gap_start", "gap_end"),
        to_micros(gaps, "gap_start"),
        to_micros(gaps, "gap_end"),
        parse(timeframe).micros,
        "_at",
    )
    steps = stepped.withColumn("time", from_micros(F.col("_at"), ntz)).drop("_at")
    return join_on(steps, candles.select(*keys, "time"), [*keys, "time"], "left_anti")


def zero_fill_gaps(
    gaps: DataFrame, candles: DataFrame, timeframe: str, keys: Sequence[str] = SERIES
) -> DataFrame:
    """Flat bars over each gap: all prices at the last close before it (else 0), no volume.

    Times that have a stored candle, such as the start of a gap between two candles, get no bar.
    """
    seeds = last_close_before(gaps.select(*keys, "gap_start", "gap_end"), candles, keys, "gap_start")
    steps = gap_steps(gaps, candles, timeframe, keys)
    priced = join_on(steps, seeds, [*keys, "gap_start", "gap_end"])
    close = F.col("last_close")
    return priced.select(
        *keys,
        "time",
        *[close.alias(p) for p in ("open", "high", "low", "close")],
        F.lit(0.0).alias("volume"),
        F.lit(True).alias("is_interpolated"),
    )


def repair_from_landing(
    gaps: DataFrame,
    candles: DataFrame,
    landed: DataFrame,
    timeframe: str,
    keys: Sequence[str] = SERIES,
) -> DataFrame:
    """Candles to store for the gaps: landed ones first, flat bars for the steps still open."""
    found = keep_one(_landed_in_gaps(gaps, landed, keys), [*keys, "time"], list(CANDLE_FIGURES), "first")
    found = join_on(found, candles.select(*keys, "time"), [*keys, "time"], "left_anti")
    flat = zero_fill_gaps(gaps, candles, timeframe, keys)
    open_steps = join_on(flat, found.select(*keys, "time"), [*keys, "time"], "left_anti")
    real = found.select(
        *keys,
        "time",
        *[F.col(c).cast("double").alias(c) for c in CANDLE_FIGURES],
        F.lit(False).alias("is_interpolated"),
    )
    return real.unionByName(open_steps)


def _landed_in_gaps(gaps: DataFrame, landed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Landed candles that lie in some gap: rows and gaps meet on (series, day)."""
    cut = gaps.select(
        *keys,
        to_micros(gaps, "gap_start").alias("_gs"),
        to_micros(gaps, "gap_end").alias("_ge"),
    ).where("_gs < _ge")
    days = F.sequence(day_number(F.col("_gs")), day_number(F.col("_ge") - F.lit(1)))
    by_day = cut.withColumn("_day", F.explode(days))
    timed = landed.withColumn("_us", to_micros(landed, "time"))
    rows = timed.withColumn("_day", day_number(F.col("_us")))
    return (
        rows.alias("r")
        .join(
            by_day.alias("g"),
            [F.col(f"r.{k}").eqNullSafe(F.col(f"g.{k}")) for k in (*keys, "_day")]
            + [F.col("r._us") >= F.col("g._gs"), F.col("r._us") < F.col("g._ge")],
            "left_semi",
        )
        .drop("_us", "_day")
    )


def repair_status(
    gaps: DataFrame, candles: DataFrame, landed: DataFrame, timeframe: str, keys: Sequence[str] = SERIES
) -> DataFrame:
    """Each gap and its outcome: ``filled`` (all missing bars landed), ``partial`` or ``zero_filled``."""
    steps = gap_steps(gaps, candles, timeframe, keys)
    have = landed.select(*keys, "time").distinct().withColumn("_have", F.lit(1))
    counted = join_on(steps, have, [*keys, "time"], "left").groupBy(*keys, "gap_start", "gap_end").agg(
        F.count(F.lit(1)).alias("steps"), F.count("_have").alias("landed_steps")
    )
    status = (
        F.when(F.col("landed_steps") == F.col("steps"), "filled")
        .when(F.col("landed_steps") == 0, "zero_filled")
        .otherwise("partial")
    )
    return counted.withColumn("status", status)
