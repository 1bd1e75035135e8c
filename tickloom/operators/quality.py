"""Data-quality reports. Each report covers all series in one job, one row per series.

Gap lists can be long, so they are rows of their own (:func:`gap_report`), never an array.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.columns import candle_is_anomalous
from tickloom.functions.timecol import (
    bar_start,
    day_number,
    from_micros,
    is_ntz,
    seconds_between,
    to_micros,
    utc_date,
    whole_div,
)
from tickloom.operators.sequence import (
    SERIES,
    alignment_score,
    candle_gaps,
    explode_steps,
    with_continuity,
)
from tickloom.plans.chunked import CHUNK, MINUTE_US, day_chunks, previous_row
from tickloom.plans.dedup import keep_one
from tickloom.plans.joins import join_on
from tickloom.timeframe import micros_of, parse

TICK_SERIES = ("exchange", "instrument_type", "symbol")
HOUR = "1h"


def _mean(name: str) -> Column:
    return F.try_divide(F.sum(name).cast("double"), F.count(name))


def candle_stats(candles: DataFrame, keys: Sequence[str]) -> DataFrame:
    return candles.groupBy(*keys).agg(*_candle_figures())


def _candle_figures() -> list[Column]:
    return [
        F.min("low").alias("price_min"),
        F.max("high").alias("price_max"),
        _mean("close").alias("price_avg"),
        F.sum("volume").cast("double").alias("volume_total"),
        _mean("volume").alias("volume_avg"),
        F.min("volume").alias("volume_min"),
        F.max("volume").alias("volume_max"),
    ]


def ohlcv_quality(
    candles: DataFrame,
    keys: Sequence[str] = SERIES,
    timeframe: str | None = None,
    order: Sequence[str] | None = None,
) -> DataFrame:
    """Completeness, gaps, alignment, anomalies and figures of each candle series.

    Bar widths come from ``timeframe`` or, without it, from the ``timeframe`` column, so series
    of different widths share the job. ``order`` removes repeated times first (first wins).
    """
    if order is not None:
        candles = keep_one(candles, [*keys, "time"], order, "first")
    width = F.lit(parse(timeframe).micros) if timeframe else micros_of(F.col("timeframe"))
    judged = with_continuity(candles, keys, width)
    gap_us = F.when(F.col("_is_gap"), F.col("_us") - F.col("_before"))
    rows = F.count(F.lit(1))
    report = judged.groupBy(*keys).agg(
        F.min("time").alias("start_date"),
        F.max("time").alias("end_date"),
        rows.alias("total_rows"),
        (whole_div(F.max("_us") - F.min("_us"), F.max("_tf")) + 1).alias("expected_rows"),
        F.count_if("_is_gap").alias("gap_count"),
        (F.coalesce(F.sum(gap_us), F.lit(0)) / F.lit(1_000_000.0)).alias("gap_seconds"),
        F.count_if("_consecutive").alias("consecutive"),
        F.count_if("_aligned").alias("aligned"),
        F.count_if(candle_is_anomalous()).alias("anomalies"),
        *_candle_figures(),
    )
    completeness = F.col("total_rows") / F.col("expected_rows") * F.lit(100.0)
    cleanliness = F.greatest(F.lit(0), F.lit(100) - F.col("anomalies"))
    return (
        report.withColumn("missing_rows", F.col("expected_rows") - F.col("total_rows"))
        .withColumn("alignment_score", alignment_score())
        .withColumn(
            "quality_score",
            completeness * F.lit(0.5)
            + F.col("alignment_score") * F.lit(0.3)
            + cleanliness * F.lit(0.2),
        )
    )


def gap_report(candles: DataFrame, keys: Sequence[str] = SERIES, timeframe: str | None = None) -> DataFrame:
    """Every gap of every candle series, as work for the gap filler."""
    return candle_gaps(candles, timeframe, keys)


def coverage_summary(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.min("time").alias("start_date"),
        F.max("time").alias("end_date"),
        F.count(F.lit(1)).alias("count"),
    )


def has_data(
    df: DataFrame, requests: DataFrame, keys: Sequence[str], tolerance_seconds: int = 3_600
) -> DataFrame:
    """Whether stored rows reach within the tolerance of both ends of each request.

    Requests and rows meet on (series, day), with the rows cut down to the first and last of
    each day; on the edge days of a request, to those of each minute.
    """
    ntz = is_ntz(df, "time")
    asked = requests.select(
        *keys,
        to_micros(requests, "start_ts").alias("_rs"),
        to_micros(requests, "end_ts").alias("_re"),
    ).distinct()
    first_day, last_day = day_number(F.col("_rs")), day_number(F.col("_re") - F.lit(1))
    by_day = asked.withColumn("_day", F.explode(F.sequence(first_day, last_day)))
    edge = (F.col("_day") == first_day) | (F.col("_day") == last_day)
    us = to_micros(df, "time")
    rows = df.select(*keys, us.alias("_us"), whole_div(us, MINUTE_US).alias("_minute"))
    # Minutes first: a request meets one row per minute of its edge days, and single rows only in
    # the minutes that hold its ends.
    minutes = rows.groupBy(*keys, "_minute").agg(F.min("_us").alias("_lo"), F.max("_us").alias("_hi"))
    minutes = minutes.withColumn("_day", day_number(F.col("_lo")))
    request = [*keys, "_rs", "_re"]
    inner_days = minutes.groupBy(*keys, "_day").agg(F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"))
    inner = join_on(by_day.where(~edge), inner_days, [*keys, "_day"]).select(*request, "_lo", "_hi")
    whole = join_on(by_day.where(edge), minutes, [*keys, "_day"]).where("_lo >= _rs AND _hi < _re")
    ends = F.array_distinct(F.array(*[whole_div(c, MINUTE_US) for c in (F.col("_rs"), F.col("_re") - F.lit(1))]))
    at_ends = join_on(asked.withColumn("_minute", F.explode(ends)), rows, [*keys, "_minute"])
    at_ends = at_ends.where("_us >= _rs AND _us < _re")
    outer = whole.select(*request, "_lo", "_hi").unionByName(
        at_ends.select(*request, F.col("_us").alias("_lo"), F.col("_us").alias("_hi"))
    )
    found = inner.unionByName(outer).groupBy(*request).agg(
        F.min("_lo").alias("_first"), F.max("_hi").alias("_last")
    )
    slack = F.lit(tolerance_seconds * 1_000_000)
    covered = (F.col("_first") <= F.col("_rs") + slack) & (F.col("_last") >= F.col("_re") - slack)
    return join_on(asked, found, request, "left").select(
        *keys,
        from_micros(F.col("_rs"), ntz).alias("start_ts"),
        from_micros(F.col("_re"), ntz).alias("end_ts"),
        F.coalesce(covered, F.lit(False)).alias("has_data"),
    )


def bucket_counts(ticks: DataFrame, keys: Sequence[str], width: str = HOUR) -> DataFrame:
    """Rows per clock bucket that has any: ``_bucket`` in microseconds and ``n``."""
    bucket = bar_start(to_micros(ticks, "time"), parse(width))
    return ticks.groupBy(*keys, bucket.alias("_bucket")).agg(F.count(F.lit(1)).alias("n"))


def _with_previous_bucket(counts: DataFrame, keys: Sequence[str], ntz: bool) -> DataFrame:
    timed = counts.withColumn("time", from_micros(F.col("_bucket"), ntz))
    carried = {"_before": F.col("_bucket")}
    return previous_row(day_chunks(timed), keys, ["time"], carried).drop(CHUNK, "time")


def bucket_counts_fill0(ticks: DataFrame, keys: Sequence[str], width: str = HOUR) -> DataFrame:
    """Rows per clock bucket from the first to the last of a series, zeros included."""
    step = parse(width).micros
    ntz = is_ntz(ticks, "time")
    seen = _with_previous_bucket(bucket_counts(ticks, keys, width), keys, ntz)
    first = F.coalesce(F.col("_before") + F.lit(step), F.col("_bucket"))
    filled = explode_steps(seen, first, F.col("_bucket") + F.lit(1), step, "_at")
    return filled.select(
        *keys,
        from_micros(F.col("_at"), ntz).alias("bucket"),
        F.when(F.col("_at") == F.col("_bucket"), F.col("n")).otherwise(F.lit(0)).alias("n"),
    )


def empty_bucket_gaps(ticks: DataFrame, keys: Sequence[str], width: str = HOUR) -> DataFrame:
    """Runs of empty clock buckets. Two neighbouring filled buckets bound each run."""
    step = parse(width).micros
    ntz = is_ntz(ticks, "time")
    seen = _with_previous_bucket(bucket_counts(ticks, keys, width), keys, ntz)
    start = F.col("_before") + F.lit(step)
    return seen.where(start < F.col("_bucket")).select(
        *keys,
        from_micros(start, ntz).alias("gap_start"),
        from_micros(F.col("_bucket"), ntz).alias("gap_end"),
        seconds_between(start, F.col("_bucket")).alias("gap_seconds"),
    )


def daily_breakdown(ticks: DataFrame, keys: Sequence[str]) -> DataFrame:
    return ticks.groupBy(*keys, utc_date(ticks, "time").alias("date")).agg(
        F.count(F.lit(1)).alias("count"),
        F.min("time").alias("min_time"),
        F.max("time").alias("max_time"),
    )


def tick_quality_days(ticks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Days found against days expected between the first and the last."""
    days = daily_breakdown(ticks, keys)
    report = days.groupBy(*keys).agg(
        F.min("date").alias("start_date"),
        F.max("date").alias("end_date"),
        F.count(F.lit(1)).alias("total_days"),
        (F.date_diff(F.max("date"), F.min("date")) + 1).alias("expected_days"),
        F.sum("count").alias("total_rows"),
    )
    return report.withColumns(
        {
            "missing_days": F.col("expected_days") - F.col("total_days"),
            "quality_score": F.col("total_days") / F.col("expected_days") * F.lit(100.0),
        }
    )


def bucket_partials(ticks: DataFrame, keys: Sequence[str], width: str = HOUR) -> DataFrame:
    """One row per series and clock bucket with figures that add up: the only pass over trades."""
    qty = "qty" if "qty" in ticks.columns else "amount"
    bucket = bar_start(to_micros(ticks, "time"), parse(width))
    sides = {"buys": False, "sells": True}
    known = "is_buyer_maker" in ticks.columns
    return ticks.groupBy(*keys, bucket.alias("_bucket")).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("time").alias("min_time"),
        F.max("time").alias("max_time"),
        F.sum(qty).alias("qty"),
        F.count(qty).alias("qty_n"),
        F.sum("price").alias("price"),
        F.count("price").alias("price_n"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        *[
            (F.count_if(F.col("is_buyer_maker") == maker) if known else F.lit(None).cast("long")).alias(side)
            for side, maker in sides.items()
        ],
    )


def tick_quality_gaps(
    ticks: DataFrame, keys: Sequence[str] = TICK_SERIES, width: str = HOUR, data_type: str = "trades"
) -> DataFrame:
    """Share of the time span not lost to empty buckets, with volume, price and side figures.

    All of it comes from one pass: the figures of a series are those of its buckets put
    together. Without ``is_buyer_maker`` the side figures are null.
    """
    step = parse(width).micros
    ntz = is_ntz(ticks, "time")
    seen = _with_previous_bucket(bucket_partials(ticks, keys, width), keys, ntz)
    lost = F.col("_bucket") - F.col("_before") - F.lit(step)
    report = seen.groupBy(*keys).agg(
        F.min("min_time").alias("start_date"),
        F.max("max_time").alias("end_date"),
        F.sum("n").alias("total_rows"),
        F.count_if(lost > 0).alias("gap_count"),
        (F.coalesce(F.sum(F.when(lost > 0, lost)), F.lit(0)) / F.lit(1_000_000.0)).alias("gap_seconds"),
        F.sum("qty").alias("total_volume"),
        F.try_divide(F.sum("qty").cast("double"), F.sum("qty_n")).alias("avg_trade_size"),
        F.min("min_price").alias("min_price"),
        F.max("max_price").alias("max_price"),
        F.try_divide(F.sum("price").cast("double"), F.sum("price_n")).alias("avg_price"),
        F.sum("n").alias("trades"),
        F.sum("buys").alias("buys"),
        F.sum("sells").alias("sells"),
    )
    sides = F.col("buys") + F.col("sells")
    total = seconds_between(to_micros(report, "start_date"), to_micros(report, "end_date"))
    score = F.when(
        total > 0,
        F.greatest(F.lit(0.0), F.lit(100.0) * (F.lit(1.0) - F.col("gap_seconds") / total)),
    ).otherwise(F.lit(100.0))
    return report.withColumns(
        {
            "buy_ratio": F.try_divide(F.col("buys"), sides),
            "sell_ratio": F.try_divide(F.col("sells"), sides),
            "quality_score": score,
            "data_type": F.lit(data_type),
        }
    )


def quality_summary(candle_report: DataFrame, tick_report: DataFrame) -> DataFrame:
    """Candle and trade reports in one table, grouped by venue, then by data type and symbol."""
    candles = candle_report.select(
        "exchange",
        "instrument_type",
        "symbol",
        F.lit("ohlcv").alias("data_type"),
        "timeframe",
        "start_date",
        "end_date",
        "total_rows",
        "quality_score",
        F.col("volume_total").cast("double").alias("volume_total"),
        F.col("price_min").cast("double").alias("price_min"),
        F.col("price_max").cast("double").alias("price_max"),
        F.lit(None).cast("long").alias("trades"),
        F.lit(None).cast("double").alias("buy_ratio"),
        F.lit(None).cast("double").alias("sell_ratio"),
        "gap_count",
        "gap_seconds",
    )
    ticks = tick_report.select(
        "exchange",
        "instrument_type",
        "symbol",
        "data_type",
        F.lit(None).cast("string").alias("timeframe"),
        "start_date",
        "end_date",
        "total_rows",
        "quality_score",
        F.col("total_volume").cast("double").alias("volume_total"),
        F.col("min_price").cast("double").alias("price_min"),
        F.col("max_price").cast("double").alias("price_max"),
        "trades",
        "buy_ratio",
        "sell_ratio",
        "gap_count",
        "gap_seconds",
    )
    return candles.unionByName(ticks).orderBy("exchange", "instrument_type", "data_type", "symbol")


def _first_of_each(rows: DataFrame, keys: Sequence[str], order: Sequence[Column], most: int, name: str) -> DataFrame:
    """(keys, name, more_name): the first `most` rows of each series as an array in that order, and how many are left out.

    The rank limits rows before they are shuffled, so an array never holds more than `most`.
    """
    inside = [c for c in rows.columns if c not in keys]
    ranked = rows.withColumn("_place", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_place") <= most)
    listed = ranked.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_place", *inside))).alias("_rows"))
    whole = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_all"))
    bare = F.transform("_rows", lambda r: F.struct(*[r[c].alias(c) for c in inside]))
    return join_on(listed, whole, keys).select(*keys, bare.alias(name), (F.col("_all") - F.size("_rows")).alias(f"more_{name}"))


def with_details(
    report: DataFrame, gaps: DataFrame, days: DataFrame, keys: Sequence[str] = SERIES, schemas: DataFrame | None = None, most_gaps: int = 20, most_days: int = 31
) -> DataFrame:
    """A report with its details in each series' row: the longest gaps, the last days with their counts, and the columns.

    `gaps` has gap_seconds and gap_start, `days` has date, `schemas` (keys of the venue, column, type, position). What an
    array leaves out is counted; `gaps` and `days` remain as tables of their own.
    """
    parts = [(gaps, (F.desc("gap_seconds"), F.asc("gap_start")), most_gaps, "gaps"), (days, (F.desc("date"),), most_days, "days")]
    for rows, order, most, name in parts:
        report = join_on(report, _first_of_each(rows, keys, order, most, name), keys, "left")
        report = report.withColumns({name: F.coalesce(name, F.array()), f"more_{name}": F.coalesce(f"more_{name}", F.lit(0))})
    if schemas is not None:
        venue = [k for k in keys if k in schemas.columns]
        columns = schemas.groupBy(*venue).agg(F.array_sort(F.collect_set(F.struct("position", "column", "type"))).alias("columns"))
        report = join_on(report, columns, venue, "left")
    return report
