"""Repeatable jobs over the stored layout. Each works on the days it has no output for, or on all with ``rewrite``."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.functions.columns import base_asset, nan_to_null, to_bool, to_id
from tickloom.functions.timecol import from_micros, is_ntz, to_micros, utc_date
from tickloom.operators import bars, intervals, market, quality, sliding
from tickloom.plans.joins import join_on
from tickloom.sinks.publish import finish_pending, replace_folders
from tickloom.sinks.upsert import upsert, upsert_by_key
from tickloom.sources import files, land, scan
from tickloom.sources.datasets import OFFERED, SERIES, dataset
from tickloom.timeframe import parse

SLIDING_FOLDERS = ("asset", "config", "date")


def _days(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*keys, utc_date(df, "time").alias("date")).distinct()


def _pending(source: DataFrame, done: DataFrame | None, keys: Sequence[str], rewrite: bool) -> DataFrame:
    """Days of the source without output, by the given keys."""
    days = _days(source, keys)
    return days if rewrite or done is None else intervals.pending_days(days, _days(done, keys), [*keys, "date"])


def _stored(spark: SparkSession, root: str, name: str, **where) -> DataFrame | None:
    try:
        return scan.scan(spark, root, name, **where)
    except Exception as error:
        if "PATH_NOT_FOUND" in str(error):
            return None
        raise


def _of_assets(df: DataFrame, assets: Sequence[str] | None) -> DataFrame:
    return df if assets is None else df.where(base_asset(F.col("symbol")).isin(*assets))


def aggregate_ohlcv(
    spark: SparkSession, root: str, rewrite: bool = False, assets: Sequence[str] | None = None, timeframe: str = "1m", start=None, end=None
) -> None:
    """Candles of all venues become one series per market type and asset."""
    source = _of_assets(scan.scan(spark, root, "ohlcv", start=start, end=end, timeframe=timeframe), assets)
    source = source.withColumn("base", base_asset(F.col("symbol")))
    done = _stored(spark, root, "aggregated", start=start, end=end)
    by_asset = source.withColumn("symbol", F.col("base"))
    pending = _pending(by_asset, done, ["instrument_type", "symbol"], rewrite).withColumnRenamed("symbol", "base")
    wanted = join_on(source.withColumn("date", utc_date(source, "time")), pending, ["instrument_type", "base", "date"], "left_semi")
    merged = market.aggregate_exchanges(market.normalise_inverse_volume(wanted), asset="base", timeframe=timeframe)
    upsert(merged, root, "aggregated")


def create_synthetic_ohlcv(spark: SparkSession, root: str, rewrite: bool = False, assets: Sequence[str] | None = None, timeframe: str = "1m", start=None, end=None) -> None:
    """Spot and swap become one series per asset."""
    source = _of_assets(scan.scan(spark, root, "aggregated", start=start, end=end, timeframe=timeframe), assets)
    pending = _pending(source, _stored(spark, root, "synthetic", start=start, end=end), ["symbol"], rewrite)
    wanted = join_on(source.withColumn("date", utc_date(source, "time")), pending, ["symbol", "date"], "left_semi")
    upsert(market.synthesize(wanted, timeframe=timeframe), root, "synthetic")


def resample_ohlcv(spark: SparkSession, root: str, timeframes: Sequence[str], rewrite: bool = False, assets: Sequence[str] | None = None) -> None:
    """Coarser bars of the synthetic series. Bars count from the start of a year, so a year with new days is done anew."""
    source = _of_assets(scan.scan(spark, root, "synthetic"), assets)
    done = _stored(spark, root, "resampled")
    years = lambda df: _days(df, ["symbol"]).select("symbol", F.year("date").alias("year"), "date")
    wanted = years(source)
    if not rewrite and done is not None:
        wanted = join_on(wanted, years(done), ["symbol", "year", "date"], "left_anti")
    wanted = wanted.select("symbol", "year").distinct()
    rows = join_on(source.withColumn("year", F.year(utc_date(source, "time"))), wanted, ["symbol", "year"], "left_semi")
    coarse = bars.resample(rows.drop("timeframe", "exchange", "instrument_type", "year"), timeframes, distinct=True)
    coarse = coarse.withColumns({"exchange": F.lit(market.AGGREGATED), "instrument_type": F.lit("synthetic")})
    upsert(coarse, root, "resampled")


#: Separate stretches of days that a scan is filtered by; more of them are read as one.
_STRETCHES = 50


def _stretches(days: Sequence[date]) -> list[tuple[date, date]]:
    """Runs of consecutive days, or the first and last of all if there are too many runs."""
    runs: list[tuple[date, date]] = []
    for day in sorted(days):
        if runs and day - runs[-1][1] <= timedelta(days=1):
            runs[-1] = (runs[-1][0], day)
        else:
            runs.append((day, day))
    return runs if len(runs) <= _STRETCHES else [(runs[0][0], runs[-1][1])]


def sliding_inputs(spark: SparkSession, root: str, path: str, config: str, intervals_: Sequence[str], assets: Sequence[str] | None = None, rewrite: bool = False) -> tuple[DataFrame, DataFrame]:
    """The days (base_asset, date) without output, and the candles that their windows reach.

    Both come from file names. A window reaches back over its length; before that, the last day with candles tells what
    the first minutes carry on from. The days become a filter on the folders.
    """
    longest = max(parse(i).minutes for i in intervals_)
    reach = -(-longest // 1440)
    have = files.stored_files(spark, root, "synthetic").select("base_asset", "date").distinct()
    if assets is not None:
        have = have.where(F.col("base_asset").isin(*assets))
    pending = have
    if not rewrite:
        done = files.listed(spark, path, SLIDING_FOLDERS).where(F.col("config") == config).select(F.col("asset").alias("base_asset"), "date").distinct()
        pending = join_on(have, done, ["base_asset", "date"], "left_anti")
    back = F.explode(F.sequence(F.lit(0), F.lit(reach)))
    near = pending.withColumn("_n", back).select("base_asset", F.date_sub("date", F.col("_n")).alias("date"))
    # The last day with candles before each window: one row per series and day, in order.
    edges = pending.select("base_asset", F.date_sub("date", reach).alias("date"), F.lit(None).cast("date").alias("_day"))
    along = Window.partitionBy("base_asset").orderBy("date", F.col("_day").isNotNull()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = have.withColumn("_day", F.col("date")).unionByName(edges).withColumn("_last", F.last("_day", ignorenulls=True).over(along))
    seeds = before.where("_day is null and _last is not null").select("base_asset", F.col("_last").alias("date"))
    needed = join_on(near.unionByName(seeds).distinct(), have, ["base_asset", "date"], "left_semi")
    spans = _stretches([r.date for r in needed.select("date").distinct().collect()])  # calendar days, however many series
    source = _of_assets(scan.scan(spark, root, "synthetic", days=spans), assets)
    source = source.withColumns({"base_asset": base_asset(F.col("symbol")), "date": utc_date(source, "time")})
    return pending, join_on(source, needed, ["base_asset", "date"], "left_semi").drop("base_asset", "date")


def create_sliding_dataset(
    spark: SparkSession, root: str, config: str, intervals_: Sequence[str] = sliding.INTERVALS, features: Sequence[str] = sliding.FEATURES,
    assets: Sequence[str] | None = None, rewrite: bool = False,
) -> str:
    """Feature arrays of every minute, one folder per asset, config and day; returns their path.

    Days that have output are left, and of the history only what the windows of the other days reach is read.
    """
    path = f"{root.rstrip('/')}/sliding"
    finish_pending(spark, path)
    pending, source = sliding_inputs(spark, root, path, config, intervals_, assets, rewrite)
    table = sliding.sliding_features(source, intervals_, features)
    out = table.select(F.col("symbol").alias("asset"), F.lit(config).alias("config"), utc_date(table, "time").alias("date"), "time", "features")
    wanted = pending.select(F.col("base_asset").alias("asset"), "date")
    out = join_on(out.withColumn("_base", base_asset(F.col("asset"))), wanted.withColumnRenamed("asset", "_base"), ["_base", "date"], "left_semi").drop("_base")
    replace_folders(out, path, SLIDING_FOLDERS)
    return path


def not_served(rows: DataFrame, served: DataFrame | None, tolerance_seconds: int = 3_600) -> DataFrame:
    """Rows of the days of a series that the serving store does not hold from their first row to their last."""
    if served is None:
        return rows
    us = to_micros(rows, "time")
    dated = rows.withColumn("_day", utc_date(rows, "time"))
    spans = dated.groupBy(*SERIES, "_day").agg(F.min(us).alias("_a"), F.max(us).alias("_b"))
    ntz = is_ntz(rows, "time")
    requests = spans.select(*SERIES, "_day", from_micros(F.col("_a"), ntz).alias("start_ts"), from_micros(F.col("_b") + 1, ntz).alias("end_ts"))
    told = quality.has_data(served, requests, SERIES, tolerance_seconds).where("has_data")
    done = told.select(*SERIES, utc_date(told, "start_ts").alias("_day")).distinct()
    return join_on(dated, done, [*SERIES, "_day"], "left_anti").drop("_day")


def load_serving(spark: SparkSession, root: str, serving_root: str, data_type: str, start=None, end=None, again: bool = False) -> None:
    """A range of a dataset, cleaned, into the serving tables. Candles are served from their own table and refused here.

    Days that are served already, to within an hour of their first and last row, are skipped unless ``again``.
    """
    of = dataset(data_type)
    if of.name == "ohlcv":
        raise ValueError("candles are not loaded into the serving tables")
    rows = nan_to_null(scan.scan(spark, root, data_type, start=start, end=end))
    if not again:
        rows = not_served(rows, _stored(spark, serving_root, data_type, start=start, end=end))
    kinds = {f.name: f.dataType.simpleString() for f in of.schema.fields}
    booleans = {c: to_bool(F.col(c)) for c, k in kinds.items() if k == "boolean"}
    ids = {c: to_id(F.col(c)) for c, k in kinds.items() if k == "bigint" and c.endswith("_id")}
    upsert(rows.withColumns(booleans | ids), serving_root, data_type, keep="last")


def backfill(
    rows: DataFrame, root: str, data_type: str, coverage: DataFrame | None = None, start=None, end=None, timeframe: str = "1m", asked: DataFrame | None = None
) -> DataFrame:
    """Stores landed rows of a range and returns the coverage after it, which only rows that were seen add to.

    Rows of a market type for which the vendor has no such files are not landed. ``asked`` are the ranges that the landing
    was to fill; where they have no rows, coverage says so.
    """
    of = dataset(data_type)
    if of.vendor:
        kinds = [kind for kind, names in OFFERED.items() if of.name in names]
        rows = rows.where(F.col("instrument_type").isin(kinds))
    if start is not None:
        rows = rows.where(F.col("time") >= F.lit(start))
    if end is not None:
        rows = rows.where(F.col("time") < F.lit(end))
    upsert(rows, root, data_type)
    if coverage is None:
        coverage = intervals.rebuild_coverage(rows, timeframe, SERIES).limit(0)
    return intervals.advance_coverage(coverage, rows, timeframe, SERIES, asked)


def sync_metadata(answers: DataFrame, path: str) -> None:
    """Markets of landed exchange answers into the symbols table; the new row wins."""
    upsert_by_key(land.flatten_markets(answers), path, ["exchange_id", "symbol"])


def quality_report(spark: SparkSession, root: str) -> DataFrame:
    """Candles and trades of the whole store in one report."""
    candles = quality.ohlcv_quality(scan.scan(spark, root, "ohlcv"))
    trades = _stored(spark, root, "trades")
    if trades is None:
        trades = spark.createDataFrame([], dataset("trades").schema)
    return quality.quality_summary(candles, quality.tick_quality_gaps(trades))


def regenerate(spark: SparkSession, root: str, timeframes: Sequence[str]) -> None:
    """All derived candles anew: venues, then markets, then coarser bars."""
    aggregate_ohlcv(spark, root, rewrite=True)
    create_synthetic_ohlcv(spark, root, rewrite=True)
    resample_ohlcv(spark, root, timeframes, rewrite=True)
