"""Reading stored datasets. Every time range also becomes a predicate on the day folders, so that only they are read."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import UTC, date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.columns import equals, in_range, nan_to_null
from tickloom.sources.datasets import SERIES, Dataset, dataset
from tickloom.sources.files import file_columns, stored_files, storage_sizes  # noqa: F401


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{dataset(name).name}"


def _instant(value: str | datetime) -> datetime:
    """A moment in UTC; one without a zone is meant as UTC."""
    at = datetime.fromisoformat(value) if isinstance(value, str) else value
    return at.replace(tzinfo=UTC) if at.tzinfo is None else at.astimezone(UTC)


def _stored_schema(of: Dataset) -> T.StructType:
    inside = [f for f in of.schema.fields if f.name not in of.folders]
    folders = [T.StructField(p, T.DateType() if p == "date" else T.StringType()) for p in of.folders]
    return T.StructType(inside + folders)


def scan(
    spark: SparkSession,
    root: str,
    data_type: str,
    start: str | datetime | None = None,
    end: str | datetime | None = None,
    exchange: str | None = None,
    symbol: str | None = None,
    instrument_type: str | None = None,
    timeframe: str | None = None,
    ordered: bool = False,
    days: Sequence[tuple[date, date]] | None = None,
) -> DataFrame:
    """Rows of a dataset with start <= time < end; NaN is null.

    Without ``end`` the range is open. The dataset's schema is enforced, and the filters on venue, market type, asset,
    width and day reach the folders. ``ordered`` sorts by series and time: rows are dealt out in ranges of these and
    sorted where they land, so what is collected or written comes in order. Otherwise rows have no order. ``days`` are
    stretches (first, last) of days to read.
    """
    of = dataset(data_type)
    rows = spark.read.schema(_stored_schema(of)).parquet(table_path(root, data_type))
    rows = rows.where(equals(exchange=exchange, instrument_type=instrument_type, symbol=symbol))
    if symbol is not None:
        rows = rows.where(F.col("base_asset") == symbol.split("/")[0])
    if timeframe is not None and "timeframe" in rows.columns:
        rows = rows.where(F.col("timeframe") == timeframe)
    start, end = (None if at is None else _instant(at) for at in (start, end))
    rows = rows.where(in_range("time", start, end))
    if start is not None:
        rows = rows.where(F.col("date") >= F.lit(start.date()))
    if end is not None:
        rows = rows.where(F.col("date") <= F.lit(end.date()))
    if days is not None:
        rows = rows.where(reduce(lambda a, b: a | b, [F.col("date").between(F.lit(a), F.lit(b)) for a, b in days], F.lit(False)))
    rows = nan_to_null(rows.select(*[f.name for f in of.schema.fields]))
    if not ordered:
        return rows
    # The rest of the key settles rows of one time; what it leaves has no order to keep.
    return rows.orderBy(*SERIES, "time", *[k for k in of.key if k != "time"])


def get_ohlcv(spark: SparkSession, root: str, timeframe: str = "1m", **where) -> DataFrame:
    return scan(spark, root, "ohlcv", timeframe=timeframe, **where)


def get_tick_data(spark: SparkSession, root: str, **where) -> DataFrame:
    return scan(spark, root, "trades", **where)


def get_funding_rates(spark: SparkSession, root: str, **where) -> DataFrame:
    return scan(spark, root, "fundingRate", **where)


def get_book_depth(spark: SparkSession, root: str, **where) -> DataFrame:
    return scan(spark, root, "bookDepth", **where)


def get_index_price_klines(spark: SparkSession, root: str, timeframe: str = "1m", **where) -> DataFrame:
    return scan(spark, root, "indexPriceKlines", timeframe=timeframe, **where)


def get_mark_price_klines(spark: SparkSession, root: str, timeframe: str = "1m", **where) -> DataFrame:
    return scan(spark, root, "markPriceKlines", timeframe=timeframe, **where)


def get_premium_index_klines(spark: SparkSession, root: str, timeframe: str = "1m", **where) -> DataFrame:
    return scan(spark, root, "premiumIndexKlines", timeframe=timeframe, **where)


def get_metrics(spark: SparkSession, root: str, **where) -> DataFrame:
    return scan(spark, root, "metrics", **where)


def get_aggregated(spark: SparkSession, root: str, timeframe: str = "1m", **where) -> DataFrame:
    return scan(spark, root, "aggregated", timeframe=timeframe, **where)


def get_synthetic(spark: SparkSession, root: str, timeframe: str = "1m", **where) -> DataFrame:
    return scan(spark, root, "synthetic", timeframe=timeframe, **where)


def _roots(roots: str | Mapping[str, str]) -> dict[str, str]:
    return {"": roots} if isinstance(roots, str) else dict(roots)


def _of_all(roots: str | Mapping[str, str], data_types: list[str], part) -> DataFrame:
    """The union of `part(root, data type)` over stores and datasets, with the store's name where several were given."""
    frames = []
    for store, root in _roots(roots).items():
        for name in data_types:
            frame = part(root, name)
            frames.append(frame if isinstance(roots, str) else frame.select(F.lit(store).alias("store"), "*"))
    return reduce(DataFrame.unionByName, frames)


def scan_stores(spark: SparkSession, roots: Mapping[str, str], data_type: str, **where) -> DataFrame:
    """Rows of a dataset from several stores {name: root}, with the name of the store each comes from."""
    return _of_all(roots, [data_type], lambda root, name: scan(spark, root, name, **where))


def inventory(spark: SparkSession, roots: str | Mapping[str, str], data_types: list[str], deep: bool = False) -> DataFrame:
    """One row per stored series: its first and last day and how many days, or rows if ``deep``, it has.

    The shallow form knows files and folders only. ``category`` is the width of candles, else the dataset. Several stores
    {name: root} give a row for each of them, with its name.
    """

    def part(root: str, name: str) -> DataFrame:
        of = dataset(name)
        rows = spark.read.schema(_stored_schema(of)).parquet(table_path(root, name)) if deep else stored_files(spark, root, name)
        category = F.col("timeframe") if "timeframe" in of.folders else F.lit(of.name)
        keys = [*SERIES, "base_asset"] if deep else ["exchange", "instrument_type", "base_asset"]
        count = F.count(F.lit(1)) if deep else F.countDistinct("date")
        return rows.groupBy(*keys, category.alias("category")).agg(F.min("date").alias("start_date"), F.max("date").alias("end_date"), count.alias("count"))

    return _of_all(roots, data_types, part)


def schema_report(spark: SparkSession, roots: str | Mapping[str, str], data_types: list[str]) -> DataFrame:
    """A row per store, dataset, venue, column and type, with how many files have it so and on which days.

    ``drifts`` tells columns that some files of the venue have in another type or not at all; ``sample`` is the column's
    value in the venue's first row by time. Only footers are read, and for the samples the first day of each venue.
    """

    def part(root: str, name: str) -> DataFrame:
        files = stored_files(spark, root, name).select("data_type", "exchange", "date", "path")
        total = files.groupBy(F.col("exchange").alias("_venue")).agg(F.count(F.lit(1)).alias("_files"), F.min("date").alias("_first"))
        columns = file_columns(files).groupBy("data_type", "exchange", "column", "type").agg(
            F.count(F.lit(1)).alias("files"), F.min("date").alias("first_day"), F.max("date").alias("last_day"), F.min("position").alias("position")
        )
        told = columns.join(total, F.col("exchange").eqNullSafe(F.col("_venue"))).withColumn("drifts", F.col("files") < F.col("_files"))
        rows = spark.read.schema(_stored_schema(dataset(name))).parquet(table_path(root, name)) if _roots_hold(spark, root, name) else None
        if rows is None:
            return told.select("data_type", "exchange", "column", "type", "position", "files", "first_day", "last_day", "drifts", F.lit(None).cast("string").alias("sample"))
        first = total.select(F.col("_venue").alias("_v"), "_first")
        early = rows.join(F.broadcast(first), F.col("exchange").eqNullSafe(F.col("_v")) & (F.col("date") == F.col("_first")))  # a row per venue
        texts = F.create_map(*[x for c in rows.columns for x in (F.lit(c), F.col(c).cast("string"))])
        key = F.struct("time", *[c for c in ("symbol", "instrument_type") if c in rows.columns])
        samples = early.groupBy(F.col("exchange").alias("_v")).agg(F.min_by(texts, key).alias("_sample"))
        return told.join(samples, F.col("exchange").eqNullSafe(F.col("_v")), "left").select(
            "data_type", "exchange", "column", "type", "position", "files", "first_day", "last_day", "drifts", F.col("_sample")[F.col("column")].alias("sample")
        )

    return _of_all(roots, data_types, part)


def _roots_hold(spark: SparkSession, root: str, name: str) -> bool:
    return stored_files(spark, root, name).head(1) != []
