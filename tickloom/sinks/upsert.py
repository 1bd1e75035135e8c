"""Keyed upserts into day-partitioned Parquet: only the folders that new rows touch are read and written."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.columns import base_asset
from tickloom.functions.timecol import utc_date
from tickloom.plans.dedup import keep_one, others
from tickloom.plans.joins import join_on
from tickloom.sinks.publish import Files, finish_pending, replace_folders, replace_table
from tickloom.sources.datasets import ARRIVAL, SERIES, conform, dataset
from tickloom.sources.scan import table_path


def merge(stored: DataFrame, new: DataFrame, keys: Sequence[str], keep: str) -> DataFrame:
    """Stored and new rows with one row per key: the stored one if ``keep`` is first, else the new one.

    New rows that share a key are settled by the order in which they arrived, where landing has noted it; rows that it does
    not tell apart, by their other columns, so the result does not depend on chance.
    """
    columns = [c for c in stored.columns if c != ARRIVAL]
    arrived = [ARRIVAL] if ARRIVAL in new.columns else []
    old = stored.select(*columns).withColumns({"_side": F.lit(0)} | {c: F.lit(None).cast(new.schema[c].dataType) for c in arrived})
    both = old.unionByName(new.select(*columns, *arrived).withColumn("_side", F.lit(1)))
    return keep_one(both, keys, ["_side", *arrived, *others(stored.select(*columns), keys)], keep).select(*columns)


def with_folders(df: DataFrame) -> DataFrame:
    return df.withColumns({"base_asset": base_asset(F.col("symbol")), "date": utc_date(df, "time")})


def stored_rows(spark: SparkSession, path: str, folders: DataFrame, like: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of the given folders; none if nothing was stored yet.

    The days and venues of the folders also become a filter, which reaches the listing, so that other folders are not read.
    """
    if not Files(spark, path).exists(path):
        return spark.createDataFrame([], like.schema)
    bounds = folders.agg(F.min("date").alias("a"), F.max("date").alias("b"), *[F.collect_set(c).alias(c) for c in on[:2]], *[F.count_if(F.col(c).isNull()).alias(f"no_{c}") for c in on[:2]]).first()
    rows = spark.read.schema(like.schema).parquet(path)
    if bounds.a is not None:
        rows = rows.where(F.col("date").between(F.lit(bounds.a), F.lit(bounds.b)))
        for c in on[:2]:
            if not bounds[f"no_{c}"]:
                rows = rows.where(F.col(c).isin(bounds[c]))
    return join_on(rows, folders, on, "left_semi").select(*like.columns)


def upsert(new: DataFrame, root: str, data_type: str, keep: str | None = None, rows_per_file: int | None = None) -> None:
    """Adds rows to a stored dataset. Doing it twice changes nothing, and neither does a job that is lost on the way.

    Rows without a time cannot be filed and fail the job.
    """
    of = dataset(data_type)
    spark, path = new.sparkSession, table_path(root, data_type)
    finish_pending(spark, path)
    rows = with_folders(conform(new, of))
    rows = rows.withColumn("time", F.coalesce("time", F.raise_error(F.lit("a row has no time")).cast("timestamp")))
    stored = stored_rows(spark, path, rows.select(*of.folders).distinct(), rows.drop(ARRIVAL), of.folders)
    merged = merge(stored, rows, [*SERIES, *of.key], keep or of.keep)
    replace_folders(merged, path, of.folders, **({"rows_per_file": rows_per_file} if rows_per_file else {}))


def upsert_by_key(new: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Insert or update of a table without days, such as symbols: the new row wins."""
    finish_pending(new.sparkSession, path)
    rows = keep_one(new, keys, others(new, keys), "last")
    if Files(new.sparkSession, path).exists(path):
        rows = merge(new.sparkSession.read.schema(rows.schema).parquet(path), rows, keys, "last")
    replace_table(rows, path)
