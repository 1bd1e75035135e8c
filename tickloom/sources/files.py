"""What a store holds, told by its files alone: names, sizes and footers."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.sources.datasets import dataset

#: What a folder without a value is called.
_NULL = "__HIVE_DEFAULT_PARTITION__"


def _folder(name: str) -> Column:
    """The value that a file's path gives a folder level; null where it has none."""
    text = F.regexp_extract("path", f"/{name}=([^/]*)/", 1)
    decoded = F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))
    return F.when((text != "") & (text != _NULL), decoded)


def listed(spark: SparkSession, path: str, folders: Sequence[str]) -> DataFrame:
    """A row per Parquet file below a path: path, size, changed and the values of its folders; no data is read.

    Spark lists the folders in tasks where there are many. A path that does not exist has no files.
    """
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        files = spark.createDataFrame([], "path string, modificationTime timestamp, length long")
    values = [_folder(f).cast("date" if f == "date" else "string").alias(f) for f in folders]
    return files.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("changed"), *values)


def stored_files(spark: SparkSession, root: str, data_type: str) -> DataFrame:
    """A row per file of a stored dataset, with its size and folders."""
    of = dataset(data_type)
    return listed(spark, f"{root.rstrip('/')}/{of.name}", of.folders).withColumn("data_type", F.lit(of.name))


def storage_sizes(spark: SparkSession, root: str, data_type: str) -> DataFrame:
    """Files and megabytes of each venue, market type and asset, and the mean per day."""
    megabytes = F.sum("size") / F.lit(1e6)
    return stored_files(spark, root, data_type).groupBy("exchange", "instrument_type", "base_asset").agg(
        F.count(F.lit(1)).alias("files"), megabytes.alias("megabytes"), (megabytes / F.countDistinct("date")).alias("megabytes_per_day")
    )


def stored_days(spark: SparkSession, root: str, data_type: str) -> DataFrame:
    """The days of each venue, market type, asset and width that have files."""
    folders = dataset(data_type).folders
    return stored_files(spark, root, data_type).select(*folders).distinct()


def file_columns(files: DataFrame) -> DataFrame:
    """The columns and types of each file (path, ...), from its footer alone: adds `position`, `column` and `type`.

    Footers are read in tasks, by the file systems that Arrow knows. Types are Arrow's, so files of other writers show what
    they hold rather than what a reader would make of it.
    """
    keys = [f.name for f in files.schema.fields]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[int] = []
            columns: list[tuple[int, str, str]] = []
            for row, path in enumerate(batch.column("path").to_pylist()):
                system, name = pyarrow.fs.FileSystem.from_uri(path)
                with system.open_input_file(name) as file:
                    schema = pq.ParquetFile(file).schema_arrow
                for position, field in enumerate(schema):
                    rows.append(row)
                    columns.append((position, field.name, str(field.type)))
            taken = batch.take(pa.array(rows, pa.int64()))
            more = [pa.array([c[i] for c in columns], kind) for i, kind in enumerate((pa.int32(), pa.string(), pa.string()))]
            yield pa.RecordBatch.from_arrays([*[taken.column(k) for k in keys], *more], [*keys, "position", "column", "type"])

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in files.schema.fields)
    # A file costs a round trip rather than bytes, so files are dealt out evenly.
    return files.repartition(F.xxhash64("path")).mapInArrow(read, f"{ddl}, position int, column string, type string")
