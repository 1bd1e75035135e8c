"""What several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickloom.session import scratch_path
from tickloom.sinks.publish import Files

#: Lower-cases A-Z and nothing else, in SQL and in Python (`bytes.lower` does the same).
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: With it Spark deletes the shuffle files of a statement when that has ended, not when the driver collects its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The frame, stored once in the shared folder and read back.

    It cuts the lineage: a lost executor costs a read of this table, not the work above it. So what was shuffled for it is
    of no more use and goes at once; each write has a plan of its own, hence no other statement reads these files.
    """
    conf, path = df.sparkSession.conf, scratch_path(df.sparkSession, purpose)
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.unset(CLEANUP) if before is None else conf.set(CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*frames: DataFrame) -> None:
    """Deletes tables that `written` stored, once all that was made of them has been written itself."""
    for frame in frames:
        for path in {file.rpartition("/")[0] for file in frame.inputFiles()}:
            if "/tickloom-" in path:
                Files(frame.sparkSession, path).delete(path)


def remainder(column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo `modulus`; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % modulus


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def fewest_parts(df: DataFrame) -> int:
    """Partitions for a shuffle that the session's own setting governs."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def per_batch(run: Callable[[pa.RecordBatch], dict[str, object]], schema: str) -> tuple[Callable, str]:
    """Arguments for `mapInArrow` from a function of one batch that returns columns."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            if batch.num_rows:
                yield pa.RecordBatch.from_pydict(run(batch))

    return batches, schema


def raw(column: pa.Array) -> list[bytes]:
    """A text column as UTF-8 bytes; null is empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


#: Bits of a row of a bitmap, as Spark's bitmaps have them.
BITMAP_ROW = 1 << 15


def bitmap(bits: DataFrame, size: int) -> np.ndarray:
    """The set of values of column `bit`, from 0 to below `size`, as `size` bits: a filter that does not grow with its input."""
    rows = bits.groupBy((F.col("bit") / BITMAP_ROW).cast("int").alias("row")).agg(F.bitmap_construct_agg(F.col("bit") % BITMAP_ROW).alias("bits"))
    out = np.zeros((size // BITMAP_ROW, BITMAP_ROW // 8), np.uint8)
    for row, part in rows.collect():  # size / BITMAP_ROW rows at most
        out[row] = np.frombuffer(part, np.uint8)
    return out.ravel()


def in_bitmap(bits: np.ndarray, bit: np.ndarray) -> np.ndarray:
    """Which of the values are in the set."""
    return bits[bit >> 3] >> (bit & 7).astype(np.uint8) & 1 == 1
