"""Landing as a stream: new vendor files are upserted batch by batch, and a restart lands nothing twice."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tickloom.sinks.upsert import upsert
from tickloom.sources.datasets import dataset
from tickloom.sources.land import typed_rows


def stream_vendor_csv(
    spark: SparkSession, inbox: str, root: str, checkpoint: str, data_type: str, exchange: str, instrument_type: str,
    symbol: str | None = None, timeframe: str | None = None, files_per_batch: int = 1000,
) -> StreamingQuery:
    """Lands the files that an inbox has and has not landed yet, then stops; run it again for those that came later.

    Files come without a header or with one that names the vendor's columns in their order (`land_vendor_csv` takes columns
    by name). The checkpoint knows which files are done. A batch that was lost after its rows were stored is run once more:
    upserts by key leave the table as it was. Batches are numbered, so equal keys are settled by arrival.
    """
    of = dataset(data_type)
    if not of.vendor:
        raise ValueError(f"{data_type} has no vendor files")
    text = T.StructType([T.StructField(c, T.StringType()) for c in of.vendor])
    read = spark.readStream.schema(text).option("maxFilesPerTrigger", files_per_batch).csv(inbox)
    rows = read.withColumns({"_file": F.col("_metadata.file_path"), "_block": F.col("_metadata.file_block_start")})

    def store(batch: DataFrame, number: int) -> None:
        upsert(typed_rows(batch, of, symbol, exchange, instrument_type, timeframe, number), root, data_type)

    return rows.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
