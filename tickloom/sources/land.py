"""Landing: vendor files and exchange answers become rows of a dataset, all files in one job."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.columns import epoch_to_micros, to_bool
from tickloom.sources.datasets import ARRIVAL, HEADER_NAMES, Dataset, conform, dataset


def _typed(column: str, kind: T.DataType) -> Column:
    """A text cell as its dataset's type; what cannot be read is null."""
    text = F.trim(F.col(column))
    if isinstance(kind, T.TimestampType):
        return F.timestamp_micros(epoch_to_micros(text))
    if isinstance(kind, T.BooleanType):
        return F.when(text.isNotNull(), to_bool(text))
    if isinstance(kind, T.LongType):
        return F.coalesce(text.try_cast("bigint"), text.try_cast("decimal(38,6)").try_cast("bigint"))
    return text.try_cast(kind)


def _header(line: str | None, of: Dataset) -> tuple[str, ...] | None:
    """The columns that a file's first line names, by their names here; None if the line is no header that names the time."""
    known = {c.lower(): c for c in of.vendor}
    cells = [c.strip().strip('"').lower() for c in (line or "").lstrip("\ufeff").split(",")]
    named = [known.get(c) or known.get(HEADER_NAMES.get(c, "")) for c in cells]
    times = {c for c in of.vendor if of.renamed.get(c, c) == "time"}
    if "time" not in known and any(HEADER_NAMES.get(c) == "time" or c == "time" for c in cells):
        named = [next(iter(times)) if n is None and (HEADER_NAMES.get(c) == "time" or c == "time") else n for n, c in zip(named, cells, strict=True)]
    if not times & set(named):
        return None
    return tuple(n if n and n not in named[:i] else f"_other_{i}" for i, n in enumerate(named))


def _files_by_header(spark: SparkSession, path: str, of: Dataset) -> dict[tuple[str, ...], list[str]]:
    """The files of a path, by the columns of each. First lines are found in tasks; the driver gets one row per file."""
    place = F.monotonically_increasing_id()
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), place.alias("place"), "value")
    first = lines.where("at = 0").groupBy("file").agg(F.min_by("value", "place").alias("line"))
    found: dict[tuple[str, ...], list[str]] = {}
    for file, line in first.collect():
        found.setdefault(_header(line, of) or of.vendor, []).append(file)
    return found


def arrival(batch: int, file: Column | None = None, block: Column | None = None, place: Column | None = None) -> Column:
    """When a row arrived: by batch, then file, then its place there.

    Rows of one part of a file are read in their order by one task, so a counter of the task's rows tells their places.
    """
    return F.struct(
        F.lit(batch).cast("long").alias("batch"),
        (F.lit("") if file is None else file).alias("file"),
        (F.lit(0) if block is None else block).cast("long").alias("block"),
        (F.monotonically_increasing_id() if place is None else place.cast("long")).alias("place"),
    )


def typed_rows(rows: DataFrame, of: Dataset, symbol: str | None, exchange: str, instrument_type: str, timeframe: str | None, batch: int) -> DataFrame:
    """Text cells under vendor names, with ``_file`` and ``_block``, as rows of the dataset; rows without a time go."""
    kinds = {f.name: f.dataType for f in of.schema.fields}
    taken = {of.renamed.get(c, c): c for c in rows.columns if of.renamed.get(c, c) in kinds}
    cells = {n: _typed(taken[n], k) if n in taken else F.lit(None).cast(k) for n, k in kinds.items()}
    cells |= {"exchange": F.lit(exchange), "instrument_type": F.lit(instrument_type)}
    if symbol is not None:
        cells["symbol"] = F.lit(symbol)
    if "timeframe" in kinds:
        cells["timeframe"] = F.lit(timeframe).cast("string")
    seq = arrival(batch, F.col("_file"), F.col("_block"))
    # The counter in `seq` follows the order of the file only before rows are filtered or moved.
    typed = rows.select(*[c.alias(n) for n, c in cells.items()], seq.alias(ARRIVAL))
    return conform(typed.where(F.col("time").isNotNull()), of)


def land_vendor_csv(
    spark: SparkSession, path: str, data_type: str, symbol: str | None, exchange: str, instrument_type: str, timeframe: str | None = None, batch: int = 0
) -> DataFrame:
    """Rows of vendor files (a folder or glob), with the order in which they arrived.

    A file whose first line names the time column has its columns taken by name, in whatever order and number they come;
    the columns of any other file are taken by position. Without `symbol`, the files' own column tells it. The time's unit
    is told row by row; rows whose time cannot be read are header rows and go. `batch` tells this landing from others.
    """
    of = dataset(data_type)
    if not of.vendor:
        raise ValueError(f"{data_type} has no vendor files")
    parts = []
    for names, files in _files_by_header(spark, path, of).items():
        text = T.StructType([T.StructField(c, T.StringType()) for c in names])
        rows = spark.read.schema(text).csv(files).withColumns({"_file": F.col("_metadata.file_path"), "_block": F.col("_metadata.file_block_start")})
        parts.append(typed_rows(rows, of, symbol, exchange, instrument_type, timeframe, batch))
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], of.schema)


def land_candles(raw: DataFrame, answer: str = "answer") -> DataFrame:
    """Candles from JSON answers [[ms, open, high, low, close, volume], ...], one answer per row with its series columns.

    A candle that lacks a price goes; one that lacks its volume has none.
    """
    each = raw.withColumn("_c", F.explode(F.from_json(F.col(answer), "array<array<double>>")))
    prices = {p: F.get("_c", F.lit(i)) for i, p in enumerate(("open", "high", "low", "close"), 1)}
    rows = each.withColumns({"time": F.timestamp_millis(F.get("_c", F.lit(0)).cast("long"))} | prices)
    rows = rows.withColumns({"volume": F.coalesce(F.get("_c", F.lit(5)), F.lit(0.0)), "is_interpolated": F.lit(False)})
    return conform(rows.dropna(subset=["time", *prices]), dataset("ohlcv"))


def land_open_interest(raw: DataFrame, answer: str = "answer") -> DataFrame:
    """Open interest from JSON answers [{timestamp, openInterestAmount}, ...]."""
    shape = "array<struct<timestamp: bigint, openInterestAmount: double>>"
    each = raw.withColumn("_o", F.explode(F.from_json(F.col(answer), shape)))
    rows = each.withColumns({"time": F.timestamp_millis(F.col("_o.timestamp")), "value": F.col("_o.openInterestAmount")})
    return conform(rows.where(F.col("time").isNotNull()), dataset("open_interest"))


def flatten_markets(raw: DataFrame, answer: str = "answer") -> DataFrame:
    """One row per market of JSON answers {symbol: market, ...}, one answer per row with its ``exchange_id``."""
    market = (
        "map<string, struct<base: string, quote: string, active: boolean, precision: struct<price: double, amount: double>, "
        "limits: struct<amount: struct<min: double>, cost: struct<min: double>>>>"
    )
    both = F.map_zip_with(
        F.from_json(F.col(answer), market), F.from_json(F.col(answer), "map<string, string>"),
        lambda _, m, text: F.struct(m.alias("m"), text.alias("raw_info")),
    )
    each = raw.select("exchange_id", F.explode(both).alias("symbol", "x"))
    return each.select(
        "symbol", "exchange_id", F.col("x.m.base").alias("base_asset"), F.col("x.m.quote").alias("quote_asset"),
        F.coalesce("x.m.active", F.lit(False)).alias("active"), F.col("x.m.precision.price").alias("price_precision"),
        F.col("x.m.precision.amount").alias("amount_precision"), F.col("x.m.limits.amount.min").alias("min_amount"),
        F.col("x.m.limits.cost.min").alias("min_cost"), F.col("x.raw_info").alias("raw_info"),
    )
