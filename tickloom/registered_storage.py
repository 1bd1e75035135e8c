"""Registered queries that go through storage: landing, upserts, scans, inventories and jobs, each in a store of its own
below the session's shared folder, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom import jobs
from tickloom.functions import columns as C
from tickloom.functions.timecol import utc_date
from tickloom.operators import bars, intervals, quality
from tickloom.registered import SQL, VENUE, doubles, load, query, ticks
from tickloom.session import scratch_path
from tickloom.sinks.upsert import upsert
from tickloom.sources import files, land, scan
from tickloom.sources.datasets import OFFERED, TASKS, available

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _store(spark: SparkSession, purpose: str) -> str:
    return scratch_path(spark, purpose)


def _utc(df: DataFrame, name: str = "time") -> DataFrame:
    """Times without a zone are UTC."""
    return df.withColumn(name, F.timestamp_micros(F.timestamp_diff("MICROSECOND", F.expr(_EPOCH), F.col(name))))


def _us(df: DataFrame, name: str = "time") -> DataFrame:
    """Stored times as microseconds, which no session zone changes."""
    return df.withColumn("us", F.unix_micros(name)).drop(name)


def _paired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades of two assets on every venue: a folder per day and series is enough of them."""
    pair = F.when(F.col("symbol").isin("A0", "A2", "A4"), "A0").otherwise("A1")
    return ticks(spark, sf_dir).withColumn("symbol", pair)


SQL["pairs"] = SQL["ticks"].replace("'A' || (user_id % 5)", "CASE WHEN user_id % 5 IN (0, 2, 4) THEN 'A0' ELSE 'A1' END")
SQL["pair_bars"] = SQL["bars"].replace("FROM ticks", "FROM pairs")


def _market_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doubles(_utc(_paired(spark, sf_dir)), "price", "qty")


def _as_files(rows: DataFrame, path: str, cells: Sequence[str], order: Sequence[str], header: bool) -> None:
    """CSV files whose names, and the rows in each, follow an order."""
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed.select(*cells).write.option("header", header).csv(path)


# --- landing ------------------------------------------------------------------------------------------------------------

_METRICS = "metrics"


def _metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A vendor's rows: figures of every event, under the vendor's names."""
    rows = load(spark, sf_dir, "events")
    ms = F.timestamp_diff("MILLISECOND", F.expr(_EPOCH), F.col("ts"))
    figures = {
        "create_time": ms, "symbol": F.concat(F.lit("A"), F.col("user_id") % 5), "sum_open_interest": F.col("value"), "sum_open_interest_value": F.col("event_id") * 2.5,
        "count_top_trader_long_short_ratio": F.col("event_id") % 7, "sum_top_trader_long_short_ratio": F.col("event_id") % 11, "count_long_short_ratio": F.col("event_id") % 13,
        "sum_long_short_ratio": F.col("user_id"),
    }
    return rows.select("event_id", *[c.cast("string").alias(n) for n, c in figures.items()])


@query(
    """SELECT 'A' || (user_id % 5) AS symbol, epoch_us(ts) // 1000 * 1000 AS us, value AS sum_open_interest, event_id * 2.5 AS sum_open_interest_value,
    CAST(event_id % 7 AS DOUBLE) AS count_top_trader_long_short_ratio, CAST(event_id % 11 AS DOUBLE) AS sum_top_trader_long_short_ratio, CAST(event_id % 13 AS DOUBLE) AS count_long_short_ratio, CAST(user_id AS DOUBLE) AS sum_long_short_ratio FROM events"""
)
def landed_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with a header, with one in another order, and with none land alike."""
    rows, path = _metrics(spark, sf_dir), _store(spark, "vendor")
    names = [c for c in rows.columns if c != "event_id"]
    for part, (cells, header) in enumerate(((names, True), (names[4:] + names[:4], True), (names, False))):
        _as_files(rows.where(F.col("event_id") % 3 == part), f"{path}/{part}", cells, ["event_id"], header)
    landed = land.land_vendor_csv(spark, f"{path}/*", _METRICS, None, "v", "swap")
    return _us(landed).select("symbol", "us", *names[2:])


@query("SELECT 'A' || (user_id % 5) AS symbol, event_id AS update_id, value AS best_bid_price, value + 1 AS best_ask_price, CAST(event_id % 9 AS DOUBLE) AS best_bid_qty, CAST(NULL AS DOUBLE) AS best_ask_qty, epoch_us(ts) AS us FROM events")
def landed_book_tickers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A header under the vendor's other names, with a column missing."""
    rows, path = load(spark, sf_dir, "events"), _store(spark, "vendor")
    cells = {"symbol": F.concat(F.lit("A"), F.col("user_id") % 5), "transaction_time": F.timestamp_diff("MICROSECOND", F.expr(_EPOCH), F.col("ts")), "update_id": F.col("event_id"), "best_bid_price": F.col("value"), "best_ask_price": F.col("value") + 1, "best_bid_qty": F.col("event_id") % 9, "unknown": F.lit("x")}
    rows.select(*[c.alias(n) for n, c in cells.items()]).write.option("header", True).csv(path)
    return _us(land.land_vendor_csv(spark, path, "bookTicker", None, "v", "swap")).select("symbol", "update_id", "best_bid_price", "best_ask_price", "best_bid_qty", "best_ask_qty", "us")


def _repeated_trades(spark: SparkSession, sf_dir: str) -> str:
    """Files in which ids come again with another price, in the order of events."""
    path = _store(spark, "vendor")
    rows = load(spark, sf_dir, "events")
    hour = F.timestamp_diff("MICROSECOND", F.expr(_EPOCH), F.date_trunc("day", "ts"))
    cells = {"trade_id": F.col("event_id") % 97, "price": F.col("value"), "qty": F.lit(1), "quote_qty": F.lit(1), "time": hour, "is_buyer_maker": F.lit(True), "is_best_match": F.lit(True)}
    _as_files(rows.select("event_id", *[c.cast("string").alias(n) for n, c in cells.items()]), path, list(cells), ["event_id"], False)
    return path


_ARRIVED = "SELECT event_id % 97 AS trade_id, epoch_us(date_trunc('day', ts)) AS us, {}(value ORDER BY event_id) AS price FROM events GROUP BY 1, 2"


def _kept(spark: SparkSession, sf_dir: str, keep: str) -> DataFrame:
    root = _store(spark, "store")
    upsert(land.land_vendor_csv(spark, _repeated_trades(spark, sf_dir), "trades", "B/U", "v", "spot"), root, "trades", keep)
    return _us(scan.get_tick_data(spark, root)).select("trade_id", "us", "price")


@query(_ARRIVED.format("first"))
def stored_first_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of equal keys in files, the one that came first is stored, whatever its values."""
    return _kept(spark, sf_dir, "first")


@query(_ARRIVED.format("last"))
def stored_last_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of equal keys in files, the one that came last is stored."""
    return _kept(spark, sf_dir, "last")


# --- upserts and scans ---------------------------------------------------------------------------------------------------


@cache
def _candles_of(spark: SparkSession, sf_dir: str) -> str:
    root = _store(spark, "store")
    hourly = bars.tick_bars(_paired(spark, sf_dir), "1h", VENUE)
    hourly = doubles(_utc(hourly), *C.PRICES, "volume").withColumn("timeframe", F.lit("1h"))
    daily = hourly.where("hour(time) = 12 and exchange = 'view'").withColumn("timeframe", F.lit("1d"))
    both = hourly.unionByName(daily).withColumn("is_interpolated", F.lit(False))
    upsert(both.where("hour(time) < 16"), root, "ohlcv")
    upsert(both.where("hour(time) >= 8").withColumn("volume", F.when(F.hour("time") < 16, -1.0).otherwise(F.col("volume"))), root, "ohlcv")
    return root


def _stored_candles(spark: SparkSession, sf_dir: str) -> str:
    """Hourly candles of all venues, and daily ones of one, by two upserts that overlap; once for all queries of a session."""
    return _candles_of(spark, sf_dir)


SQL["stored"] = "SELECT exchange, instrument_type, symbol, f AS timeframe, epoch_us(time) AS us, time, CAST(open AS DOUBLE) AS open, CAST(high AS DOUBLE) AS high, CAST(low AS DOUBLE) AS low, CAST(close AS DOUBLE) AS close, CAST(volume AS DOUBLE) AS volume FROM pair_bars, (VALUES ('1h'), ('1d')) v(f) WHERE f = '1h' OR (hour(time) = 12 AND exchange = 'view')"
_BARS = ("pairs", "pair_bars", "stored")
_CANDLE = ("exchange", "instrument_type", "symbol", "timeframe", "us", *C.PRICES, "volume")


@query(f"SELECT {', '.join(_CANDLE)} FROM stored", *_BARS)
def stored_candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What two overlapping upserts leave is what a scan reads."""
    return _us(scan.scan(spark, _stored_candles(spark, sf_dir), "ohlcv")).select(*_CANDLE)


@query(f"SELECT {', '.join(_CANDLE)} FROM stored WHERE timeframe = '1h' AND symbol = 'A1' AND time >= '2024-01-03 06:00:00' AND time < '2024-01-10 18:00:00'", *_BARS)
def scanned_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One width, one asset and a range of time, which the folders answer, in order."""
    rows = scan.get_ohlcv(spark, _stored_candles(spark, sf_dir), "1h", symbol="A1", start="2024-01-03T06:00:00", end="2024-01-10T18:00:00", ordered=True)
    return _us(rows).select(*_CANDLE)


@query("SELECT exchange, instrument_type, symbol AS base_asset, timeframe AS category, CAST(min(time) AS DATE) AS start_date, CAST(max(time) AS DATE) AS end_date, count(DISTINCT CAST(time AS DATE)) AS count FROM stored GROUP BY 1, 2, 3, 4", *_BARS)
def stored_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days of every series from file names."""
    return scan.inventory(spark, _stored_candles(spark, sf_dir), ["ohlcv"])


@query("SELECT s AS store, exchange, instrument_type, symbol, symbol AS base_asset, timeframe AS category, CAST(min(time) AS DATE) AS start_date, CAST(max(time) AS DATE) AS end_date, count(*) AS count FROM stored, (VALUES ('lake'), ('copy')) v(s) GROUP BY ALL", *_BARS)
def inventory_of_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every series in two stores."""
    root, copy = _stored_candles(spark, sf_dir), _store(spark, "store")
    upsert(scan.scan(spark, root, "ohlcv"), copy, "ohlcv")
    return scan.inventory(spark, {"lake": root, "copy": copy}, ["ohlcv"], deep=True)


@query("SELECT exchange, instrument_type, symbol AS base_asset, TRUE AS has_files, count(DISTINCT CAST(time AS DATE)) AS days FROM stored GROUP BY ALL", *_BARS)
def stored_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes from a listing; bytes depend on the writer, so what is told is that they add up."""
    sizes = files.storage_sizes(spark, _stored_candles(spark, sf_dir), "ohlcv")
    sound = (F.col("files") > 0) & (F.col("megabytes") > 0)
    return sizes.select("exchange", "instrument_type", "base_asset", sound.alias("has_files"), F.round(F.col("megabytes") / F.col("megabytes_per_day")).cast("long").alias("days"))


@query(
    """SELECT 'ohlcv' AS data_type, e.exchange, c AS "column", CASE c WHEN 'symbol' THEN 'string' WHEN 'time' THEN 'timestamp' WHEN 'is_interpolated' THEN 'bool' ELSE 'double' END AS type, FALSE AS drifts, CASE c WHEN 'is_interpolated' THEN 'false' WHEN 'symbol' THEN e.symbol END AS sample
    FROM (SELECT exchange, first(symbol ORDER BY time, symbol) AS symbol FROM stored GROUP BY exchange) e, (VALUES ('symbol'), ('time'), ('open'), ('high'), ('low'), ('close'), ('volume'), ('is_interpolated')) v(c)""",
    *_BARS,
)
def stored_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns and types of every venue from footers, with a value of its first row."""
    report = scan.schema_report(spark, _stored_candles(spark, sf_dir), ["ohlcv"])
    plain = F.when(F.col("column").isin("symbol", "is_interpolated"), F.col("sample"))
    return report.select("data_type", "exchange", "column", F.regexp_extract("type", "^[a-z]+", 0).alias("type"), "drifts", plain.alias("sample"))


@query("SELECT exchange, symbol, trade_id, epoch_us(time) AS us, CAST(price AS DOUBLE) AS price, CAST(qty AS DOUBLE) AS qty FROM pairs", "pairs")
def served_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades into the serving store, of which a second load finds all but the new days served."""
    root, served = _store(spark, "store"), _store(spark, "serving")
    rows = _market_ticks(spark, sf_dir)
    upsert(rows.where("day(time) <= 15"), root, "trades")
    jobs.load_serving(spark, root, served, "trades")
    upsert(rows.where("day(time) > 15"), root, "trades")
    jobs.load_serving(spark, root, served, "trades")
    return _us(scan.get_tick_data(spark, served)).select("exchange", "symbol", "trade_id", "us", "price", "qty")


@query(
    """SELECT exchange, instrument_type, symbol, day AS date FROM (SELECT exchange, instrument_type, symbol, CAST(time AS DATE) AS day, min(time) AS a, max(time) AS b FROM pairs WHERE trade_id % 3 > 0 GROUP BY ALL) s
    WHERE NOT EXISTS (SELECT 1 FROM pairs t WHERE t.trade_id % 9 = 0 AND t.exchange = s.exchange AND t.symbol = s.symbol AND t.time BETWEEN s.a AND s.b)""",
    "pairs",
)
def unserved_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E9 over two stores: days of a series between whose first and last row the serving side has nothing."""
    rows = _market_ticks(spark, sf_dir)
    left = jobs.not_served(rows.where("trade_id % 3 > 0"), rows.where("trade_id % 9 = 0"), tolerance_seconds=86_400)
    return left.select(*VENUE, utc_date(left, "time").alias("date")).distinct()


SQL["wanted"] = "SELECT DISTINCT k AS instrument_type, t AS data_type FROM ticks, (VALUES ('spot'), ('swap'), ('future')) a(k), (VALUES " + ", ".join(f"('{t}')" for t in sorted(set(TASKS.values()))) + ") b(t)"
@query(
    """SELECT instrument_type, data_type FROM wanted WHERE NOT (instrument_type = 'spot' AND data_type NOT IN ('ohlcv', 'trades', 'aggTrades'))
    AND NOT (instrument_type = 'swap' AND data_type = 'liquidationSnapshot')""",
    "ticks",
    "wanted",
)
def every_offer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All datasets of all tasks against all market types."""
    kinds = F.explode(F.array(*[F.lit(k) for k in OFFERED])).alias("instrument_type")
    types = F.explode(F.array(*[F.lit(t) for t in sorted(set(TASKS.values()))])).alias("data_type")
    wanted = ticks(spark, sf_dir).select("exchange").distinct().select(kinds, "exchange").select("instrument_type", types).distinct()
    return available(wanted, spark)


# --- coverage with a status ------------------------------------------------------------------------------------------------

# Orders are dated by day, so whole days tell what ranges must come out.
SQL["ranges"] = "SELECT o_custkey % 20 AS symbol, o_orderdate AS start_ts, o_orderdate + to_days(CAST(o_orderkey % 9 + 1 AS INTEGER)) AS end_ts, CASE WHEN o_orderkey % 3 = 0 THEN 'observed' ELSE 'known_empty' END AS status FROM orders WHERE o_orderkey % 4 = 0"
SQL["statuses"] = """SELECT symbol, day, CASE WHEN bool_or(status = 'observed') THEN 'observed' ELSE 'known_empty' END AS status FROM (
    SELECT symbol, CAST(t AS DATE) AS day, status FROM (SELECT symbol, status, unnest(generate_series(start_ts, end_ts - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS t FROM ranges)
    UNION ALL SELECT symbol, day, 'observed' FROM (SELECT DISTINCT o_custkey % 20 AS symbol, CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_orderkey % 5 = 0)) GROUP BY symbol, day"""


SQL["asked"] = "SELECT DISTINCT o_custkey % 20 AS symbol, o_orderdate AS start_ts, o_orderdate + to_days(CAST(o_orderkey % 30 + 1 AS INTEGER)) AS end_ts FROM orders WHERE o_orderkey % 7 = 0"


def _ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders").where("o_orderkey % 4 = 0")
    end = F.timestamp_add("DAY", (F.col("o_orderkey") % 9 + 1).cast("int"), F.col("o_orderdate"))
    status = F.when(F.col("o_orderkey") % 3 == 0, intervals.OBSERVED).otherwise(intervals.KNOWN_EMPTY)
    return orders.select((F.col("o_custkey") % 20).alias("symbol"), F.col("o_orderdate").alias("start_ts"), end.alias("end_ts"), status.alias("status"))


def _known(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = load(spark, sf_dir, "orders").where("o_orderkey % 5 = 0").select((F.col("o_custkey") % 20).alias("symbol"), F.col("o_orderdate").alias("time"))
    return intervals.advance_coverage(_ranges(spark, sf_dir), landed, "1d", ["symbol"])


@query(
    """SELECT symbol, status, CAST(min(day) AS TIMESTAMP) AS start_ts, CAST(max(day) AS TIMESTAMP) + INTERVAL 1 DAY AS end_ts FROM (
    SELECT *, day - CAST(row_number() OVER (PARTITION BY symbol, status ORDER BY day) AS INTEGER) AS run FROM statuses) GROUP BY symbol, status, run""",
    "ranges",
    "statuses",
)
def coverage_with_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J4 with a status: what was asked for and is empty stays known, unless it was observed."""
    return _known(spark, sf_dir)


@query(
    """SELECT symbol, request_start, request_end, status, CAST(min(day) AS TIMESTAMP) AS gap_start, CAST(max(day) AS TIMESTAMP) + INTERVAL 1 DAY AS gap_end FROM (
    SELECT *, day - CAST(row_number() OVER (PARTITION BY symbol, request_start, request_end, status ORDER BY day) AS INTEGER) AS run FROM (
    SELECT r.symbol, r.request_start, r.request_end, r.day, coalesce(s.status, 'missing') AS status FROM (
    SELECT symbol, start_ts AS request_start, end_ts AS request_end, CAST(unnest(generate_series(start_ts, end_ts - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS day FROM asked) r LEFT JOIN statuses s USING (symbol, day)) WHERE status <> 'observed') GROUP BY symbol, request_start, request_end, status, run""",
    "ranges",
    "statuses",
    "asked",
)
def gaps_with_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F17 with a status: missing parts of requests apart from those known to be empty."""
    orders = load(spark, sf_dir, "orders").where("o_orderkey % 7 = 0")
    end = F.timestamp_add("DAY", (F.col("o_orderkey") % 30 + 1).cast("int"), F.col("o_orderdate"))
    asked = orders.select((F.col("o_custkey") % 20).alias("symbol"), F.col("o_orderdate").alias("start_ts"), end.alias("end_ts"))
    path = _store(spark, "coverage")
    _known(spark, sf_dir).write.parquet(path)
    return intervals.coverage_gaps(asked, spark.read.parquet(path), ["symbol"])


# --- report with details --------------------------------------------------------------------------------------------------


@query(
    """SELECT q.exchange, q.instrument_type, q.symbol, q.total_rows, coalesce(g.gaps, '') AS gaps, coalesce(g.n, 0) AS all_gaps, d.days, d.n AS all_days FROM (SELECT exchange, instrument_type, symbol, count(*) AS total_rows FROM pairs GROUP BY ALL) q
    LEFT JOIN (SELECT exchange, instrument_type, symbol, max(n) AS n, string_agg(us || '+' || seconds, ',' ORDER BY place) AS gaps FROM (
        SELECT *, row_number() OVER (PARTITION BY exchange, instrument_type, symbol ORDER BY seconds DESC, us) AS place, count(*) OVER (PARTITION BY exchange, instrument_type, symbol) AS n FROM (
        SELECT exchange, instrument_type, symbol, epoch_us(before) + 3600000000 AS us, (epoch_us(bucket) - epoch_us(before)) // 1000000 - 3600 AS seconds FROM (
        SELECT exchange, instrument_type, symbol, bucket, lag(bucket) OVER (PARTITION BY exchange, instrument_type, symbol ORDER BY bucket) AS before FROM (SELECT DISTINCT exchange, instrument_type, symbol, date_trunc('hour', time) AS bucket FROM pairs)) WHERE bucket > before + INTERVAL 1 HOUR)) WHERE place <= 3 GROUP BY ALL) g USING (exchange, instrument_type, symbol)
    JOIN (SELECT exchange, instrument_type, symbol, max(n) AS n, string_agg(us || ':' || rows, ',' ORDER BY place) AS days FROM (
        SELECT exchange, instrument_type, symbol, epoch_us(day) AS us, rows, row_number() OVER (PARTITION BY exchange, instrument_type, symbol ORDER BY day DESC) AS place, count(*) OVER (PARTITION BY exchange, instrument_type, symbol) AS n FROM (
        SELECT exchange, instrument_type, symbol, date_trunc('day', time) AS day, count(*) AS rows FROM pairs GROUP BY ALL)) WHERE place <= 4 GROUP BY ALL) d USING (exchange, instrument_type, symbol)""",
    "pairs",
)
def report_with_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each series with its longest gaps and last days in its row, and how many there are in all."""
    rows = _market_ticks(spark, sf_dir)
    report = quality.with_details(quality.tick_quality_gaps(rows, VENUE), quality.empty_bucket_gaps(rows, VENUE), quality.daily_breakdown(rows, VENUE), VENUE, most_gaps=3, most_days=4)
    gaps = F.transform("gaps", lambda g: F.concat_ws("+", F.unix_micros(g.gap_start), g.gap_seconds.cast("long")))
    days = F.transform("days", lambda d: F.concat_ws(":", F.unix_micros(d.min_time) - F.pmod(F.unix_micros(d.min_time), F.lit(86_400_000_000)), d["count"]))
    return report.select(*VENUE, "total_rows", F.array_join(gaps, ",").alias("gaps"), (F.size("gaps") + F.col("more_gaps")).alias("all_gaps"), F.array_join(days, ",").alias("days"), (F.size("days") + F.col("more_days")).alias("all_days"))
