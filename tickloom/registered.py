"""Registered queries over the given tables, with the SQL that must give the same rows.

The tables stand in for market data: `events` are trades, `lineitem` are daily candles over several years, and the days on
which customers of `orders` bought are series with gaps. Prices and quantities are DECIMAL, so sums do not depend on the
order in which tasks finish; figures leave as DOUBLE.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions import columns as C
from tickloom.functions.timecol import utc_date
from tickloom.operators import bars, intervals, market, micro, quality, repair, sequence, sliding
from tickloom.plans.dedup import keep_one
from tickloom.sinks.upsert import merge
from tickloom.sources import land
from tickloom.sources.datasets import available

VENUE = ("exchange", "instrument_type", "symbol")
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str, *with_: str) -> Callable:
    """Registers a query with its SQL; `with_` names the common tables that the SQL starts from."""

    def keep(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[run.__name__] = run
        ORACLES[run.__name__] = (f"WITH {', '.join(f'{n} AS ({SQL[n]})' for n in with_)} " if with_ else "") + sql
        return run

    return keep


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def doubles(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("double") for n in names})


# --- inputs ------------------------------------------------------------------------------------------------------------


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    spot = F.col("event_type").isin("click", "view", "signup")
    return load(spark, sf_dir, "events").select(
        F.col("ts").alias("time"),
        F.col("event_type").alias("exchange"),
        F.when(spot, "spot").otherwise("swap").alias("instrument_type"),
        F.concat(F.lit("A"), (F.col("user_id") % 5).cast("string")).alias("symbol"),
        F.col("value").cast("decimal(18,2)").alias("price"),
        (F.col("event_id") % 9 + 1).cast("decimal(9,0)").alias("qty"),
        (F.col("event_id") % 2 == 0).alias("is_buyer_maker"),
        F.col("event_id").alias("trade_id"),
    )


def venue_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    hourly = bars.tick_bars(ticks(spark, sf_dir), "1h", VENUE)
    return hourly.withColumn("volume", F.col("volume").cast("decimal(18,0)"))


def sparse_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly candles of which some lack their prices: swaps at 3 h, and A1 on all venues at 0 h."""
    hour = F.hour("time")
    lost = ((hour == 3) & (F.col("instrument_type") == "swap")) | ((hour == 0) & (F.col("symbol") == "A1"))
    return venue_bars(spark, sf_dir).withColumns({p: F.when(~lost, F.col(p)) for p in C.PRICES})


def synthetic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return market.synthesize(sparse_bars(spark, sf_dir), timeframe="1h")


def daily_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily candles from `lineitem`, the price of a trade being its extended price."""
    rows = load(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("A"), (F.col("l_suppkey") % 5).cast("string")).alias("symbol"),
        F.col("l_shipdate").alias("time"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("price"),
        F.col("l_quantity").cast("decimal(9,0)").alias("qty"),
        (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("trade_id"),
    )
    daily = bars.tick_bars(rows, "1d", ["symbol"], order=("time", "trade_id", "price"))
    typical = ((F.col("open") + F.col("high") + F.col("low") + F.col("close")) * F.expr("0.25BD")).cast("decimal(18,4)")
    daily = daily.withColumns({"twap": typical, "vwap": typical, "volume": F.col("volume").cast("decimal(9,0)")})
    daily = daily.withColumn("quote_volume", (F.col("twap") * F.col("volume")).cast("decimal(28,4)"))
    return doubles(daily, *C.PRICES)


def covered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges of one to three days from every day on which a customer group ordered."""
    orders = load(spark, sf_dir, "orders")
    day = F.timestamp_add("DAY", (F.col("o_orderkey") % 3 + 1).cast("int"), F.col("o_orderdate"))
    return orders.select((F.col("o_custkey") % 20).alias("symbol"), F.col("o_orderdate").alias("start_ts"), day.alias("end_ts"))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A range of one to sixty days from every order."""
    orders = load(spark, sf_dir, "orders")
    end = F.timestamp_add("DAY", (F.col("o_orderkey") % 60 + 1).cast("int"), F.col("o_orderdate"))
    return orders.select((F.col("o_custkey") % 20).alias("symbol"), F.col("o_orderdate").alias("start_ts"), end.alias("end_ts"))


def order_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "orders").select((F.col("o_custkey") % 20).alias("symbol"), F.col("o_orderdate").alias("time"))


def _round2(x: str) -> str:
    return f"round_even(({x}) * 100, 0) / 100"


_WEIGHTED = ", ".join(f"CASE WHEN sum(volume) > 0 THEN CAST(sum({p} * volume) AS DOUBLE) / CAST(sum(volume) AS DOUBLE) ELSE CAST(sum({p}) AS DOUBLE) / count({p}) END AS {p}" for p in C.PRICES)
_PRICED = ", ".join(
    f"CASE WHEN sum(volume) FILTER ({p} IS NOT NULL) > 0 THEN CAST(sum({p} * volume) AS DOUBLE) / CAST(sum(volume) FILTER ({p} IS NOT NULL) AS DOUBLE) ELSE CAST(sum({p}) AS DOUBLE) / nullif(count({p}), 0) END AS {p}"
    for p in C.PRICES
)
_FILLED = ", ".join(f"coalesce(last_value({p} IGNORE NULLS) OVER (PARTITION BY symbol, CAST(time AS DATE) ORDER BY time ROWS UNBOUNDED PRECEDING), first_value({p} IGNORE NULLS) OVER (PARTITION BY symbol, CAST(time AS DATE) ORDER BY time ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS {p}" for p in C.PRICES)
_LOST = "(hour(time) = 3 AND instrument_type = 'swap') OR (hour(time) = 0 AND symbol = 'A1')"
_OHLC4 = "(open + high + low + close) / 4"
_DOUBLE_PRICES = ", ".join(f"CAST({p} AS DOUBLE) AS {p}" for p in C.PRICES)

#: Common tables of the oracles, the counterparts of the inputs above.
SQL = {
    "ticks": """SELECT ts AS time, event_type AS exchange,
        CASE WHEN event_type IN ('click', 'view', 'signup') THEN 'spot' ELSE 'swap' END AS instrument_type,
        'A' || (user_id % 5) AS symbol, CAST(value AS DECIMAL(18,2)) AS price, CAST(event_id % 9 + 1 AS DECIMAL(9,0)) AS qty,
        event_id % 2 = 0 AS is_buyer_maker, event_id AS trade_id FROM events""",
    "bars": """SELECT exchange, instrument_type, symbol, date_trunc('hour', time) AS time,
        first(price ORDER BY time, trade_id) AS open, max(price) AS high, min(price) AS low,
        last(price ORDER BY time, trade_id) AS close, CAST(sum(qty) AS DECIMAL(18,0)) AS volume
        FROM ticks GROUP BY exchange, instrument_type, symbol, date_trunc('hour', time)""",
    "sparse": "SELECT exchange, instrument_type, symbol, time, volume, " + ", ".join(f"CASE WHEN NOT ({_LOST}) THEN {p} END AS {p}" for p in C.PRICES) + " FROM bars",
    "merged": f"SELECT symbol, time, CAST(sum(volume) AS DOUBLE) AS volume, {_PRICED} FROM sparse GROUP BY symbol, time",
    "filled": f"SELECT symbol, time, volume, {_FILLED} FROM merged",
    "rounded": "SELECT symbol, time, "
    + ", ".join(f"{_round2(p)} AS {p}" for p in (*C.PRICES, "volume"))
    + f", {_round2(f'{_OHLC4} * volume')} AS quote_volume, {_round2(_OHLC4)} AS twap, {_round2(_OHLC4)} AS vwap FROM filled",
    "synthetic": "SELECT symbol, time, open, greatest(high, open, close) AS high, least(low, open, close) AS low, close, volume, quote_volume, twap, vwap FROM rounded",
    "daily": f"""SELECT symbol, time, {_DOUBLE_PRICES}, volume, twap, twap AS vwap, CAST(twap * volume AS DECIMAL(28,4)) AS quote_volume FROM (
        SELECT *, CAST((open + high + low + close) * 0.25 AS DECIMAL(18,4)) AS twap FROM (
        SELECT 'A' || (l_suppkey % 5) AS symbol, date_trunc('day', l_shipdate) AS time,
        first(CAST(l_extendedprice AS DECIMAL(18,2)) ORDER BY l_shipdate, l_orderkey, l_linenumber, l_extendedprice) AS open,
        max(CAST(l_extendedprice AS DECIMAL(18,2))) AS high, min(CAST(l_extendedprice AS DECIMAL(18,2))) AS low,
        last(CAST(l_extendedprice AS DECIMAL(18,2)) ORDER BY l_shipdate, l_orderkey, l_linenumber, l_extendedprice) AS close,
        CAST(sum(CAST(l_quantity AS DECIMAL(9,0))) AS DECIMAL(9,0)) AS volume
        FROM lineitem GROUP BY 1, 2))""",
    "covered": "SELECT o_custkey % 20 AS symbol, o_orderdate AS start_ts, o_orderdate + to_days(CAST(o_orderkey % 3 + 1 AS INTEGER)) AS end_ts FROM orders",
    "requests": "SELECT DISTINCT o_custkey % 20 AS symbol, o_orderdate AS start_ts, o_orderdate + to_days(CAST(o_orderkey % 60 + 1 AS INTEGER)) AS end_ts FROM orders",
    "islands": """SELECT symbol, min(start_ts) AS start_ts, max(end_ts) AS end_ts FROM (
        SELECT *, sum(opens) OVER (PARTITION BY symbol ORDER BY start_ts, end_ts ROWS UNBOUNDED PRECEDING) AS island FROM (
        SELECT *, CASE WHEN start_ts <= max(end_ts) OVER (PARTITION BY symbol ORDER BY start_ts, end_ts ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS opens
        FROM covered)) GROUP BY symbol, island""",
    "days": "SELECT DISTINCT o_custkey % 20 AS symbol, CAST(o_orderdate AS DATE) AS day FROM orders",
    "stepped": """SELECT *, epoch_us(time) AS us, lag(epoch_us(time)) OVER w AS before, lag(close) OVER w AS before_close
        FROM bars WINDOW w AS (PARTITION BY exchange, instrument_type, symbol ORDER BY time)""",
    "gaps": "SELECT exchange, instrument_type, symbol, make_timestamp(before) AS gap_start, time AS gap_end FROM stepped WHERE (us - before) * 10 > 3600000000 * 15",
    "missing": """SELECT g.*, s.t AS time FROM gaps g, LATERAL (SELECT unnest(generate_series(g.gap_start + INTERVAL 1 HOUR, g.gap_end - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS t) s""",
    "landed": "SELECT exchange, instrument_type, symbol, time, open, high, low, close, volume FROM (SELECT DISTINCT ON (exchange, instrument_type, symbol, time) * FROM (SELECT b.exchange, b.instrument_type, b.symbol, b.time + INTERVAL 1 HOUR AS time, b.open, b.high, b.low, b.close, b.volume FROM bars b) ORDER BY exchange, instrument_type, symbol, time)",
    "buckets": "SELECT exchange, symbol, date_trunc('hour', time) AS bucket, count(*) AS n FROM ticks GROUP BY 1, 2, 3",
    "waits": "SELECT exchange, us - before AS delta_us FROM (SELECT exchange, epoch_us(time) AS us, lag(epoch_us(time)) OVER (PARTITION BY exchange ORDER BY time, trade_id) AS before FROM ticks) WHERE before IS NOT NULL",
}


# --- bars and markets ----------------------------------------------------------------------------------------------------


@query(
    f"SELECT instrument_type, symbol, time, {', '.join(f'{_round2(p)} AS {p}' for p in C.PRICES)}, {_round2('volume')} AS volume, 'aggregated' AS exchange, '1h' AS timeframe "
    f"FROM (SELECT instrument_type, symbol, time, CAST(sum(volume) AS DOUBLE) AS volume, {_WEIGHTED} FROM bars GROUP BY instrument_type, symbol, time)",
    "ticks",
    "bars",
)
def venue_vwap_candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly candles of each venue, put together by volume."""
    return market.aggregate_exchanges(venue_bars(spark, sf_dir), asset="symbol", distinct=True, timeframe="1h")


@query(f"SELECT exchange, instrument_type, symbol, time, {_DOUBLE_PRICES}, CAST(volume AS DOUBLE) AS volume FROM bars", "ticks", "bars")
def tick_bars_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E4."""
    return doubles(venue_bars(spark, sf_dir), *C.PRICES, "volume")


@query(
    "SELECT exchange, make_timestamp(epoch_us(time) // 100000 * 100000) AS time, CAST(first(price ORDER BY time, trade_id) AS DOUBLE) AS open, CAST(max(price) AS DOUBLE) AS high, CAST(min(price) AS DOUBLE) AS low, CAST(last(price ORDER BY time, trade_id) AS DOUBLE) AS close, CAST(sum(qty) AS DOUBLE) AS volume, CAST(max(price) AS DOUBLE) - CAST(min(price) AS DOUBLE) AS volatility FROM ticks GROUP BY exchange, epoch_us(time) // 100000",
    "ticks",
)
def tick_bars_100ms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E4 and C23 at a tenth of a second."""
    return bars.micro_volatility(doubles(bars.tick_bars(ticks(spark, sf_dir), "100ms", ["exchange"]), *C.PRICES, "volume"))


@query("SELECT exchange, date_trunc('hour', time) AS time, CAST(last(price ORDER BY time, trade_id) AS DOUBLE) AS price, last(trade_id ORDER BY time, trade_id) AS trade_id FROM ticks GROUP BY 1, 2", "ticks")
def last_value_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E5."""
    return doubles(bars.last_value_resample(ticks(spark, sf_dir), "1h", ["exchange"], ["price", "trade_id"]), "price")


_SYN = ("ticks", "bars", "sparse", "merged", "filled", "rounded", "synthetic")


@query("SELECT *, 'aggregated' AS exchange, 'synthetic' AS instrument_type, '1h' AS timeframe FROM synthetic", *_SYN)
def synthetic_candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E2 with F9, C14, C15 and C16."""
    return synthetic(spark, sf_dir)


def _resampled(source: str, bar: str, frame: str, year: str = "NULL") -> str:
    outer = ", ".join(f"{_round2(c)} AS {c}" for c in ("open", "high", "low", "close", "volume", "quote_volume", "twap"))
    vwap = _round2("CASE WHEN volume = 0 THEN close ELSE pv / volume END")
    return f"""SELECT symbol, '{frame}' AS timeframe, time, open, greatest(high, open, close) AS high, least(low, open, close) AS low, close, volume, quote_volume, twap, vwap, anchor_year FROM (
        SELECT symbol, bar AS time, {outer}, {vwap} AS vwap, anchor_year FROM (
        SELECT symbol, bar, anchor_year, first(open ORDER BY time) FILTER (open IS NOT NULL) AS open, max(high) AS high, min(low) AS low, last(close ORDER BY time) FILTER (close IS NOT NULL) AS close,
        CAST(coalesce(sum(volume), 0) AS DOUBLE) AS volume, CAST(coalesce(sum(quote_volume), 0) AS DOUBLE) AS quote_volume, CAST(sum(twap) AS DOUBLE) / count(twap) AS twap, CAST(coalesce(sum(vwap * volume), 0) AS DOUBLE) AS pv
        FROM (SELECT *, {bar} AS bar, CAST({year} AS INTEGER) AS anchor_year FROM {source}) GROUP BY symbol, bar, anchor_year) WHERE open IS NOT NULL)"""


@query(_resampled("synthetic", "make_timestamp(epoch_us(time) // 14400000000 * 14400000000)", "4h") + " UNION ALL " + _resampled("synthetic", "date_trunc('day', time)", "1d"), *_SYN)
def resample_4h_1d(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E3 for two widths from one scan."""
    return bars.resample(synthetic(spark, sf_dir).drop("timeframe", "exchange", "instrument_type"), ["4h", "1d"])


@query(
    _resampled("(SELECT *, min(time) OVER (PARTITION BY symbol, year(time)) AS origin FROM daily)", "origin + to_days(CAST(date_diff('day', origin, time) // 3 * 3 AS INTEGER))", "3d", "year(time)"),
    "daily",
)
def resample_3d_year_anchor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three-day bars start anew each year."""
    return bars.resample(daily_bars(spark, sf_dir), ["3d"], distinct=True)


@query(_resampled("daily", "time - to_days(CAST(dayofweek(time) AS INTEGER))", "1w", "year(time)"), "daily")
def resample_1w_sunday(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weeks start on Sundays."""
    return bars.resample(daily_bars(spark, sf_dir), ["1w"], distinct=True)


@query(
    """SELECT symbol, time, max(CASE WHEN exchange = 'click' THEN CAST(close AS DOUBLE) END) AS spot, max(CASE WHEN exchange = 'view' THEN CAST(close AS DOUBLE) END) AS mark,
    max(CASE WHEN exchange = 'purchase' THEN CAST(close AS DOUBLE) END) AS index,
    max(CASE WHEN exchange = 'view' THEN CAST(close AS DOUBLE) END) - max(CASE WHEN exchange = 'click' THEN CAST(close AS DOUBLE) END) AS mark_minus_spot,
    max(CASE WHEN exchange = 'view' THEN CAST(close AS DOUBLE) END) - max(CASE WHEN exchange = 'purchase' THEN CAST(close AS DOUBLE) END) AS mark_minus_index
    FROM bars WHERE exchange IN ('click', 'view', 'purchase') GROUP BY symbol, time""",
    "ticks",
    "bars",
)
def basis_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D9."""
    hourly = doubles(venue_bars(spark, sf_dir), "close")
    return market.price_basis(*(hourly.where(F.col("exchange") == v) for v in ("click", "view", "purchase")))


@query(
    """SELECT s.symbol, count(*) AS bars, avg(abs(vwap - tick_vwap)) AS mean_abs_error, max(abs(vwap - tick_vwap)) AS max_abs_error, avg(abs(vwap - tick_vwap) / nullif(tick_vwap, 0)) AS mean_rel_error
    FROM synthetic s JOIN (SELECT symbol, date_trunc('hour', time) AS time, CAST(sum(price * qty) AS DOUBLE) / CAST(sum(qty) AS DOUBLE) AS tick_vwap FROM ticks GROUP BY 1, 2) t USING (symbol, time) GROUP BY s.symbol""",
    *_SYN,
)
def vwap_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E17."""
    return market.vwap_validation(synthetic(spark, sf_dir), market.tick_vwap(ticks(spark, sf_dir), "1h", ["symbol"]), ["symbol"])


# --- trades ---------------------------------------------------------------------------------------------------------------


@query(
    """SELECT exchange, trade_id, CASE WHEN is_buyer_maker THEN 'sell' ELSE 'buy' END AS side,
    CAST(sum(CASE WHEN is_buyer_maker THEN -qty ELSE qty END) OVER w AS DOUBLE) AS cvd, CAST(sum(price * qty) OVER w AS DOUBLE) / CAST(sum(qty) OVER w AS DOUBLE) AS vwap
    FROM ticks WINDOW w AS (PARTITION BY exchange ORDER BY time, trade_id ROWS UNBOUNDED PRECEDING)""",
    "ticks",
)
def trade_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F10, F11, C17 and C18."""
    flow = micro.trade_flow(ticks(spark, sf_dir), ["exchange"])
    return doubles(flow.select("exchange", "trade_id", "side", "cvd", "vwap"), "cvd")


@query(
    """SELECT exchange, count(*) AS n, CAST(sum(delta_us) AS DOUBLE) / count(*) / 1000 AS mean, min(delta_us) / 1000 AS min, max(delta_us) / 1000 AS max, count(*) FILTER (delta_us = 0) AS zero_gaps,
    quantile_cont(delta_us, 0.25) / 1000 AS p25, quantile_cont(delta_us, 0.5) / 1000 AS median, quantile_cont(delta_us, 0.75) / 1000 AS p75, quantile_cont(delta_us, 0.99) / 1000 AS p99, round(stddev_samp(delta_us / 1000), 3) AS std
    FROM waits GROUP BY exchange""",
    "ticks",
    "waits",
)
def inter_arrival_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E13 and F2."""
    stats = micro.inter_arrival_stats(micro.inter_arrival(ticks(spark, sf_dir), ["exchange"]), ["exchange"])
    return stats.withColumn("std", F.round("std", 3))


@query(
    """SELECT e.exchange, CAST(b.bin AS INTEGER) AS bin, lo + b.bin * ((hi - lo) / 50) AS bin_start, count(w.delta_us) AS n
    FROM (SELECT exchange, min(delta_us) AS lo, max(delta_us) AS hi FROM waits GROUP BY exchange) e CROSS JOIN range(50) b(bin)
    LEFT JOIN waits w ON w.exchange = e.exchange AND least((w.delta_us - lo) * 50 // (hi - lo), 49) = b.bin GROUP BY e.exchange, b.bin, lo, hi""",
    "ticks",
    "waits",
)
def inter_arrival_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E14."""
    return micro.histogram(micro.inter_arrival(ticks(spark, sf_dir), ["exchange"]), ["exchange"], "delta_us")


@query(
    "SELECT exchange, symbol, CAST(sum(qty) AS DOUBLE) AS total_volume, CAST(sum(qty) AS DOUBLE) / count(*) AS avg_trade_size, CAST(min(price) AS DOUBLE) AS min_price, CAST(max(price) AS DOUBLE) AS max_price, CAST(sum(price) AS DOUBLE) / count(*) AS avg_price, count(*) AS trades FROM ticks GROUP BY 1, 2",
    "ticks",
)
def tick_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E7."""
    return doubles(micro.tick_stats(ticks(spark, sf_dir), ["exchange", "symbol"]), "total_volume", "min_price", "max_price")


@query(
    "SELECT exchange, count(*) FILTER (NOT is_buyer_maker) AS buys, count(*) FILTER (is_buyer_maker) AS sells, count(*) FILTER (NOT is_buyer_maker) / count(*) AS buy_ratio, count(*) FILTER (is_buyer_maker) / count(*) AS sell_ratio FROM ticks GROUP BY 1",
    "ticks",
)
def buy_sell_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E8."""
    return micro.buy_sell_ratio(ticks(spark, sf_dir), ["exchange"])


@query("SELECT exchange, CAST(time AS DATE) AS date, count(*) AS count, min(time) AS min_time, max(time) AS max_time FROM ticks GROUP BY 1, 2", "ticks")
def daily_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E10."""
    return quality.daily_breakdown(ticks(spark, sf_dir), ["exchange"])


@query("SELECT exchange, symbol, min(time) AS start_date, max(time) AS end_date, count(*) AS count FROM ticks GROUP BY 1, 2", "ticks")
def coverage_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E6."""
    return quality.coverage_summary(ticks(spark, sf_dir), ["exchange", "symbol"])


@query(
    "SELECT g.exchange, g.symbol, g.t AS bucket, coalesce(b.n, 0) AS n FROM (SELECT exchange, symbol, unnest(generate_series(min(bucket), max(bucket), INTERVAL 1 HOUR)) AS t FROM buckets GROUP BY 1, 2) g LEFT JOIN buckets b ON b.exchange = g.exchange AND b.symbol = g.symbol AND b.bucket = g.t",
    "ticks",
    "buckets",
)
def bucket_counts_fill0(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E11."""
    return quality.bucket_counts_fill0(ticks(spark, sf_dir), ["exchange", "symbol"])


@query(
    "SELECT exchange, symbol, before + INTERVAL 1 HOUR AS gap_start, bucket AS gap_end, epoch_us(bucket) / 1e6 - epoch_us(before) / 1e6 - 3600 AS gap_seconds FROM (SELECT *, lag(bucket) OVER (PARTITION BY exchange, symbol ORDER BY bucket) AS before FROM buckets) WHERE bucket > before + INTERVAL 1 HOUR",
    "ticks",
    "buckets",
)
def empty_bucket_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F15."""
    return quality.empty_bucket_gaps(ticks(spark, sf_dir), ["exchange", "symbol"])


# --- candle sequences and quality -----------------------------------------------------------------------------------------


@query("SELECT exchange, instrument_type, symbol, gap_start, gap_end, (epoch_us(gap_end) - epoch_us(gap_start)) / 1e6 AS gap_seconds FROM gaps", "ticks", "bars", "stepped", "gaps")
def candle_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F13 and I5."""
    return quality.gap_report(venue_bars(spark, sf_dir), VENUE, "1h")


_JUDGED = "(us - before) * 10 BETWEEN 3600000000 * 9 AND 3600000000 * 11"


@query(
    f"SELECT *, CASE WHEN consecutive > 0 THEN aligned / consecutive * 100 ELSE 100 END AS alignment_score FROM (SELECT exchange, instrument_type, symbol, count(*) FILTER ({_JUDGED}) AS consecutive, count(*) FILTER ({_JUDGED} AND abs(CAST(open AS DOUBLE) - CAST(before_close AS DOUBLE)) < CAST(open AS DOUBLE) * 0.001) AS aligned FROM stepped GROUP BY 1, 2, 3)",
    "ticks",
    "bars",
    "stepped",
)
def open_close_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F14."""
    return sequence.open_close_alignment(doubles(venue_bars(spark, sf_dir), *C.PRICES), "1h", VENUE)


@query(
    f"""SELECT *, total_rows / expected_rows * 100 * 0.5 + alignment_score * 0.3 + greatest(0, 100 - anomalies) * 0.2 AS quality_score FROM (
    SELECT *, expected_rows - total_rows AS missing_rows, CASE WHEN consecutive > 0 THEN aligned / consecutive * 100 ELSE 100 END AS alignment_score FROM (
    SELECT exchange, instrument_type, symbol, min(time) AS start_date, max(time) AS end_date, count(*) AS total_rows, (max(us) - min(us)) // 3600000000 + 1 AS expected_rows,
    count(*) FILTER ((us - before) * 10 > 3600000000 * 15) AS gap_count, CAST(coalesce(sum(us - before) FILTER ((us - before) * 10 > 3600000000 * 15), 0) AS DOUBLE) / 1e6 AS gap_seconds,
    count(*) FILTER ({_JUDGED}) AS consecutive, count(*) FILTER ({_JUDGED} AND abs(CAST(open AS DOUBLE) - CAST(before_close AS DOUBLE)) < CAST(open AS DOUBLE) * 0.001) AS aligned,
    count(*) FILTER (open <= 0 OR high <= 0 OR low <= 0 OR close <= 0 OR high < low OR volume < 0) AS anomalies,
    CAST(min(low) AS DOUBLE) AS price_min, CAST(max(high) AS DOUBLE) AS price_max, CAST(sum(close) AS DOUBLE) / count(*) AS price_avg, CAST(sum(volume) AS DOUBLE) AS volume_total,
    CAST(sum(volume) AS DOUBLE) / count(*) AS volume_avg, CAST(min(volume) AS DOUBLE) AS volume_min, CAST(max(volume) AS DOUBLE) AS volume_max FROM stepped GROUP BY 1, 2, 3))""",
    "ticks",
    "bars",
    "stepped",
)
def ohlcv_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I1 with F13, F14, C19 and E12."""
    rows = venue_bars(spark, sf_dir).withColumns({p: F.col(p).cast("double") for p in ("open",)})
    report = quality.ohlcv_quality(rows.withColumn("timeframe", F.lit("1h")), VENUE)
    return doubles(report, "price_min", "price_max", "volume_min", "volume_max")


@query(
    "SELECT exchange, instrument_type, symbol, CAST(min(low) AS DOUBLE) AS price_min, CAST(max(high) AS DOUBLE) AS price_max, CAST(sum(close) AS DOUBLE) / count(*) AS price_avg, CAST(sum(volume) AS DOUBLE) AS volume_total, CAST(sum(volume) AS DOUBLE) / count(*) AS volume_avg, CAST(min(volume) AS DOUBLE) AS volume_min, CAST(max(volume) AS DOUBLE) AS volume_max FROM bars GROUP BY 1, 2, 3",
    "ticks",
    "bars",
)
def candle_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E12."""
    return doubles(quality.candle_stats(venue_bars(spark, sf_dir), VENUE), "price_min", "price_max", "volume_min", "volume_max")


@query(
    "SELECT symbol, min(day) AS start_date, max(day) AS end_date, count(*) AS total_days, CAST(date_diff('day', min(day), max(day)) + 1 AS INTEGER) AS expected_days, CAST(sum(n) AS BIGINT) AS total_rows, date_diff('day', min(day), max(day)) + 1 - count(*) AS missing_days, count(*) / (date_diff('day', min(day), max(day)) + 1) * 100 AS quality_score FROM (SELECT o_custkey % 20 AS symbol, CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY 1, 2) GROUP BY symbol"
)
def tick_quality_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I2."""
    return quality.tick_quality_days(order_days(spark, sf_dir), ["symbol"])


_TICK_REPORT = """SELECT t.*, CAST(coalesce(g.gap_count, 0) AS BIGINT) AS gap_count, coalesce(g.gap_seconds, 0) AS gap_seconds,
    CASE WHEN span > 0 THEN greatest(0, 100 * (1 - coalesce(g.gap_seconds, 0) / span)) ELSE 100 END AS quality_score FROM (
    SELECT exchange, instrument_type, symbol, min(time) AS start_date, max(time) AS end_date, count(*) AS total_rows, (epoch_us(max(time)) - epoch_us(min(time))) / 1e6 AS span,
    CAST(sum(qty) AS DOUBLE) AS total_volume, CAST(sum(qty) AS DOUBLE) / count(*) AS avg_trade_size, CAST(min(price) AS DOUBLE) AS min_price, CAST(max(price) AS DOUBLE) AS max_price, CAST(sum(price) AS DOUBLE) / count(*) AS avg_price,
    count(*) AS trades, count(*) FILTER (NOT is_buyer_maker) AS buys, count(*) FILTER (is_buyer_maker) AS sells, count(*) FILTER (NOT is_buyer_maker) / count(*) AS buy_ratio, count(*) FILTER (is_buyer_maker) / count(*) AS sell_ratio, 'trades' AS data_type
    FROM ticks GROUP BY 1, 2, 3) t LEFT JOIN (SELECT exchange, instrument_type, symbol, count(*) AS gap_count, CAST(sum(us - before - 3600000000) AS DOUBLE) / 1e6 AS gap_seconds FROM stepped WHERE us - before > 3600000000 GROUP BY 1, 2, 3) g USING (exchange, instrument_type, symbol)"""


@query(f"SELECT * EXCLUDE (span) FROM ({_TICK_REPORT})", "ticks", "bars", "stepped")
def tick_quality_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I3 with E6, E7, E8 and F15 from one pass over the trades."""
    return doubles(quality.tick_quality_gaps(ticks(spark, sf_dir), VENUE), "total_volume", "min_price", "max_price")


@query(
    f"""SELECT exchange, instrument_type, symbol, 'ohlcv' AS data_type, '1h' AS timeframe, min(time) AS start_date, max(time) AS end_date, count(*) AS total_rows,
    count(*) / ((max(us) - min(us)) // 3600000000 + 1) * 100 * 0.5 + CASE WHEN count(*) FILTER ({_JUDGED}) > 0 THEN count(*) FILTER ({_JUDGED} AND abs(CAST(open AS DOUBLE) - CAST(before_close AS DOUBLE)) < CAST(open AS DOUBLE) * 0.001) / count(*) FILTER ({_JUDGED}) * 100 ELSE 100 END * 0.3
    + greatest(0, 100 - count(*) FILTER (open <= 0 OR high <= 0 OR low <= 0 OR close <= 0 OR high < low OR volume < 0)) * 0.2 AS quality_score,
    CAST(sum(volume) AS DOUBLE) AS volume_total, CAST(min(low) AS DOUBLE) AS price_min, CAST(max(high) AS DOUBLE) AS price_max, CAST(NULL AS BIGINT) AS trades, CAST(NULL AS DOUBLE) AS buy_ratio, CAST(NULL AS DOUBLE) AS sell_ratio,
    count(*) FILTER ((us - before) * 10 > 3600000000 * 15) AS gap_count, CAST(coalesce(sum(us - before) FILTER ((us - before) * 10 > 3600000000 * 15), 0) AS DOUBLE) / 1e6 AS gap_seconds FROM stepped GROUP BY 1, 2, 3
    UNION ALL SELECT exchange, instrument_type, symbol, data_type, NULL, start_date, end_date, total_rows, quality_score, total_volume, min_price, max_price, trades, buy_ratio, sell_ratio, gap_count, gap_seconds FROM ({_TICK_REPORT})""",
    "ticks",
    "bars",
    "stepped",
)
def quality_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candles and trades in one report."""
    rows = venue_bars(spark, sf_dir).withColumns({"timeframe": F.lit("1h"), "open": F.col("open").cast("double")})
    return quality.quality_summary(quality.ohlcv_quality(rows), quality.tick_quality_gaps(ticks(spark, sf_dir)))


@query(
    """SELECT r.symbol, r.start_ts, r.end_ts, coalesce(min(d.t) <= r.start_ts + INTERVAL 1 HOUR AND max(d.t) >= r.end_ts - INTERVAL 1 HOUR, FALSE) AS has_data
    FROM requests r LEFT JOIN (SELECT DISTINCT o_custkey % 20 AS symbol, o_orderdate AS t FROM orders) d ON d.symbol = r.symbol AND d.t >= r.start_ts AND d.t < r.end_ts GROUP BY 1, 2, 3""",
    "requests",
)
def has_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E9."""
    return quality.has_data(order_days(spark, sf_dir), requests(spark, sf_dir), ["symbol"])


# --- ranges and days ------------------------------------------------------------------------------------------------------


@query("SELECT * FROM islands", "covered", "islands")
def coalesce_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F16."""
    return intervals.coalesce_intervals(covered(spark, sf_dir), ["symbol"])


_GAPS = """SELECT r.symbol, r.start_ts AS request_start, r.end_ts AS request_end, greatest(h.a, r.start_ts) AS gap_start, least(h.b, r.end_ts) AS gap_end FROM {requests} r JOIN (
    SELECT symbol, coalesce(lag(end_ts) OVER (PARTITION BY symbol ORDER BY start_ts), TIMESTAMP '1900-01-01') AS a, start_ts AS b FROM islands
    UNION ALL SELECT symbol, max(end_ts), TIMESTAMP '2900-01-01' FROM islands GROUP BY symbol) h ON h.symbol = r.symbol AND h.a < r.end_ts AND h.b > r.start_ts"""


@query(_GAPS.format(requests="requests"), "covered", "islands", "requests")
def coverage_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F17."""
    return intervals.coverage_gaps(requests(spark, sf_dir), covered(spark, sf_dir), ["symbol"])


@query(
    _GAPS.format(requests="(SELECT DISTINCT r.symbol, greatest(r.start_ts, l.at) AS start_ts, r.end_ts FROM requests r JOIN (SELECT o_custkey % 20 AS symbol, max(o_orderdate) - INTERVAL 1000 DAY AS at FROM orders GROUP BY 1) l ON l.symbol = r.symbol WHERE greatest(r.start_ts, l.at) < r.end_ts)"),
    "covered",
    "islands",
    "requests",
)
def pending_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J3 with C4: what is still to be landed since a series was listed."""
    listing = order_days(spark, sf_dir).groupBy("symbol").agg(F.timestamp_add("DAY", F.lit(-1000), F.max("time")).alias("listing_date"))
    return intervals.pending_ranges(requests(spark, sf_dir), covered(spark, sf_dir), listing, ["symbol"])


@query("SELECT symbol, min(day) AS first_day, max(day) AS last_day, count(*) AS days FROM (SELECT *, day - CAST(row_number() OVER (PARTITION BY symbol ORDER BY day) AS INTEGER) AS run FROM days) GROUP BY symbol, run", "days")
def contiguous_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F18."""
    return intervals.contiguous_days(order_days(spark, sf_dir), ["symbol"])


@query(
    "SELECT symbol, CAST(g.d AS DATE) AS missing_day FROM (SELECT symbol, unnest(generate_series(CAST(min(day) AS TIMESTAMP), CAST(max(day) AS TIMESTAMP), INTERVAL 1 DAY)) AS d FROM days GROUP BY symbol) g WHERE NOT EXISTS (SELECT 1 FROM days x WHERE x.symbol = g.symbol AND x.day = CAST(g.d AS DATE))",
    "days",
)
def missing_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D5 and I8."""
    return intervals.missing_days(order_days(spark, sf_dir), ["symbol"])


_REBUILT = "SELECT symbol, CAST(min(day) AS TIMESTAMP) AS start_ts, CAST(max(day) AS TIMESTAMP) + INTERVAL 1 DAY AS end_ts FROM (SELECT *, day - CAST(row_number() OVER (PARTITION BY symbol ORDER BY day) AS INTEGER) AS run FROM days) GROUP BY symbol, run"


@query(_REBUILT, "days")
def rebuild_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E16."""
    return intervals.rebuild_coverage(order_days(spark, sf_dir), "1d", ["symbol"])


SQL["known"] = f"SELECT * FROM requests UNION ALL {_REBUILT}"
SQL["advanced"] = SQL["islands"].replace("FROM covered", "FROM known")


@query("SELECT * FROM advanced", "days", "requests", "known", "advanced")
def advance_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J4."""
    return intervals.advance_coverage(requests(spark, sf_dir), order_days(spark, sf_dir), "1d", ["symbol"])


@query(
    "SELECT DISTINCT c.symbol, CAST(d.t AS DATE) AS date FROM covered c, LATERAL (SELECT unnest(generate_series(date_trunc('day', c.start_ts), c.end_ts - INTERVAL 1 MICROSECOND, INTERVAL 1 DAY)) AS t) d WHERE NOT EXISTS (SELECT 1 FROM days x WHERE x.symbol = c.symbol AND x.day = CAST(d.t AS DATE))",
    "covered",
    "days",
)
def claimed_but_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D7 and I9."""
    days = order_days(spark, sf_dir)
    return intervals.claimed_but_missing(covered(spark, sf_dir), days.select("symbol", utc_date(days, "time").alias("date")), ["symbol"])


@query("SELECT DISTINCT exchange, CAST(time AS DATE) AS date FROM ticks WHERE CAST(time AS DATE) NOT IN (SELECT CAST(time AS DATE) FROM ticks WHERE exchange = 'purchase' AND price > 260)", "ticks")
def pending_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days without a dear purchase."""
    source = ticks(spark, sf_dir).withColumn("date", F.to_date("time"))
    done = source.where((F.col("exchange") == "purchase") & (F.col("price") > 260))
    return intervals.pending_days(source, done.select("date").distinct().join(source.select("exchange").distinct(), F.lit(True)), ["exchange", "date"])


@query("SELECT exchange, symbol, min(time) AS listing_date FROM ticks GROUP BY 1, 2", "ticks")
def listing_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E15."""
    return intervals.listing_dates(ticks(spark, sf_dir), ["exchange", "symbol"])


@query("SELECT exchange, count(DISTINCT symbol) AS symbols FROM ticks GROUP BY exchange HAVING count(DISTINCT symbol) > 1", "ticks")
def mixed_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The warning of E16, and H5."""
    return intervals.mixed_symbols(ticks(spark, sf_dir), ["exchange"])


# --- repair ---------------------------------------------------------------------------------------------------------------

_STORED = ("ticks", "bars", "stepped", "gaps", "missing")
_LAST_CLOSE = "coalesce((SELECT last(CAST(b.close AS DOUBLE) ORDER BY b.time) FROM bars b WHERE b.exchange = m.exchange AND b.instrument_type = m.instrument_type AND b.symbol = m.symbol AND b.time < m.gap_start), 0)"


def _gaps(rows: DataFrame) -> DataFrame:
    return sequence.candle_gaps(rows, "1h", VENUE)


@query(f"SELECT exchange, instrument_type, symbol, time, c AS open, c AS high, c AS low, c AS close, CAST(0 AS DOUBLE) AS volume, TRUE AS is_interpolated FROM (SELECT m.*, {_LAST_CLOSE} AS c FROM missing m)", *_STORED)
def zero_fill_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 and D8."""
    rows = doubles(venue_bars(spark, sf_dir), *C.PRICES, "volume")
    return repair.zero_fill_gaps(_gaps(rows), rows, "1h", VENUE)


def _landed(rows: DataFrame) -> DataFrame:
    """A second landing: every candle an hour late, twice."""
    late = rows.withColumn("time", F.timestamp_add("HOUR", F.lit(1), F.col("time")))
    return late.unionByName(late)


@query(
    f"""SELECT m.exchange, m.instrument_type, m.symbol, m.time, coalesce(CAST(l.open AS DOUBLE), c) AS open, coalesce(CAST(l.high AS DOUBLE), c) AS high, coalesce(CAST(l.low AS DOUBLE), c) AS low, coalesce(CAST(l.close AS DOUBLE), c) AS close,
    coalesce(CAST(l.volume AS DOUBLE), 0) AS volume, l.open IS NULL AS is_interpolated FROM (SELECT m.*, {_LAST_CLOSE} AS c FROM missing m) m LEFT JOIN landed l ON l.exchange = m.exchange AND l.instrument_type = m.instrument_type AND l.symbol = m.symbol AND l.time = m.time""",
    *_STORED,
    "landed",
)
def repair_from_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2."""
    rows = doubles(venue_bars(spark, sf_dir), *C.PRICES, "volume")
    return repair.repair_from_landing(_gaps(rows), rows, _landed(rows), "1h", VENUE)


@query(
    """SELECT m.exchange, m.instrument_type, m.symbol, m.gap_start, m.gap_end, count(*) AS steps, count(l.open) AS landed_steps, CASE WHEN count(l.open) = count(*) THEN 'filled' WHEN count(l.open) = 0 THEN 'zero_filled' ELSE 'partial' END AS status
    FROM missing m LEFT JOIN landed l ON l.exchange = m.exchange AND l.instrument_type = m.instrument_type AND l.symbol = m.symbol AND l.time = m.time GROUP BY 1, 2, 3, 4, 5""",
    *_STORED,
    "landed",
)
def repair_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The outcome that J2 reports for each gap."""
    rows = doubles(venue_bars(spark, sf_dir), *C.PRICES, "volume")
    return repair.repair_status(_gaps(rows), rows, _landed(rows), "1h", VENUE)


@query(
    "SELECT exchange, instrument_type, symbol, t AS time, CAST(open AS DOUBLE) AS open, CAST(high AS DOUBLE) AS high, CAST(low AS DOUBLE) AS low, CAST(close AS DOUBLE) AS close, CAST(volume AS DOUBLE) AS volume, t <> time AS is_filled FROM (SELECT *, unnest(generate_series(time, coalesce(lead(time) OVER (PARTITION BY exchange, instrument_type, symbol ORDER BY time) - INTERVAL 1 HOUR, time), INTERVAL 1 HOUR)) AS t FROM bars)",
    "ticks",
    "bars",
)
def asof_ffill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D4."""
    return sequence.asof_fill(doubles(venue_bars(spark, sf_dir), *C.PRICES, "volume"), "1h", VENUE)


@query(
    "SELECT exchange, instrument_type, symbol, time, CAST(coalesce(open, lag(close) OVER (PARTITION BY exchange, instrument_type, symbol ORDER BY time)) AS DOUBLE) AS open FROM sparse",
    "ticks",
    "bars",
    "sparse",
)
def fill_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1."""
    filled = sequence.fill_open(sparse_bars(spark, sf_dir), VENUE)
    return doubles(filled.select(*VENUE, "time", "open"), "open")


# --- sliding features -----------------------------------------------------------------------------------------------------

_FIGURES = ("open", "high", "low", "close", "volume", "quote_volume", "twap", "vwap")


def minute_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bars.tick_bars(ticks(spark, sf_dir), "1m", ["symbol"])
    rows = doubles(rows.withColumn("volume", F.col("volume").cast("decimal(18,0)")), *C.PRICES, "volume")
    return rows.withColumns({"twap": C.ohlc4(), "vwap": C.ohlc4(), "quote_volume": C.ohlc4() * F.col("volume")})


SQL["minutes"] = f"""SELECT *, {_OHLC4} AS twap, {_OHLC4} AS vwap, {_OHLC4} * volume AS quote_volume FROM (SELECT symbol, date_trunc('minute', time) AS time,
    CAST(first(price ORDER BY time, trade_id) AS DOUBLE) AS open, CAST(max(price) AS DOUBLE) AS high, CAST(min(price) AS DOUBLE) AS low, CAST(last(price ORDER BY time, trade_id) AS DOUBLE) AS close, CAST(sum(qty) AS DOUBLE) AS volume FROM ticks GROUP BY symbol, date_trunc('minute', time))"""
SQL["grid"] = """SELECT g.symbol, g.m AS time, c.* EXCLUDE (symbol, time) FROM (
    SELECT symbol, unnest(generate_series(min(time), date_trunc('day', max(time)) + INTERVAL 1439 MINUTE, INTERVAL 1 MINUTE)) AS m FROM minutes GROUP BY symbol) g
    ASOF JOIN minutes c ON c.symbol = g.symbol AND g.m >= c.time"""
SQL["day_ends"] = "SELECT symbol, CAST(time AS DATE) AS day, max(time) AS last FROM minutes GROUP BY 1, 2"


def _rolled(interval: str, w: int) -> str:
    over = "(PARTITION BY symbol ORDER BY time)"
    frame = f"(PARTITION BY symbol ORDER BY time ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW)"
    return f"""SELECT symbol, time, '{interval}' AS interval, coalesce(lag(open, {w - 1}) OVER {over}, first_value(open) OVER {over}) AS open, max(high) OVER {frame} AS high, min(low) OVER {frame} AS low, close,
        sum(volume) OVER {frame} AS volume, sum(quote_volume) OVER {frame} AS quote_volume, avg(twap) OVER {frame} AS twap, sum(vwap * volume) OVER {frame} / sum(volume) OVER {frame} AS vwap FROM grid"""


SQL["rolled"] = _rolled("1m", 1) + " UNION ALL " + _rolled("1h", 60)
_SLIDING = ("ticks", "minutes", "grid", "day_ends", "rolled")


def sliding_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sliding.sliding_features(minute_bars(spark, sf_dir), ["1m", "1h"])


@query(
    "SELECT e.symbol, e.time, e.interval, "
    + ", ".join(f"CASE WHEN e.time <= e.last THEN round(r.{f} + 1e-8, 4) END AS {f}" for f in _FIGURES)
    + """ FROM (SELECT symbol, last, name AS interval, unnest(generate_series(CAST(day AS TIMESTAMP), CAST(day AS TIMESTAMP) + INTERVAL 1439 MINUTE, INTERVAL 1 MINUTE)) AS time
    FROM day_ends, (VALUES ('1m'), ('1h')) i(name)) e LEFT JOIN rolled r ON r.symbol = e.symbol AND r.interval = e.interval AND r.time = e.time""",
    *_SLIDING,
)
def sliding_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J5 with F3 to F8 and D3, one row per minute and interval.

    Means often end on a rounding tie, which the order of a sum would settle; hence the offset.
    """
    each = sliding.long_features(sliding_table(spark, sf_dir), ["1m", "1h"], _FIGURES, ["symbol"])
    return each.withColumns({f: F.round(F.col(f) + F.lit(1e-8), 4) for f in _FIGURES})


@query(
    "SELECT e.symbol, e.day AS date, 2 * 8 * (1440 - count(r.time)) AS missing_values, min(r.low_open) AS min_open, coalesce(min(r.low_open) <= 0, FALSE) AS open_not_positive FROM day_ends e JOIN (SELECT symbol, time, min(open) AS low_open FROM rolled GROUP BY 1, 2) r ON r.symbol = e.symbol AND CAST(r.time AS DATE) = e.day AND r.time <= e.last GROUP BY e.symbol, e.day",
    *_SLIDING,
)
def sliding_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I6."""
    return sliding.sliding_quality(sliding_table(spark, sf_dir), _FIGURES, ["symbol"])


@query("SELECT exchange, instrument_type, symbol, time, trade_id FROM ticks QUALIFY row_number() OVER (PARTITION BY exchange, symbol, date_trunc('hour', time) ORDER BY time, trade_id) = 1", "ticks")
def dedup_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F12 with the stored row winning."""
    rows = ticks(spark, sf_dir).withColumn("hour", F.date_trunc("hour", "time"))
    return keep_one(rows, ["exchange", "symbol", "hour"], ["time", "trade_id"], "first").select(*VENUE, "time", "trade_id")


@query("SELECT exchange, instrument_type, symbol, time, trade_id FROM ticks QUALIFY row_number() OVER (PARTITION BY exchange, symbol, date_trunc('hour', time) ORDER BY time DESC, trade_id DESC) = 1", "ticks")
def dedup_keep_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F12 with the new row winning."""
    rows = ticks(spark, sf_dir).withColumn("hour", F.date_trunc("hour", "time"))
    return keep_one(rows, ["exchange", "symbol", "hour"], ["time", "trade_id"], "last").select(*VENUE, "time", "trade_id")


# --- storage --------------------------------------------------------------------------------------------------------------


def _halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Stored and new trades that share a third of their keys, where the new ones cost more."""
    rows = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("price"))
    new = rows.where(F.col("l_orderkey") % 3 != 1).withColumn("price", F.col("price") + 1)
    return rows.where(F.col("l_orderkey") % 3 != 0), new


def _merged(best: str) -> str:
    return f"""SELECT l_orderkey, l_linenumber, price FROM (
        SELECT 0 AS side, l_orderkey, l_linenumber, l_extendedprice AS price FROM lineitem WHERE l_orderkey % 3 <> 0
        UNION ALL SELECT 1, l_orderkey, l_linenumber, l_extendedprice + 1 FROM lineitem WHERE l_orderkey % 3 <> 1)
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY side {best}, price {best}) = 1"""


@query(_merged("ASC"))
def merge_stored_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an upsert writes for a dataset whose stored rows stay."""
    return merge(*_halves(spark, sf_dir), ["l_orderkey", "l_linenumber"], "first")


@query(_merged("DESC"))
def merge_new_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an upsert writes for a dataset whose new rows win."""
    return merge(*_halves(spark, sf_dir), ["l_orderkey", "l_linenumber"], "last")


@query(f"SELECT exchange, instrument_type, symbol, epoch_us(time) AS us, {_DOUBLE_PRICES}, CASE WHEN symbol = 'A2' THEN 0 ELSE CAST(volume AS DOUBLE) END AS volume FROM bars WHERE symbol <> 'A3'", "ticks", "bars")
def landed_candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candles from answers in JSON, of which A3's lack their close and A2's their volume."""
    rows = doubles(venue_bars(spark, sf_dir), *C.PRICES, "volume")
    rows = rows.withColumns({"close": F.when(F.col("symbol") != "A3", F.col("close")), "volume": F.when(F.col("symbol") != "A2", F.col("volume"))})
    ms = F.timestamp_diff("MILLISECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), F.col("time")).cast("double")
    answer = F.to_json(F.array(F.array(ms, *C.PRICES, "volume")))
    landed = land.land_candles(rows.select(*VENUE, F.lit("1h").alias("timeframe"), answer.alias("answer")))
    return landed.select(*VENUE, F.unix_micros("time").alias("us"), *C.PRICES, "volume")


@query("SELECT DISTINCT instrument_type, exchange AS venue, CASE trade_id % 3 WHEN 0 THEN 'trades' WHEN 1 THEN 'metrics' ELSE 'fundingRate' END AS data_type FROM ticks WHERE instrument_type = 'swap' OR trade_id % 3 = 0", "ticks")
def offered_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of the wanted datasets each market type offers."""
    n = F.col("trade_id") % 3
    kind = F.when(n == 0, "trades").when(n == 1, "metrics").otherwise("fundingRate")
    wanted = ticks(spark, sf_dir).select("instrument_type", F.col("exchange").alias("venue"), kind.alias("data_type")).distinct()
    return available(wanted, spark)


@query("SELECT CAST(time AS DATE) AS date FROM ticks WHERE exchange = 'click' AND price > 200 UNION SELECT CAST(time AS DATE) FROM ticks WHERE exchange = 'view' AND price > 200", "ticks")
def union_of_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H2: days on which either of two venues saw a dear trade."""
    rows = ticks(spark, sf_dir).where("price > 200")
    rows = rows.withColumn("date", utc_date(rows, "time"))
    return intervals.union_days(rows.where("exchange = 'click'"), rows.where("exchange = 'view'"), ["date"])


SQL["agg"] = f"SELECT instrument_type, symbol, time, {', '.join(f'{_round2(p)} AS {p}' for p in C.PRICES)}, {_round2('volume')} AS volume FROM (SELECT instrument_type, symbol, time, CAST(sum(volume) AS DOUBLE) AS volume, {_WEIGHTED} FROM bars GROUP BY instrument_type, symbol, time)"
SQL["agg_merged"] = SQL["merged"].replace("FROM sparse", "FROM agg")
SQL["agg_filled"] = SQL["filled"].replace("FROM merged", "FROM agg_merged")
SQL["agg_rounded"] = SQL["rounded"].replace("FROM filled", "FROM agg_filled")
SQL["agg_synthetic"] = SQL["synthetic"].replace("FROM rounded", "FROM agg_rounded")


@query(_resampled("agg_synthetic", "make_timestamp(epoch_us(time) // 14400000000 * 14400000000)", "4h"), "ticks", "bars", "agg", "agg_merged", "agg_filled", "agg_rounded", "agg_synthetic")
def regenerated_4h(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole chain of the regeneration job: trades, venues, markets, coarser bars."""
    venues = market.aggregate_exchanges(venue_bars(spark, sf_dir), asset="symbol", distinct=True)
    merged = market.synthesize(venues)
    return bars.resample(merged.drop("timeframe", "exchange", "instrument_type"), ["4h"], distinct=True)


# --- columns --------------------------------------------------------------------------------------------------------------


def _symbols(n: Column) -> Column:
    names = ("BTC/USD", "BTC/USD:BTC", "BTC/USDT:USDT", "ETH/USD:USDC")
    return F.element_at(F.array(*[F.lit(x) for x in names]), (n % 4 + 1).cast("int"))


@query(
    """SELECT event_id, split_part(sym, '/', 1) AS asset, sym IN ('BTC/USD', 'BTC/USD:BTC') AS inverse,
    CASE WHEN sym IN ('BTC/USD', 'BTC/USD:BTC') AND event_type <> 'click' THEN CASE WHEN value = 0 THEN 0 ELSE 100 / ((value + value + value + value) / 4) END ELSE 100 END AS volume
    FROM (SELECT *, (['BTC/USD', 'BTC/USD:BTC', 'BTC/USDT:USDT', 'ETH/USD:USDC'])[user_id % 4 + 1] AS sym FROM events)"""
)
def inverse_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C8, C9 and C10."""
    kind = F.when(F.col("event_type") == "click", "spot").otherwise("swap")
    rows = load(spark, sf_dir, "events").withColumns({"symbol": _symbols(F.col("user_id")), "instrument_type": kind, "exchange": F.lit("bitmex"), "volume": F.lit(100.0)})
    rows = rows.withColumns({p: F.col("value") for p in C.PRICES})
    out = market.normalise_inverse_volume(rows)
    return out.select("event_id", C.base_asset(F.col("symbol")).alias("asset"), C.is_inverse_usd(F.col("symbol")).alias("inverse"), "volume")


@query(
    "SELECT event_id, CASE event_id % 4 WHEN 0 THEN epoch_us(ts) // 1000000 * 1000000 WHEN 1 THEN epoch_us(ts) // 1000 * 1000 WHEN 2 THEN epoch_us(ts) ELSE NULL END AS us FROM events"
)
def epoch_unit_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C6 on seconds, milliseconds, microseconds and text that is no time."""
    us = F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), F.col("ts"))
    kinds = F.col("event_id") % 4
    written = F.when(kinds == 0, F.floor(us / 1_000_000).cast("string")).when(kinds == 1, F.floor(us / 1_000).cast("string")).when(kinds == 2, us.cast("string")).otherwise("Infinity")
    return load(spark, sf_dir, "events").select("event_id", C.epoch_to_micros(written).alias("us"))


@query(
    "SELECT event_id, event_id % 3 = 0 AS flag, CASE WHEN event_id % 5 = 0 THEN -1 ELSE user_id END AS id, CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS number FROM events"
)
def coerced_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C11, C12 and C13 on text."""
    n = F.col("event_id")
    words = F.when(n % 3 == 0, "True").when(n % 3 == 1, "nan").otherwise(F.lit(None))
    rows = load(spark, sf_dir, "events").select(
        "event_id", words.alias("flag"), F.when(n % 5 != 0, F.concat(F.col("user_id").cast("string"), F.lit(".0"))).alias("id"),
        F.when(n % 7 == 0, "n/a").otherwise(F.concat(F.lit(" "), F.col("value").cast("string"))).alias("number"),
    )
    rows = C.numeric_text(rows, ["number"])
    return rows.select("event_id", C.to_bool(F.col("flag")).alias("flag"), C.to_id(F.col("id")).alias("id"), "number")


@query("SELECT event_id, round_even(value * 1.005 * 100, 0) / 100 AS rounded, value <= 0 AS anomalous FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-20' AND event_type = 'view'")
def filtered_rounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1, C2, C3, C14 and C19."""
    start, end = (F.expr(f"TIMESTAMP_NTZ'2024-01-{d}'") for d in ("05", "20"))
    rows = load(spark, sf_dir, "events").where(C.equals(event_type="view")).where((F.col("ts") >= start) & (F.col("ts") < end))
    rows = rows.withColumns({p: F.col("value") for p in C.PRICES} | {"volume": F.lit(1.0)})
    return rows.select("event_id", C.round2(F.col("value") * 1.005).alias("rounded"), C.candle_is_anomalous().alias("anomalous"))
