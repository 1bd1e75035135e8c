"""What is stored: schema, key and keep policy of every dataset, and which of them a market type offers."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SERIES = ("exchange", "instrument_type", "symbol")
PARTITIONS = ("exchange", "instrument_type", "base_asset", "date")
#: The order in which rows of one landing arrived, which settles equal keys among them; it is not stored.
ARRIVAL = "_seq"


@dataclass(frozen=True)
class Dataset:
    """columns: beyond the series columns, in DDL. key: beyond the series. keep: which of equal keys stays."""

    name: str
    columns: str
    key: tuple[str, ...]
    keep: str = "last"
    vendor: tuple[str, ...] = ()
    renamed: dict[str, str] = field(default_factory=dict)

    @property
    def schema(self) -> T.StructType:
        series = ", ".join(f"{c} string" for c in SERIES)
        return T.StructType.fromDDL(f"{series}, {self.columns}")

    @property
    def folders(self) -> tuple[str, ...]:
        """Folder levels of the stored table: candles of different widths lie apart, so that one width can be read alone."""
        return (*PARTITIONS[:-1], "timeframe", "date") if "timeframe" in self.schema.names else PARTITIONS


_OHLC = "open double, high double, low double, close double"
_FIGURES = f"{_OHLC}, volume double, quote_volume double, twap double, vwap double"
# The columns of vendor files without a header, in their order.
_KLINE = ("open_time", "open", "high", "low", "close", "volume", "close_time", "quote_volume", "count", "taker_buy_volume", "taker_buy_quote_volume", "ignore")
_TRADE = ("trade_id", "price", "qty", "quote_qty", "time", "is_buyer_maker", "is_best_match")
_AGG = ("agg_trade_id", "price", "qty", "first_trade_id", "last_trade_id", "time", "is_buyer_maker", "is_best_match")
_BOOK_TICKER = ("update_id", "best_bid_price", "best_bid_qty", "best_ask_price", "best_ask_qty", "time", "symbol")
_DEPTH = ("timestamp", "percentage", "depth", "notional")
_LIQUIDATION = (
    "time", "side", "order_type", "time_in_force", "original_quantity", "price", "average_price", "order_status",
    "last_fill_quantity", "accumulated_fill_quantity",
)
_METRICS = (
    "create_time", "symbol", "sum_open_interest", "sum_open_interest_value", "count_top_trader_long_short_ratio",
    "sum_top_trader_long_short_ratio", "count_long_short_ratio", "sum_long_short_ratio",
)
_FUNDING = ("calc_time", "symbol", "last_funding_rate")

# Other names under which vendor headers have a column.
HEADER_NAMES = {
    "id": "trade_id", "quantity": "qty", "quote_quantity": "quote_qty", "transact_time": "time", "transacttime": "time", "transaction_time": "time",
    "opentime": "open_time", "closetime": "close_time", "t": "time", "timestamp": "timestamp", "funding_time": "calc_time", "fundingtime": "calc_time",
    "funding_rate": "last_funding_rate", "fundingrate": "last_funding_rate",
}


def _klines(name: str) -> Dataset:
    columns = f"time timestamp, timeframe string, {_OHLC}, count bigint"
    return Dataset(name, columns, ("timeframe", "time"), "last", _KLINE, {"open_time": "time"})


def _doubles(*names: str) -> str:
    return ", ".join(f"{n} double" for n in names)


DATASETS: dict[str, Dataset] = {
    d.name: d
    for d in (
        Dataset("ohlcv", f"time timestamp, timeframe string, {_OHLC}, volume double, is_interpolated boolean", ("timeframe", "time"), "first"),
        Dataset("trades", "trade_id bigint, price double, qty double, quote_qty double, time timestamp, is_buyer_maker boolean, is_best_match boolean", ("time", "trade_id"), "first", _TRADE),
        Dataset("aggTrades", "agg_trade_id bigint, price double, qty double, first_trade_id bigint, last_trade_id bigint, time timestamp, is_buyer_maker boolean, is_best_match boolean", ("time", "agg_trade_id"), "last", _AGG),
        Dataset("bookTicker", f"update_id bigint, {_doubles(*_BOOK_TICKER[1:5])}, time timestamp", ("time", "update_id"), "last", _BOOK_TICKER),
        Dataset("bookDepth", f"time timestamp, {_doubles(*_DEPTH[1:])}", ("time", "percentage"), "last", _DEPTH, {"timestamp": "time"}),
        Dataset("liquidationSnapshot", f"time timestamp, side string, order_type string, time_in_force string, {_doubles('original_quantity', 'price', 'average_price')}, order_status string, {_doubles('last_fill_quantity', 'accumulated_fill_quantity')}", ("time", "side", "price", "original_quantity"), "last", _LIQUIDATION),
        Dataset("metrics", f"time timestamp, {_doubles(*_METRICS[2:])}", ("time",), "last", _METRICS, {"create_time": "time"}),
        Dataset("fundingRate", "time timestamp, last_funding_rate double", ("time",), "first", _FUNDING, {"calc_time": "time"}),
        _klines("markPriceKlines"),
        _klines("indexPriceKlines"),
        _klines("premiumIndexKlines"),
        Dataset("open_interest", "time timestamp, value double", ("time",)),
        Dataset("synthetic", f"time timestamp, timeframe string, {_FIGURES}", ("timeframe", "time"), "last"),
        Dataset("resampled", f"time timestamp, timeframe string, {_FIGURES}", ("timeframe", "time"), "last"),
        Dataset("aggregated", f"time timestamp, timeframe string, {_OHLC}, volume double", ("timeframe", "time"), "last"),
    )
}

# The dataset that each backfill task lands.
TASKS = {
    "backfill_ohlcv": "ohlcv",
    "backfill_tick_data": "trades",
    "backfill_funding": "fundingRate",
    "backfill_agg_trades": "aggTrades",
    "backfill_book_ticker": "bookTicker",
    "backfill_liquidation": "liquidationSnapshot",
    "backfill_metrics": "metrics",
    "backfill_book_depth": "bookDepth",
    "backfill_index_price_klines": "indexPriceKlines",
    "backfill_mark_price_klines": "markPriceKlines",
    "backfill_premium_index_klines": "premiumIndexKlines",
}

_KLINES_OF_PRICES = ("markPriceKlines", "indexPriceKlines", "premiumIndexKlines")
# The datasets whose files a vendor offers for each market type, by day or by month.
OFFERED_BY = {
    ("spot", "daily"): ("ohlcv", "trades", "aggTrades"),
    ("spot", "monthly"): ("ohlcv", "trades", "aggTrades"),
    ("swap", "daily"): ("ohlcv", "trades", "aggTrades", "bookTicker", "bookDepth", "metrics", *_KLINES_OF_PRICES),
    ("swap", "monthly"): ("ohlcv", "trades", "aggTrades", "bookTicker", "fundingRate", *_KLINES_OF_PRICES),
    ("future", "daily"): ("ohlcv", "trades", "aggTrades", "bookTicker", "bookDepth", "metrics", "liquidationSnapshot", *_KLINES_OF_PRICES),
    ("future", "monthly"): ("ohlcv", "trades", "aggTrades", "bookTicker", "fundingRate", *_KLINES_OF_PRICES),
}
#: Offered in either form; files of both are landed.
OFFERED = {kind: tuple(sorted({name for (k, _), names in OFFERED_BY.items() if k == kind for name in names})) for kind, _ in OFFERED_BY}


def dataset(name: str) -> Dataset:
    """The dataset of this name, or of the backfill task of this name."""
    name = TASKS.get(name, name)
    if name not in DATASETS:
        raise ValueError(f"unknown dataset {name!r}; known: {sorted(DATASETS)}")
    return DATASETS[name]


def is_offered(data_type: str, instrument_type: str) -> bool:
    """Whether vendor files of a dataset exist for the market type. Datasets that come from answers are not asked for."""
    of = dataset(data_type)
    return not of.vendor or of.name in OFFERED.get(instrument_type, ())


def available(wanted: DataFrame, spark: SparkSession) -> DataFrame:
    """Rows (data_type, instrument_type, ...) whose dataset the market type offers."""
    pairs = [(kind, name) for kind, names in OFFERED.items() for name in names]
    offered = spark.createDataFrame(pairs, "instrument_type string, data_type string")
    return wanted.join(offered, ["instrument_type", "data_type"], "left_semi")


def conform(df: DataFrame, of: Dataset) -> DataFrame:
    """The dataset's columns and types, and the order of arrival if the frame has it; columns that it lacks are null."""
    columns = [(F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in of.schema.fields]
    return df.select(*columns, *[c for c in df.columns if c == ARRIVAL])
