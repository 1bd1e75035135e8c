"""Column expressions shared by the operators. All stay inside code generation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PRICES = ("open", "high", "low", "close")

# Settlement currencies that count as US dollars.
USD_SETTLEMENTS = ("USD", "USDT", "USDC", "USDE", "DAI", "TUSD", "USDP", "USDS")
# Fixed value: the venue whose inverse contracts report volume in dollars.
INVERSE_VENUE = "bitmex"
# Text spellings of booleans.
TRUE_WORDS = ("true", "t")
# Feature names that stand for another column.
FEATURE_COLUMNS = {
    "volume_in_usd": "quote_volume",
    "lifted_volume_in_usd": "taker_buy_quote_volume",
}


def in_range(time: str, start, end) -> Column:
    """Half-open range: start <= time < end. Either bound may be None."""
    parts = []
    if start is not None:
        parts.append(F.col(time) >= F.lit(start))
    if end is not None:
        parts.append(F.col(time) < F.lit(end))
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def equals(**wanted: str | None) -> Column:
    parts = [F.col(name) == F.lit(value) for name, value in wanted.items() if value is not None]
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def base_asset(symbol: Column) -> Column:
    return F.split_part(symbol, F.lit("/"), F.lit(1))


def is_inverse_usd(symbol: Column) -> Column:
    """Quoted in USD and settled in something that is not a dollar."""
    quote_part = F.split_part(symbol, F.lit("/"), F.lit(2))
    quote = F.split_part(quote_part, F.lit(":"), F.lit(1))
    settlement = F.split_part(quote_part, F.lit(":"), F.lit(2))
    settled_in_coin = (~quote_part.contains(":")) | (~settlement.isin(*USD_SETTLEMENTS))
    return F.coalesce((quote == "USD") & settled_in_coin, F.lit(False))


def ohlc4() -> Column:
    return (F.col("open") + F.col("high") + F.col("low") + F.col("close")) / F.lit(4)


def base_volume(
    exchange: Column, instrument_type: Column, symbol: Column, venue: str = INVERSE_VENUE
) -> Column:
    """Volume in the base asset: dollar-denominated contracts are divided by their mean price."""
    inverse = (exchange == venue) & (instrument_type != "spot") & is_inverse_usd(symbol)
    converted = F.coalesce(F.try_divide(F.col("volume"), ohlc4()), F.lit(0.0))
    return F.when(inverse, converted).otherwise(F.col("volume"))


def round2(value: Column) -> Column:
    """Two decimals, ties to even on the scaled double."""
    return F.rint(value.cast("double") * F.lit(100.0)) / F.lit(100.0)


def rounded(df: DataFrame, names) -> DataFrame:
    return df.withColumns({name: round2(F.col(name)) for name in names})


def clamp_high_low(df: DataFrame) -> DataFrame:
    """After rounding, the high and low must still enclose open and close."""
    return df.withColumns(
        {
            "high": F.greatest("high", "open", "close"),
            "low": F.least("low", "open", "close"),
        }
    )


def candle_is_anomalous() -> Column:
    """Any price at or below zero, high under low, or negative volume. Nulls do not count."""
    tests = [F.col(p) <= 0 for p in PRICES]
    tests += [F.col("high") < F.col("low"), F.col("volume") < 0]
    return reduce(lambda a, b: a | b, [F.coalesce(t, F.lit(False)) for t in tests])


def taker_side(is_buyer_maker: Column) -> Column:
    """The side that took; null where the maker is not known, which counts as neither."""
    return F.when(is_buyer_maker, F.lit("sell")).when(~is_buyer_maker, F.lit("buy"))


def signed_qty(is_buyer_maker: Column, qty: Column) -> Column:
    """Bought is positive, sold is negative; null where the maker is not known."""
    return F.when(is_buyer_maker, -qty).when(~is_buyer_maker, qty)


def to_bool(value: Column) -> Column:
    """Text or boolean to BOOLEAN; null and every false spelling become false."""
    return F.coalesce(F.lower(F.trim(value.cast("string"))).isin(*TRUE_WORDS), F.lit(False))


def to_id(value: Column) -> Column:
    """Identifiers as BIGINT, -1 where missing. ``12.0`` reads as 12."""
    text = value.cast("string")
    whole = text.try_cast("decimal(38,6)").try_cast("bigint")
    return F.coalesce(text.try_cast("bigint"), whole, F.lit(-1).cast("bigint"))


def epoch_to_micros(value: Column) -> Column:
    """Microseconds from text or number in s, ms, µs or ISO form; the unit is told by size."""
    text = F.trim(value.cast("string"))
    number = text.try_cast("double")
    # NaN, infinities and what no 64-bit time can hold are not times.
    number = F.when(F.abs(number) < F.lit(9e18), number)
    scaled = (
        F.when(number > 1e14, number)
        .when(number > 1e11, number * F.lit(1e3))
        .when(number > -9e12, number * F.lit(1e6))
    )
    # Text without a zone is UTC whatever the session zone is.
    plain = F.timestamp_diff(
        "MICROSECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), text.try_cast("timestamp_ntz")
    )
    zoned = F.unix_micros(text.try_cast("timestamp"))
    iso = F.when(text.rlike(r"(Z|[+-]\d{2}:?\d{2})$") & text.contains(":"), zoned).otherwise(plain)
    return F.when(number.isNotNull(), F.rint(scaled).cast("bigint")).otherwise(iso)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Files written from float frames mark missing values as NaN; operators expect NULL."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    null = F.lit(None).cast("double")
    return df.withColumns({name: F.nanvl(F.col(name), null) for name in floats}) if floats else df


def feature_column(feature: str, available) -> str:
    """Source column of a requested feature; unknown features fail at once."""
    name = FEATURE_COLUMNS.get(feature, feature)
    if name not in available:
        raise ValueError(f"feature {feature!r} needs column {name!r}, found {sorted(available)}")
    return name


def provenance(df: DataFrame, **literals: str) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in literals.items()})


def numeric_text(df: DataFrame, names) -> DataFrame:
    """Columns of numbers written as text become DOUBLE; text that is no number becomes null."""
    return df.withColumns({name: F.trim(F.col(name).cast("string")).try_cast("double") for name in names})
