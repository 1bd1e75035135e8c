"""Time columns as whole microseconds since 1970, for TIMESTAMP and TIMESTAMP_NTZ alike.

Long arithmetic keeps bar keys and differences inside code generation and does not
depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.timeframe import DAY_US, SECOND_US, WEEK_US, Timeframe

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
# 1970-01-01 was a Thursday, four days after a Sunday.
_EPOCH_AFTER_SUNDAY_US = 4 * DAY_US


def is_ntz(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.TimestampNTZType)


def to_micros(df: DataFrame, name: str) -> Column:
    if is_ntz(df, name):
        return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH_NTZ), F.col(name))
    return F.unix_micros(F.col(name))


def from_micros(micros: Column, ntz: bool) -> Column:
    if ntz:
        return F.timestamp_add("MICROSECOND", micros, F.expr(_EPOCH_NTZ))
    return F.timestamp_micros(micros)


def floor_to(value: Column, width: int) -> Column:
    return value - F.pmod(value, F.lit(width).cast("long"))


def whole_div(value: Column, width: Column | int) -> Column:
    """Floor division of whole numbers. The remainder goes first, so the division is exact."""
    by = F.lit(width).cast("long") if isinstance(width, int) else width
    return ((value - F.pmod(value, by)) / by).cast("long")


def day_number(micros: Column) -> Column:
    """Days since 1970-01-01 (UTC) as INT."""
    return whole_div(micros, DAY_US).cast("int")


def utc_date(df: DataFrame, name: str) -> Column:
    """The calendar day in UTC, whatever the session zone is."""
    return F.date_from_unix_date(day_number(to_micros(df, name)))


def seconds_between(start_us: Column, end_us: Column) -> Column:
    return (end_us - start_us) / F.lit(float(SECOND_US))


def sunday_on_or_before(micros: Column) -> Column:
    return micros - F.pmod(micros + F.lit(_EPOCH_AFTER_SUNDAY_US), F.lit(WEEK_US).cast("long"))


def bar_start(micros: Column, frame: Timeframe, first_us: Column | None = None) -> Column:
    """Left edge of the bar holding ``micros``.

    Widths that divide a day start on the clock. Weeks start on Sundays. Any other width
    counts from midnight of ``first_us`` (weeks: from its Sunday), or from 1970 without it.
    """
    if frame.divides_day:
        return floor_to(micros, frame.micros)
    if frame.unit == "w":
        if frame.count == 1:
            return sunday_on_or_before(micros)
        origin = sunday_on_or_before(F.lit(0).cast("long") if first_us is None else first_us)
    else:
        origin = F.lit(0).cast("long") if first_us is None else floor_to(first_us, DAY_US)
    return origin + floor_to(micros - origin, frame.micros)
