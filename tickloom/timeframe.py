"""Bar widths such as ``1m``, ``4h``, ``3d``, ``1w`` or ``100ms``."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

SECOND_US = 1_000_000
DAY_US = 86_400 * SECOND_US
WEEK_US = 7 * DAY_US

PATTERN = r"^(\d+)(ms|[smhdw])$"

_UNIT_US = {
    "ms": 1_000,
    "s": SECOND_US,
    "m": 60 * SECOND_US,
    "h": 3_600 * SECOND_US,
    "d": DAY_US,
    "w": WEEK_US,
}


@dataclass(frozen=True)
class Timeframe:
    name: str
    count: int
    unit: str

    @property
    def micros(self) -> int:
        return self.count * _UNIT_US[self.unit]

    @property
    def seconds(self) -> float:
        return self.micros / SECOND_US

    @property
    def minutes(self) -> int:
        if self.micros % (60 * SECOND_US):
            raise ValueError(f"{self.name} is not a whole number of minutes")
        return self.micros // (60 * SECOND_US)

    @property
    def divides_day(self) -> bool:
        """True when bars of this width start at the same clock times every day."""
        return DAY_US % self.micros == 0


def micros_of(timeframe: Column) -> Column:
    """Widths of a column of timeframes; a name that :func:`parse` refuses fails the query."""
    name = F.lower(F.trim(timeframe))
    count = F.regexp_extract(name, PATTERN, 1).try_cast("bigint")
    unit = F.regexp_extract(name, PATTERN, 2)
    width = F.lit(None).cast("bigint")
    for word, micros in _UNIT_US.items():
        width = F.when(unit == word, F.lit(micros).cast("bigint")).otherwise(width)
    known = count * width
    bad = F.raise_error(F.concat(F.lit("unknown timeframe "), timeframe)).cast("bigint")
    return F.when(timeframe.isNull() | (known > 0), known).otherwise(bad)


def parse(name: str) -> Timeframe:
    match = re.fullmatch(PATTERN, name.strip().lower())
    if not match or int(match.group(1)) == 0:
        raise ValueError(f"unknown timeframe {name!r}; expected e.g. 1m, 4h, 3d, 1w")
    return Timeframe(name, int(match.group(1)), match.group(2))
