"""Sequence work over long series, cut into chunks of bounded size.

A window partitioned by the series alone would put a whole series, possibly a third of all
rows, into one task. Every function here works in three steps instead:

1. summarise each (series, chunk) with a grouped aggregate, combined map-side;
2. carry the summaries along the series in two levels: within runs of chunks, then over the
   runs, so that no task sees more than one row per chunk of a run or one per run;
3. join the carried value back and run the row-level window inside (series, chunk).

A chunk is a calendar period: a day for candles (at most 1,440 one-minute bars), a minute for
trades. It follows from the row alone, so nothing has to be sampled or stored. A null series
key is a series like any other.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.timecol import day_number, to_micros, whole_div
from tickloom.plans.joins import join_on

CHUNK = "_chunk"
# Chunks in a run: the minutes of a day, or about four years of days.
RUN = 1_440
MINUTE_US = 60_000_000


def minute_chunks(df: DataFrame, time: str = "time") -> DataFrame:
    """Add ``_chunk``: the UTC minute. For trades and other rows that a day does not bound."""
    return df.withColumn(CHUNK, whole_div(to_micros(df, time), MINUTE_US))


def day_chunks(df: DataFrame, time: str = "time") -> DataFrame:
    """Add ``_chunk``: the UTC day. For rows a day bounds, such as candles or daily summaries."""
    return df.withColumn(CHUNK, day_number(to_micros(df, time)).cast("long"))


def _rows(keys: Sequence[str], order: Sequence[str]) -> Window:
    return Window.partitionBy(*keys, CHUNK).orderBy(*order)


def _plus(a: Column, b: Column) -> Column:
    return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(a + b)


_OVER = {"sum": F.sum, "max": F.max, "last": lambda c: F.last(c, ignorenulls=True)}
_TOTAL = {"sum": F.sum, "max": F.max, "last": lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col(CHUNK)))}
_COMBINE = {"sum": _plus, "max": F.greatest, "last": lambda earlier, within: F.coalesce(within, earlier)}


def _carry(summary: DataFrame, keys: Sequence[str], kinds: Mapping[str, str]) -> DataFrame:
    """Replace each column by what all earlier chunks of the series come to."""
    run = summary.withColumn("_run", whole_div(F.col(CHUNK), RUN))
    runs = run.groupBy(*keys, "_run").agg(*[_TOTAL[kind](n).alias(f"_all_{n}") for n, kind in kinds.items()])
    before_run = Window.partitionBy(*keys).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    earlier = runs.select(
        *keys, "_run", *[_OVER[kind](f"_all_{n}").over(before_run).alias(f"_run_{n}") for n, kind in kinds.items()]
    )
    before = Window.partitionBy(*keys, "_run").orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    within = run.select(
        *keys, "_run", CHUNK, *[_OVER[kind](n).over(before).alias(f"_in_{n}") for n, kind in kinds.items()]
    )
    both = join_on(within, earlier, [*keys, "_run"])
    return both.select(
        *keys, CHUNK, *[_COMBINE[kind](F.col(f"_run_{n}"), F.col(f"_in_{n}")).alias(n) for n, kind in kinds.items()]
    )


def _attach(df: DataFrame, carried: DataFrame, keys: Sequence[str]) -> DataFrame:
    return join_on(df, carried, [*keys, CHUNK])


def running_sums(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], sums: Mapping[str, Column]
) -> DataFrame:
    """Running totals from the start of each series up to and including the row."""
    totals = df.groupBy(*keys, CHUNK).agg(*[F.sum(value).alias(f"_before_{name}") for name, value in sums.items()])
    carried = _carry(totals, keys, {f"_before_{n}": "sum" for n in sums})
    frame = _rows(keys, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = _attach(df, carried, keys)
    zero = F.lit(0)
    result = joined.withColumns(
        {
            name: F.coalesce(F.col(f"_before_{name}"), zero)
            + F.coalesce(F.sum(value).over(frame), zero)
            for name, value in sums.items()
        }
    )
    return result.drop(*[f"_before_{n}" for n in sums])


def running_max(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, value: Column
) -> DataFrame:
    """Largest value of all strictly earlier rows of the series; null on the first row."""
    tops = df.groupBy(*keys, CHUNK).agg(F.max(value).alias("_top"))
    carried = _carry(tops, keys, {"_top": "max"})
    frame = _rows(keys, order).rowsBetween(Window.unboundedPreceding, -1)
    joined = _attach(df, carried, keys)
    return joined.withColumn(name, F.greatest(F.col("_top"), F.max(value).over(frame))).drop("_top")


def previous_row(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Mapping[str, Column]
) -> DataFrame:
    """The given expressions evaluated on the row before, across chunk edges."""
    row = F.struct(*[value.alias(name) for name, value in values.items()])
    lasts = df.groupBy(*keys, CHUNK).agg(F.max_by(row, F.struct(*order)).alias("_before_row"))
    carried = _carry(lasts, keys, {"_before_row": "last"})
    joined = _attach(df, carried, keys)
    local = F.lag(row).over(_rows(keys, order))
    found = joined.withColumn("_previous", F.coalesce(local, F.col("_before_row")))
    return found.withColumns({n: F.col(f"_previous.{n}") for n in values}).drop(
        "_before_row", "_previous"
    )


def last_known(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Mapping[str, Column]
) -> DataFrame:
    """Forward fill: the latest non-null value at or before the row."""
    position = F.struct(*order)
    lasts = df.groupBy(*keys, CHUNK).agg(
        *[
            F.max_by(value, F.when(value.isNotNull(), position)).alias(f"_seed_{name}")
            for name, value in values.items()
        ]
    )
    carried = _carry(lasts, keys, {f"_seed_{n}": "last" for n in values})
    frame = _rows(keys, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = _attach(df, carried, keys)
    return joined.withColumns(
        {
            name: F.coalesce(F.last(value, ignorenulls=True).over(frame), F.col(f"_seed_{name}"))
            for name, value in values.items()
        }
    ).drop(*[f"_seed_{n}" for n in values])
