"""Half-open time ranges: coverage, what is missing from it, and runs of days."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.timecol import day_number, from_micros, is_ntz, to_micros, utc_date, whole_div
from tickloom.plans.chunked import CHUNK, MINUTE_US, last_known, minute_chunks, running_max
from tickloom.plans.joins import join_on
from tickloom.timeframe import DAY_US, parse


def coalesce_intervals(
    intervals: DataFrame,
    keys: Sequence[str],
    start: str = "start_ts",
    end: str = "end_ts",
) -> DataFrame:
    """Union of the ranges of each key; overlapping and touching ranges become one."""
    # Equal starts collapse map-side; only the longest of them can matter.
    distinct = (
        intervals.where(F.col(start) < F.col(end))
        .groupBy(*keys, F.col(start).alias("_s"))
        .agg(F.max(end).alias("_e"))
    )
    cut = minute_chunks(distinct, "_s")
    reached = running_max(cut, keys, ["_s"], "_reached", F.col("_e"))
    opens = F.col("_reached").isNull() | (F.col("_s") > F.col("_reached"))
    islands = last_known(reached, keys, ["_s"], {"_island": F.when(opens, F.col("_s"))})
    return (
        islands.groupBy(*keys, "_island")
        .agg(F.max("_e").alias(end))
        .select(*keys, F.col("_island").alias(start), end)
    )


def _by_day(df: DataFrame, start: str, end: str) -> DataFrame:
    """Cut each range at midnight: adds ``_chunk`` (day), ``_s`` and ``_e`` in microseconds."""
    s, e = to_micros(df, start), to_micros(df, end)
    timed = df.withColumns({"_from": s, "_upto": e}).where("_from < _upto")
    first = day_number(F.col("_from"))
    last = day_number(F.col("_upto") - F.lit(1))
    days = timed.withColumn(CHUNK, F.explode(F.sequence(first, last)))
    midnight = F.col(CHUNK).cast("long") * F.lit(DAY_US)
    return days.withColumns(
        {
            "_s": F.greatest("_from", midnight),
            "_e": F.least(F.col("_upto"), midnight + F.lit(DAY_US)),
        }
    )


#: What is known of a range: rows of it were seen, or it was asked for and has none.
OBSERVED, KNOWN_EMPTY, MISSING = "observed", "known_empty", "missing"


def coverage_gaps(
    requests: DataFrame, coverage: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """The parts of each request (key, start_ts, end_ts) that no coverage range holds.

    What is not held is found once for each series, whole, and then met by the requests: each part is the one that a request
    starts in, or starts within the request, so it is found once and nothing has to be put together again. Coverage with a
    ``status`` gives one too: ``missing`` where nothing is known, and ``known_empty`` for the parts that were asked for
    before and have no rows.
    """
    ntz = is_ntz(requests, "start_ts")
    labelled = ["status"] if "status" in coverage.columns else []
    asked = (
        requests.select(*keys, to_micros(requests, "start_ts").alias("_rs"), to_micros(requests, "end_ts").alias("_re"))
        .where("_rs < _re")
        .distinct()
    )
    holes = _not_held(asked.select(*keys).distinct(), coverage, keys)
    spanned = lambda df, spans: df.withColumn("_span", F.explode(spans))
    day, on = day_number, [*keys, "_span"]
    a, b, rs, re = (F.col(c) for c in ("_hole.a", "_hole.b", "_rs", "_re"))
    ahead = join_on(spanned(asked, _spans(day(rs), day(re - 1))), spanned(holes, _spans_around(day(a))), on)
    ahead = ahead.where((a >= rs) & (a < re)).drop("_span")
    starts = spanned(asked.select(*keys, "_rs").distinct(), _spans_around(day(rs)))
    behind = join_on(starts, spanned(holes, _spans(day(a), day(b - 1))), on).where((a < rs) & (b > rs)).drop("_span")
    return join_on(asked, behind, [*keys, "_rs"]).unionByName(ahead).select(
        *keys,
        from_micros(F.col("_rs"), ntz).alias("request_start"),
        from_micros(F.col("_re"), ntz).alias("request_end"),
        from_micros(F.greatest("_hole.a", "_rs"), ntz).alias("gap_start"),
        from_micros(F.least("_hole.b", "_re"), ntz).alias("gap_end"),
        *[F.col(f"_hole.{c}") for c in labelled],
    )


#: Before and after every time there is.
_EVER = 1 << 60


def _not_held(series: DataFrame, coverage: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All that each series' coverage leaves open, as ``_hole`` (a, b in microseconds, status), none touching another of its status."""
    labelled = "status" in coverage.columns
    known = coverage.where(F.col("status").isin(OBSERVED, KNOWN_EMPTY)) if labelled else coverage
    hole = lambda a, b, status: F.struct(F.coalesce(a, F.lit(-_EVER)).alias("a"), b.alias("b"), F.lit(status).alias("status"))
    times = lambda df: {"_s": to_micros(df, "start_ts"), "_e": to_micros(df, "end_ts")}
    timed = known.select(*keys, *[c.alias(n) for n, c in times(known).items()]).where("_s < _e").groupBy(*keys, "_s").agg(F.max("_e").alias("_e"))
    reached = running_max(timed.withColumn(CHUNK, whole_div(F.col("_s"), MINUTE_US)), keys, ["_s"], "_reached", F.col("_e"))
    opens = reached.where("_reached is null or _s > _reached")
    ends = join_on(series, timed.groupBy(*keys).agg(F.max("_e").alias("_e")), keys, "left")
    holes = opens.select(*keys, hole(F.col("_reached"), F.col("_s"), MISSING).alias("_hole")).unionByName(
        ends.select(*keys, hole(F.col("_e"), F.lit(_EVER), MISSING).alias("_hole"))
    )
    if labelled:
        told = label_ranges(known, keys).where(F.col("status") == KNOWN_EMPTY)
        told = told.withColumns(times(told))
        holes = holes.unionByName(told.select(*keys, hole(F.col("_s"), F.col("_e"), KNOWN_EMPTY).alias("_hole")))
    return holes


#: Days in the longest span are two to this power.
_LONGEST = 16


def _span(bucket: Column, level: int) -> Column:
    return bucket.cast("long") * F.lit(_LONGEST + 1) + F.lit(level)


def _spans(first: Column, last: Column) -> Column:
    """The days from first to last as few spans, each of 2**level days and starting at a multiple of that: some
    two for each doubling of the length."""
    out = []
    for level in range(_LONGEST):
        a = F.shiftright(first + F.lit((1 << level) - 1), level)
        b = F.shiftright(last + F.lit(1), level)
        out.append(F.when((a < b) & (a.bitwiseAND(F.lit(1)) == 1), _span(a, level)))
        out.append(F.when((a < b) & (b.bitwiseAND(F.lit(1)) == 1), _span(b - 1, level)))
    a = F.shiftright(first + F.lit((1 << _LONGEST) - 1), _LONGEST)
    b = F.shiftright(last + F.lit(1), _LONGEST)
    longest = F.when(a < b, F.transform(F.sequence(a, b - 1), lambda x: _span(x, _LONGEST)))
    return F.array_compact(F.concat(F.array(*out), F.coalesce(longest, F.array().cast("array<bigint>"))))


def _spans_around(day: Column) -> Column:
    """The spans of every length that hold the day."""
    return F.array(*[_span(F.shiftright(day, level), level) for level in range(_LONGEST + 1)])


def _labelled_pieces(ranges: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Pieces (``_s``, ``_e`` in microseconds) of days with one status each, none overlapping another.

    A sweep over the ends of all ranges, day by day: between two ends, the ranges that are open tell the status.
    """
    pieces = _by_day(ranges.where(F.col("status").isin(OBSERVED, KNOWN_EMPTY)), "start_ts", "end_ts")
    seen = (F.col("status") == OBSERVED).cast("int")
    ends = F.explode(F.array(*[F.struct(F.col(at).alias("at"), (seen * by).alias("seen"), ((1 - seen) * by).alias("empty")) for at, by in (("_s", 1), ("_e", -1))]))
    steps = pieces.select(*keys, CHUNK, ends.alias("_x")).groupBy(*keys, CHUNK, "_x.at").agg(F.sum("_x.seen").alias("_seen"), F.sum("_x.empty").alias("_empty"))
    along = Window.partitionBy(*keys, CHUNK).orderBy("at")
    upto = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    open_ = steps.select(*keys, CHUNK, F.col("at").alias("_s"), F.lead("at").over(along).alias("_e"), F.sum("_seen").over(upto).alias("_seen"), F.sum("_empty").over(upto).alias("_empty"))
    status = F.when(F.col("_seen") > 0, OBSERVED).when(F.col("_empty") > 0, KNOWN_EMPTY)
    return open_.where("_e is not null").withColumn("status", status).where("status is not null").drop("_seen", "_empty")


def label_ranges(ranges: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Ranges with a status, none overlapping another: what was observed anywhere is observed, the rest stays known empty."""
    ntz = is_ntz(ranges, "start_ts")
    told = _labelled_pieces(ranges, keys)
    timed = told.select(*keys, "status", from_micros(F.col("_s"), ntz).alias("start_ts"), from_micros(F.col("_e"), ntz).alias("end_ts"))
    return coalesce_intervals(timed, [*keys, "status"])


def clamp_to_listing(requests: DataFrame, listing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """No request starts before its series was listed; requests that end earlier vanish."""
    joined = join_on(requests, listing.select(*keys, "listing_date"), keys, "left")
    return (
        joined.withColumn("start_ts", F.greatest("start_ts", "listing_date"))
        .drop("listing_date")
        .where("start_ts < end_ts")
    )


def pending_ranges(
    requests: DataFrame,
    coverage: DataFrame,
    listing: DataFrame,
    keys: Sequence[str],
) -> DataFrame:
    """What a backfill of the requests would still have to land; ranges known to be empty are not asked for again."""
    gaps = coverage_gaps(clamp_to_listing(requests, listing, keys), coverage, keys)
    return gaps.where(F.col("status") == MISSING).drop("status") if "status" in gaps.columns else gaps


def _day_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per series and day with its first and last time: the bound for what follows."""
    us = to_micros(df, "time")
    return df.groupBy(*keys, day_number(us).alias("_day")).agg(F.min(us).alias("_first"), F.max(us).alias("_last"))


def contiguous_days(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Runs of consecutive days on which a series has rows."""
    days = _day_rows(df, keys)
    run = F.col("_day") - F.row_number().over(Window.partitionBy(*keys).orderBy("_day"))
    return (
        days.withColumn("_run", run)
        .groupBy(*keys, "_run")
        .agg(F.min("_day").alias("a"), F.max("_day").alias("b"), F.count(F.lit(1)).alias("days"))
        .select(
            *keys,
            F.date_from_unix_date(F.col("a")).alias("first_day"),
            F.date_from_unix_date(F.col("b")).alias("last_day"),
            "days",
        )
    )


def rebuild_coverage(candles: DataFrame, timeframe: str, keys: Sequence[str]) -> DataFrame:
    """Coverage from stored candles: each run of days, first candle to last candle plus a bar."""
    ntz = is_ntz(candles, "time")
    days = _day_rows(candles, keys)
    run = F.col("_day") - F.row_number().over(Window.partitionBy(*keys).orderBy("_day"))
    return (
        days.withColumn("_run", run)
        .groupBy(*keys, "_run")
        .agg(F.min("_first").alias("a"), F.max("_last").alias("b"))
        .select(
            *keys,
            from_micros(F.col("a"), ntz).alias("start_ts"),
            from_micros(F.col("b") + F.lit(parse(timeframe).micros), ntz).alias("end_ts"),
        )
    )


def mixed_symbols(candles: DataFrame, folder: Sequence[str]) -> DataFrame:
    """Folders that hold candles of more than one symbol, which coverage cannot tell apart."""
    symbols = candles.select(*folder, "symbol").distinct()
    return symbols.groupBy(*folder).agg(F.count(F.lit(1)).alias("symbols")).where("symbols > 1")


def advance_coverage(
    coverage: DataFrame, landed: DataFrame, timeframe: str, keys: Sequence[str], asked: DataFrame | None = None
) -> DataFrame:
    """Coverage after landing new candles. Only observed rows add to what is covered.

    With ``asked``, the ranges (key, start_ts, end_ts) that the landing was to fill, or with coverage that has a ``status``,
    the result has one: what was asked for and has no rows is known to be empty, until rows of it are seen.
    """
    added = rebuild_coverage(landed, timeframe, keys)
    columns = [*keys, "start_ts", "end_ts"]
    if asked is None and "status" not in coverage.columns:
        return coalesce_intervals(coverage.select(*columns).unionByName(added), keys)
    known = coverage if "status" in coverage.columns else coverage.withColumn("status", F.lit(OBSERVED))
    ranges = known.select(*columns, "status").unionByName(added.withColumn("status", F.lit(OBSERVED)))
    if asked is not None:
        ranges = ranges.unionByName(asked.select(*columns).withColumn("status", F.lit(KNOWN_EMPTY)))
    return label_ranges(ranges, keys)


def missing_days(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Days without rows between the first and last day of each series."""
    days = df.select(*keys, utc_date(df, "time").alias("_day")).distinct()
    before = F.lag("_day").over(Window.partitionBy(*keys).orderBy("_day"))
    holes = days.withColumn("_before", before).where(F.date_diff("_day", "_before") > 1)
    between = F.sequence(F.date_add("_before", 1), F.date_sub("_day", 1))
    return holes.select(*keys, F.explode(between).alias("missing_day"))


def claimed_but_missing(
    coverage: DataFrame, present_days: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """Days that coverage claims, even in part, but that hold no rows."""
    claimed = _by_day(coverage, "start_ts", "end_ts").select(
        *keys, F.date_from_unix_date(F.col(CHUNK)).alias("date")
    )
    have = present_days.select(*keys, "date").distinct()
    return join_on(claimed.distinct(), have, [*keys, "date"], "left_anti")


def pending_days(source_days: DataFrame, output_days: DataFrame, on: Sequence[str]) -> DataFrame:
    """Source days without output yet."""
    return join_on(source_days.select(*on).distinct(), output_days.select(*on).distinct(), on, "left_anti")


def union_days(first: DataFrame, second: DataFrame, on: Sequence[str]) -> DataFrame:
    return first.select(*on).unionByName(second.select(*on)).distinct()


def listing_dates(candles: DataFrame, keys: Sequence[str]) -> DataFrame:
    """First stored time of each series."""
    return candles.groupBy(*keys).agg(F.min("time").alias("listing_date"))
