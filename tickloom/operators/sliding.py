"""Trailing-window features of one-minute candles, for several window lengths at once.

Every output day sees the candles of the days a fixed look-back names, densified to one row
per minute by repeating the row before. Days are grouped into blocks; a block is read once with
its look-back days in front, and all windows run inside (asset, block), whose size is bounded
by ``(block_days + look-back days) * 1,440`` rows however long the history is.

Windows are tiled: a window of 60 minutes is two windows of 30, a day is six of 4 hours. Each
length is built from the next shorter one by lags in the same sorted partition, so the cost
does not grow with the window, sums suffer no cancellation, and one sort serves every length.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.columns import feature_column
from tickloom.functions.timecol import from_micros, is_ntz, to_micros, utc_date, whole_div
from tickloom.plans.dedup import keep_one
from tickloom.plans.joins import join_on
from tickloom.timeframe import DAY_US, parse

# Default intervals and features of a sliding dataset.
INTERVALS = ("1m", "5m", "1h")
FEATURES = ("open", "high", "low", "close", "volume", "quote_volume", "twap", "vwap")

DAY_MINUTES = 1_440
MINUTE_US = 60_000_000
# Windows of more tiles than this get an intermediate length.
MAX_TILES = 8


def tiling(lengths: Sequence[int]) -> list[tuple[int, list[tuple[int, int]]]]:
    """For each length to build, in order: the (shorter length, lag) tiles that make it up."""
    have = [1]
    steps: list[tuple[int, list[tuple[int, int]]]] = []

    def tiles(length: int) -> list[tuple[int, int]]:
        parts, at = [], 0
        while at < length:
            size = max(h for h in have if h <= length - at)
            parts.append((size, at))
            at += size
        return parts

    for length in sorted(set(lengths)):
        while length not in have:
            parts = tiles(length)
            # Too many tiles: the first of them make an intermediate length, longer than any before.
            size = sum(part for part, _ in parts[:MAX_TILES])
            steps.append((size, tiles(size)))
            have.append(size)
    return steps


def _days(candles: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per (asset, day): the bound of every day-level step below."""
    return candles.groupBy(*keys, "_day").agg(F.min("_m").alias("_first"))


def _blocks(days: DataFrame, keys: Sequence[str], longest: int, block_days: int) -> DataFrame:
    """Which block makes each output day, and which days a block must read.

    Normally ``block_days`` neighbouring days share a block. A day whose look-back days do not
    reach back over the longest window, although older candles exist, would see too much
    history in a shared block; it becomes a block of its own.
    """
    look_back = longest // DAY_MINUTES + 1
    own = Window.partitionBy(*keys).orderBy("_day").rangeBetween(-look_back, 0)
    ever = Window.partitionBy(*keys)
    reach = F.min("_first").over(own)
    full = (reach <= F.col("_day").cast("long") * DAY_MINUTES - (longest - 1)) | (
        reach == F.min("_first").over(ever)
    )
    base = F.when(full, F.col("_day") - F.pmod(F.col("_day"), F.lit(block_days))).otherwise(
        F.col("_day")
    )
    placed = days.withColumns({"_alone": ~full, "_base": base})
    block = [*keys, "_base", "_alone"]
    reads = placed.withColumn(
        "_reads", F.explode(F.sequence(F.col("_day") - F.lit(look_back), F.col("_day")))
    )
    # Bit i of the mask says that day base+i is an output of this block.
    masks = placed.groupBy(*block).agg(F.sum(F.expr("shiftleft(1L, _day - _base)")).alias("_mask"))
    return join_on(reads.select(*block, "_reads").distinct(), masks, block)


def _measures(valid: Sequence[tuple[str, Column]]) -> Column:
    return F.struct(*[value.alias(name) for name, value in valid])


def _add(values: Sequence[Column]) -> Column:
    """Sum that skips nulls and is null when every term is."""
    total = F.coalesce(values[0], F.lit(0.0))
    for value in values[1:]:
        total = total + F.coalesce(value, F.lit(0.0))
    return F.when(F.coalesce(*values).isNotNull(), total)


def _greatest(values: Sequence[Column]) -> Column:
    return values[0] if len(values) == 1 else F.greatest(*values)


def _least(values: Sequence[Column]) -> Column:
    return values[0] if len(values) == 1 else F.least(*values)


def rolling_windows(
    dense: DataFrame, over: Window, lengths: Sequence[int], measures: dict[str, tuple[str, Column]]
) -> DataFrame:
    """Add a struct ``_w<length>`` of trailing max, min or sum for each length in rows.

    ``dense`` has one row per step inside the partitions of ``over``. Windows that reach before
    the first row use the rows there are.
    """
    combine = {"max": _greatest, "min": _least, "sum": _add}
    result = dense.withColumn("_w1", _measures([(n, v) for n, (_, v) in measures.items()]))
    for length, tiles in tiling(lengths):
        lagged = {
            (size, lag): f"_t{i}" for i, (size, lag) in enumerate(tiles)
        }
        result = result.withColumns(
            {
                name: F.col(f"_w{size}") if lag == 0 else F.lag(f"_w{size}", lag).over(over)
                for (size, lag), name in lagged.items()
            }
        )
        parts = [
            (n, combine[kind]([F.col(f"{t}.{n}") for t in lagged.values()]))
            for n, (kind, _) in measures.items()
        ]
        result = result.withColumn(f"_w{length}", _measures(parts)).drop(*lagged.values())
    return result


def dense_blocks(
    candles: DataFrame, keys: Sequence[str], values: Sequence[str], longest: int, block_days: int
) -> tuple[DataFrame, list[str]]:
    """One row per (asset, block, minute): the candles a block reads, gaps filled forward.

    ``_blank`` marks output minutes that have no value: before the first candle read, or after
    the last candle of their day.
    """
    blocks = _blocks(_days(candles, keys), keys, longest, block_days)
    block = [*keys, "_base", "_alone"]
    read = join_on(candles, blocks.withColumnRenamed("_reads", "_day"), [*keys, "_day"])
    along = Window.partitionBy(*block).orderBy("_m")
    following = F.lead("_m").over(along)
    seen = read.withColumns(
        {
            "_next": following,
            "_opening": F.row_number().over(along) == 1,
            "open": F.coalesce("open", F.lag("close").over(along)),
        }
    )
    day_end = (F.col("_day").cast("long") + 1) * DAY_MINUTES
    upto = F.coalesce("_next", day_end)
    # Minutes of the row's own day without a later candle in that day stay blank.
    last_of_day = F.col("_next").isNull() | (F.col("_next") >= day_end)
    row = F.struct(*values)
    nothing = F.lit(None).cast(candles.select(row.alias("r")).schema["r"].dataType)
    run = F.struct(
        F.col("_m").alias("a"), upto.alias("b"), row.alias("row"),
        F.when(last_of_day, F.col("_m") + 1).otherwise(F.lit(None).cast("long")).alias("blank_from"),
        day_end.alias("blank_upto"),
    )
    lead_in = F.struct(
        (F.col("_day").cast("long") * DAY_MINUTES).alias("a"), F.col("_m").alias("b"),
        nothing.alias("row"),
        (F.col("_day").cast("long") * DAY_MINUTES).alias("blank_from"), F.col("_m").alias("blank_upto"),
    )
    runs = F.when(F.col("_opening"), F.array(lead_in, run)).otherwise(F.array(run))
    spans = seen.select(*block, "_mask", F.explode(runs).alias("_run"))
    minute = F.when(
        F.col("_run.a") < F.col("_run.b"), F.sequence(F.col("_run.a"), F.col("_run.b") - F.lit(1))
    )
    grid = spans.withColumn("_m", F.explode(minute))
    blank = F.coalesce(
        (F.col("_m") >= F.col("_run.blank_from")) & (F.col("_m") < F.col("_run.blank_upto")),
        F.lit(False),
    )
    dense = grid.select(
        *block, "_mask", "_m", "_run.row.*", blank.alias("_blank")
    )
    return dense, block


def sliding_features(
    candles: DataFrame,
    intervals: Sequence[str] = INTERVALS,
    features: Sequence[str] = FEATURES,
    keys: Sequence[str] = ("symbol",),
    block_days: int = 7,
    order: Sequence[str] | None = None,
) -> DataFrame:
    """Features of every minute of every day that has candles.

    Returns keys, ``time`` and ``features``: one array per interval (ascending), each with the
    requested features in order. Minutes without a value hold nulls. ``order`` removes repeated
    times first (last wins).

    Meaning of a feature over a window of W minutes ending at the row: open of the first minute,
    close of the last, highest high, lowest low, summed volume and quote volume, mean TWAP,
    volume-weighted VWAP. Windows before the start of the history are cut there.
    """
    if not 1 <= block_days <= 62:
        raise ValueError("block_days must be between 1 and 62")
    by_feature = {f: feature_column(f, candles.columns) for f in features}
    known = {"open", "high", "low", "close", "volume", "quote_volume", "twap", "vwap", "taker_buy_quote_volume"}
    unknown = set(by_feature.values()) - known
    if unknown:
        raise ValueError(f"no window rule for {sorted(unknown)}")
    lengths = sorted({parse(i).minutes for i in intervals})
    ntz = is_ntz(candles, "time")
    if order is not None:
        candles = keep_one(candles, [*keys, "time"], order, "last")
    figures = [c for c in candles.columns if c in known]
    us = to_micros(candles, "time")
    timed = candles.select(*keys, *[F.col(c).cast("double").alias(c) for c in figures], us.alias("_us"))
    minutes = timed.withColumn("_m", whole_div(F.col("_us"), MINUTE_US)).withColumn(
        "_day", whole_div(F.col("_us"), DAY_US).cast("int")
    )
    wanted = sorted(set(by_feature.values()) | ({"volume"} if "vwap" in by_feature.values() else set()))
    values = sorted(set(wanted) | {"open", "close"})
    dense, block = dense_blocks(minutes, keys, values, lengths[-1], block_days)

    over = Window.partitionBy(*block).orderBy("_m")
    sums = [c for c in ("volume", "quote_volume", "taker_buy_quote_volume") if c in wanted]
    measures: dict[str, tuple[str, Column]] = {c: ("sum", F.col(c)) for c in sums}
    if "high" in wanted:
        measures["high"] = ("max", F.col("high"))
    if "low" in wanted:
        measures["low"] = ("min", F.col("low"))
    if "twap" in wanted:
        measures["twap"] = ("sum", F.col("twap"))
        measures["twaps"] = ("sum", F.when(F.col("twap").isNotNull(), F.lit(1.0)))
    if "vwap" in wanted:
        measures["pv"] = ("sum", F.col("vwap") * F.col("volume"))
    rolled = rolling_windows(dense, over, lengths, measures)
    running = over.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = over.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rolled = rolled.withColumns(
        {
            "_opens": F.last("open", ignorenulls=True).over(running),
            "_opening": F.first("open", ignorenulls=True).over(whole),
        }
    )
    rolled = rolled.withColumns(
        {f"_o{w}": F.coalesce(F.lag("_opens", w - 1).over(over), F.col("_opening")) for w in lengths}
    )
    if "vwap" in wanted:
        for w in lengths:
            ratio = F.try_divide(F.col(f"_w{w}.pv"), F.col(f"_w{w}.volume"))
            rolled = rolled.withColumn(f"_r{w}", F.coalesce(ratio, F.col("vwap")))
        # Backward fill in the same sort order, from the row's own day only: a later day is the future.
        spec = f"PARTITION BY {', '.join(f'`{c}`' for c in block)} ORDER BY _m"
        rolled = rolled.withColumns(
            {f"_n{w}": F.when(F.col(f"_r{w}").isNotNull(), F.struct("_m", F.col(f"_r{w}").alias("r"))) for w in lengths}
        )
        rolled = rolled.withColumns({f"_n{w}": F.expr(f"lead(_n{w}, 1) IGNORE NULLS OVER ({spec})") for w in lengths})
        day = lambda m: whole_div(m, DAY_MINUTES)
        rolled = rolled.withColumns(
            {
                f"_v{w}": F.coalesce(
                    F.col(f"_r{w}"), F.when(day(F.col(f"_n{w}._m")) == day(F.col("_m")), F.col(f"_n{w}.r"))
                )
                for w in lengths
            }
        )

    def value(feature: str, w: int) -> Column:
        column = by_feature[feature]
        if column == "open":
            return F.col(f"_o{w}")
        if column == "close":
            return F.col("close")
        if column == "vwap":
            return F.col(f"_v{w}")
        if column == "twap":
            return F.try_divide(F.col(f"_w{w}.twap"), F.col(f"_w{w}.twaps"))
        return F.col(f"_w{w}.{column}")

    blank = F.lit(None).cast("double")
    table = F.array(
        *[F.array(*[F.when(F.col("_blank"), blank).otherwise(value(f, w)) for f in features]) for w in lengths]
    )
    shift = (whole_div(F.col("_m"), DAY_MINUTES) - F.col("_base")).cast("int")
    outputs = rolled.withColumn("_shift", shift).where(
        "_shift >= 0 AND _shift < 63 AND (shiftright(_mask, _shift) & 1L) = 1"
    )
    return outputs.select(
        *keys, from_micros(F.col("_m") * F.lit(MINUTE_US), ntz).alias("time"), table.alias("features")
    )


def long_features(
    sliding: DataFrame, intervals: Sequence[str], features: Sequence[str], keys: Sequence[str]
) -> DataFrame:
    """One row per (asset, minute, interval) with a column per feature."""
    names = sorted(intervals, key=lambda i: parse(i).minutes)
    pairs = F.arrays_zip(F.array(*[F.lit(n) for n in names]).alias("interval"), F.col("features").alias("f"))
    each = sliding.select(*keys, "time", F.explode(pairs).alias("_p"))
    return each.select(
        *keys,
        "time",
        F.col("_p.interval").alias("interval"),
        *[F.col("_p.f")[i].alias(f) for i, f in enumerate(features)],
    )


def sliding_quality(sliding: DataFrame, features: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Missing values and lowest open of each (asset, day)."""
    flat = F.flatten("features")
    missing = F.size(F.filter(flat, lambda v: v.isNull()))
    report = sliding.withColumn("date", utc_date(sliding, "time"))
    aggregates = [F.sum(missing).alias("missing_values")]
    if "open" in features:
        place = list(features).index("open")
        lowest = F.array_min(F.transform("features", lambda row: row[place]))
        aggregates.append(F.min(lowest).alias("min_open"))
    result = report.groupBy(*keys, "date").agg(*aggregates)
    if "open" in features:
        result = result.withColumn("open_not_positive", F.coalesce(F.col("min_open") <= 0, F.lit(False)))
    return result
