"""Corners of the market-data operators on hand-made frames."""

import itertools
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tickloom.functions import columns as C
from tickloom.operators import bars, intervals, market, micro, quality, repair, sequence, sliding
from tickloom.timeframe import micros_of

T0 = datetime(2024, 1, 1)
VENUE = ["exchange", "instrument_type", "symbol"]
CANDLE = "exchange string, instrument_type string, symbol string, time timestamp_ntz, open double, high double, low double, close double, volume double"


def at(minutes):
    return T0 + timedelta(minutes=minutes)


def candle(venue, minute, price, volume, kind="spot", symbol="BTC/USD"):
    return (venue, kind, symbol, at(minute), price, price, price, price, volume)


def test_zero_volume_takes_the_mean_and_null_prices_count_in_the_venue_weight(spark):
    rows = [candle("a", 0, 10.0, 0.0), candle("b", 0, 20.0, 0.0), candle("a", 1, 10.0, 1.0), candle("b", 1, None, 3.0)]
    df = spark.createDataFrame(rows, CANDLE)
    venues = {r.time: r.close for r in market.aggregate_exchanges(df, asset="symbol").collect()}
    assert venues == {at(0): 15.0, at(1): 2.5}
    assert {r.time: r.close for r in market.synthesize(df).collect()} == {at(0): 15.0, at(1): 10.0}


def test_repeated_candles_count_once(spark):
    df = spark.createDataFrame([candle("a", 0, 10.0, 1.0)] * 2 + [candle("b", 0, 20.0, 1.0)], CANDLE)
    row = market.aggregate_exchanges(df, asset="symbol").first()
    assert (row.volume, row.close, row.exchange, row.timeframe) == (2.0, 15.0, "aggregated", "1m")
    rows = df.withColumns({"twap": C.ohlc4(), "vwap": C.ohlc4(), "quote_volume": F.lit(1.0)}).where("exchange = 'a'").drop(*VENUE[:2])
    assert bars.resample(rows, ["1h"]).first().volume == 1.0


def test_a_null_key_is_a_series(spark):
    df = spark.createDataFrame([candle(None, m, 10.0, 1.0) for m in (0, 1, 5)], CANDLE)
    assert quality.ohlcv_quality(df, VENUE, "1m").first().total_rows == 3
    assert sequence.candle_gaps(df, "1m", VENUE).count() == 1
    assert sequence.asof_fill(df, "1m", VENUE).count() == 6
    ticks = df.select(*VENUE, "time", F.lit(1.0).alias("price"), F.lit(1.0).alias("qty"), F.lit(None).cast("boolean").alias("is_buyer_maker"), F.lit(1).cast("long").alias("trade_id"))
    assert micro.trade_flow(ticks, VENUE).count() == 3
    assert micro.trade_flow(ticks, VENUE).where("side is not null").isEmpty()
    spans = spark.createDataFrame([(None, at(0), at(5)), (None, at(5), at(9))], "symbol string, start_ts timestamp_ntz, end_ts timestamp_ntz")
    assert intervals.coalesce_intervals(spans, ["symbol"]).count() == 1


def test_unknown_timeframes_fail(spark):
    frame = spark.createDataFrame([("30s",), ("100ms",), ("1d",)], "tf string")
    assert [r[0] for r in frame.select(micros_of(F.col("tf"))).collect()] == [30_000_000, 100_000, 86_400_000_000]
    with pytest.raises(Exception, match="unknown timeframe"):
        spark.createDataFrame([("5x",)], "tf string").select(micros_of(F.col("tf"))).collect()


def test_days_are_utc_whatever_the_session_says(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([("a", at(60))], "exchange string, time timestamp_ntz").withColumn("time", F.expr("to_utc_timestamp(cast(time as timestamp), 'America/New_York')").cast("timestamp"))
        utc = df.select("exchange", F.timestamp_micros(F.lit(1704070800000000)).alias("time"))
        assert str(quality.daily_breakdown(utc, ["exchange"]).first().date) == "2024-01-01"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_repair_fills_only_what_is_missing(spark):
    stored = spark.createDataFrame([candle("a", 0, 10.0, 1.0), candle("a", 1, 11.0, 1.0), candle("a", 5, 12.0, 1.0)], CANDLE)
    gaps = sequence.candle_gaps(stored, "1m", VENUE)
    flat = repair.zero_fill_gaps(gaps, stored, "1m", VENUE)
    assert sorted(r.time for r in flat.collect()) == [at(2), at(3), at(4)]
    landed = spark.createDataFrame([candle("a", m, 50.0, 2.0) for m in (1, 2, 3, 3, 4)], CANDLE)
    rows = repair.repair_from_landing(gaps, stored, landed, "1m", VENUE).collect()
    assert sorted((r.time, r.close, r.is_interpolated) for r in rows) == [(at(m), 50.0, False) for m in (2, 3, 4)]
    assert repair.repair_status(gaps, stored, landed, "1m", VENUE).first().status == "filled"
    assert repair.repair_status(gaps, stored, landed.where("close < 0"), "1m", VENUE).first().status == "zero_filled"


def test_quality_without_maker_flags(spark):
    ticks = spark.createDataFrame([("a", "spot", "B", at(m), 1.0, 1.0, m) for m in (0, 1, 200)], "exchange string, instrument_type string, symbol string, time timestamp_ntz, price double, qty double, trade_id long")
    row = quality.tick_quality_gaps(ticks).first()
    assert row.buy_ratio is None and row.gap_count == 1 and row.gap_seconds == 7200.0
    plan = quality.tick_quality_gaps(ticks)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") == 1 or "ReusedExchange" in plan or plan.count("Scan") <= 4


def test_histogram_without_keys(spark):
    rows = micro.histogram(spark.range(101), [], "id", 10).collect()
    assert sum(r.n for r in rows) == 101 and len(rows) == 10


def test_rounding_and_times(spark):
    values = [2.675, 0.125, 1.005, 2.5]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v double").select(C.round2(F.col("v"))).collect()]
    assert got == [2.68, 0.12, 1.0, 2.5]
    text = spark.createDataFrame([("Infinity",), ("nan",), ("1e300",), ("1704067200",)], "t string")
    assert [r[0] for r in text.select(C.epoch_to_micros(F.col("t"))).collect()] == [None, None, None, 1704067200000000]


def test_tick_bars_need_no_sort(spark):
    ticks = spark.createDataFrame([("a", at(0), 2, 1.0, 1.0), ("a", at(0), 1, 5.0, 1.0)], "exchange string, time timestamp_ntz, trade_id long, price double, qty double")
    one = bars.tick_bars(ticks, "1m", ["exchange"])
    assert (one.first().open, one.first().close) == (5.0, 1.0)
    assert "SortAggregate" not in one._jdf.queryExecution().executedPlan().toString()
    # Any 64-bit id has a place, -1 for a missing one among them, and no id comes before all.
    ids = [None, -(2**63), -1, 0, 2**63 - 1]
    rows = spark.createDataFrame([("a", at(0), i, float(k + 1), 1.0) for k, i in enumerate(ids)], "exchange string, time timestamp_ntz, trade_id long, price double, qty double")
    bar = bars.tick_bars(rows.where("trade_id is not null"), "1m", ["exchange"]).first()
    assert (bar.open, bar.close) == (2.0, 5.0)
    bar = bars.tick_bars(rows.where("trade_id is null or trade_id in (-1, 0)"), "1m", ["exchange"]).first()
    assert (bar.open, bar.close) == (1.0, 4.0)


def test_building_a_flow_starts_no_job(spark):
    ticks = spark.createDataFrame([("a", at(0), 2, 1.0, 1.0, True)], "exchange string, time timestamp_ntz, trade_id long, price double, qty double, is_buyer_maker boolean")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("flow", "flow")
    micro.trade_flow(ticks, ["exchange"])
    assert not tracker.getJobIdsForGroup("flow")


def sliding_input(spark):
    rows = []
    for m in range(4 * 1440):
        dark = 1440 + 22 * 60 <= m < 2 * 1440 + 2 * 60
        rows.append(("B", at(m), 100.0 + m % 7, 1.0, None if dark else 100.0 + m // 1440))
    df = spark.createDataFrame(rows, "symbol string, time timestamp_ntz, close double, volume double, vwap double")
    return df.withColumns({p: F.col("close") for p in ("open", "high", "low")})


def test_features_do_not_look_ahead_nor_depend_on_blocks(spark):
    df = sliding_input(spark)
    tables = []
    for days in (1, 3, 7, 62):
        out = sliding.sliding_features(df, ["1m"], ["vwap", "close"], block_days=days)
        tables.append({r.time: r.features for r in out.collect()})
    assert all(t == tables[0] for t in tables)
    assert tables[0][at(1440 + 23 * 60)][0][0] is None
    assert tables[0][at(2 * 1440)][0][0] == 102.0


def test_any_lengths_can_be_tiled():
    for lengths in ([60], [1, 60], [127], [5, 60, 240, 1440, 4320], [7, 11, 997]):
        steps = sliding.tiling(lengths)
        assert set(lengths) - {1} <= {size for size, _ in steps}
        for size, tiles in steps:
            assert len(tiles) <= sliding.MAX_TILES and sum(n for n, _ in tiles) == size


def test_tiled_windows_equal_plain_frames(spark):
    from pyspark.sql import Window

    rows = spark.range(500).select(F.lit("B").alias("symbol"), F.col("id").alias("_m"), (F.col("id") * 37 % 101).cast("double").alias("x"))
    over = Window.partitionBy("symbol").orderBy("_m")
    rolled = sliding.rolling_windows(rows, over, [1, 7, 60, 250], {"x": ("max", F.col("x")), "s": ("sum", F.col("x"))})
    for w in (7, 60, 250):
        frame = over.rowsBetween(-(w - 1), 0)
        off = rolled.withColumns({"a": F.max("x").over(frame), "b": F.sum("x").over(frame)}).where((F.col(f"_w{w}.x") != F.col("a")) | (F.col(f"_w{w}.s") != F.col("b")))
        assert off.isEmpty()


def test_coverage_and_gaps_make_up_the_request(spark):
    shape = "symbol string, start_ts timestamp_ntz, end_ts timestamp_ntz"
    cover = spark.createDataFrame([("B", at(0), at(10)), ("B", at(10), at(20)), ("B", at(5), at(8)), ("B", at(3000), at(3100)), ("B", at(7), at(7))], shape)
    asked = spark.createDataFrame([("B", at(15), at(3050)), ("C", at(0), at(9))], shape)
    assert {(r.start_ts, r.end_ts) for r in intervals.coalesce_intervals(cover, ["symbol"]).collect()} == {(at(0), at(20)), (at(3000), at(3100))}
    gaps = {(r.symbol, r.gap_start, r.gap_end) for r in intervals.coverage_gaps(asked, cover, ["symbol"]).collect()}
    assert gaps == {("B", at(20), at(3000)), ("C", at(0), at(9))}


def test_gaps_of_long_requests_are_found_without_cutting_them_into_days(spark):
    rng = random.Random(7)
    hour = lambda h: T0 + timedelta(hours=h)
    ranges = lambda n, far, most: [(rng.choice(["A", "B", None]), a, a + rng.randint(0, most)) for a in (rng.randrange(far) for _ in range(n))]
    asked = [*ranges(60, 900, 400), ("Z", 5, 5000), ("A", -300000, 300000)]
    cover = [(*x, rng.choice([intervals.OBSERVED, intervals.KNOWN_EMPTY, "other"])) for x in ranges(40, 900, 30)]
    frame = lambda rows, tail="": spark.createDataFrame([(k, hour(a), hour(b), *s) for k, a, b, *s in rows], "symbol string, start_ts timestamp_ntz, end_ts timestamp_ntz" + tail)
    found = lambda df: sorted((r.symbol or "", *r[1:]) for r in df.collect())

    def expected(labelled):
        out = []
        for k, a, b in set(asked):
            held = {h: s for want in (intervals.KNOWN_EMPTY, intervals.OBSERVED) for key, x, y, s in cover if key == k and s in (want, want if labelled else "other") for h in range(x, y)}
            of = [held.get(h, intervals.MISSING) if labelled else "held" if h in held else intervals.MISSING for h in range(a, b)]
            start = a
            for status, run in itertools.groupby(of):
                end = start + len(list(run))
                if status in (intervals.MISSING, intervals.KNOWN_EMPTY):
                    out.append((k or "", *(hour(h) for h in (a, b, start, end)), *([status] if labelled else [])))
                start = end
        return sorted(out)

    requests, coverage = frame(asked), frame(cover, ", status string")
    assert found(intervals.coverage_gaps(requests, coverage, ["symbol"])) == expected(True)
    plain = intervals.coverage_gaps(requests, coverage.drop("status"), ["symbol"])
    assert found(plain) == expected(False)
    plan = plain._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Window" in line and "_re#" in line]
    sizes = spark.range(1).select(F.size(intervals._spans(F.lit(-5), F.lit(60))), F.size(intervals._spans(F.lit(-100000), F.lit(1000000)))).first()
    assert sizes[0] <= 14 and sizes[1] <= 48
