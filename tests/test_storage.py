"""Scans, upserts, landing and jobs over a temporary store."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tickloom import jobs
from tickloom.operators import bars, intervals
from tickloom.sinks.upsert import merge, upsert
from tickloom.sources import land, scan
from tickloom.sinks import publish
from tickloom.sources import files
from tickloom.sources.datasets import OFFERED, available, dataset, is_offered
from tickloom.streaming.landing import stream_vendor_csv

START = datetime(2024, 1, 1)


def candles(spark, venue, kind, symbol, minutes, price=10.0, volume=1.0):
    at = F.timestamp_micros(F.unix_micros(F.lit("2024-01-01 00:00:00").cast("timestamp")) + F.col("id") * 60_000_000)
    rows = spark.range(minutes).select(at.alias("time"))
    given = {"exchange": venue, "instrument_type": kind, "symbol": symbol, "timeframe": "1m"}
    rows = rows.withColumns({k: F.lit(v) for k, v in given.items()})
    return rows.withColumns({p: F.lit(price) for p in ("open", "high", "low", "close")} | {"volume": F.lit(volume), "is_interpolated": F.lit(False)})


def test_upsert_twice_changes_nothing_and_keeps_the_stored_candle(spark, tmp_path):
    root = str(tmp_path)
    rows = candles(spark, "v", "spot", "BTC/USD", 1500)
    upsert(rows.unionByName(rows.limit(10)), root, "ohlcv")
    first = sorted(map(str, scan.get_ohlcv(spark, root).collect()))
    upsert(candles(spark, "v", "spot", "BTC/USD", 20, price=99.0), root, "ohlcv")
    assert sorted(map(str, scan.get_ohlcv(spark, root).collect())) == first
    assert len(first) == 1500


def test_generic_rows_are_replaced(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "c"), (3, "d"), (3, "e")], "k int, v string")
    assert {tuple(r) for r in merge(old, new, ["k"], "last").collect()} == {(1, "a"), (2, "c"), (3, "e")}
    assert {tuple(r) for r in merge(old, new, ["k"], "first").collect()} == {(1, "a"), (2, "b"), (3, "d")}


def test_scan_reads_only_the_days_of_its_range(spark, tmp_path):
    root = str(tmp_path)
    upsert(candles(spark, "v", "spot", "BTC/USD", 3000), root, "ohlcv")
    part = scan.get_ohlcv(spark, root, start="2024-01-01T12:00:00", end="2024-01-01T13:00:00", symbol="BTC/USD")
    assert part.count() == 60
    plan = part._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters") :].split("]")[0]
    assert "date" in filters and "base_asset" in filters
    assert scan.get_ohlcv(spark, root, exchange="other").count() == 0
    stock = {r.category: r["count"] for r in scan.inventory(spark, root, ["ohlcv"], deep=True).collect()}
    assert stock == {"1m": 3000}
    assert [r["count"] for r in scan.inventory(spark, root, ["ohlcv"]).collect()] == [3]
    assert scan.storage_sizes(spark, root, "ohlcv").first().files >= 3


@pytest.mark.parametrize("header", [True, False])
def test_vendor_files_of_all_units(spark, tmp_path, header):
    of = dataset("aggTrades")
    times = ["1704067200", "1704067200000", "1704067200000000", "2024-01-01 00:00:00", "Infinity"]
    lines = [",".join(of.vendor)] if header else []
    lines += [f"{i},1.5,2,10,11,{t},True,false" for i, t in enumerate(times)]
    (tmp_path / "a.csv").write_text("\n".join(lines))
    rows = land.land_vendor_csv(spark, str(tmp_path / "*.csv"), "aggTrades", "BTC/USD", "v", "spot").orderBy("agg_trade_id").collect()
    assert [r.agg_trade_id for r in rows] == [0, 1, 2, 3]
    assert {r.time for r in rows} == {START}
    assert rows[0].is_buyer_maker is True and rows[0].is_best_match is False


def test_answers_become_rows(spark):
    ms = 1704067200000
    raw = spark.createDataFrame([("v", "spot", "B/U", "1m", json.dumps([[ms, 1, 2, 0.5, 1.5, None], [ms + 60000, None, 2, 1, 1, 3]]))], "exchange string, instrument_type string, symbol string, timeframe string, answer string")
    (row,) = land.land_candles(raw).collect()
    assert (row.time, row.open, row.volume) == (START, 1.0, 0.0)
    interest = raw.withColumn("answer", F.lit(json.dumps([{"timestamp": ms, "openInterestAmount": 7.5}])))
    assert land.land_open_interest(interest).first().value == 7.5
    market = {"B/U": {"base": "B", "quote": "U", "active": True, "precision": {"price": 0.1, "amount": 1}, "limits": {"amount": {"min": 2}, "cost": {"min": 3}}}}
    flat = land.flatten_markets(spark.createDataFrame([("v", json.dumps(market))], "exchange_id string, answer string")).first()
    assert (flat.symbol, flat.base_asset, flat.min_amount, flat.min_cost) == ("B/U", "B", 2.0, 3.0)
    assert json.loads(flat.raw_info)["quote"] == "U"


def test_only_offered_datasets_stay(spark):
    asked = spark.createDataFrame([("spot", "metrics"), ("swap", "metrics")], "instrument_type string, data_type string")
    assert [r.instrument_type for r in available(asked, spark).collect()] == ["swap"]
    assert [k for k in ("spot", "swap", "future") if is_offered("liquidationSnapshot", k)] == ["future"]
    assert [k for k in ("spot", "swap", "future") if is_offered("fundingRate", k)] == ["swap", "future"]
    assert is_offered("open_interest", "spot")  # comes from answers
    assert all(dataset(n) for names in OFFERED.values() for n in names)


def test_jobs_end_to_end_and_again(spark, tmp_path):
    root = str(tmp_path)
    for venue, kind, price, volume in (("a", "spot", 10.0, 1.0), ("b", "spot", 20.0, 3.0), ("a", "swap", 30.0, 4.0)):
        upsert(candles(spark, venue, kind, "BTC/USD", 300, price, volume), root, "ohlcv")
    jobs.regenerate(spark, root, ["1h"])
    merged = {r.instrument_type: (r.close, r.volume) for r in scan.get_aggregated(spark, root).where("time = '2024-01-01 01:00:00'").collect()}
    assert merged == {"spot": (17.5, 4.0), "swap": (30.0, 4.0)}
    assert scan.get_synthetic(spark, root).where("time = '2024-01-01 01:00:00'").first().close == 23.75
    hours = scan.scan(spark, root, "resampled", timeframe="1h").collect()
    assert len(hours) == 5 and {r.volume for r in hours} == {480.0}
    jobs.aggregate_ohlcv(spark, root)
    jobs.create_synthetic_ohlcv(spark, root)
    jobs.resample_ohlcv(spark, root, ["1h"])
    assert sorted(map(str, scan.scan(spark, root, "resampled", timeframe="1h").collect())) == sorted(map(str, hours))
    path = jobs.create_sliding_dataset(spark, root, "c", ["1m", "5m"], ["close", "volume"])
    stored = spark.read.parquet(path)
    assert stored.count() == 1440
    row = stored.where("time = '2024-01-01 01:00:00'").first()
    assert row.features == [[23.75, 8.0], [23.75, 40.0]]
    jobs.create_sliding_dataset(spark, root, "c", ["1m", "5m"], ["close", "volume"])
    assert spark.read.parquet(path).count() == 1440
    report = jobs.quality_report(spark, root).collect()
    assert len(report) == 3 and all(r.quality_score == 100.0 for r in report)


def test_backfill_and_metadata_and_serving(spark, tmp_path):
    root = str(tmp_path)
    coverage = jobs.backfill(candles(spark, "a", "spot", "BTC/USD", 120), root, "ohlcv", end=datetime(2024, 1, 1, 1))
    assert scan.get_ohlcv(spark, root).count() == 60
    assert [r.end_ts for r in coverage.collect()] == [datetime(2024, 1, 1, 1)]
    answers = spark.createDataFrame([("v", json.dumps({"B/U": {"base": "B", "quote": "U"}}))], "exchange_id string, answer string")
    for _ in range(2):
        jobs.sync_metadata(answers, f"{root}/symbols")
    assert spark.read.parquet(f"{root}/symbols").count() == 1
    with pytest.raises(ValueError):
        jobs.load_serving(spark, root, f"{root}/s", "ohlcv")


@pytest.mark.parametrize("header", ["named", "positions", "shuffled"])
def test_vendor_columns_are_taken_by_name(spark, tmp_path, header):
    cells = {"create_time": "2024-01-01 00:05:00", "symbol": "BTCUSDT", "sum_open_interest": "1.5", "sum_open_interest_value": "2.5", "count_top_trader_long_short_ratio": "3", "sum_top_trader_long_short_ratio": "4", "count_long_short_ratio": "5", "sum_long_short_ratio": "6"}
    names = list(cells)
    if header == "shuffled":
        names = names[3:] + ["new_column"] + names[:3]
        cells["new_column"] = "99"
    lines = [] if header == "positions" else [",".join(names)]
    (tmp_path / "m.csv").write_text("\n".join([*lines, ",".join(cells[n] for n in names)]) + "\n")
    (row,) = land.land_vendor_csv(spark, str(tmp_path / "*.csv"), "metrics", "BTC/USDT:USDT", "v", "swap").collect()
    assert (row.time, row.symbol, row.sum_open_interest, row.sum_open_interest_value, row.sum_long_short_ratio) == (datetime(2024, 1, 1, 0, 5), "BTC/USDT:USDT", 1.5, 2.5, 6.0)


def test_files_of_several_headers_land_together(spark, tmp_path):
    (tmp_path / "a.csv").write_text("calc_time,funding_interval_hours,last_funding_rate\n1704067200000,8,0.01\n")
    (tmp_path / "b.csv").write_text("1704067260000,BTCUSDT,0.02\n")
    (tmp_path / "c.csv").write_text("symbol,last_funding_rate,calc_time\nETHUSDT,0.03,1704067320000\n")
    rows = land.land_vendor_csv(spark, str(tmp_path / "*.csv"), "fundingRate", None, "v", "swap").orderBy("time").collect()
    assert [(r.symbol, r.last_funding_rate) for r in rows] == [(None, 0.01), ("BTCUSDT", 0.02), ("ETHUSDT", 0.03)]
    (tmp_path / "d").mkdir()
    (tmp_path / "d/t.csv").write_text("id,price,quantity,first_trade_id,last_trade_id,transact_time,is_buyer_maker\n7,1,2,3,4,1704067200000,true\n")
    (row,) = land.land_vendor_csv(spark, str(tmp_path / "d"), "aggTrades", "B/U", "v", "swap").collect()
    assert (row.qty, row.last_trade_id, row.time, row.is_buyer_maker, row.is_best_match) == (2.0, 4, START, True, None)


def test_equal_keys_are_settled_by_arrival(spark, tmp_path):
    (tmp_path / "in").mkdir()
    lines = [f"1,{p},1,1,1704067200000,true,true" for p in (5, 9, 1, 7)]
    (tmp_path / "in/a.csv").write_text("\n".join(lines[:2]) + "\n")
    (tmp_path / "in/b.csv").write_text("\n".join(lines[2:]) + "\n")
    rows = land.land_vendor_csv(spark, str(tmp_path / "in"), "trades", "B/U", "v", "spot")
    for keep, price in (("first", 5.0), ("last", 7.0)):
        upsert(rows.repartition(3), str(tmp_path / keep), "trades", keep)
        assert [r.price for r in scan.get_tick_data(spark, str(tmp_path / keep)).collect()] == [price]


def ticks(spark, n, day=1):
    at = F.timestamp_micros(F.lit(1704067200000000 + (day - 1) * 86_400_000_000) + F.col("id") * 1000)
    return spark.range(n).select(F.lit("v").alias("exchange"), F.lit("spot").alias("instrument_type"), F.lit("B/U").alias("symbol"), F.col("id").alias("trade_id"), F.lit(1.0).alias("price"), F.lit(2.0).alias("qty"), at.alias("time"), F.lit(True).alias("is_buyer_maker"))


def test_a_large_day_is_several_files_and_nothing_is_left_behind(spark, tmp_path):
    root = str(tmp_path)
    for _ in range(2):
        upsert(ticks(spark, 200_000), root, "trades", rows_per_file=50_000)
        listed = files.stored_files(spark, root, "trades").collect()
        assert len(listed) >= 4 and len({f.date for f in listed}) == 1
        assert scan.get_tick_data(spark, root).count() == 200_000
        assert not publish.Files(spark, root).below(f"{root}/_pending/trades")
    # Spark deals a large folder to several tasks.
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        upsert(ticks(spark, 200_000), root, "trades")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert files.stored_files(spark, root, "trades").count() > 3


def test_a_lost_job_is_finished_by_the_next(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    upsert(ticks(spark, 10, 1).unionByName(ticks(spark, 10, 2)), root, "trades")
    moved = []

    def stop(self, source, target, rename=publish.Files.rename):
        if "date=" in target:
            moved.append(target)
            if len(moved) == 2:
                raise OSError("lost")
        rename(self, source, target)

    monkeypatch.setattr(publish.Files, "rename", stop)
    with pytest.raises(OSError):
        upsert(ticks(spark, 20, 1).unionByName(ticks(spark, 20, 2)), root, "trades")
    monkeypatch.undo()
    assert len(publish.Files(spark, root).below(f"{root}/_pending/trades")) == 1
    (tmp_path / "_pending/trades/4-half.open").mkdir()
    assert publish.finish_pending(spark, f"{root}/trades") == 1
    assert scan.get_tick_data(spark, root).count() == 40
    assert not publish.Files(spark, root).below(f"{root}/_pending/trades")


def test_widths_lie_apart_and_reads_can_be_ordered(spark, tmp_path):
    root = str(tmp_path)
    minutes = candles(spark, "v", "spot", "BTC/USD", 100)
    upsert(minutes.unionByName(minutes.where("minute(time) = 0").withColumn("timeframe", F.lit("1h"))).unionByName(candles(spark, "a", "spot", "ETH/USD", 50)), root, "ohlcv")
    read = scan.scan(spark, root, "ohlcv", timeframe="1h")
    assert read.count() == 2 and all("timeframe=1h" in f for f in {r.f for r in read.select(F.input_file_name().alias("f")).collect()})
    rows = [(r.exchange, r.time) for r in scan.get_ohlcv(spark, root, ordered=True).collect()]
    assert rows == sorted(rows) and len(rows) == 150
    assert {(r.category, r["count"]) for r in scan.inventory(spark, root, ["ohlcv"]).where("exchange = 'v'").collect()} == {("1m", 1), ("1h", 1)}
    plan = scan.inventory(spark, root, ["ohlcv"])._jdf.queryExecution().executedPlan().toString()
    assert "parquet" not in plan.lower().replace(".parquet", "")


def test_several_stores_and_their_schemas(spark, tmp_path):
    roots = {"a": str(tmp_path / "a"), "b": str(tmp_path / "b")}
    for name, root in roots.items():
        upsert(candles(spark, name, "spot", "BTC/USD", 10), root, "ohlcv")
    assert {(r.store, r.exchange, r["count"]) for r in scan.inventory(spark, roots, ["ohlcv"], deep=True).collect()} == {("a", "a", 10), ("b", "b", 10)}
    assert {(r.store, r.exchange) for r in scan.scan_stores(spark, roots, "ohlcv").collect()} == {("a", "a"), ("b", "b")}
    other = "/exchange=a/instrument_type=spot/base_asset=BTC/timeframe=1m/date=2024-01-02"
    spark.createDataFrame([(1, "x")], "open int, extra string").coalesce(1).write.parquet(roots["a"] + "/ohlcv" + other)
    report = {(r.store, r.column, r.type): r for r in scan.schema_report(spark, roots, ["ohlcv"]).collect()}
    assert {t for s, c, t in report if (s, c) == ("a", "open")} == {"double", "int32"}
    assert report["a", "open", "double"].drifts and report["a", "extra", "string"].drifts and not report["b", "open", "double"].drifts
    assert report["b", "open", "double"].sample == "10.0" and report["b", "symbol", "string"].sample == "BTC/USD"
    assert str(report["a", "open", "int32"].first_day) == "2024-01-02"


def test_sliding_reads_what_new_days_reach(spark, tmp_path):
    root = str(tmp_path)
    days = candles(spark, "a", "spot", "BTC/USD", 8 * 1440, 10.0).withColumn("open", 1.0 + F.unix_seconds("time") % 977)
    days = days.where("date(time) not in ('2024-01-02', '2024-01-06')")
    figures = days.withColumns({"quote_volume": F.col("volume"), "twap": F.col("open"), "vwap": F.col("open"), "exchange": F.lit("aggregated"), "instrument_type": F.lit("synthetic"), "symbol": F.lit("BTC")})
    figures = figures.withColumns({"high": F.greatest("open", "high"), "low": F.least("open", "low"), "close": F.col("open") + 0.5}).drop("is_interpolated")
    upsert(figures.where("time < '2024-01-07'"), root, "synthetic")
    path = jobs.create_sliding_dataset(spark, root, "c", ["1m", "1d"], ["open", "close", "volume", "high"])
    upsert(figures, root, "synthetic")
    pending, source = jobs.sliding_inputs(spark, root, path, "c", ["1m", "1d"])
    assert sorted(str(r.date) for r in pending.collect()) == ["2024-01-07", "2024-01-08"]
    # One day back from each, and the last day with candles before that.
    assert sorted({str(r.d) for r in source.select(F.to_date("time").alias("d")).distinct().collect()}) == ["2024-01-05", "2024-01-07", "2024-01-08"]
    plan = source._jdf.queryExecution().executedPlan().toString()
    assert "2024-01-05" in plan[plan.index("PartitionFilters") :].split("PushedFilters")[0] or "19727" in plan[plan.index("PartitionFilters") :].split("PushedFilters")[0]
    jobs.create_sliding_dataset(spark, root, "c", ["1m", "1d"], ["open", "close", "volume", "high"])
    step = sorted(map(str, spark.read.parquet(path).where("config = 'c'").drop("config").collect()))
    jobs.create_sliding_dataset(spark, root, "all", ["1m", "1d"], ["open", "close", "volume", "high"])
    assert len(step) == 6 * 1440
    assert step == sorted(map(str, spark.read.parquet(path).where("config = 'all'").drop("config").collect()))


def test_a_second_load_writes_nothing(spark, tmp_path):
    root, served = str(tmp_path / "r"), str(tmp_path / "s")
    upsert(ticks(spark, 100, 1).withColumn("trade_id", F.when(F.col("trade_id") != 3, F.col("trade_id"))), root, "trades")
    jobs.load_serving(spark, root, served, "trades")
    before = {(r.path, r.changed) for r in files.stored_files(spark, served, "trades").collect()}
    rows = scan.get_tick_data(spark, served)
    assert rows.count() == 100 and rows.where("trade_id = -1").count() == 1
    upsert(ticks(spark, 50, 2), root, "trades")
    jobs.load_serving(spark, root, served, "trades")
    after = {(r.path, r.changed) for r in files.stored_files(spark, served, "trades").collect()}
    assert before < after and scan.get_tick_data(spark, served).count() == 150
    # What a missing id became is an id like others when bars are made.
    assert bars.tick_bars(scan.get_tick_data(spark, served), "1d", ["symbol"]).count() == 2


def test_backfill_knows_what_is_empty_and_what_is_not_offered(spark, tmp_path):
    root = str(tmp_path)
    series = "exchange string, instrument_type string, symbol string, start_ts timestamp, end_ts timestamp"
    asked = spark.createDataFrame([("a", "spot", "BTC/USD", datetime(2024, 1, 1), datetime(2024, 1, 1, 3))], series)
    coverage = jobs.backfill(candles(spark, "a", "spot", "BTC/USD", 60), root, "ohlcv", asked=asked)
    coverage = spark.createDataFrame(coverage.collect(), coverage.schema)  # coverage is a stored table
    told = sorted((r.start_ts.hour, r.end_ts.hour, r.status) for r in coverage.collect())
    assert told == [(0, 1, "observed"), (1, 3, "known_empty")]
    more = spark.createDataFrame([("a", "spot", "BTC/USD", datetime(2024, 1, 1), datetime(2024, 1, 1, 5))], series)
    gaps = intervals.coverage_gaps(more, coverage, ["exchange", "instrument_type", "symbol"])
    assert sorted((r.gap_start.hour, r.gap_end.hour, r.status) for r in gaps.collect()) == [(1, 3, "known_empty"), (3, 5, "missing")]
    listing = more.selectExpr("exchange", "instrument_type", "symbol", "start_ts as listing_date")
    assert [r.gap_start.hour for r in intervals.pending_ranges(more, coverage, listing, ["exchange", "instrument_type", "symbol"]).collect()] == [3]
    later = jobs.backfill(candles(spark, "a", "spot", "BTC/USD", 120), root, "ohlcv", coverage)
    assert sorted((r.start_ts.hour, r.end_ts.hour, r.status) for r in later.collect()) == [(0, 2, "observed"), (2, 3, "known_empty")]
    jobs.backfill(ticks(spark, 5).withColumn("instrument_type", F.lit("future")), root, "trades")
    metrics = ticks(spark, 5).select("exchange", "instrument_type", "symbol", "time")
    jobs.backfill(metrics, root, "metrics")
    assert not publish.Files(spark, root).below(f"{root}/metrics")


def test_a_stream_lands_each_file_once(spark, tmp_path):
    inbox, root, at = tmp_path / "in", str(tmp_path / "store"), str(tmp_path / "checkpoint")
    inbox.mkdir()
    for name, price in (("a", 1), ("b", 2)):
        (inbox / f"{name}.csv").write_text(f"trade_id,price,qty,quote_qty,time,is_buyer_maker,is_best_match\n1,{price},1,1,1704067200000,true,true\n")
        for _ in range(2):
            stream_vendor_csv(spark, str(inbox), root, at, "trades", "v", "spot", "B/U").awaitTermination()
        assert [r.price for r in scan.get_tick_data(spark, root).collect()] == [1.0]
    assert len(list((tmp_path / "checkpoint/commits").glob("[0-9]*"))) == 2
