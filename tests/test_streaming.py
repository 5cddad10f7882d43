"""Streams against the same operators on tables, late rows, replays, and the live view."""

import json
import os

import pytest
from pyspark.sql import functions as F

from oddsline.config import BOOK_ROWS, PRICE_ROWS, TRADE_ROWS
from oddsline.operators import views, windows
from oddsline.plans import live as live_job
from oddsline.sources import feeds, messages, streams
from oddsline.streaming import jobs, monitor
from oddsline.streaming.live_view import LiveView
from oddsline.streaming import thinning
from oddsline.streaming.dedup import drop_repeated_within
from oddsline.schemas import DOUBLE, LONG, STRING, struct
from tests.test_windows import KLINE, kept_by_rule, random_rows

BASE = 1_704_067_200_000  # 2024-01-01 00:00 UTC


def write_file(folder, number, lines):
    """File ``number`` of a stream folder; modification times give the order."""
    folder.mkdir(exist_ok=True)
    path = folder / f"{number:03d}.json"
    path.write_text("\n".join(lines) + "\n")
    os.utime(path, (1_700_000_000 + number * 10,) * 2)


def tick(seconds, price=1.0, symbol="BTCUSDT"):
    return json.dumps([{"snapshot_time": BASE + int(seconds * 1000), "symbol": symbol, "close": price,
                        "quote_asset_volume": 2.0, "taker_buy_quote": 1.0}])


def options(tmp_path, name="checkpoint"):
    return jobs.StreamOptions(str(tmp_path / name), trigger=None, name=f"q-{tmp_path.name}-{name}")


def text_lines(df):
    return [r.value for r in df.collect()]


def sorted_messages(df):
    return text_lines(df.orderBy("event_id").select("value"))


def same_rows(a, b, *, digits=6):
    def rows(df):
        doubles = [f.name for f in df.schema if f.dataType.simpleString() == "double"]
        df = df.withColumns({c: F.round(c, digits) for c in doubles})
        return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=str)
    assert rows(a) == rows(b)


@pytest.mark.parametrize("row_type", [PRICE_ROWS, BOOK_ROWS, TRADE_ROWS])
def test_stream_in_many_batches_equals_table(spark, tmp_path, row_type):
    events = feeds.events(spark, "/root/testdata/sf0.001")
    raw = feeds.kline_messages(events) if row_type == PRICE_ROWS else feeds.market_messages(events)
    lines = sorted_messages(raw)
    for i in range(5):
        write_file(tmp_path / "in", i, lines[i * 200:(i + 1) * 200])
    stream = streams.text_stream(spark, str(tmp_path / "in"), max_files=1)
    query, view = jobs.start_live_windows(stream, row_type, str(tmp_path / "view"), options(tmp_path))
    monitor.drain(query)
    batches = [p["batchId"] for p in query.recentProgress]
    assert len(set(batches)) >= 5
    expected = views.live_view(jobs.WINDOWS_OF[row_type](raw), row_type)
    same_rows(view.read(), expected)
    view.compact()
    same_rows(view.read(), expected)


def test_late_rows(spark, tmp_path):
    # The watermark of a batch is that of the batch before.
    for i, lines in enumerate([[tick(10)], [tick(600)], [tick(605)], [tick(55), tick(570)]]):
        write_file(tmp_path / "in", i, lines)
    stream = streams.text_stream(spark, str(tmp_path / "in"), max_files=1)
    log = monitor.ProgressLog()
    spark.streams.addListener(log)
    query, view = jobs.start_live_windows(stream, PRICE_ROWS, str(tmp_path / "view"), options(tmp_path))
    monitor.drain(query)
    ticks = {r.window_end: r.ticks for r in view.read().collect()}
    assert ticks == {BASE + 60_000: 1, BASE + 600_000: 1, BASE + 660_000: 2}
    report = monitor.progress_report(spark, [query])
    assert report.agg(F.sum("dropped_late_rows")).first()[0] == 1
    assert report.agg(F.sum("input_rows")).first()[0] == 5
    spark.streams.removeListener(log)


def test_three_queries_of_the_live_job(spark, tmp_path):
    events = feeds.events(spark, "/root/testdata/sf0.001")
    write_file(tmp_path / "klines", 0, sorted_messages(feeds.kline_messages(events)))
    write_file(tmp_path / "markets", 0, sorted_messages(feeds.market_messages(events)))
    started = live_job.start_all(
        streams.text_stream(spark, str(tmp_path / "klines")),
        streams.text_stream(spark, str(tmp_path / "markets")),
        str(tmp_path / "views"), str(tmp_path / "checkpoints"), trigger=None)
    monitor.drain(*[query for query, _ in started.values()])
    for row_type, (_, view) in started.items():
        rows = view.read()
        assert rows.count() > 0
        assert rows.filter(~F.col("rowkey").startswith(row_type + "#")).count() == 0


def wait_for(condition, seconds=60):
    import time

    end = time.time() + seconds
    while not condition():
        assert time.time() < end
        time.sleep(0.1)


def test_view_is_maintained_beside_a_running_stream(spark, tmp_path):
    write_file(tmp_path / "in", 0, [tick(0, price=1.0), tick(1, symbol="ETHUSDT")])
    stream = streams.text_stream(spark, str(tmp_path / "in"), max_files=1)
    # the clock stands at 00:03, rows live for one minute: only the last window stays
    plan = jobs.Maintenance(ttl_seconds=60, keep=1, clock=lambda: BASE / 1000 + 180)
    query, view = jobs.start_live_windows(stream, PRICE_ROWS, str(tmp_path / "view"),
                                          jobs.StreamOptions(str(tmp_path / "c"), trigger="50 milliseconds"))
    try:
        wait_for(lambda: view.last_version() == 0)
        assert plan.run(view) is None  # the only batch may still be written again
        for i in range(1, 5):
            write_file(tmp_path / "in", i, [tick(i * 30, price=float(i)), tick(i * 30 + 1, symbol="ETHUSDT")])
            wait_for(lambda: view.last_version() >= i)
            if i == 3:
                first, run = view.last_version(), query.runId
                assert plan.run(view) == first - 1
                assert first in view._versions("deltas", "batch_id")
        assert query.isActive and query.runId == run and query.exception() is None
        query.processAllAvailable()
        assert plan.run(view) >= first
        rows = {(r.identifier, r.window_end - BASE): r.ticks for r in view.read().collect()}
        assert rows[("BTCUSDT", 180_000)] == 1
        assert ("BTCUSDT", 60_000) not in rows and ("BTCUSDT", 120_000) not in rows
        assert len(os.listdir(tmp_path / "view" / "base")) == 1
    finally:
        query.stop()


def test_maintenance_thread(spark, tmp_path):
    view = LiveView(spark, str(tmp_path / "v"), CELLS)
    for i in range(3):
        view.upsert(batch(spark, ("a", 10, float(i), None)), i)
    maintainer = jobs.Maintainer([view], jobs.Maintenance(seconds=0.05, ttl_seconds=None)).start()
    wait_for(lambda: view._versions("base", "upto") == [1])
    maintainer.stop()
    assert contents(view) == [("a", 2.0, None)]
    broken = jobs.Maintainer([view, None], jobs.Maintenance(seconds=0.05)).start()
    wait_for(lambda: broken.failure is not None)
    with pytest.raises(AttributeError):
        broken.stop()


def test_a_failing_query_raises(spark, tmp_path):
    write_file(tmp_path / "in", 0, [tick(1)])
    stream = streams.text_stream(spark, str(tmp_path / "in"))

    def broken(batch, batch_id):
        raise ValueError("sink is down")

    query = (stream.writeStream.foreachBatch(broken)
             .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start())
    with pytest.raises(Exception, match="sink is down"):
        monitor.drain(query)


# --- live view --------------------------------------------------------------

CELLS = struct(rowkey=STRING, window_end=LONG, x=DOUBLE, y=DOUBLE)


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), CELLS)


def contents(view, **arguments):
    return sorted((r.rowkey, r.x, r.y) for r in view.read(**arguments).collect())


def test_null_cells_do_not_erase(spark, tmp_path):
    view = LiveView(spark, str(tmp_path / "v"), CELLS)
    assert contents(view) == []
    view.upsert(batch(spark, ("a", 1, 5.0, 1.0), ("b", 1, 2.0, None)), 0)
    view.upsert(batch(spark, ("a", 1, None, 3.0)), 1)
    assert contents(view) == [("a", 5.0, 3.0), ("b", 2.0, None)]
    assert contents(view, upto=0) == [("a", 5.0, 1.0), ("b", 2.0, None)]


def test_replay_of_a_batch_changes_nothing(spark, tmp_path):
    view = LiveView(spark, str(tmp_path / "v"), CELLS)
    first, second = batch(spark, ("a", 1, 5.0, 1.0)), batch(spark, ("a", 1, 6.0, None))
    for rows, batch_id in ((first, 0), (second, 1), (second, 1), (first, 0)):
        view.upsert(rows, batch_id)
    assert contents(view) == [("a", 6.0, 1.0)]


def test_compaction_and_vacuum(spark, tmp_path):
    view = LiveView(spark, str(tmp_path / "v"), CELLS)
    assert view.compact() is None
    for i in range(4):
        view.upsert(batch(spark, ("a", 100, float(i), None), (f"k{i}", i, 1.0, 1.0)), i)
        if i % 2:
            assert view.compact() == i
    before = contents(view)
    assert view.compact() == 3  # nothing new: the base stays
    view.vacuum(keep=1)
    assert contents(view) == before
    assert os.listdir(tmp_path / "v" / "base") == ["upto=3"]
    assert os.listdir(tmp_path / "v" / "deltas") == []
    view.upsert(batch(spark, ("a", 100, None, 9.0)), 4)
    assert ("a", 3.0, 9.0) in contents(view)


def test_expired_rows_leave_the_view(spark, tmp_path):
    view = LiveView(spark, str(tmp_path / "v"), CELLS)
    view.upsert(batch(spark, ("old", 10, 1.0, 1.0), ("new", 20, 1.0, 1.0)), 0)
    assert contents(view, newer_than=10) == [("new", 1.0, 1.0)]
    view.compact(min_window_end=10)
    assert contents(view) == [("new", 1.0, 1.0)]


def bounded_view(spark, tmp_path):
    view = LiveView(spark, str(tmp_path / "v"), CELLS, buckets=4)
    keys = [(f"BIN#{s}#{9999999999999 - t}", t) for s in ("A", "B", "C") for t in range(10, 100, 10)]
    view.upsert(batch(spark, *[(k, t, 1.0, None) for k, t in keys]), 0)
    view.compact()
    view.upsert(batch(spark, *[(k, t, None, 2.0) for k, t in keys[::2]]), 1)
    view.upsert(batch(spark, *[(k, t, 3.0, None) for k, t in keys[::3]], (f"BIN#A#{9999999999999 - 100}", 100, 5.0, 5.0)), 2)
    return view


def test_bounded_reads_equal_filtered_ones(spark, tmp_path):
    view = bounded_view(spark, tmp_path)
    every = {r.rowkey: tuple(r) for r in view.read().collect()}
    assert len(every) == 28
    key = f"BIN#B#{9999999999999 - 30}"
    for arguments, keep in (
            ({"key": key}, lambda r: r[0] == key), ({"key": "none"}, lambda r: False),
            ({"prefix": "BIN#C#"}, lambda r: r[0].startswith("BIN#C#")), ({"newer_than": 50}, lambda r: r[1] > 50),
            ({"prefix": "BIN#A#", "newer_than": 80}, lambda r: r[0].startswith("BIN#A#") and r[1] > 80),
            ({"prefix": "BIN#", "newer_than": 80}, lambda r: r[1] > 80)):
        assert {r.rowkey: tuple(r) for r in view.read(**arguments).collect()} == {
            k: r for k, r in every.items() if keep(r)}, arguments
    older = LiveView.open(spark, str(tmp_path / "v"))  # asks for 16 buckets, reads the stored 4
    assert {r.rowkey: tuple(r) for r in older.read(upto=1).collect()} != every
    assert {r.rowkey: tuple(r) for r in older.read().collect()} == every
    with pytest.raises(ValueError):
        LiveView.open(spark, str(tmp_path / "nothing"))


def test_bounds_reach_both_scans_and_the_base_stays_in_place(spark, tmp_path):
    view = bounded_view(spark, tmp_path)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        check_bounded_plans(view)
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")


def check_bounded_plans(view):
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    one = plan(view.read(key="BIN#B#1"))
    assert one.count("EqualTo(rowkey,BIN#B#1)") == 2 and "SelectedBucketsCount: 1 out of 4" in one
    some = plan(view.read(prefix="BIN#A#", newer_than=80))
    assert some.count("StringStartsWith(rowkey,BIN#A#)") == 2 and some.count("GreaterThan(window_end,80)") == 2
    assert some.count(f"LessThan(rowkey,BIN#A#{9999999999999 - 80})") == 2
    for text in (one, some, plan(view.read())):
        assert text.count("Exchange") == 1  # of the deltas, into the buckets of the base
        assert text.index("Exchange") > text.index("SelectedBucketsCount")


def test_unfinished_folders_are_ignored(spark, tmp_path):
    view = LiveView(spark, str(tmp_path / "v"), CELLS)
    view.upsert(batch(spark, ("a", 1, 5.0, 1.0)), 0)
    view.upsert(batch(spark, ("a", 1, 6.0, 1.0)), 1)
    os.remove(tmp_path / "v" / "deltas" / "batch_id=1" / "_SUCCESS")
    assert contents(view) == [("a", 5.0, 1.0)]
    view.compact()
    os.remove(tmp_path / "v" / "base" / "upto=0" / "_buckets-16")
    assert contents(view) == [("a", 5.0, 1.0)] and view._versions("base", "upto") == []
    assert view.compact() == 0  # written again over the unfinished one
    assert contents(view) == [("a", 5.0, 1.0)]


# --- other sinks ------------------------------------------------------------

def test_event_rows(spark, tmp_path):
    line = {"symbol": "btc", "timestamp": BASE, "binance_price": 5.0, "poly_best_bid": 0.4}
    write_file(tmp_path / "in", 0, [json.dumps(line), json.dumps({**line, "timestamp": BASE + 1})])
    schema = "symbol string, timestamp bigint, binance_price double, poly_best_bid double"
    events = streams.text_stream(spark, str(tmp_path / "in")).select(
        F.from_json("value", schema).alias("e")).select("e.*")
    query, view = jobs.start_event_rows(events, str(tmp_path / "v"), options(tmp_path))
    monitor.drain(query)
    rows = view.read().orderBy("rowkey").collect()
    assert [r.rowkey for r in rows] == [f"BTC#{9999999999999 - BASE - 1}", f"BTC#{9999999999999 - BASE}"]
    assert rows[0].binance_price == 5.0 and rows[0].poly_last_trade is None


def test_events_of_one_millisecond_all_stay(spark, tmp_path):
    line = {"event_id": 1, "symbol": "btc", "timestamp": BASE, "binance_price": 5.0}
    write_file(tmp_path / "in", 0, [json.dumps(line), json.dumps({**line, "event_id": 2, "binance_price": 6.0})])
    write_file(tmp_path / "in", 1, [json.dumps({**line, "event_id": 3}), json.dumps(line)])
    schema = "event_id bigint, symbol string, timestamp bigint, binance_price double"
    events = streams.text_stream(spark, str(tmp_path / "in"), max_files=1).select(
        F.from_json("value", schema).alias("e")).select("e.*")
    query, view = jobs.start_event_rows(events, str(tmp_path / "v"), options(tmp_path))
    monitor.drain(query)
    rowkey = f"BTC#{9999999999999 - BASE}"
    for _ in range(2):  # the second time from a compacted view
        rows = view.read(prefix="BTC#").orderBy("event_key").collect()
        assert [(r.event_key, r.rowkey, r.binance_price) for r in rows] == [
            (f"{rowkey}#1", rowkey, 5.0), (f"{rowkey}#2", rowkey, 6.0), (f"{rowkey}#3", rowkey, 5.0)]
        view.compact()


def test_parquet_sink_appends_finished_windows(spark, tmp_path):
    write_file(tmp_path / "in", 0, [tick(5), tick(65), tick(300)])
    windows_ = jobs.price_windows(streams.text_stream(spark, str(tmp_path / "in")))
    monitor.drain(jobs.start_parquet(windows_, str(tmp_path / "out"), options(tmp_path)))
    ends = sorted(r.e for r in spark.read.parquet(str(tmp_path / "out")).select(
        (F.unix_millis("window_end") - BASE).alias("e")).collect())
    assert ends == [60_000, 120_000]


def test_console_sink_runs(spark, tmp_path, capfd):
    write_file(tmp_path / "in", 0, [tick(5)])
    rows = jobs.price_windows(streams.text_stream(spark, str(tmp_path / "in")))
    monitor.drain(jobs.start_console(rows, options(tmp_path)))


def kline_lines(rows):
    return [json.dumps(dict(zip(("event_id", "symbol", "snapshot_time", "is_closed", "close"), r))) for r in rows]


def thinning_stream(spark, tmp_path, delay="1 hour"):
    stream = streams.text_stream(spark, str(tmp_path / "in"), max_files=1).select(
        F.from_json("value", KLINE).alias("k")).select("k.*")
    with thinning.keyed_state(spark):
        return jobs.start_parquet(thinning.thinned(stream, 1.0, delay, tie="event_id"), str(tmp_path / "out"),
                                  options(tmp_path, "c"))


def test_thinned_stream_follows_the_rule_over_a_restart(spark, tmp_path):
    rows = random_rows(21, 500, 400, 0.05)
    expected, last = [], {}
    provider = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    for i in range(4):
        write_file(tmp_path / "in", i, kline_lines(rows[i * 125:(i + 1) * 125]))
        ids, last = kept_by_rule(rows[i * 125:(i + 1) * 125], 1000, last)
        expected += ids
        if i != 2:  # two runs take one micro-batch, the last takes two
            monitor.drain(thinning_stream(spark, tmp_path))
    kept = spark.read.parquet(str(tmp_path / "out"))
    assert kept.columns == ["event_id", "symbol", "snapshot_time", "is_closed", "close"]
    assert sorted(r.event_id for r in kept.collect()) == sorted(expected)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == provider
    assert not (tmp_path / "out" / "state").exists()  # the state is the checkpoint's


def test_thinned_stream_forgets_idle_symbols(spark, tmp_path):
    base = 1_700_000_000_000
    part = [[(1, "A", base, False, 1.0), (2, "B", base, False, 1.0), (3, "B", base + 10, False, 1.0)],
            [(4, "B", base + 60_000, False, 1.0), (5, None, base + 60_000, False, 1.0)],
            [(6, "B", base + 60_100, False, 1.0), (7, "C", base + 120_000, False, 1.0), (8, "C", None, True, 1.0)],
            [(9, "A", base + 1, True, 1.0), (10, "A", base + 120_000, False, 1.0), (11, None, base + 121_000, False, 1.0)]]
    for i, rows in enumerate(part):
        write_file(tmp_path / "in", i, kline_lines(rows))
    query = thinning_stream(spark, tmp_path, "10 seconds")
    monitor.drain(query)
    kept = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted(r.event_id for r in kept) == [1, 2, 4, 5, 7, 10, 11]  # 9 is late, 8 has no time
    state = [sum(op["numRowsTotal"] for op in p["stateOperators"]) for p in query.recentProgress]
    assert state[-1] <= max(state) and state[-1] < 2 * 4


def test_repeated_snapshots_on_a_stream(spark, tmp_path):
    base, expected = 1_700_000_000_000, []
    schema = "symbol string, timestamp bigint, snapshot_time bigint, close double"
    for i in range(6):  # ten minutes each, beginning with the last two of the one before
        rows = [(s, (base + m * 60_000) * 1_000_000, base + m * 60_000, float(i))
                for m in range(max(0, 10 * i - 2), 10 * i + 10) for s in ("A", "B", None)]
        expected += [(s, t, c) for s, _, t, c in rows if t >= base + 600_000 * i]
        lines = [json.dumps(dict(zip(("symbol", "timestamp", "snapshot_time", "close"), r))) for r in rows + rows[:5]]
        write_file(tmp_path / "in", i, lines)
    stream = streams.text_stream(spark, str(tmp_path / "in"), max_files=1).select(
        F.from_json("value", schema).alias("k")).select("k.*")
    query = jobs.start_parquet(drop_repeated_within(stream, "5 minutes"), str(tmp_path / "out"), options(tmp_path))
    monitor.drain(query)
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.columns == ["symbol", "timestamp", "snapshot_time", "close"]
    assert sorted(((r.symbol, r.snapshot_time, r.close) for r in got.collect()), key=str) == sorted(expected, key=str)
    state = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress]
    assert len(state) >= 6 and max(state) <= 3 * 25 < len(expected)  # bounded by the delay, not by what has come


def test_totals_outlive_a_restart(spark, tmp_path):
    progress = monitor.ProgressTable(spark, str(tmp_path / "totals"))
    spark.streams.addListener(progress)
    try:
        for number, files in enumerate([[[tick(10)], [tick(600)], [tick(605)]], [[tick(55), tick(56), tick(570)]]]):
            for i, lines in enumerate(files):
                write_file(tmp_path / "in", number * 10 + i, lines)
            raw = monitor.observed(streams.text_stream(spark, str(tmp_path / "in"), max_files=1), lines=F.count("*"))
            query, view = jobs.start_live_windows(raw, PRICE_ROWS, str(tmp_path / "view"), jobs.StreamOptions(
                str(tmp_path / "c"), trigger=None, name="prices"))
            monitor.drain(query)
            progress.wait_for(query)
    finally:
        spark.streams.removeListener(progress)
    total = monitor.ProgressTable(spark, str(tmp_path / "totals")).totals().first()
    assert total["query"] == "prices" and total.input_rows == 6 and total.observed == {"lines": 6}
    assert total.observed["lines"] - sum(r.ticks for r in view.read().collect()) == 2  # both lines of the late window
    assert total.dropped_by_state >= 1


def test_bounded_micro_batches(spark, tmp_path):
    for i in range(6):
        write_file(tmp_path / "in", i, [tick(i)] * 20)
    size = os.path.getsize(tmp_path / "in" / os.listdir(tmp_path / "in")[0])
    for limit, batches in ((2 * size + size // 2, range(2, 4)), (1, range(6, 7)), (100 * size, range(1, 2))):
        stream = streams.text_stream(spark, str(tmp_path / "in"), max_bytes=limit)
        query, _ = jobs.start_live_windows(stream, PRICE_ROWS, str(tmp_path / f"v{limit}"), options(tmp_path, f"c{limit}"))
        monitor.drain(query)
        taken = [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]
        assert sum(taken) == 120 and len(taken) in batches
    with pytest.raises(ValueError):
        streams.text_stream(spark, str(tmp_path / "in"), max_files=1, max_bytes=1)


def test_streams_and_tables_share_operators(spark):
    """Without a stream no watermark is added, so the batch plan stays a plain aggregate."""
    events = feeds.events(spark, "/root/testdata/sf0.001")
    df = windows.live_trades(messages.trades(messages.decode_market_events(feeds.market_messages(events))))
    assert "EventTimeWatermark" not in df._jdf.queryExecution().analyzed().toString()


def test_a_new_checkpoint_over_an_old_root_is_refused(spark, tmp_path):
    write_file(tmp_path / "in", 0, [tick(1)])
    raw = streams.text_stream(spark, str(tmp_path / "in"))
    start = lambda name: jobs.start_live_windows(raw, PRICE_ROWS, str(tmp_path / "root"), options(tmp_path, name))
    monitor.drain(start("first")[0])
    write_file(tmp_path / "in", 1, [tick(200, 7.0)])
    with pytest.raises(ValueError, match="new checkpoint"):
        start("second")
    running, view = start("first")  # the same checkpoint goes on
    monitor.drain(running)
    assert sorted(r.current_price for r in view.read().collect()) == [1.0, 7.0]


def test_a_key_twice_in_a_batch(spark, tmp_path):
    schema = struct(rowkey=STRING, window_end=LONG, a=DOUBLE, b=DOUBLE)
    for number, rows in enumerate(([("k", 1, 1.0, None), ("k", 2, 2.0, 5.0), ("l", 1, 3.0, 3.0)],
                                   [("l", 1, 3.0, 3.0), ("k", 2, 2.0, 5.0), ("k", 1, 1.0, None)])):
        view = LiveView(spark, str(tmp_path / str(number)), schema)
        view.upsert(spark.createDataFrame(rows, schema).repartition(3), 0, order="window_end")
        assert sorted(map(tuple, view.read().collect())) == [("k", 2, 2.0, 5.0), ("l", 1, 3.0, 3.0)]


def test_only_deltas_are_aggregated(spark, tmp_path):
    schema = struct(rowkey=STRING, window_end=LONG, a=DOUBLE)
    view = LiveView(spark, str(tmp_path), schema)
    view.upsert(spark.createDataFrame([("k", 1, 1.0), ("l", 1, 2.0)], schema), 0)
    view.compact()
    for batch_id, rows in ((1, [("k", 2, None)]), (2, [("m", 2, 4.0), ("k", 3, 9.0)])):
        view.upsert(spark.createDataFrame(rows, schema), batch_id)
    assert sorted(map(tuple, view.read().collect())) == [("k", 3, 9.0), ("l", 1, 2.0), ("m", 2, 4.0)]
    assert view.last_version() == 2
    text = view.read()._jdf.queryExecution().optimizedPlan().toString()
    aggregated = text[text.index("Aggregate"):]
    assert text.count("Aggregate") == 1 and aggregated.count("Relation") == 1  # the deltas alone


def test_thinning_keeps_null_symbols(spark, tmp_path):
    captured = spark.createDataFrame([(0, None, False), (500, None, False), (2000, None, False), (0, "a", True)],
                                     "snapshot_time bigint, symbol string, is_closed boolean")
    from oddsline.operators.snapshots import thin_snapshots

    kept = sorted(((r.symbol or ""), r.snapshot_time) for r in thin_snapshots(captured).collect())
    assert kept == [("", 0), ("", 2000), ("a", 0)]
