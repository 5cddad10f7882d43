"""Raw files in several arrivals: stored once, judged where touched."""

import os
import threading

import pytest

from oddsline.plans import batch
from oddsline.plans.catalog import QUERIES
from oddsline.plans.queries_streams import arrivals
from oddsline.sinks import tables as sinks
from oddsline.sources import feeds, streams
from oddsline.streaming import monitor
from oddsline.streaming.cleansing import KINDS, CleansedTables

FOLDER = "/root/testdata/sf0.001"


def take(spark, tables, root, arrived, max_files=None):
    for kind, rows in zip(KINDS, arrived):
        if rows is not None:
            rows.write.mode("append").parquet(f"{root}/raw/{kind}")
        schema = spark.read.parquet(f"{root}/raw/{kind}").schema
        stream = streams.table_stream(spark, f"{root}/raw/{kind}", schema, max_files)
        monitor.drain(tables.start(kind, stream, f"{root}/checkpoints/{kind}"))


def outcomes(df):
    return sorted((r.window_start, r.symbol, r.window_close, r.prediction_result) for r in df.collect())


def stored(spark, path):
    return outcomes(spark.read.parquet(path))


def test_only_touched_days_are_judged_again(spark, tmp_path):
    root, out = str(tmp_path / "in"), str(tmp_path / "out")
    tables = CleansedTables(spark, root, "ns")
    assert tables.judge(out) == []
    events = feeds.events(spark, FOLDER)
    whole = batch.verdicts(feeds.klines(events), feeds.stored_market_events(events))
    first, second = arrivals(spark, FOLDER)
    take(spark, tables, root, first, max_files=2)  # several micro-batches
    days = tables.judge(out)
    assert days[0] == "2024-01-01" and days[-1] == "2024-01-19"
    before = {d: os.stat(f"{out}/analysis/{d}").st_mtime_ns for d in os.listdir(f"{out}/analysis")}
    assert tables.judge(out) == []  # nothing new
    take(spark, tables, root, second)
    days = tables.judge(out)
    assert days[0] == "2024-01-10" and days[1] == "2024-01-20"
    after = {d: os.stat(f"{out}/analysis/{d}").st_mtime_ns for d in os.listdir(f"{out}/analysis")}
    assert all(after[d] == t for d, t in before.items() if d[5:] not in days)
    assert stored(spark, f"{out}/analysis") == outcomes(whole)
    assert spark.read.parquet(f"{out}/view").count() == whole.count()


def test_a_micro_batch_again_changes_nothing(spark, tmp_path):
    root = str(tmp_path)
    tables = CleansedTables(spark, root, "ns")
    (klines, events), _ = arrivals(spark, FOLDER)
    for rows, number in ((klines, 0), (klines.limit(0), 1), (klines, 0)):
        tables.append("klines", rows, number)
    tables.append("events", events, 0)
    assert tables.read("klines").count() == klines.count()
    assert tables.read("events").count() == events.count()
    assert tables.touched([-1, -1], [0, -1]) == tables.touched([-1, -1], [1, 0])
    assert tables.touched([0, 0], [1, 0]) == []


def test_a_failure_before_the_note_judges_the_same_days_again(spark, tmp_path, monkeypatch):
    root, out = str(tmp_path / "in"), str(tmp_path / "out")
    tables = CleansedTables(spark, root, "ns")
    first, _ = arrivals(spark, FOLDER)
    take(spark, tables, root, first)
    with monkeypatch.context() as patched:
        patched.setattr(sinks, "dated_view", lambda view: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            tables.judge(out)
    half = stored(spark, f"{out}/analysis")
    assert tables.judge(out) and stored(spark, f"{out}/analysis") == half
    assert tables.judge(out) == []


def test_unreadable_times_touch_no_day(spark, tmp_path):
    tables = CleansedTables(spark, str(tmp_path), "ns")
    (klines, _), _ = arrivals(spark, FOLDER)
    broken = klines.limit(3).withColumns({"timestamp": klines["symbol"]})
    tables.append("klines", broken, 0)
    assert tables.read("klines").count() == 3 and tables.judge(str(tmp_path / "out")) == []


def test_a_micro_batch_again_leaves_nothing_of_the_first_try(spark, tmp_path):
    tables = CleansedTables(spark, str(tmp_path), "ns")
    (klines, _), _ = arrivals(spark, FOLDER)
    part = klines.filter("timestamp < 1704240000000000000")  # 2024-01-03
    for rows in (klines, part):
        tables.append("klines", rows, 0)
    assert tables.read("klines").count() == part.count() > 0
    assert tables.touched([-1, -1], [0, -1]) == ["2024-01-01", "2024-01-02"]


def test_both_kinds_are_cleansed_side_by_side(spark, monkeypatch):
    both, append = threading.Barrier(len(KINDS)), CleansedTables.append

    def together(self, kind, raw, number):
        both.wait(60)
        append(self, kind, raw, number)

    monkeypatch.setattr(CleansedTables, "append", together)
    assert QUERIES["incremental_verdicts"](spark, FOLDER).count() > 0
