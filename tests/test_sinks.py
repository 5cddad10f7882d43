"""Written tables: re-runs, partitions, retention, the batch job."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from oddsline.operators import views
from oddsline.plans import batch
from oddsline.sinks import tables as sinks
from oddsline.sinks.folders import Folders
from oddsline.sources import feeds, tables
from tests.test_views import NOON, batch_view


def test_running_a_day_again_replaces_only_that_day(spark, tmp_path):
    path = str(tmp_path / "view")
    day = 86400
    sinks.write_batch_view(batch_view(spark, [
        ("BTCUSDT", NOON - day, 1.0, "UNCERTAIN"), ("BTCUSDT", NOON, 2.0, "UNCERTAIN"),
        ("ETHUSDT", NOON + 900, 3.0, "UNCERTAIN")]), path)
    sinks.write_batch_view(batch_view(spark, [("BTCUSDT", NOON, 9.0, "CORRECT_BULL")]), path)
    rows = sinks.read_batch_view(spark, path).collect()
    assert sorted((r.price_close, str(r.date)) for r in rows) == [
        (1.0, "2024-01-29"), (9.0, "2024-01-30")]


def test_view_keeps_values_and_order(spark, tmp_path):
    path = str(tmp_path / "view")
    sinks.write_batch_view(batch_view(spark, [
        ("BTCUSDT", NOON + 900 * i, 92543.87654321, "CORRECT_BULL") for i in range(40)]), path)
    rows = sinks.read_batch_view(spark, path).orderBy("rowkey").collect()
    assert {r.price_close for r in rows} == {92543.87654321}
    starts = [r.timestamp for r in rows]
    assert starts == sorted(starts, reverse=True)  # newest first in key order


def test_raw_candles_append_by_symbol_and_utc_date(spark, tmp_path):
    path = str(tmp_path / "raw")
    df = spark.createDataFrame([("BTCUSDT", 1767286619000, 1.0), ("BTCUSDT", 1767311999999, 2.0),
                                ("ETHUSDT", 1767312000000, 3.0)], "symbol string, timestamp bigint, close double")
    sinks.write_raw_klines(df, path)
    sinks.write_raw_klines(df.limit(1), path)
    rows = spark.read.parquet(path).groupBy("symbol", "date").count().collect()
    assert sorted((r.symbol, str(r.date), r["count"]) for r in rows) == [
        ("BTCUSDT", "2026-01-01", 3), ("ETHUSDT", "2026-01-02", 1)]


def test_cleansing_casts_texts_and_keeps_bad_rows(spark):
    raw = feeds.klines(feeds.events(spark, "/root/testdata/sf0.001")).limit(1)
    raw = raw.select(*[F.col(c).cast("string").alias(c) for c in raw.columns])
    bad = raw.withColumn("open", F.lit("oops")).withColumn("timestamp", F.lit("x"))
    row = sinks.cleanse_klines(bad).first()
    assert row.open is None and row.timestamp is None and row.date is None and row.close is not None


def test_metadata_is_filed_by_utc_date(spark, tmp_path):
    path = str(tmp_path / "meta")
    df = spark.createDataFrame([(1767225599, "{}"), (1767225600, json.dumps({"btc": {}}))],
                               "start_s bigint, value string")
    sinks.write_metadata(df, path)
    rows = spark.read.schema("start_s bigint, value string, date date").json(path).collect()
    assert sorted((str(r.date), r.value) for r in rows) == [("2025-12-31", "{}"), ("2026-01-01", '{"btc": {}}')]


def test_retention(spark, tmp_path):
    path = str(tmp_path / "klines")
    klines = feeds.klines(feeds.events(spark, "/root/testdata/sf0.001")).drop("event_id")
    sinks.write_cleansed(klines, path)
    tables.create_klines_table(spark, "t_retention", path)
    tables.repair_partitions(spark, "t_retention")
    listed = tables.list_partitions(spark, "t_retention")
    old = sinks.expired_partitions(listed, dt.date(2024, 2, 10))
    assert {r.date for r in old.collect()} == {dt.date(2024, 1, d) for d in range(1, 11)}
    assert sinks.drop_partitions(spark, "t_retention", old) == 10
    assert tables.list_partitions(spark, "t_retention").count() == listed.count() - 10
    assert spark.table("t_retention").agg(F.min("date")).first()[0] == dt.date(2024, 1, 11)


def test_hot_partition_value_is_split_over_writers(spark, tmp_path):
    path = str(tmp_path / "hot")
    # 90% of 400,000 rows share one symbol
    df = spark.range(400_000).select(
        F.when(F.col("id") % 10 == 0, F.concat(F.lit("S"), F.col("id") % 7)).otherwise("HOT").alias("symbol"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"))
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4m")
    try:
        sinks.write_partitioned(df, path, ("symbol",))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    files = spark.read.parquet(path).select("symbol", F.input_file_name().alias("f")).distinct()
    counts = {r.symbol: r["count"] for r in files.groupBy("symbol").count().collect()}
    assert counts["HOT"] >= 3
    assert spark.read.parquet(path).count() == 400_000


def test_batch_job(spark, tmp_path):
    events = feeds.events(spark, "/root/testdata/sf0.001")
    klines, market = feeds.klines(events), feeds.stored_market_events(events)
    out = str(tmp_path / "out")
    report = batch.run(spark, klines, market, out).collect()
    expected = batch.verdicts(klines, market)
    assert sum(r["count"] for r in report if r.overall) == expected.count()
    assert spark.read.parquet(f"{out}/view").count() == expected.count()
    day = batch.verdicts(klines, market, date="2024-01-15")
    assert {str(r.d) for r in day.select(F.to_date("window_start").alias("d")).collect()} <= {"2024-01-15"}
    assert views.batch_view(expected).columns == [
        c for c in spark.read.parquet(f"{out}/view").columns if c != "date"]


def test_daily_run_keeps_other_days_and_refuses_a_wrong_unit(spark, tmp_path):
    from oddsline.config import Settings

    events = feeds.events(spark, "/root/testdata/sf0.001")
    klines, market = feeds.klines(events), feeds.stored_market_events(events)
    out = str(tmp_path / "out")
    batch.run(spark, klines, market, out)
    rows = lambda: sorted(map(tuple, spark.read.parquet(f"{out}/analysis").collect()), key=str)
    whole = rows()
    batch.run(spark, klines, market, out, date="2024-01-15")
    assert rows() == whole
    with pytest.raises(ValueError, match="unit"):
        batch.run(spark, klines, market, out, settings=Settings(epoch_unit="us"))


def test_judging_again_withdraws_rows(spark, tmp_path):
    events = feeds.events(spark, "/root/testdata/sf0.001")
    klines, market = feeds.klines(events), feeds.stored_market_events(events)
    out = str(tmp_path / "out")
    assert batch.run(spark, klines, market.limit(0), out).collect() == []  # a first run without verdicts
    assert spark.read.schema("rowkey string").parquet(f"{out}/view").count() == 0
    batch.run(spark, klines, market, out)
    days = lambda name: sorted(n for n in os.listdir(f"{out}/{name}") if n.startswith("date="))
    before = days("analysis")
    assert days("view") == before and f"date={DAY}" in before
    batch.run(spark, klines, market.limit(0), out, date=DAY)
    assert days("analysis") == days("view") == [d for d in before if d != f"date={DAY}"]
    batch.run(spark, klines, market, out, date=DAY)
    assert days("analysis") == before
    batch.run(spark, klines, market.limit(0), out, until="2024-01-20", date="2024-01-10")
    assert days("view") == [d for d in before if not "date=2024-01-10" <= d <= "date=2024-01-20"]
    assert batch.run(spark, klines, market.limit(0), out).collect() == []
    assert days("analysis") == days("view") == []


DAY = "2024-01-15"


def dated(spark, *rows):
    return spark.createDataFrame(list(rows), "x int, date string").withColumn("date", F.col("date").cast("date"))


def stored_rows(spark, path):
    return sorted((r.x, str(r.date)) for r in spark.read.schema("x int, date date").parquet(path).collect())


def test_an_interrupted_swap_is_finished(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    old = [(1, "2024-01-01"), (2, "2024-01-02"), (3, "2024-01-03"), (4, "2024-01-04")]
    new = [(20, "2024-01-02"), (50, "2024-01-05")]
    want = [(1, "2024-01-01"), (20, "2024-01-02"), (50, "2024-01-05")]
    steps = ("move", "remove", "make", "write")
    for fail_at in range(14):
        sinks.replace_range(dated(spark, *old), path)
        calls = 0

        def failing(original):
            def call(self, *args):
                nonlocal calls
                calls += 1
                if calls == fail_at:
                    raise OSError("lost")
                return original(self, *args)
            return call

        with monkeypatch.context() as patched:
            for step in steps:
                patched.setattr(Folders, step, failing(getattr(Folders, step)))
            try:
                sinks.replace_range(dated(spark, *new), path, "2024-01-02", "2024-01-31")
            except OSError:
                pass
        sinks.finish_swaps(spark, path)
        assert stored_rows(spark, path) in (want, old), fail_at
        assert [n for n in os.listdir(path) if n.startswith("_staged")] == []
    assert stored_rows(spark, path) == want


def test_replaced_days(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.replace_days(dated(spark, (1, "2024-01-01"), (2, "2024-01-02")), path, ["2024-01-01", "2024-01-02"])
    sinks.replace_days(dated(spark, (3, "2024-01-02")), path, ["2024-01-02", "2024-01-03"])
    assert stored_rows(spark, path) == [(1, "2024-01-01"), (3, "2024-01-02")]
    with pytest.raises(ValueError, match="outside"):
        sinks.replace_days(dated(spark, (3, "2024-01-05")), path, ["2024-01-02"])
    with pytest.raises(ValueError, match="outside"):
        sinks.replace_range(dated(spark, (3, "2024-01-05")), path, "2024-01-02", "2024-01-04")
    assert stored_rows(spark, path) == [(1, "2024-01-01"), (3, "2024-01-02")]


def test_check_of_times_reads_one_date(spark, tmp_path, monkeypatch):
    from oddsline.config import Settings

    path = str(tmp_path / "k")
    sinks.write_partitioned(feeds.klines(feeds.events(spark, "/root/testdata/sf0.001")), path, ("date",))
    klines = spark.read.parquet(path)
    plans, agg = [], type(klines).agg

    def seen(self, *columns):
        out = agg(self, *columns)
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        return out

    monkeypatch.setattr(type(klines), "agg", seen)
    batch.check_times(klines, Settings(), "2024-01-10", "2024-01-12")
    assert "ReadSchema: struct<>" in plans[0] and "date#" in plans[0].split("PartitionFilters")[1]
    assert "(date#" in plans[1].split("PartitionFilters")[1].split("]")[0] and "= 2024-01-12" in plans[1]
    batch.check_times(klines, Settings(), "2030-01-01")  # no such date: nothing to check
    for unit in ("s", "ms", "us"):
        with pytest.raises(ValueError, match="unit"):
            batch.check_times(klines, Settings(epoch_unit=unit), "2024-01-10")
    batch.check_times(klines, Settings(), now=dt.datetime(2024, 2, 1))
    with pytest.raises(ValueError, match="unit"):
        batch.check_times(klines, Settings(), now=dt.datetime(2021, 2, 1))


def test_cleansed_tables_need_no_unit(spark, tmp_path):
    events = feeds.events(spark, "/root/testdata/sf0.001")
    klines, market = feeds.klines(events), feeds.stored_market_events(events)
    sinks.write_cleansed(sinks.cleanse_klines(klines, "ns"), str(tmp_path / "k"))
    sinks.write_cleansed(sinks.cleanse_market_events(market), str(tmp_path / "e"))
    stored = [spark.read.parquet(str(tmp_path / name)) for name in "ke"]
    got = batch.verdicts(*stored, date="2024-01-10", until="2024-01-20")
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(last_trade_price)" in text and "PartitionFilters: [isnotnull(date" in text
    want = batch.verdicts(klines, market).filter("date(window_start) BETWEEN '2024-01-10' AND '2024-01-20'")
    key = lambda df: sorted((r.window_start, r.symbol, r.window_close, r.prediction_result) for r in df.collect())
    assert key(got) == key(want) and key(got)
