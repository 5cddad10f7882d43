"""Views, cells and the queries over them."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from oddsline.config import BOOK_ROWS, PRICE_ROWS
from oddsline.operators import serving, views

NOON = 1706616000  # 2024-01-30 12:00 UTC
UTC = dt.timezone.utc


def analysis(spark, rows):
    """(symbol, epoch seconds, close, result) -> analysis rows."""
    data = [(dt.datetime.fromtimestamp(s, UTC), sym[:3].lower(), sym, 1.0, 2.0, 0.5, close, 3.0, 0.7, 0.9,
             4, 0.01, "UP", "UP", result) for sym, s, close, result in rows]
    return spark.createDataFrame(
        data, "window_start timestamp, crypto string, symbol string, window_open double, "
              "window_high double, window_low double, window_close double, avg_volume double, "
              "avg_probability double, max_probability double, bet_activity_count bigint, "
              "price_movement double, actual_direction string, predicted_direction string, "
              "prediction_result string")


def batch_view(spark, rows):
    return views.batch_view(analysis(spark, rows))


def live_view(spark, rows):
    """(symbol, window end in epoch seconds, price) -> live price rows."""
    data = [(sym, dt.datetime.fromtimestamp(s, UTC), price) for sym, s, price in rows]
    live = spark.createDataFrame(data, "symbol string, window_end timestamp, current_price double")
    for name in ("current_sentiment", "avg_price", "min_price", "max_price", "volatility",
                 "total_usdt_volume", "avg_sentiment"):
        live = live.withColumn(name, F.lit(None).cast("double"))
    return views.live_view(live.withColumn("ticks", F.lit(2).cast("bigint")), PRICE_ROWS)


# --- cells ------------------------------------------------------------------

def test_cells_round_trip(spark):
    view = batch_view(spark, [("BTCUSDT", NOON, 92543.87654321, "CORRECT_BULL")])
    cells = views.to_cells(view, views.batch_cells())
    assert cells.count() == 15
    row = views.from_cells(cells, {"close": "double", "activity": "bigint", "result": "string"}).first()
    assert (row.close, row.activity, row.result) == (92543.87654321, 4, "CORRECT_BULL")
    assert row.rowkey == "BTCUSDT_" + str(9999999999999 - NOON * 1000)


def test_null_values_give_no_cell(spark):
    cells = views.to_cells(live_view(spark, [("BTCUSDT", NOON, 5.0)]), views.live_cells(PRICE_ROWS))
    assert sorted(r.qualifier for r in cells.collect()) == ["current_price", "ticks", "window_end"]
    assert {r.family for r in cells.collect()} == {"b"}


def test_newest_version_of_each_cell_counts(spark):
    cells = spark.createDataFrame([("k", "f", "x", "5", 1), ("k", "f", "x", "6", 2), ("k", "f", "y", "7", 1)],
                                  "rowkey string, family string, qualifier string, value string, v int")
    row = views.from_cells(cells, {"x": "bigint", "y": "bigint", "z": "bigint"}, version="v").first()
    assert (row.x, row.y, row.z) == (6, 7, None)


def test_families(spark):
    row = views.families(batch_view(spark, [("BTCUSDT", NOON, 5.0, "UNCERTAIN")])).first()
    assert row.price_data.close == 5.0 and row.bet_data.activity == 4
    assert row.analysis.result == "UNCERTAIN"


def test_short_market_keys_collide_and_full_ones_do_not(spark):
    live = spark.createDataFrame([("0123456789abcdef-" + c, dt.datetime.fromtimestamp(NOON, UTC)) for c in "xy"],
                                 "market_id string, window_end timestamp")
    for name in ("current_prob", "current_spread", "current_imbalance", "avg_prob", "min_prob",
                 "max_prob", "avg_imbalance", "avg_spread", "num_updates"):
        live = live.withColumn(name, F.lit(1.0))
    assert views.live_view(live, BOOK_ROWS).select("rowkey").distinct().count() == 2
    short = views.live_view(live, BOOK_ROWS, truncate=16)
    assert short.select("rowkey").distinct().count() == 1
    assert short.select("market_id").distinct().count() == 2


def test_legacy_frames(spark):
    given = spark.createDataFrame([("btc", 1767201300, 92000.0)], "symbol string, window_end_ts bigint, open double")
    frame = views.legacy_batch_frame(given)
    assert len(frame.columns) == 14 and frame.first().divergence is None
    assert views.legacy_batch_view(frame).first().rowkey == "BTC#1767201300"
    with pytest.raises(ValueError, match="binance_price"):
        views.legacy_live_frame(given.withColumnRenamed("window_end_ts", "timestamp"))
    with pytest.raises(Exception, match="null in required column symbol"):
        views.legacy_batch_frame(given.withColumn("symbol", F.lit(None).cast("string"))).collect()


# --- scans ------------------------------------------------------------------

def test_scans(spark):
    view = batch_view(spark, [("BTCUSDT", NOON + 900 * i, float(i), "UNCERTAIN") for i in range(20)]
                      + [("BTCUSDTX", NOON, 1.0, "UNCERTAIN")])
    key = "BTCUSDT_" + str(9999999999999 - NOON * 1000)
    assert serving.point_lookup(view, key).first().price_close == 0.0
    assert serving.prefix_scan(view, serving.batch_prefix("BTCUSDT")).count() == 20
    assert serving.range_scan(view, NOON, NOON + 900).count() == 3
    assert [r.price_close for r in serving.sample_view(view, 2).collect()] == [1.0, 19.0]  # "X" < "_"
    newest = serving.latest_windows(view, 3).filter("symbol = 'BTCUSDT'").collect()
    assert sorted(r.price_close for r in newest) == [17.0, 18.0, 19.0]


def test_prefix_reaches_parquet(spark, tmp_path):
    path = str(tmp_path / "view")
    batch_view(spark, [("BTCUSDT", NOON, 1.0, "UNCERTAIN")]).write.parquet(path)
    scan = serving.prefix_scan(spark.read.parquet(path), "BTCUSDT_")
    assert "StringStartsWith(rowkey,BTCUSDT_)" in scan._jdf.queryExecution().executedPlan().toString()


def test_newest_rows_are_limited_before_the_shuffle(spark, tmp_path):
    path = str(tmp_path / "view")
    batch_view(spark, [("BTCUSDT", NOON, 1.0, "UNCERTAIN")]).write.parquet(path)
    text = serving.latest_windows(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in text and "Partial" in text


# --- merged timeline --------------------------------------------------------

def stamps(df):
    return [(r.timestamp, r.source) for r in df.collect()]


def test_boundary(spark):
    batch = batch_view(spark, [("BTCUSDT", NOON - 900, 1.0, "UNCERTAIN"), ("BTCUSDT", NOON, 1.0, "UNCERTAIN")])
    live = live_view(spark, [("BTCUSDT", NOON + 600, 1.0), ("BTCUSDT", NOON + 1200, 2.0)])
    assert stamps(serving.merged_timeline(batch, live)) == [
        (NOON + 1200, "speed"), (NOON + 900, "batch"), (NOON, "batch")]
    assert stamps(serving.merged_timeline(batch, live, boundary="start")) == [
        (NOON + 1200, "speed"), (NOON + 600, "speed"), (NOON, "batch"), (NOON - 900, "batch")]


def test_symbols_without_batch_rows_keep_live_points(spark):
    batch = batch_view(spark, [("BTCUSDT", NOON, 1.0, "UNCERTAIN")])
    live = live_view(spark, [("ETHUSDT", NOON - 600, 1.0), ("BTCUSDT", NOON - 600, 1.0)])
    merged = serving.merged_timeline(batch, live).collect()
    assert [(r.symbol, r.source) for r in merged] == [("BTCUSDT", "batch"), ("ETHUSDT", "speed")]


def test_a_past_range_knows_the_windows_after_it(spark):
    batch = batch_view(spark, [("BTCUSDT", NOON + 900 * i, 1.0, "UNCERTAIN") for i in range(8)]
                       + [("ETHUSDT", NOON, 1.0, "UNCERTAIN")])
    live = live_view(spark, [(s, NOON + 60 * i, float(i)) for s in ("BTCUSDT", "ETHUSDT", "XRPUSDT") for i in range(200)])
    rows = serving.merged_timeline(batch, live, start_s=NOON + 1800, end_s=NOON + 3600).collect()
    count = lambda symbol, source: sum((r.symbol, r.source) == (symbol, source) for r in rows)
    # BTC has windows until two hours later, ETH only one before the range, XRP none.
    assert (count("BTCUSDT", "batch"), count("BTCUSDT", "speed")) == (3, 0)
    assert (count("ETHUSDT", "batch"), count("ETHUSDT", "speed")) == (0, 31)
    assert (count("XRPUSDT", "batch"), count("XRPUSDT", "speed")) == (0, 31)
    assert all(NOON + 1800 <= r.timestamp <= NOON + 3600 for r in rows)
    across = serving.merged_timeline(batch, live, "BTC", NOON + 6300, NOON + 7800)
    assert [t for t, s in stamps(across) if s == "speed"] == list(range(NOON + 7800, NOON + 7200, -60))


def test_one_symbol_range_and_limits(spark):
    batch = batch_view(spark, [("BTCUSDT", NOON - 900 * i, 1.0, "UNCERTAIN") for i in range(1, 200)]
                       + [("ETHUSDT", NOON - 900, 1.0, "UNCERTAIN")])
    live = live_view(spark, [("BTCUSDT", NOON + 60 * i, float(i)) for i in range(1, 130)])
    day = serving.merged_timeline(batch, live, symbol="BTC", now=NOON)
    counts = {r["source"]: r["count"] for r in day.groupBy("source").count().collect()}
    assert counts == {"batch": 97}  # no point lies after now
    later = NOON + 60 * 129
    day = serving.merged_timeline(batch, live, symbol="BTC", now=later)
    counts = {r["source"]: r["count"] for r in day.groupBy("source").count().collect()}
    assert counts == {"batch": 88, "speed": 129}
    limited = serving.merged_timeline(batch, live, now=later, live_limit=100).filter("source = 'speed'")
    assert limited.count() == 100 and limited.agg(F.min("timestamp")).first()[0] == NOON + 60 * 30
    with pytest.raises(ValueError, match="now"):
        serving.merged_timeline(batch, live, live_minutes=10)
    everything = serving.merged_timeline(batch, live, symbol="BTCUSDT")
    counts = {r["source"]: r["count"] for r in everything.groupBy("source").count().collect()}
    assert counts == {"batch": 199, "speed": 129}
    recent = serving.merged_timeline(batch, live, symbol="BTC", now=NOON + 60 * 129, live_minutes=10)
    assert recent.filter("source = 'speed'").count() == 11
    assert serving.merged_timeline(batch, None, symbol="BTC").filter("source = 'speed'").count() == 0


def test_current_state(spark):
    batch = batch_view(spark, [("BTCUSDT", NOON, 1.0, "UNCERTAIN"), ("ETHUSDT", NOON - 900, 7.0, "UNCERTAIN"),
                               ("ETHUSDT", NOON - 1800, 6.0, "UNCERTAIN"), ("SOLUSDT", NOON - 7200, 1.0, "UNCERTAIN")])
    live = live_view(spark, [("BTCUSDT", NOON + 60, 2.0), ("BTCUSDT", NOON + 120, 3.0)])
    state = {r.symbol: r for r in serving.current_state(batch, live, NOON + 300).collect()}
    assert set(state) == {"BTCUSDT", "ETHUSDT"}
    assert (state["BTCUSDT"].source, state["BTCUSDT"].timestamp, state["BTCUSDT"].data.current_price) == (
        "speed", (NOON + 120) * 1000, 3.0)
    assert (state["ETHUSDT"].source, state["ETHUSDT"].timestamp, state["ETHUSDT"].price_data.close) == (
        "batch", NOON - 900, 7.0)


# --- accuracy ---------------------------------------------------------------

def test_accuracies(spark):
    results = ["CORRECT_BULL", "CORRECT_BEAR", "FAILED_BULL", "UNCERTAIN", "SOMETHING_ELSE"]
    view = batch_view(spark, [("BTCUSDT", NOON + 900 * i, 1.0, r) for i, r in enumerate(results)])
    row = serving.recent_accuracy(view).first()
    assert (row.windows_analyzed, row.correct_predictions, row.wrong_predictions, row.accuracy) == (5, 2, 3, 0.4)
    newest = serving.recent_accuracy(view, 3).first()
    assert (newest.windows_analyzed, newest.correct_predictions) == (3, 0)
    none = serving.symbol_accuracy(view, "XRP").first()
    assert (none.symbol, none.windows_analyzed, none.accuracy) == ("XRPUSDT", 0, None)
    summary = {r.prediction_result: r for r in serving.accuracy_summary(view).collect()}
    assert len(summary) == 5 and summary["FAILED_BEAR"]["count"] == 0
    assert summary["CORRECT_BULL"].percent == 20.0 and summary["CORRECT_BULL"].total == 5
    assert round(summary["UNCERTAIN"].overall_accuracy, 6) == 66.666667


def test_accuracy_of_an_empty_view(spark):
    empty = batch_view(spark, [("BTCUSDT", NOON, 1.0, "UNCERTAIN")]).filter("false")
    rows = serving.accuracy_summary(empty).collect()
    assert len(rows) == 5 and {r.percent for r in rows} == {0.0} and rows[0].overall_accuracy is None
    assert serving.recent_accuracy(empty).count() == 0


def test_expiry(spark):
    live = live_view(spark, [("A", NOON, 1.0), ("A", NOON - 86401, 1.0)])
    kept = serving.expire(live, NOON, 86400, "window_end", 1000).collect()
    assert len(kept) == 1


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_stored_bounds_reach_the_scans(spark, tmp_path):
    from oddsline.sinks import tables as sinks

    rows = [("BTCUSDT", NOON - 86400 * i, 1.0, "UNCERTAIN") for i in range(9)]
    sinks.write_batch_view(batch_view(spark, rows), str(tmp_path / "view"))
    view = spark.read.parquet(str(tmp_path / "view"))
    live_view(spark, [("BTCUSDT", NOON, 1.0)]).write.parquet(str(tmp_path / "live"))
    live = spark.read.parquet(str(tmp_path / "live"))
    scan = serving.range_scan(view, NOON - 86400, NOON, "BTC")
    assert "PartitionFilters: [isnotnull(date" in plan(scan) and "GreaterThanOrEqual(rowkey" in plan(scan)
    assert sorted(r.window_ts for r in scan.collect()) == [NOON - 86400, NOON]
    assert "PartitionFilters: [isnotnull(date" in plan(serving.merged_timeline(view, live, now=NOON))
    state = serving.current_state(view, live, NOON)
    assert "SortAggregate" not in plan(state) and "PartitionFilters: [isnotnull(date" in plan(state)
    assert "GreaterThanOrEqual(window_end" in plan(serving.expire(live, NOON, 60, "window_end", 1000))


def test_numbers_of_cells_are_aggregated_by_hash(spark):
    cells = views.to_cells(batch_view(spark, [("BTCUSDT", NOON, 9.5, "UNCERTAIN")]), views.batch_cells())
    numbers = views.from_cells(cells, {"close": "double", "activity": "bigint"})
    assert "SortAggregate" not in plan(numbers) and numbers.first().close == 9.5


def test_accuracy_of_a_symbol_without_windows(spark):
    row = serving.symbol_accuracy(batch_view(spark, [("BTCUSDT", NOON, 1.0, "CORRECT_BULL")]), "ETH").first()
    assert (row.windows_analyzed, row.correct_predictions, row.wrong_predictions, row.accuracy) == (0, 0, 0, None)
