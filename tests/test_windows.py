"""Window aggregates, joins, snapshots."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from oddsline.operators import snapshots, windows
from oddsline.plans.batch import verdicts
from oddsline.sources import feeds, messages

T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def prices(spark, rows):
    df = spark.createDataFrame([(at(s), "btc", "BTCUSDT", *rest) for s, *rest in rows],
                               "binance_time timestamp, crypto string, symbol string, open double, "
                               "high double, low double, close double, volume double")
    return df


def odds(spark, rows):
    return spark.createDataFrame([(at(s), "btc", p) for s, p in rows],
                                 "poly_time timestamp, crypto string, price double")


def test_ohlc_takes_first_and_last_by_time(spark):
    df = prices(spark, [(60, 2.0, 9.0, 1.0, 3.0, 4.0), (0, 1.0, 5.0, 0.5, 2.0, 2.0),
                        (899, 3.0, 4.0, 2.0, 7.0, 6.0), (900, 8.0, 8.0, 8.0, 8.0, 8.0)])
    first, second = windows.ohlc_windows(df).orderBy("window_start").collect()
    assert (first.window_open, first.window_high, first.window_low, first.window_close,
            first.avg_volume, first.candle_count) == (1.0, 9.0, 0.5, 7.0, 4.0, 3)
    assert second.candle_count == 1


def test_snapshots_of_one_candle_are_ordered_by_capture(spark):
    df = prices(spark, [(0, 1.0, 1.0, 1.0, c, 1.0) for c in (5.0, 6.0, 7.0)]).withColumn(
        "snapshot_time", (F.lit(1704067200000) - F.col("close") * 1000).cast("bigint"))
    assert windows.ohlc_windows(df, sequence="snapshot_time").first().window_close == 5.0


def test_ties_do_not_depend_on_row_order(spark):
    rows = [(5, float(i), 1.0, 1.0, float(i), 1.0) for i in range(50)]
    results = set()
    for seed in range(4):
        random.Random(seed).shuffle(rows)
        row = windows.ohlc_windows(prices(spark, rows).repartition(seed + 1)).first()
        results.add((row.window_open, row.window_close))
    assert len(results) == 1


def test_aggregates_are_hash_aggregates(spark):
    events = feeds.events(spark, "/root/testdata/sf0.001")
    ticks = messages.price_ticks(messages.decode_klines(feeds.kline_messages(events)))
    for df in (verdicts(feeds.klines(events), feeds.stored_market_events(events)),
               windows.live_price(ticks), snapshots.newest_per_candle(feeds.klines(events))):
        text = df._jdf.queryExecution().executedPlan().toString()
        assert "HashAggregate" in text and "SortAggregate" not in text
        assert "partial_" in text


def test_rows_without_time_are_left_out(spark):
    df = odds(spark, [(0, 0.5)]).unionByName(spark.createDataFrame(
        [(None, "btc", 0.9)], "poly_time timestamp, crypto string, price double"))
    rows = windows.probability_windows(df).collect()
    assert len(rows) == 1 and rows[0].bet_activity_count == 1


def test_mean_on_the_threshold_is_uncertain(spark):
    # 0.6 + 0.2 + 0.4 gives 1.2 or 1.2000000000000002, depending on the order
    for order in ([0.6, 0.2, 0.4], [0.4, 0.2, 0.6], [0.2, 0.4, 0.6]):
        df = odds(spark, list(enumerate(order))).coalesce(1)
        assert windows.probability_windows(df).first().avg_probability == 0.4


def test_join_is_inner_and_analysis_complete(spark):
    ohlc = windows.ohlc_windows(prices(spark, [
        (0, 100.0, 101.0, 99.0, 100.5, 1.0), (900, 100.0, 101.0, 99.0, 100.0, 1.0),
        (1800, 0.0, 1.0, 0.0, 1.0, 1.0), (2700, 100.0, 101.0, 90.0, 95.0, 1.0)]))
    probability = windows.probability_windows(odds(spark, [
        (1, 0.7), (901, 0.7), (1801, 0.7), (3600, 0.7)]))
    rows = windows.analyze(ohlc, probability).orderBy("window_start").collect()
    assert [r.prediction_result for r in rows] == ["CORRECT_BULL", "UNCERTAIN", "UNCERTAIN"]
    assert rows[2].price_movement is None
    assert rows[0].asDict().keys() == dict.fromkeys(windows.ANALYSIS_COLUMNS).keys()


def test_tagging_by_token(spark):
    df = odds(spark, [(0, 0.7), (1, 0.3)]).withColumn("asset_id", F.when(F.col("price") > 0.5, "t1")
                                                      .otherwise("unlisted"))
    tokens = spark.createDataFrame([("t1", "eth"), ("t2", "sol")], "token_id string, crypto string")
    rows = windows.tag_markets(df, tokens).collect()
    assert [(r.asset_id, r.crypto) for r in rows] == [("t1", "eth")]


def test_live_price_of_one_tick_has_no_volatility(spark):
    df = spark.createDataFrame([(at(0), "BTCUSDT", 5.0, 2.0, None)],
                               "event_time timestamp, symbol string, price double, "
                               "usdt_volume double, buy_sentiment double")
    row = windows.live_price(df).first()
    assert (row.volatility, row.current_sentiment, row.avg_sentiment, row.ticks) == (None, None, None, 1)
    ranges = windows.with_price_ranges(windows.live_price(df)).first()
    assert (ranges.price_range, ranges.momentum) == (0.0, 0.0)


def test_newest_sentiment_may_be_null(spark):
    df = spark.createDataFrame([(at(0), "B", 5.0, 2.0, 0.5), (at(9), "B", 6.0, 0.0, None)],
                               "event_time timestamp, symbol string, price double, "
                               "usdt_volume double, buy_sentiment double")
    row = windows.live_price(df).first()
    assert (row.current_price, row.current_sentiment, row.avg_sentiment) == (6.0, None, 0.5)


# --- snapshots --------------------------------------------------------------

KLINE = "event_id bigint, symbol string, snapshot_time bigint, is_closed boolean, close double"


def kept_by_rule(rows, interval, last=None):
    """The rule, one row after the other."""
    kept, last = [], dict(last or {})
    for event_id, symbol, time, closed, _ in sorted(rows, key=lambda r: (r[2], r[0])):
        if closed or symbol not in last or time - last[symbol] >= interval:
            kept.append(event_id)
            last[symbol] = time
    return sorted(kept), last


def random_rows(seed, n, step, close_share):
    rng, time, rows = random.Random(seed), 1_700_000_000_000, []
    for i in range(n):
        time += rng.choice([0, 1, step // 3, step // 2, step, 3 * step])
        rows.append((i, rng.choice("AAAB"), time, rng.random() < close_share, float(i)))
    return rows


def test_functions_compose():
    rng = random.Random(4)
    for _ in range(400):
        interval, functions, time = rng.choice([5, 50, 400]), [], 1000
        for _ in range(3):
            n = rng.randrange(1, 12)
            times = np.array(sorted(time + rng.randrange(100) for _ in range(n)))
            closed = np.array([rng.random() < 0.1 for _ in range(n)])
            ends, exits = snapshots._chunk_steps(times, closed, interval)
            functions.append((times[ends].tolist(), exits, bool(closed.any())))
            time += 100
        a, b, c = functions
        left = snapshots.composed(snapshots.composed(a, b, interval), c, interval)
        right = snapshots.composed(a, snapshots.composed(b, c, interval), interval)
        for last in range(1000 - 2 * interval, 1000, 7):
            want = last
            for function in functions:
                want = snapshots.exit_of(function, want, interval)
            assert snapshots.exit_of(left, last, interval) == snapshots.exit_of(right, last, interval) == want


@pytest.mark.parametrize("seed,close_share", [(1, 0.0), (3, 0.05)])
def test_no_task_holds_a_symbols_history(spark, monkeypatch, seed, close_share):
    rows = random_rows(seed, 400, 400, close_share)
    largest = []
    monkeypatch.setattr(snapshots, "FAN_OUT", 4)
    original = snapshots._joined

    def watched(functions, span, interval):
        largest.append(functions.groupBy("symbol", F.floor(F.col("_chunk") / span)).count().agg(F.max("count")).first()[0])
        return original(functions, span, interval)

    monkeypatch.setattr(snapshots, "_joined", watched)
    thinned = snapshots.thin_snapshots(spark.createDataFrame(rows, KLINE), 1.0, "1 second", tie="event_id")
    assert sorted(r.event_id for r in thinned.collect()) == kept_by_rule(rows, 1000)[0]
    assert len(largest) >= 4 and 1 < max(largest) <= 4  # some levels, each of few functions


@pytest.mark.parametrize("seed,close_share,chunk", [
    (1, 0.0, "10 seconds"), (2, 0.0, "1 minute"), (3, 0.05, "10 seconds"), (4, 0.5, "2 seconds"),
    (5, 0.01, "1 hour"), (6, 0.0, "1 second")])
def test_thinning_follows_the_rule(spark, seed, close_share, chunk):
    rows = random_rows(seed, 600, 400, close_share)
    thinned = snapshots.thin_snapshots(spark.createDataFrame(rows, KLINE), 1.0, chunk, tie="event_id")
    assert sorted(r.event_id for r in thinned.collect()) == kept_by_rule(rows, 1000)[0]


def test_regular_ticks_never_merge_their_phases(spark):
    rows = [(i, "A", 1_700_000_000_037 + i * 100, False, 0.0) for i in range(900)]
    thinned = snapshots.thin_snapshots(spark.createDataFrame(rows, KLINE), 0.7, "5 seconds", tie="event_id")
    assert sorted(r.event_id for r in thinned.collect()) == kept_by_rule(rows, 700)[0]


def test_thinning_continues_from_earlier_data(spark):
    rows = random_rows(11, 400, 400, 0.02)
    first, last = kept_by_rule(rows[:200], 1000)
    expected, _ = kept_by_rule(rows[200:], 1000, last)
    previous = spark.createDataFrame(list(last.items()), "symbol string, last_kept bigint")
    thinned = snapshots.thin_snapshots(spark.createDataFrame(rows[200:], KLINE), 1.0, "10 seconds",
                                       tie="event_id", previous=previous)
    assert sorted(r.event_id for r in thinned.collect()) == expected


def test_newest_per_candle_prefers_closed(spark):
    rows = [(1, "A", 1_700_000_001_000, False, 1.0), (2, "A", 1_700_000_002_000, True, 2.0),
            (3, "A", 1_700_000_003_000, False, 3.0), (4, "B", 1_700_000_001_000, None, 4.0),
            (5, "B", 1_700_000_005_000, False, 5.0)]
    df = spark.createDataFrame(rows, KLINE).withColumn("timestamp", F.lit(1_700_000_000_000_000_000))
    newest = snapshots.newest_per_candle(df).collect()
    assert sorted((r.symbol, r.event_id, r.close) for r in newest) == [("A", 2, 2.0), ("B", 5, 5.0)]


def test_repeated_snapshots_are_dropped(spark):
    df = spark.createDataFrame([(1, "A", 5, True, 1.0)] * 3 + [(2, "A", 6, True, 1.0)], KLINE) \
        .withColumn("timestamp", F.lit(0))
    assert snapshots.drop_repeated(df).count() == 2
