"""Decoding, metadata and stored tables."""

import json

import pytest
from pyspark.sql import functions as F

from oddsline import schemas
from oddsline.sinks import tables as sinks
from oddsline.sources import feeds, footers, messages, metadata, tables


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_kline_messages_may_hold_many_records(spark):
    record = {"timestamp": 1, "snapshot_time": 2, "symbol": "BTCUSDT", "close": 3.5, "volume": 1.0,
              "quote_asset_volume": 4.0, "trades": 5, "taker_buy_base": 0.5, "taker_buy_quote": 1.0}
    df = texts(spark, json.dumps([record, {**record, "symbol": "ETHUSDT"}]), json.dumps(record),
               "[]", "junk", None)
    rows = messages.decode_klines(df).collect()
    assert sorted(r.symbol for r in rows) == ["BTCUSDT", "BTCUSDT", "ETHUSDT"]
    ticks = messages.price_ticks(messages.decode_klines(df)).collect()
    assert {t.buy_sentiment for t in ticks} == {0.25}


def test_bytes_are_decoded(spark):
    df = texts(spark, '[{"symbol": "BTCUSDT"}]').select(F.col("value").cast("binary"))
    assert messages.decode_klines(df).first().symbol == "BTCUSDT"


def test_market_events_as_object_or_array(spark):
    event = {"event_type": "book", "market": "m", "timestamp": "1767286619999",
             "bids": [{"price": "0.4", "size": "2"}], "asks": [{"price": "0.5", "size": "6"}]}
    trade = {"event_type": "last_trade_price", "market": "m", "timestamp": "oops", "price": "0.3",
             "size": "x"}
    df = texts(spark, json.dumps(event), json.dumps([event]), json.dumps(trade))
    decoded = messages.decode_market_events(df)
    books = messages.book_updates(decoded).collect()
    assert len(books) == 2
    assert {(round(b.spread, 6), b.mid_price_prob, b.book_imbalance) for b in books} == {(0.1, 0.45, -0.5)}
    found = messages.trades(decoded).first()
    assert (found.event_time, found.trade_price, found.trade_size) == (None, 0.3, None)


def test_messages_are_parsed_once(spark):
    lines = plan(messages.decode_market_events(texts(spark, "{}"))).splitlines()
    assert sum("from_json" in line for line in lines) == 1


def test_message_log(spark):
    keep = ['{"type":"test","data":"value"}', "[1]", ' {"a": {}} ', "0"]
    drop = ["PONG", "", "   ", "[]", "{}", "[ ]", "{ }", "null", "not json", '{"a":', '{"a": "PONG"}', None]
    kept = messages.clean_message_log(texts(spark, *keep, *drop)).collect()
    assert sorted(r.value for r in kept) == sorted(keep)


def test_historical_rows(spark):
    row = [1499040000000, "0.01634790", "0.8", "0.015758", "0.015771", "148976.11427815",
           1499644799999, "2434.19055334", 308, "1756.87402397", "28.46694368", "17928899.62484339"]
    df = spark.createDataFrame([("BTCUSDT", json.dumps([row, row])), ("ETHUSDT", "[]")],
                               "symbol string, value string")
    rows = messages.decode_historical_klines(df).collect()
    assert len(rows) == 2
    first = rows[0]
    assert (first.timestamp, first.open, first.trades, first.is_closed) == (
        1499040000000, 0.0163479, 308, True)
    assert first.snapshot_time == first.close_time == 1499644799999
    assert str(first.date) == "2017-07-03" and "ignore" not in first.asDict()


def test_token_ids(spark):
    good = {"btc": {"markets": [{"clobTokenIds": '["btc-1", "btc-2"]'}, {"clobTokenIds": '["x"]'}]},
            "eth": {"markets": [{"clobTokenIds": '["eth-1"]'}]}}
    bad = {"sol": {"markets": []}, "xrp": {}, "btc": {"markets": [{"clobTokenIds": "oops"}]},
           "eth": {"markets": [{"clobTokenIds": "[]"}]}}
    rows = metadata.token_ids(texts(spark, json.dumps(good), json.dumps(bad), "junk")).collect()
    assert sorted(tuple(r) for r in rows) == [
        ("btc", 0, "btc-1"), ("btc", 1, "btc-2"), ("eth", 0, "eth-1")]


def test_market_outcomes(spark):
    market = {"id": "7", "slug": "btc-updown-15m-1767200400", "outcomes": '["Up", "Down"]',
              "outcomePrices": '["0.585", "0.415"]', "clobTokenIds": '["t1", "t2"]',
              "lastTradePrice": 0.58}
    rows = metadata.market_outcomes(texts(spark, json.dumps(market), '{"id": "8"}')).collect()
    assert sorted((r.position, r.outcome, r.price, r.token_id) for r in rows) == [
        (0, "Up", 0.585, "t1"), (1, "Down", 0.415, "t2")]


def test_events_pages(spark):
    events = spark.range(1, 76).select("id", (F.col("id") % 3 == 0).alias("closed"))
    assert metadata.events_page(events).count() == 75
    assert metadata.events_page(events, closed=True).count() == 25
    pages = [[r.id for r in metadata.events_page(events, limit=50, offset=o).collect()] for o in (0, 50)]
    assert pages == [list(range(1, 51)), list(range(51, 76))]
    assert metadata.events_page(events, limit=25).count() == 25


@pytest.fixture(scope="module")
def klines_table(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("klines") / "t")
    klines = feeds.klines(feeds.events(spark, "/root/testdata/sf0.001")).drop("event_id")
    sinks.write_cleansed(klines, path, sort=("symbol",))
    tables.create_klines_table(spark, "t_klines", path)
    tables.repair_partitions(spark, "t_klines")
    return path


def test_table_is_pruned_to_the_date_and_columns(spark, klines_table):
    loaded = tables.load_klines(spark.table("t_klines"), date="2024-01-15")
    text = plan(loaded.select("binance_time", "close"))
    assert "PartitionFilters: [isnotnull(date" in text
    schema = text.split("ReadSchema: ")[1].splitlines()[0]
    assert "close:double" in schema and "volume" not in schema and "open" not in schema
    assert loaded.count() == spark.read.parquet(f"{klines_table}/date=2024-01-15").count() > 0


def test_new_partitions_are_found(spark, klines_table):
    before = tables.list_partitions(spark, "t_klines").count()
    extra = spark.table("t_klines").filter("date = DATE'2024-01-15'").withColumn(
        "date", F.lit("2025-05-05").cast("date"))
    sinks.write_cleansed(extra, klines_table)
    assert tables.list_partitions(spark, "t_klines").count() == before
    tables.repair_partitions(spark, "t_klines")
    assert tables.list_partitions(spark, "t_klines").count() == before + 1
    assert spark.table("t_klines").schema.fieldNames() == schemas.KLINES.fieldNames()


def test_probabilities_skip_books_columns(spark, tmp_path):
    path = str(tmp_path / "events")
    stored = feeds.stored_market_events(feeds.events(spark, "/root/testdata/sf0.001"))
    sinks.write_cleansed(stored, path)
    loaded = tables.load_probabilities(spark.read.schema(schemas.MARKET_EVENTS).parquet(path))
    schema = plan(loaded).split("ReadSchema: ")[1].splitlines()[0]
    assert "bids" not in schema and "asks" not in schema
    assert loaded.filter("price IS NULL").count() == 0


def test_cleansed_price_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "cleansed")
    stored = feeds.stored_market_events(feeds.events(spark, "/root/testdata/sf0.001"))
    sinks.write_cleansed(sinks.cleanse_market_events(stored), path)
    found = spark.read.parquet(path).filter("last_trade_price > 0.9")
    assert "GreaterThan(last_trade_price,0.9)" in plan(found)


def test_inspection(spark, klines_table):
    files = tables.read_files(spark, klines_table, schemas.KLINES)
    assert "snapshot_time" in files.columns
    newest = tables.latest_snapshots(files, 5).collect()
    assert len(newest) == 5
    assert [r.snapshot_time for r in newest] == sorted((r.snapshot_time for r in newest), reverse=True)


def test_escaped_types_are_found_without_full_parsing(spark):
    events = [{"event_type": "book", "market": "a", "bids": [{"price": "0.4", "size": "1"}]},
              {"event_type": "last_trade_price", "market": "b", "price": "0.5", "size": "2"}]
    plain = texts(spark, *[json.dumps(e) for e in events], json.dumps(events))
    escaped = texts(spark, json.dumps(events).replace("book", "b\\u006fok").replace(
        "last_trade", "last\\u005ftrade"))
    df = plain.unionByName(escaped)
    assert [r.market_id for r in messages.books_of(df).collect()] == ["a"] * 3
    assert [r.trade_size for r in messages.trades_of(df).collect()] == [2.0] * 3
    text = plan(messages.trades_of(df))
    assert "bids" not in text and "asks" not in text


def test_answers_from_footers_read_no_column(spark, tmp_path):
    path, settings = str(tmp_path / "k"), dict(spark.conf.getAll)
    klines = feeds.klines(feeds.events(spark, "/root/testdata/sf0.001")).drop("event_id")
    klines.write.partitionBy("date").parquet(path)
    bounds = footers.stored_bounds(spark, path, schemas.KLINES, "snapshot_time", "close", date="2024-01-05",
                                   until="2024-01-08")
    plan = lambda df: df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    text = plan(bounds)
    assert "PushedAggregation: [COUNT(*), MIN(snapshot_time), MAX(snapshot_time), MIN(close), MAX(close)]" in text
    assert "PushedGroupBy: [date]" in text and "PartitionFilters: [isnotnull(date" in text
    want = (klines.filter("date BETWEEN '2024-01-05' AND '2024-01-08'").groupBy("date")
            .agg(F.count("*"), F.min("snapshot_time"), F.max("snapshot_time"), F.min("close"), F.max("close")))
    assert sorted(map(tuple, bounds.collect())) == sorted(map(tuple, want.collect()))
    rows = footers.stored_rows(spark, path)
    assert "PushedAggregation: [COUNT(*)]" in plan(rows) and rows.first().rows == klines.count()
    cover = footers.stored_coverage(spark, a=(path, schemas.KLINES)).first()
    assert cover.table_name == "a" and cover.rows == klines.count()
    assert "PushedGroupBy: [date]" in plan(footers.stored_coverage(spark, a=(path, schemas.KLINES)))
    assert dict(spark.conf.getAll) == settings
    with pytest.raises(ValueError, match="symbol"):
        footers.stored_bounds(spark, path, schemas.KLINES, "symbol")
