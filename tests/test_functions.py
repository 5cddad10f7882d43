"""Column functions against hand-made tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from oddsline import schemas
from oddsline.config import CRYPTO_KEYWORDS, RESULTS
from oddsline.functions import book, rowkeys, symbols, times, verdict


def column(spark, rows, schema, expression):
    """Values of an expression, in the order of the rows."""
    data = [(i, *row) for i, row in enumerate(rows)]
    df = spark.createDataFrame(data, "i int, " + schema)
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def test_predicted_direction_is_strict(spark):
    rows = [(0.60,), (0.61,), (0.40,), (0.39,), (0.5,), (None,)]
    assert column(spark, rows, "p double", verdict.predicted_direction("p")) == [
        "UNCERTAIN", "UP", "UNCERTAIN", "DOWN", "UNCERTAIN", "UNCERTAIN"]


def test_actual_direction_is_strict(spark):
    rows = [(0.001,), (-0.001,), (0.0011,), (-0.0011,), (0.0,), (None,)]
    assert column(spark, rows, "m double", verdict.actual_direction("m")) == [
        "FLAT", "FLAT", "UP", "DOWN", "FLAT", "FLAT"]


def test_prediction_result(spark):
    rows = [("UP", "UP"), ("DOWN", "DOWN"), ("UP", "DOWN"), ("DOWN", "UP"), ("UP", "FLAT"),
            ("DOWN", "FLAT"), ("UNCERTAIN", "UP"), ("UNCERTAIN", "FLAT")]
    assert column(spark, rows, "p string, a string", verdict.prediction_result("p", "a")) == [
        "CORRECT_BULL", "CORRECT_BEAR", "FAILED_BULL", "FAILED_BEAR"] + ["UNCERTAIN"] * 4
    assert set(RESULTS) == {"CORRECT_BULL", "CORRECT_BEAR", "FAILED_BULL", "FAILED_BEAR", "UNCERTAIN"}


def test_price_movement_of_zero_open_is_null(spark):
    assert column(spark, [(0.0, 5.0), (100.0, 101.0)], "o double, c double",
                  verdict.price_movement("o", "c")) == [None, 0.01]


def test_buy_sentiment(spark):
    rows = [(5.0, 10.0), (5.0, 0.0), (5.0, -1.0), (None, 10.0)]
    assert column(spark, rows, "t double, v double", book.buy_sentiment("t", "v")) == [
        0.5, None, None, None]


def test_mixed_timestamps(spark):
    rows = [("1767286619999",), ("2026-01-11T12:00:00Z",), ("zzz",), (None,), ("",),
            ("99999999999999999",)]
    assert column(spark, rows, "t string", times.mixed_timestamp("t").cast("timestamp_ntz")) == [
        dt.datetime(2026, 1, 1, 16, 56, 59, 999000), dt.datetime(2026, 1, 11, 12), None, None, None,
        None]


def test_epoch_units(spark):
    moment = dt.datetime(2026, 1, 1, 0, 0, 0, 123456)
    micros = 1767225600123456
    for unit, value, expected in (
            ("s", micros // 1_000_000, moment.replace(microsecond=0)),
            ("ms", micros // 1000, moment.replace(microsecond=123000)),
            ("us", micros, moment), ("ns", micros * 1000 + 7, moment)):
        assert column(spark, [(value,)], "e bigint",
                      times.epoch_to_timestamp("e", unit).cast("timestamp_ntz")) == [expected]
    assert column(spark, [(2 ** 62,)], "e bigint", times.epoch_to_timestamp("e", "ms")) == [None]


@pytest.mark.parametrize("utc,start", [
    ("2024-06-01 12:00:00", "2024-06-01 12:00:00"),
    ("2024-06-01 12:14:59", "2024-06-01 12:00:00"),
    ("2024-06-01 12:15:00", "2024-06-01 12:15:00"),
    ("2024-06-01 12:59:59", "2024-06-01 12:45:00"),
    ("2024-03-10 07:20:00", "2024-03-10 07:15:00"),   # 03:20 Eastern, first hour of summer time
    ("2024-11-03 05:35:00", "2024-11-03 05:30:00"),   # 01:35 Eastern, before the clock goes back
    ("2024-11-03 06:35:00", "2024-11-03 06:30:00"),   # 01:35 Eastern again
    ("2024-01-01 04:59:59", "2024-01-01 04:45:00"),   # New Year's Eve, Eastern
    ("2024-02-29 23:46:00", "2024-02-29 23:45:00"),
])
def test_quarter_floor(spark, utc, start):
    value = column(spark, [(utc,)], "t string", times.quarter_floor(F.col("t").cast("timestamp")))[0]
    assert dt.datetime.fromtimestamp(value, dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S") == start
    eastern = dt.datetime.fromtimestamp(value, dt.timezone.utc)
    assert eastern.minute % 15 == 0


def test_order_key_sorts_by_time_then_hash(spark):
    df = spark.createDataFrame(
        [("2024-01-01 00:00:00.000001", 1), ("2024-01-01 00:00:00.000002", 2),
         ("2024-01-01 00:14:59.999999", 3), ("2024-01-01 00:14:59.999999", 4)], "t string, v int")
    for span in (900, None):
        key = times.order_key(F.col("t").cast("timestamp"), "v", span_seconds=span)
        rows = df.select("t", "v", key.alias("k")).collect()
        assert all(r.k >= 0 for r in rows)
        assert rows[0].k != rows[1].k and rows[2].k != rows[3].k
        if span:
            assert rows[0].k < rows[1].k < min(rows[2].k, rows[3].k)


def test_symbols(spark):
    rows = [("BTCUSDT",), ("ETHUSDT",), ("SOLUSDT",), ("XRPUSDT",), ("DOGEUSDT",), (None,)]
    assert column(spark, rows, "s string", symbols.symbol_to_crypto("s")) == [
        "btc", "eth", "sol", "xrp", "unknown", "unknown"]
    assert column(spark, [("BTC",), ("BTCUSDT",)], "s string", symbols.normalize_symbol("s")) == [
        "BTCUSDT", "BTCUSDT"]


CRYPTO = [
    "Will Bitcoin reach a new high?", "btc above 100k", "EtHeReUm upgrade date", "ETH staking",
    "Solana outage", "Cardano roadmap", "ADA doubles", "Polkadot auction", "AVAX target", "matic swap",
    "Chainlink oracle", "Uniswap launch", "Ripple case", "XRP verdict", "DOGE tweet", "Shiba Inu burn",
    "LTC payments", "Cosmos hub", "Algorand grant", "XTZ vote", "Monero fork", "Stellar bridge",
    "DeFi volume", "NFT sales", "Blockchain jobs", "New token listing", "Altcoin season",
    "Stablecoin rules", "Memecoin week", "BNB chain", "Coinbase shares", "FTX estate", "OpenSea fees",
    "MetaMask users", "Aave vote", "Compound rate", "Synthetix pool", "Bitcoin 🚀 to the moon",
    "Climate solution for 2025", "Whether it rains", "Cryptocurrencies grow",
]
OTHER = ["Who wins the final?", "Presidential race 2024", "Weather tomorrow", "Apple price target",
         "", "   ", None]


def test_crypto_titles(spark):
    rows = [(t,) for t in CRYPTO + OTHER]
    assert column(spark, rows, "t string", symbols.is_crypto_title("t")) == (
        [True] * len(CRYPTO) + [False] * len(OTHER))


def test_needed_keywords_cover_all():
    needed = symbols.needed_keywords()
    assert all(any(n in k for n in needed) for k in CRYPTO_KEYWORDS)
    assert len(CRYPTO_KEYWORDS) == 56 and len(needed) < 56


def test_slugs(spark):
    moment = F.lit("2025-12-31 17:07:00").cast("timestamp")
    assert column(spark, [("btc",)], "c string", symbols.event_slug("c", moment)) == [
        "btc-updown-15m-1767200400"]
    rows = [("btc-updown-15m-1767200400",), ("other",)]
    assert column(spark, rows, "s string", symbols.slug_epoch("s")) == [1767200400, None]
    assert column(spark, rows[:1], "s string", symbols.slug_crypto("s")) == ["btc"]


# --- order books ------------------------------------------------------------

def _tops(spark, bids, asks, **options):
    levels = "array<struct<price:string,size:string>>"
    df = spark.createDataFrame([(bids, asks)], f"bids {levels}, asks {levels}")
    row = book.with_top_of_book(df, **options).first()
    return row.best_bid, row.best_ask, row.bid_depth, row.ask_depth


def test_top_of_book_by_number_and_by_text(spark):
    bids = [("0.9", "1"), ("0.10", "2"), ("1", "3")]
    asks = [("0.2", "4"), ("1e-3", "5")]
    assert _tops(spark, bids, asks) == (1.0, 0.001, 3.0, 5.0)
    assert _tops(spark, bids, asks, string_compare=True) == (1.0, 0.001, 3.0, 4.0)


def test_first_of_equal_levels_wins(spark):
    bids, asks = [("0.5", "1"), ("0.50", "2")], [("0.6", "3"), ("0.60", "4")]
    assert _tops(spark, bids, asks) == (0.5, 0.6, 1.0, 3.0)


def test_unreadable_levels(spark):
    assert _tops(spark, [], None) == (None, None, None, None)
    assert _tops(spark, [], None, string_compare=True) == (None, None, None, None)
    assert _tops(spark, [("x", "1"), (None, "2")], [("NaN", "1")]) == (None, None, None, None)
    assert _tops(spark, [("x", "1"), ("0.2", "y")], [("x", "1"), ("0", "7")]) == (0.2, 0.0, None, 7.0)


def test_levels_are_those_of_the_json_reader(spark):
    one = '{"price":"0.1","size":"5"}'
    texts = [None, "", " ", "[]", "null", "{}", one, f"[{one}]", f"[{one},{one}]", f"\t[ {one} ,\n{one} ] ",
             f"[{one},]", f"[{one}", f"[{one}]]", f"[{one}] x", f"[{one} {one}]", f"[{one},null]", f"[{one},{{}}]",
             f"x[{one}]", f"\x0b[{one}]", f"\u00a0[{one}]",
             '[{"size":"5","price":"0.1"}]', '[{"price":"0.1"}]', '[{"price":0.1,"size":5}]', '[{"price":null,"size":"5"}]',
             '[{"price":"0.1","size":"5","more":"1"}]', '[{"price":"0.1","size":"5","price":"0.2"}]',
             '[{"price":"price","size":"size"}]', '[{"price":"","size":""}]', '[{"price":"é😀","size":"x\x7f"}]',
             '[{"price":"a\\"b","size":"\\u0041"}]', '[{"price":"a\nb","size":"\x00"}]', '[{"price": "0.1", "size": "5"}]',
             "[" + ",".join([one] * 20000) + "]"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    both = rows.select("t", book.levels("t").alias("read"), F.from_json("t", schemas.LEVELS).alias("json"))
    assert [r["t"] for r in both.collect() if r["read"] != r["json"]] == []
    assert both.schema["read"].dataType == schemas.LEVELS


def test_times_are_read_as_before_the_guard_against_failing_casts(spark):
    texts = [None, "", "17", " 17 ", "+17", "-17", "1.5", "1e3", "2026-01-11", "2026", "2026-01-11 12:00:00", "T12:00:00Z ",
             "17:00", "1704104317590:", ":", "2026-01-11T12:00:00.123456+02:00", "99999999999999999999", "\t1704104317590\n"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    plain = F.coalesce(times.epoch_to_timestamp(F.col("t").try_cast("bigint"), "ms"), F.try_to_timestamp("t"))
    assert rows.filter(~times.mixed_timestamp("t").eqNullSafe(plain)).collect() == []


def test_imbalance(spark):
    rows = [(3.0, 1.0), (0.0, 0.0), (None, 1.0)]
    assert column(spark, rows, "b double, a double", book.imbalance("b", "a")) == [0.5, None, None]
    assert column(spark, rows[:1], "b double, a double", book.spread("b", "a")) == [2.0]


# --- row keys ---------------------------------------------------------------

def test_keys(spark):
    end_s, end_ms = 1767201300, 1767201300000
    row = spark.range(1).select(
        rowkeys.batch_rowkey(F.lit("BTCUSDT"), F.timestamp_seconds(F.lit(1768132800))).alias("batch"),
        rowkeys.window_end_rowkey(F.lit("btc"), F.lit(end_s)).alias("end"),
        rowkeys.event_rowkey(F.lit("btc"), F.lit(end_ms)).alias("event"),
        rowkeys.live_rowkey("BIN", F.lit("BTCUSDT"), F.lit(end_ms)).alias("live"),
        rowkeys.live_rowkey("PB", F.lit("0123456789abcdefXYZ"), F.lit(end_ms), 16).alias("short"),
    ).first()
    assert row.batch == "BTCUSDT_8231867199999"
    assert row.end == "BTC#1767201300"
    assert row.event == f"BTC#{9999999999999 - end_ms}"
    assert row.live == f"BIN#BTCUSDT#{9999999999999 - end_ms}"
    assert row.short == f"PB#0123456789abcdef#{9999999999999 - end_ms}"


def test_newer_keys_sort_first(spark):
    keys = column(spark, [(1767201300000,), (1767201400000,)], "ms bigint",
                  rowkeys.event_rowkey(F.lit("BTC"), "ms"))
    assert keys[1] < keys[0]


def test_parse_keys(spark):
    rows = [("ETH#1767201300",), ("PB#market123#8232798699999",), ("BTCUSDT_8231867199999",),
            ("invalid_rowkey_no_separator",), ("",), (None,), ("a#b#c",), ("a#1#2#3",)]
    plain = column(spark, rows, "k string", rowkeys.parse_plain_rowkey("k"))
    assert tuple(plain[0]) == ("ETH", 1767201300) and plain[1:] == [None] * 7
    live = column(spark, rows, "k string", rowkeys.parse_live_rowkey("k"))
    assert tuple(live[1]) == ("PB", "market123", 1767201300000)
    assert live[0].row_type is None and live[0].identifier == "ETH"
    assert live[2:] == [None] * 6
    batch = column(spark, rows, "k string", rowkeys.parse_batch_rowkey("k"))
    assert tuple(batch[2]) == ("BTCUSDT", 1768132800)
    assert [b for i, b in enumerate(batch) if i != 2] == [None] * 7


def test_strict_parsing_raises(spark):
    with pytest.raises(Exception, match="not a row key"):
        column(spark, [("nonsense",)], "k string", rowkeys.parse_plain_rowkey("k", strict=True))


def test_parse_cell(spark):
    rows = [("92543.87654321",), ("42",), ("CORRECT_BULL",), ("1e-05",), ("1.0E-5",), ("a.b",), (None,)]
    cells = [tuple(c) for c in column(spark, rows, "v string", rowkeys.parse_cell("v"))]
    assert cells == [(92543.87654321, None, None), (None, 42, None), (None, None, "CORRECT_BULL"),
                     (None, None, "1e-05"), (1.0e-5, None, None), (None, None, "a.b"),
                     (None, None, None)]


def test_doubles_are_rounded_as_doubles(spark):
    from oddsline.functions.rounding import half_away
    values = [0.5196875, 2.5, -2.5, -1e-9, 1e305, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = [r[0] for r in df.orderBy("i").select(half_away("v", 6)).collect()]
    assert got == [0.519687, 2.5, -2.5, 0.0, 1e305, None] and str(got[3]) == "-0.0"
    assert [r[0] for r in df.orderBy("i").limit(3).select(half_away("v", 0)).collect()] == [1.0, 3.0, -3.0]


def test_exact_key_sorts_by_microsecond_then_by_the_whole_number(spark):
    rows = [(10, 2 ** 62), (10, 2 ** 62 + 2 ** 40), (10, -5), (11, 0), (9, 7), (10, None)]
    df = spark.createDataFrame(rows, "us bigint, n bigint").withColumn("t", F.timestamp_micros("us"))
    rising = [(r.us, r.n) for r in df.orderBy(times.exact_key("t", "n")).collect()]
    assert rising == [(9, 7), (10, -5), (10, 2 ** 62), (10, 2 ** 62 + 2 ** 40), (10, None), (11, 0)]
    falling = df.orderBy(times.exact_key("t", "n", descending=True).desc()).collect()
    assert [(r.us, r.n) for r in falling] == [(11, 0), (10, -5), (10, 2 ** 62), (10, 2 ** 62 + 2 ** 40), (10, None), (9, 7)]
