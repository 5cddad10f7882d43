"""Feeds in the shape of the live collectors, derived from the ``events`` and ``orders`` tables.

Every input row gives one feed row, on batch tables and on streams alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from oddsline.config import BOOK_EVENT, CAPTURED, SLUG_INFIX, TRADE_EVENT
from oddsline.functions.times import epoch_to_timestamp, quarter_floor
from oddsline.schemas import DOUBLE, LONG, STRING, struct

EVENTS_SCHEMA = struct(event_id=LONG, ts=T.TimestampNTZType(), user_id=LONG, event_type=STRING,
                       value=DOUBLE, props=STRING)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(EVENTS_SCHEMA).parquet(f"{folder}/events.parquet")


def _with_number(source: DataFrame) -> DataFrame:
    """Event time as an instant and the number ``k`` (0-99) inside ``props``."""
    return source.withColumns({
        "ts": F.col("ts").cast("timestamp"),
        "k": F.regexp_extract("props", "([0-9]+)", 1).cast("int"),
    })


def _double(value: float) -> Column:
    return F.lit(float(value))


def klines(source: DataFrame) -> DataFrame:
    """Candle snapshots (``timestamp`` in nanoseconds) plus ``event_id``."""
    k = F.col("k").cast("double")
    remainder = F.col("user_id") % 5
    symbol = (F.when(remainder == 0, "BTCUSDT").when(remainder == 1, "ETHUSDT")
              .when(remainder == 2, "SOLUSDT").when(remainder == 3, "XRPUSDT").otherwise("DOGEUSDT"))
    open_ = _double(100) + F.col("value") / _double(100)
    close = _double(100) + k / _double(100)
    millis = F.unix_millis("ts")
    return _with_number(source).select(
        "event_id",
        (F.unix_micros("ts") * 1000).alias("timestamp"),
        millis.alias("snapshot_time"),
        open_.alias("open"),
        (F.greatest(open_, close) + _double(0.5)).alias("high"),
        (F.least(open_, close) - _double(0.5)).alias("low"),
        close.alias("close"),
        (F.col("value") * _double(10)).alias("volume"),
        (millis - F.pmod(millis, F.lit(60000)) + 59999).alias("close_time"),
        F.when(F.col("event_type") == "error", _double(0))
         .otherwise(F.col("value") * _double(100)).alias("quote_asset_volume"),
        F.col("k").cast("bigint").alias("trades"),
        (F.col("value") * k / _double(100)).alias("taker_buy_base"),
        (F.col("value") * k).alias("taker_buy_quote"),
        symbol.alias("symbol"),
        (F.col("event_type") != "click").alias("is_closed"),
        F.to_date("ts").alias("date"))


def _message(value: Column) -> Column:
    """A text that is built once.

    Without the generator Catalyst would copy the building expression into every later
    filter and projection over the text.
    """
    return F.explode_outer(F.array(value))


def kline_messages(source: DataFrame) -> DataFrame:
    """(event_id, captured, value): each candle as a JSON array with one record, ``timestamp`` in ms.

    Beside the message stands the instant of its capture, in microseconds.
    """
    record = klines(source).withColumns({
        CAPTURED: epoch_to_timestamp("timestamp", "ns"), "timestamp": F.col("snapshot_time")})
    fields = ("timestamp", "snapshot_time", "symbol", "close", "volume", "quote_asset_volume",
              "trades", "taker_buy_base", "taker_buy_quote")
    return record.select("event_id", CAPTURED, _message(F.to_json(F.array(F.struct(*fields)))).alias("value"))


def _cents(number: Column) -> Column:
    return F.concat(F.lit("0."), F.lpad(number.cast("string"), 2, "0"))


def market_messages(source: DataFrame) -> DataFrame:
    """(event_id, value): book and trade events as JSON, as records of ``MARKET_MESSAGE``."""
    return market_events(source).select(
        "event_id", _message(F.to_json(F.struct(
            "event_type", "market", F.unix_millis("ts").cast("string").alias("timestamp"),
            "bids", "asks", "price", "size"))).alias("value"))


def market_events(source: DataFrame) -> DataFrame:
    """Book and trade events with two levels per side."""
    k = F.col("k")
    user, event = F.col("user_id"), F.col("event_id")

    def level(price: Column, size: Column) -> Column:
        return F.struct(price.alias("price"), size.cast("string").alias("size"))

    return _with_number(source).select(
        "event_id", "ts", F.to_date("ts").alias("date"),
        F.concat(F.lit("market-"), (user % 7).cast("string")).alias("market"),
        F.concat(F.lit("asset-"), user.cast("string")).alias("asset_id"),
        F.when(F.col("event_type").isin("view", "click"), BOOK_EVENT)
         .otherwise(TRADE_EVENT).alias("event_type"),
        _cents(k).alias("price"),
        F.col("value").cast("string").alias("size"),
        F.array(level(_cents(k % 50), user), level(_cents(k % 37), event % 97)).alias("bids"),
        F.array(level(_cents(50 + k % 50), event % 89),
                level(_cents(50 + k % 37), user % 13)).alias("asks"),
        # Stored text time: ISO for sign-ups, epoch milliseconds otherwise.
        F.when(F.col("event_type") == "signup",
               F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
         .otherwise(F.unix_millis("ts").cast("string")).alias("timestamp"),
        # Clicks carry no readable price.
        F.when(F.col("event_type") == "click", "n/a").otherwise(_cents(k)).alias("last_trade_price"))


def stored_market_events(source: DataFrame) -> DataFrame:
    """The all-text stored table."""
    return market_events(source).select(
        "market", "asset_id", _message(F.col("timestamp")).alias("timestamp"), "last_trade_price",
        F.to_json("bids").alias("bids"), F.to_json("asks").alias("asks"), "event_type", "date")


def log_lines(source: DataFrame) -> DataFrame:
    """(event_id, value): a collector log in which small ``k`` give junk lines."""
    k = F.col("k")
    junk = ("PONG", "", "[]", "{}", "[ ]", "null", "not json {", "   ", '{"reply": "PONG"}', "{ }")
    value = F.concat(F.lit('{"event_type":"'), F.col("event_type"), F.lit('","user":'),
                     F.col("user_id").cast("string"), F.lit(',"k":'), k.cast("string"), F.lit("}"))
    for i, text in enumerate(junk):
        value = F.when(k == i, text).otherwise(value)
    return _with_number(source).select("event_id", _message(value).alias("value"))


def historical_messages(source: DataFrame) -> DataFrame:
    """(event_id, symbol, value): each candle as a message with one 12-position row."""
    def text(name: str) -> Column:
        return F.concat(F.lit('"'), F.col(name).cast("string"), F.lit('"'))

    # Texts and numbers are mixed, as the exchange sends them.
    row = F.concat(F.lit("[["), F.concat_ws(
        ",", F.col("snapshot_time").cast("string"), text("open"), text("high"), text("low"),
        text("close"), text("volume"), F.col("close_time").cast("string"),
        text("quote_asset_volume"), F.col("trades").cast("string"), text("taker_buy_base"),
        text("taker_buy_quote"), F.lit('"0"')), F.lit("]]"))
    return klines(source).select("event_id", "symbol", _message(row).alias("value"))


def markets_of_orders(orders: DataFrame) -> DataFrame:
    """One market per order: (event_id, owner, at, closed)."""
    return orders.select(F.col("o_orderkey").alias("event_id"), F.col("o_custkey").alias("owner"),
                         F.col("o_orderdate").cast("timestamp").alias("at"),
                         (F.col("o_orderstatus") == "F").alias("closed"))


def markets_of_events(source: DataFrame) -> DataFrame:
    """One market per event: (event_id, owner, at, closed)."""
    return source.select("event_id", F.col("user_id").alias("owner"),
                         F.col("ts").cast("timestamp").alias("at"),
                         (F.col("event_type") != "click").alias("closed"))


def _market_fields(markets: DataFrame) -> DataFrame:
    crypto = F.element_at(F.array(*[F.lit(c) for c in ("btc", "eth", "sol", "xrp")]),
                          (F.col("owner") % 4 + 1).cast("int"))
    start = quarter_floor("at")
    up = F.col("owner") % 100
    name = F.col("event_id").cast("string")
    return markets.select(
        "event_id", name.alias("id"),
        crypto.alias("crypto"), start.alias("start_s"),
        F.concat(crypto, F.lit(SLUG_INFIX), start.cast("string")).alias("slug"),
        F.concat(F.upper(crypto), F.lit(" Up or Down")).alias("title"),
        F.lit('["Up", "Down"]').alias("outcomes"),
        F.concat(F.lit('["'), _cents(up), F.lit('", "'), _cents(99 - up), F.lit('"]'))
         .alias("outcomePrices"),
        F.concat(F.lit('["'), name, F.lit('-up", "'), name, F.lit('-down"]')).alias("clobTokenIds"),
        "closed")


def stored_events(markets: DataFrame) -> DataFrame:
    """Typed event list: (event_id, crypto, slug, title, closed, start_s)."""
    return _market_fields(markets).select("event_id", "crypto", "slug", "title", "closed", "start_s")


def market_objects(markets: DataFrame) -> DataFrame:
    """(event_id, value): each market object as JSON."""
    return _market_fields(markets).select("event_id", _message(F.to_json(F.struct(
        "id", "slug", "title", "outcomes", "outcomePrices", "clobTokenIds", "closed"))).alias("value"))


def metadata_messages(markets: DataFrame) -> DataFrame:
    """(event_id, start_s, value): event metadata ``{crypto: {"markets": [{...}]}}`` as JSON."""
    market = F.struct("id", "slug", "clobTokenIds", "closed")
    event = F.struct(F.col("id"), F.col("title"), F.col("slug"), F.array(market).alias("markets"))
    return _market_fields(markets).select(
        "event_id", "start_s", _message(F.to_json(F.create_map("crypto", event))).alias("value"))
