"""Explicit schemas of all tables and messages (nothing is inferred at run time)."""

from __future__ import annotations

from pyspark.sql import types as T

STRING, LONG, DOUBLE = T.StringType(), T.LongType(), T.DoubleType()
BOOLEAN, DATE = T.BooleanType(), T.DateType()


def struct(*required: tuple[str, T.DataType], **optional: T.DataType) -> T.StructType:
    """A struct of required fields, then nullable ones."""
    return T.StructType([T.StructField(n, t, False) for n, t in required]
                        + [T.StructField(n, t) for n, t in optional.items()])


# Candle snapshots, partitioned by date.
KLINES = struct(
    timestamp=LONG, snapshot_time=LONG, open=DOUBLE, high=DOUBLE, low=DOUBLE, close=DOUBLE,
    volume=DOUBLE, close_time=LONG, quote_asset_volume=DOUBLE, trades=LONG, taker_buy_base=DOUBLE,
    taker_buy_quote=DOUBLE, symbol=STRING, is_closed=BOOLEAN, date=DATE)

# The same after cleansing: the timestamp in milliseconds, and as a point in time.
CLEANSED_KLINES = T.StructType([f for f in KLINES if f.name != "date"]
                               + [T.StructField("event_time", T.TimestampType()), T.StructField("date", DATE)])

# Market events as stored by the collector: everything text, partitioned by date.
MARKET_EVENTS = struct(
    market=STRING, asset_id=STRING, timestamp=STRING, last_trade_price=STRING, bids=STRING,
    asks=STRING, event_type=STRING, date=DATE)

# One record inside a candle message (messages are JSON arrays of these).
KLINE_MESSAGE = struct(
    timestamp=LONG, snapshot_time=LONG, symbol=STRING, close=DOUBLE, volume=DOUBLE,
    quote_asset_volume=DOUBLE, trades=LONG, taker_buy_base=DOUBLE, taker_buy_quote=DOUBLE)

LEVELS = T.ArrayType(struct(price=STRING, size=STRING))

# One market event message.
MARKET_MESSAGE = struct(
    event_type=STRING, market=STRING, timestamp=STRING, bids=LEVELS, asks=LEVELS, price=STRING,
    size=STRING)

# Market events after cleansing.
CLEANSED_EVENTS = struct(
    market=STRING, asset_id=STRING, event_time=T.TimestampType(), last_trade_price=DOUBLE, bids=LEVELS,
    asks=LEVELS, event_type=STRING, date=DATE)

# A market inside the stored event metadata (only the fields that are used).
MARKET_INFO = struct(
    id=STRING, question=STRING, slug=STRING, title=STRING, outcomes=STRING, outcomePrices=STRING,
    volume=STRING, liquidity=STRING, clobTokenIds=STRING, active=BOOLEAN, closed=BOOLEAN,
    lastTradePrice=DOUBLE, bestBid=DOUBLE, bestAsk=DOUBLE, spread=DOUBLE)
EVENT_INFO = struct(id=STRING, title=STRING, slug=STRING, closed=BOOLEAN,
                    markets=T.ArrayType(MARKET_INFO))

# Columns of a 12-position historical candle row, in order.
HISTORICAL_KLINE_FIELDS = (
    "timestamp", "open", "high", "low", "close", "volume", "close_time",
    "quote_asset_volume", "trades", "taker_buy_base", "taker_buy_quote", "ignore",
)

# Older record formats, still accepted by the view writers.
LEGACY_BATCH = struct(
    ("symbol", STRING), ("window_end_ts", LONG), open=DOUBLE, close=DOUBLE, high=DOUBLE, low=DOUBLE,
    volume=DOUBLE, volatility=DOUBLE, avg_prob_up=DOUBLE, avg_prob_down=DOUBLE, total_bet_vol=DOUBLE,
    sentiment_score=DOUBLE, prediction_result=STRING, divergence=DOUBLE)
LEGACY_LIVE = struct(
    ("symbol", STRING), ("timestamp", LONG), ("binance_price", DOUBLE),
    poly_last_trade=DOUBLE, poly_best_bid=DOUBLE, poly_best_ask=DOUBLE, implied_prob=DOUBLE)
