"""Decoding of raw messages: candles, market events, message logs, historical candles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from oddsline import schemas
from oddsline.config import BOOK_EVENT, CAPTURED, NUMBER, TRADE_EVENT
from oddsline.functions.book import (buy_sentiment, imbalance, mid_probability, spread,
                                     with_top_of_book)
from oddsline.functions.times import as_column, epoch_to_timestamp

_EMPTY_JSON = r"^\s*(\[\s*\]|\{\s*\}|null)?\s*$"


_TICK_FIELDS = ("snapshot_time", "symbol", "close", "quote_asset_volume", "taker_buy_quote")
_EVENT_FIELDS = ("event_type", "market", "timestamp")


def _records(messages: DataFrame, value: Column | str, schema: T.StructType,
             carry: tuple[str, ...], fields: tuple[str, ...] | None) -> DataFrame:
    """One row per record; a message may be an array of records or a single one.

    Only ``fields`` are converted, the parser skips the others.  ``explode`` would add
    "array is not empty" and "array is not null" filters below itself and parse every
    message again for them; ``explode_outer`` with a filter above parses once.
    """
    text = as_column(value).cast("string")
    if fields is not None:
        schema = T.StructType([schema[name] for name in fields])
    parsed = messages.select(*carry, F.from_json(text, T.ArrayType(schema)).alias("records"))
    return (parsed.select(*carry, F.explode_outer("records").alias("r"))
            .filter(F.col("r").isNotNull()).select(*carry, "r.*"))


def decode_klines(messages: DataFrame, value: Column | str = "value", carry: tuple[str, ...] = (),
                  fields: tuple[str, ...] | None = None) -> DataFrame:
    """Candle records, optionally only some of their fields."""
    return _records(messages, value, schemas.KLINE_MESSAGE, carry, fields)


def decode_market_events(messages: DataFrame, value: Column | str = "value",
                         carry: tuple[str, ...] = (),
                         payload: tuple[str, ...] = ("bids", "asks", "price", "size")) -> DataFrame:
    """Book and trade events with event time; times that are no number give null."""
    records = _records(messages, value, schemas.MARKET_MESSAGE, carry, _EVENT_FIELDS + payload)
    return records.select(
        *carry, F.col("market").alias("market_id"), "event_type",
        epoch_to_timestamp(F.col("timestamp").try_cast("bigint"), "ms").alias("event_time"), *payload)


def _may_hold(text: Column, event_type: str) -> Column:
    """False only if the text cannot hold an event of the type, without parsing it.

    A JSON text spells the type out unless it writes characters as ``\\u`` escapes.
    """
    return text.contains(event_type) | text.contains("\\u")


def price_ticks(klines: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Price, volume and buy sentiment of each candle record, at its snapshot time."""
    return klines.select(
        *carry, "symbol", epoch_to_timestamp("snapshot_time", "ms").alias("event_time"),
        F.col("close").alias("price"), F.col("quote_asset_volume").alias("usdt_volume"),
        buy_sentiment("taker_buy_quote", "quote_asset_volume").alias("buy_sentiment"))


def book_updates(events: DataFrame, string_compare: bool = False,
                 carry: tuple[str, ...] = ()) -> DataFrame:
    """Best prices, depth, spread, probability and imbalance of each book event."""
    books = events.filter(F.col("event_type") == BOOK_EVENT)
    tops = with_top_of_book(books, string_compare)
    return tops.select(
        *carry, "market_id", "event_time", "best_bid", "best_ask", "bid_depth", "ask_depth",
        spread("best_bid", "best_ask").alias("spread"),
        mid_probability("best_bid", "best_ask").alias("mid_price_prob"),
        imbalance("bid_depth", "ask_depth").alias("book_imbalance"))


def trades(events: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    return events.filter(F.col("event_type") == TRADE_EVENT).select(
        *carry, "market_id", "event_time",
        F.col("price").try_cast("double").alias("trade_price"),
        F.col("size").try_cast("double").alias("trade_size"))


def ordering(messages: DataFrame) -> tuple[str, ...]:
    """The columns beside the messages, if any, that order rows of the same millisecond."""
    return tuple(c for c in (CAPTURED, NUMBER) if c in messages.columns)


def ticks_of(messages: DataFrame, value: str = "value", carry: tuple[str, ...] = ()) -> DataFrame:
    """Candle messages -> price ticks."""
    return price_ticks(decode_klines(messages, value, carry, _TICK_FIELDS), carry)


def books_of(messages: DataFrame, value: str = "value", string_compare: bool = False,
             carry: tuple[str, ...] = ()) -> DataFrame:
    """Market messages -> book updates; messages without books are not parsed."""
    found = messages.filter(_may_hold(F.col(value).cast("string"), BOOK_EVENT))
    return book_updates(decode_market_events(found, value, carry, ("bids", "asks")),
                        string_compare, carry)


def trades_of(messages: DataFrame, value: str = "value", carry: tuple[str, ...] = ()) -> DataFrame:
    """Market messages -> trades; messages without trades are not parsed."""
    found = messages.filter(_may_hold(F.col(value).cast("string"), TRADE_EVENT))
    return trades(decode_market_events(found, value, carry, ("price", "size")), carry)


def clean_message_log(lines: DataFrame, value: str = "value") -> DataFrame:
    """Drop heartbeats, blanks, empty arrays/objects, ``null`` and texts that are not JSON."""
    text = F.col(value)
    return lines.filter(~text.contains("PONG") & ~text.rlike(_EMPTY_JSON)
                        & F.try_parse_json(text).isNotNull())


def decode_historical_klines(messages: DataFrame, value: Column | str = "value",
                             symbol: Column | str = "symbol",
                             carry: tuple[str, ...] = ()) -> DataFrame:
    """Arrays of 12-position candle rows -> typed candle records.

    Numbers may be quoted or not.  Historical candles are closed and their snapshot
    time is the close time.
    """
    rows = messages.select(*carry, as_column(symbol).alias("symbol"), F.explode_outer(F.from_json(
        as_column(value).cast("string"), "array<array<string>>")).alias("row"))
    rows = rows.filter(F.col("row").isNotNull())
    position = {name: i + 1 for i, name in enumerate(schemas.HISTORICAL_KLINE_FIELDS)}

    def field(name: str, kind: str) -> Column:
        return F.try_element_at("row", F.lit(position[name])).try_cast(kind).alias(name)

    whole = ("timestamp", "close_time", "trades")
    typed = [field(name, "bigint" if name in whole else "double")
             for name in schemas.HISTORICAL_KLINE_FIELDS if name != "ignore"]
    return (rows.select(*carry, "symbol", *typed)
            .withColumns({"is_closed": F.lit(True), "snapshot_time": F.col("close_time"),
                          "date": F.to_date(epoch_to_timestamp("timestamp", "ms"))}))
