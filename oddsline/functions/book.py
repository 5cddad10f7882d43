"""Order-book measures over arrays of (price, size) texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from oddsline import schemas
from oddsline.functions.times import as_column

# A list of levels as the collector writes it. Possessive quantifiers need no stack for long books.
_SPACE, _TEXT = r"[ \t\r\n]*+", r'"([^"\\\x00-\x1F]*+)"'
_PRICE, _SIZE = (f'"{name}"{_SPACE}:{_SPACE}{_TEXT}' for name in ("price", "size"))
_LEVEL = rf"\{{{_SPACE}{_PRICE}{_SPACE},{_SPACE}{_SIZE}{_SPACE}\}}"
_LEVELS = rf"\A{_SPACE}\[{_SPACE}{_LEVEL}(?:{_SPACE},{_SPACE}{_LEVEL})*+{_SPACE}\]{_SPACE}\z"


def _number(text: Column) -> Column:
    number = text.try_cast("double")
    return F.when(~F.isnan(number), number)


def levels(text: Column | str) -> Column:
    """Levels of a JSON text; unreadable texts give null.

    Texts in the collector's own form are taken apart by patterns, in half the time that
    the JSON reader needs; all others are left to it.
    """
    text = as_column(text)
    prices, sizes = (F.regexp_extract_all(text, F.lit(part), F.lit(1)) for part in (_PRICE, _SIZE))
    return F.when(text.rlike(_LEVELS), F.arrays_zip(prices.alias("price"), sizes.alias("size"))).otherwise(
        F.from_json(text, schemas.LEVELS))


def _top_level(levels: Column, sign: int) -> Column:
    """(rank, position, size) of the level with the largest ``sign * price``.

    Price and depth come out of one pass over the array.  Nulls rank below every
    number and the earlier of two equally priced levels wins.
    """
    return F.array_max(F.transform(
        levels,
        lambda level, i: F.struct((_number(level["price"]) * F.lit(float(sign))).alias("rank"),
                                  (-i).alias("position"), level["size"].alias("size"))))


def _top_by_text(levels: Column, highest: bool) -> Column:
    """Level whose price *text* is extreme (text order: '0.9' > '0.10')."""
    priced = F.filter(levels, lambda level: level["price"].isNotNull())
    if highest:
        return F.array_max(F.transform(priced, lambda level, i: F.struct(
            level["price"].alias("price"), (-i).alias("position"), level["size"].alias("size"))))
    return F.array_min(F.transform(priced, lambda level, i: F.struct(
        level["price"].alias("price"), i.alias("position"), level["size"].alias("size"))))


def with_top_of_book(events: DataFrame, string_compare: bool = False) -> DataFrame:
    """Add ``best_bid, best_ask, bid_depth, ask_depth``.

    ``string_compare`` takes the depth at the extreme price text instead of the
    extreme number, as older consumers did; best prices are numeric either way.
    """
    bids, asks = F.col("bids"), F.col("asks")
    tops = events.withColumns({"_bid": _top_level(bids, 1), "_ask": _top_level(asks, -1)})
    bid_size, ask_size = F.col("_bid.size"), F.col("_ask.size")
    # Without any readable price there is no best level and no depth.
    bid_size = F.when(F.col("_bid.rank").isNotNull(), bid_size)
    ask_size = F.when(F.col("_ask.rank").isNotNull(), ask_size)
    if string_compare:
        bid_size = _top_by_text(bids, True)["size"]
        ask_size = _top_by_text(asks, False)["size"]
    return tops.withColumns({
        "best_bid": F.col("_bid.rank"),
        "best_ask": -F.col("_ask.rank"),
        "bid_depth": bid_size.try_cast("double"),
        "ask_depth": ask_size.try_cast("double"),
    }).drop("_bid", "_ask")


def spread(bid: Column | str, ask: Column | str) -> Column:
    return F.abs(as_column(ask) - as_column(bid))


def mid_probability(bid: Column | str, ask: Column | str) -> Column:
    return (as_column(bid) + as_column(ask)) / F.lit(2.0)


def imbalance(bid_depth: Column | str, ask_depth: Column | str) -> Column:
    """-1 (all asks) to 1 (all bids); null without depth."""
    bid, ask = as_column(bid_depth), as_column(ask_depth)
    return F.when(bid + ask > 0, (bid - ask) / (bid + ask))


def buy_sentiment(taker_buy_quote: Column | str, quote_volume: Column | str) -> Column:
    """Share of aggressive buying; null without volume."""
    volume = as_column(quote_volume)
    return F.when(volume > 0, as_column(taker_buy_quote) / volume)
