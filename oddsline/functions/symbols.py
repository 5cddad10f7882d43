"""Traded pairs, short asset names and title keywords."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F

from oddsline.config import (CRYPTO_KEYWORDS, PAIR_TO_CRYPTO, QUOTE_SUFFIX, SLUG_INFIX,
                             UNKNOWN_CRYPTO)
from oddsline.functions.times import as_column, quarter_floor


def symbol_to_crypto(symbol: Column | str, pairs=PAIR_TO_CRYPTO) -> Column:
    value = as_column(symbol)
    return reduce(lambda chain, pair: F.when(value == pair[0], pair[1]).otherwise(chain),
                  reversed(pairs), F.lit(UNKNOWN_CRYPTO))


def normalize_symbol(symbol: Column | str) -> Column:
    """``BTC`` -> ``BTCUSDT``; pairs stay as they are."""
    value = as_column(symbol)
    return F.when(value.endswith(QUOTE_SUFFIX), value).otherwise(F.concat(value, F.lit(QUOTE_SUFFIX)))


def needed_keywords(keywords=CRYPTO_KEYWORDS) -> list[str]:
    """Keywords that contain no other keyword: a title has one of these iff it has any.

    Short ones come first; they hit most often and end the search.
    """
    return sorted((k for k in keywords if not any(other != k and other in k for other in keywords)),
                  key=len)


def is_crypto_title(title: Column | str, keywords=CRYPTO_KEYWORDS) -> Column:
    """True if the lower-cased title contains any keyword; a null title is not a match."""
    text = F.lower(as_column(title))
    hits = [text.contains(k) for k in needed_keywords(keywords)]
    return F.coalesce(reduce(or_, hits), F.lit(False))


def event_slug(crypto: Column | str, ts: Column | str) -> Column:
    return F.concat(as_column(crypto), F.lit(SLUG_INFIX), quarter_floor(ts).cast("string"))


def slug_crypto(slug: Column | str) -> Column:
    return F.substring(as_column(slug), 1, 3)


def slug_epoch(slug: Column | str) -> Column:
    """Epoch seconds at the end of a slug; null if the slug has another form."""
    return F.try_element_at(F.split(as_column(slug), SLUG_INFIX), F.lit(2)).try_cast("bigint")
