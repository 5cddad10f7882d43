"""Row keys of the serving views, and their parsing.

Keys end in a reversed time so that a plain ascending scan returns newest rows first.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from oddsline.config import BATCH_KEY_SEPARATOR, KEY_SEPARATOR, REVERSE_TIME_BASE
from oddsline.functions.times import as_column


def reversed_ms(epoch_ms: Column | str) -> Column:
    return F.lit(REVERSE_TIME_BASE) - as_column(epoch_ms)


def batch_rowkey(symbol: Column | str, window_start: Column | str) -> Column:
    """``SYMBOL_<reversed window start>``."""
    start_ms = F.unix_seconds(as_column(window_start)) * 1000
    return F.concat_ws(BATCH_KEY_SEPARATOR, as_column(symbol), reversed_ms(start_ms).cast("string"))


def window_end_rowkey(symbol: Column | str, window_end_s: Column | str) -> Column:
    """``SYMBOL#<window end in seconds>`` (not reversed)."""
    return F.concat_ws(KEY_SEPARATOR, F.upper(as_column(symbol)),
                       as_column(window_end_s).cast("string"))


def event_rowkey(symbol: Column | str, epoch_ms: Column | str) -> Column:
    """``SYMBOL#<reversed ms>`` for one row per event."""
    return F.concat_ws(KEY_SEPARATOR, F.upper(as_column(symbol)),
                       reversed_ms(epoch_ms).cast("string"))


def live_rowkey(row_type: str, identifier: Column | str, window_end_ms: Column | str,
                truncate: int | None = None) -> Column:
    """``TYPE#IDENTIFIER#<reversed window end>``.

    ``truncate=16`` gives the older short keys, in which two identifiers with the
    same first 16 characters collide.
    """
    name = as_column(identifier)
    if truncate:
        name = F.substring(name, 1, truncate)
    return F.concat_ws(KEY_SEPARATOR, F.lit(row_type), name,
                       reversed_ms(window_end_ms).cast("string"))


def _checked(key: Column, parsed: Column, ok: Column, strict: bool) -> Column:
    if strict:
        return F.when(ok, parsed).otherwise(
            F.raise_error(F.concat(F.lit("not a row key: "), F.coalesce(key, F.lit("null")))))
    return F.when(ok, parsed)


def parse_batch_rowkey(key: Column | str, strict: bool = False) -> Column:
    """struct(symbol, epoch_s) of a ``SYMBOL_<reversed>`` key; null if malformed."""
    key = as_column(key)
    parts = F.split(key, BATCH_KEY_SEPARATOR)
    stamp = F.try_element_at(parts, F.lit(2)).try_cast("bigint")
    ok = (F.size(parts) == 2) & stamp.isNotNull()
    actual_ms = reversed_ms(stamp)
    seconds = F.call_function("div", actual_ms - F.pmod(actual_ms, F.lit(1000)), F.lit(1000))
    return _checked(key, F.struct(F.try_element_at(parts, F.lit(1)).alias("symbol"),
                                  seconds.alias("epoch_s")), ok, strict)


def parse_plain_rowkey(key: Column | str, strict: bool = False) -> Column:
    """struct(symbol, stamp) of a two-part ``SYMBOL#<number>`` key."""
    key = as_column(key)
    parts = F.split(key, KEY_SEPARATOR)
    stamp = F.try_element_at(parts, F.lit(2)).try_cast("bigint")
    ok = (F.size(parts) == 2) & stamp.isNotNull()
    return _checked(key, F.struct(F.try_element_at(parts, F.lit(1)).alias("symbol"),
                                  stamp.alias("stamp")), ok, strict)


def parse_live_rowkey(key: Column | str, strict: bool = False) -> Column:
    """struct(row_type, identifier, epoch_ms) of three-part keys and of two-part event keys.

    Two-part keys carry no type and get a null ``row_type``.
    """
    key = as_column(key)
    parts = F.split(key, KEY_SEPARATOR)
    count = F.size(parts)
    stamp = F.try_element_at(parts, F.lit(-1)).try_cast("bigint")
    ok = count.isin(2, 3) & stamp.isNotNull()
    typed = count == 3
    return _checked(key, F.struct(
        F.when(typed, F.try_element_at(parts, F.lit(1))).alias("row_type"),
        F.try_element_at(parts, F.when(typed, F.lit(2)).otherwise(F.lit(1))).alias("identifier"),
        reversed_ms(stamp).alias("epoch_ms")), ok, strict)


def parse_cell(text: Column | str) -> Column:
    """struct(number, whole, word): a text with a dot becomes a double, digits a bigint, the rest a word."""
    value = as_column(text)
    number = F.when(value.contains("."), value.try_cast("double"))
    whole = F.when(~value.contains("."), value.try_cast("bigint"))
    word = F.when(number.isNull() & whole.isNull(), value)
    return F.struct(number.alias("number"), whole.alias("whole"), word.alias("word"))
