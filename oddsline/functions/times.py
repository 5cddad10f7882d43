"""Epoch numbers, mixed timestamp texts, window arithmetic and ordering keys."""

from __future__ import annotations

import math
from decimal import Decimal

from pyspark.sql import Column, functions as F

QUARTER_SECONDS = 900

# First and last millisecond of the years 1 to 9999.
MIN_EPOCH_MS = -62135596800000
MAX_EPOCH_MS = 253402300799999

_PER_MILLI = {"ms": 1, "us": 1_000, "ns": 1_000_000}


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def epoch_to_timestamp(value: Column | str, unit: str = "ms") -> Column:
    """Epoch number to timestamp; numbers outside the years 1-9999 give null."""
    epoch = as_column(value).cast("bigint")
    if unit == "s":
        return F.when(epoch.between(MIN_EPOCH_MS // 1000, MAX_EPOCH_MS // 1000),
                      F.timestamp_seconds(epoch))
    scale = _PER_MILLI[unit]
    in_range = epoch.between(MIN_EPOCH_MS * scale, MAX_EPOCH_MS * scale) if unit != "ns" else F.lit(True)
    if unit == "ms":
        return F.when(in_range, F.timestamp_millis(epoch))
    micros = epoch if unit == "us" else F.call_function("div", epoch, F.lit(1000))
    return F.when(in_range, F.timestamp_micros(micros))


def mixed_timestamp(text: Column | str) -> Column:
    """Text holding either epoch milliseconds or an ISO instant; anything else gives null.

    A failing cast to a number costs an exception, so texts with a colon are never tried as one.
    """
    value = as_column(text)
    return F.coalesce(epoch_to_timestamp(F.when(~value.contains(":"), value.try_cast("bigint")), "ms"),
                      F.try_to_timestamp(value))


def quarter_floor(ts: Column | str, seconds: int = QUARTER_SECONDS) -> Column:
    """Epoch seconds of the start of the block holding ``ts``.

    Offsets of US Eastern time are whole hours, so the UTC quarter hour is the
    Eastern quarter hour too, also around daylight-saving changes.
    """
    epoch = F.unix_seconds(as_column(ts))
    return epoch - F.pmod(epoch, F.lit(seconds))


def floor_time(ts: Column | str, every: str) -> Column:
    """Start of the block of length ``every`` holding ``ts``."""
    micros = F.unix_micros(as_column(ts))
    return F.timestamp_micros(micros - F.pmod(micros, F.lit(interval_seconds(every) * 1_000_000)))


def order_key(ts: Column | str, *ties: Column | str, span_seconds: int | None = None) -> Column:
    """A BIGINT that sorts rows by time and then, for equal times, by a hash of ``ties``.

    ``min_by``/``max_by`` over a BIGINT keep the fixed-width aggregation buffer that
    hash aggregation needs; ordering by a struct would sort every input partition.
    Inside windows of ``span_seconds`` the key holds microseconds since window start,
    otherwise epoch milliseconds.  Equal times resolve the same way on every run
    and after every task retry.
    """
    instant = as_column(ts)
    if span_seconds is None:
        offset, bits = F.unix_millis(instant), 42
    else:
        span = span_seconds * 1_000_000
        offset, bits = F.pmod(F.unix_micros(instant), F.lit(span)), math.ceil(math.log2(span))
    if not ties:
        return offset
    free = 63 - bits
    hashed = F.xxhash64(*[as_column(t) for t in ties]).bitwiseAND(F.lit((1 << free) - 1))
    return F.shiftleft(offset, free).bitwiseOR(hashed)


def exact_key(ts: Column | str, tie: Column | str, descending: bool = False) -> Column:
    """A DECIMAL that sorts rows by the microsecond and then by the whole BIGINT ``tie``, falling
    if ``descending``: the first of equal times has the smallest key, or else the largest.

    Like a BIGINT it has a fixed-width aggregation buffer.
    """
    return _pair(F.unix_micros(as_column(ts)), as_column(tie), descending)


def _pair(major: Column, minor: Column, descending: bool = False) -> Column:
    """Two BIGINTs, the first within 62 bits, as one number of at most 38 digits."""
    high = major.cast("decimal(20,0)") * F.lit(Decimal(2 ** 64))
    low = F.coalesce(minor, F.lit(2 ** 63 - 1)).cast("decimal(20,0)")
    return (high - low if descending else high + low).cast("decimal(38,0)")


def ranked_key(flag: Column, epoch_ms: Column | str, tie: Column | str) -> Column:
    """Sorts by a flag, then by epoch milliseconds, then by the whole BIGINT ``tie``."""
    bound = F.lit(2 ** 60)
    captured = F.greatest(F.least(as_column(epoch_ms), bound), -bound)
    return _pair(F.when(flag, F.lit(2 ** 61)).otherwise(F.lit(0)) + captured, as_column(tie))


def refined(coarse: Column | str, fine: Column | str) -> Column:
    """``fine`` where it lies within the millisecond that ``coarse`` tells, else ``coarse``."""
    coarse, fine = as_column(coarse), as_column(fine)
    return F.when(F.unix_millis(coarse) == F.unix_millis(fine), fine).otherwise(coarse)


def interval_seconds(text: str) -> int:
    """Length of an interval such as ``15 minutes``."""
    number, unit = text.split()
    return int(number) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]
