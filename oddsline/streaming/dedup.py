"""Snapshots that arrive more than once on a stream, as when a backfill overlaps it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from oddsline.config import Settings
from oddsline.functions.times import epoch_to_timestamp
from oddsline.operators.snapshots import snapshot_keys


def drop_repeated_within(klines: DataFrame, delay: str, keys: tuple[str, ...] | None = None,
                         settings: Settings = Settings()) -> DataFrame:
    """The first arrival of each snapshot of a stream, columns unchanged.

    A copy is dropped if it comes before the watermark, the newest candle time less
    ``delay``, has passed the snapshot's time by another ``delay``; by then its key leaves the
    state, which so holds what ``delay`` allows and not the whole past. Give at least the
    time that a backfill reaches back. Rows behind the watermark are dropped as late.
    """
    carried = klines.withColumn("_time", epoch_to_timestamp("timestamp", settings.epoch_unit))
    return carried.withWatermark("_time", delay).dropDuplicatesWithinWatermark(
        list(snapshot_keys(klines) if keys is None else keys)).drop("_time")
