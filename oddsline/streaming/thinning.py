"""Thinning of a live snapshot stream, with keyed state.

The last kept time of each symbol lives in the state store, so it belongs to the query's
checkpoint: a replay or a restart goes on with exactly the state of the last committed
micro-batch. A timer drops it once the watermark has passed it by the interval, because any
snapshot that can still come is kept then whatever came before; idle symbols leave no state.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from oddsline.config import Settings
from oddsline.operators.snapshots import FAR_PAST, kept_after

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _Thinning(StatefulProcessor):
    def __init__(self, interval: int, columns: list[str], names: list[str]):
        self.interval, self.columns, self.names = interval, columns, names

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last_kept", "t bigint")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        arrived = pd.concat(list(rows), ignore_index=True)
        arrived.columns = self.names  # the worker renames those that begin with an underscore
        late = arrived["_t"].to_numpy(np.int64) < timerValues.getCurrentWatermarkInMs()
        arrived = arrived[~late].sort_values(["_t", "_tie"], kind="stable")
        if arrived.empty:
            return
        last = self.last.get()[0] if self.last.exists() else FAR_PAST
        times = arrived["_t"].to_numpy(np.int64)
        kept = kept_after(times, arrived["_closed"].to_numpy(bool), last, self.interval)
        if len(kept):
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            newest = int(times[kept[-1]])
            self.last.update((newest,))
            self.handle.registerTimer(newest + self.interval)
            yield arrived.iloc[kept][self.columns]

    def handleExpiredTimer(self, key: Any, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.last.clear()
        return iter(())

    def close(self) -> None:
        pass


@contextmanager
def keyed_state(spark: SparkSession):
    """While a query with keyed state is started: its state store, then the setting as before."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before) if before else spark.conf.unset(_PROVIDER)


def thinned(klines: DataFrame, seconds: float = Settings.snapshot_seconds, delay: str = Settings.watermark,
            tie: str | None = None) -> DataFrame:
    """A stream with closed snapshots and at most one other per ``seconds`` since the last kept one.

    Append mode. Snapshots of a symbol are taken in the order of their time within a
    micro-batch, ``tie`` (default: a row hash) telling those of one millisecond apart; rows
    behind the watermark are late and left out, like those without a time. If micro-batches
    come in the order of time the result is that of ``thin_snapshots``. Start it within
    ``keyed_state``. A task holds the new rows of a symbol of one micro-batch, which the
    source's admission limit bounds.
    """
    columns = list(klines.columns)
    keyed = klines.filter(F.col("snapshot_time").isNotNull()).withColumns({
        "_time": F.timestamp_millis("snapshot_time"), "_t": F.col("snapshot_time"),
        "_tie": F.col(tie).cast("bigint") if tie else F.xxhash64(*columns),
        "_closed": F.coalesce("is_closed", F.lit(False))}).withWatermark("_time", delay)
    keyed = keyed.withColumn("_key", F.col("symbol"))
    processor = _Thinning(int(round(seconds * 1000)), columns, keyed.columns)
    return keyed.groupBy("_key").transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=klines.schema, outputMode="Append", timeMode="EventTime")
