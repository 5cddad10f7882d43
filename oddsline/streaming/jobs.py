"""Streaming queries: live windows into the live view, and other stream sinks."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from oddsline.config import BOOK_ROWS, EVENT_KEY, NUMBER, PRICE_ROWS, TRADE_ROWS, Settings
from oddsline.operators import views, windows
from oddsline.sources import messages
from oddsline.streaming.live_view import LiveView


@dataclass(frozen=True)
class StreamOptions:
    """``trigger=None`` processes everything available and stops."""

    checkpoint: str
    trigger: str | None = Settings.trigger
    name: str | None = None


@dataclass(frozen=True)
class Maintenance:
    """Compact a live view every so many seconds, beside its stream, and leave expired rows behind."""

    seconds: float = 3600
    ttl_seconds: int | None = Settings.live_ttl_days * 86400
    keep: int = 2
    clock: Callable[[], float] = time.time

    def oldest_window_end(self) -> int | None:
        """Epoch milliseconds; windows that ended by then are expired."""
        if self.ttl_seconds is None:
            return None
        return int((self.clock() - self.ttl_seconds) * 1000)

    def run(self, view: LiveView) -> int | None:
        """One round, while the stream may go on; returns the version of the newest base.

        A base is published by its number when it is complete: micro-batches and readers
        never wait for it.
        """
        upto = view.compact(self.oldest_window_end(), settled=True)
        view.vacuum(self.keep)
        return upto


class Maintainer:
    """Rounds of maintenance of some views, in a thread of their own until ``stop``."""

    def __init__(self, views_: list[LiveView], maintenance: Maintenance):
        self.views, self.maintenance = views_, maintenance
        self.failure: BaseException | None = None
        self._ended = threading.Event()
        self._thread = threading.Thread(target=self._loop, name="live-view-maintenance", daemon=True)

    def _loop(self) -> None:
        while not self._ended.wait(self.maintenance.seconds):
            try:
                for view in self.views:
                    self.maintenance.run(view)
            except Exception as error:  # told by stop(): the streams go on without it
                self.failure = error
                return

    def start(self) -> Maintainer:
        self._thread.start()
        return self

    def stop(self) -> None:
        """Ends after the present round; a failure of any round is raised."""
        self._ended.set()
        self._thread.join()
        if self.failure:
            raise self.failure


def price_windows(raw: DataFrame, settings: Settings = Settings(), value: str = "value") -> DataFrame:
    return windows.live_price(messages.ticks_of(raw, value, messages.ordering(raw)), settings.live_window,
                              settings.watermark)


def book_windows(raw: DataFrame, settings: Settings = Settings(), value: str = "value",
                 string_compare: bool = False) -> DataFrame:
    return windows.live_book(messages.books_of(raw, value, string_compare, messages.ordering(raw)),
                             settings.live_window, settings.watermark)


def trade_windows(raw: DataFrame, settings: Settings = Settings(), value: str = "value") -> DataFrame:
    return windows.live_trades(messages.trades_of(raw, value), settings.live_window, settings.watermark)


WINDOWS_OF = {PRICE_ROWS: price_windows, BOOK_ROWS: book_windows, TRADE_ROWS: trade_windows}


def _start(writer: DataStreamWriter, options: StreamOptions) -> StreamingQuery:
    writer = writer.option("checkpointLocation", options.checkpoint)
    if options.name:
        writer = writer.queryName(options.name)
    if options.trigger is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=options.trigger).start()


def view_of(spark: SparkSession, rows: DataFrame, root: str, key: str = "rowkey") -> LiveView:
    """A live view with the columns of ``rows`` (batch or streaming)."""
    return LiveView(spark, root, rows.schema, key)


def _has_started(spark: SparkSession, checkpoint: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/offsets")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def start_upsert(rows: DataFrame, root: str, options: StreamOptions,
                 order: str | None = None, key: str = "rowkey") -> tuple[StreamingQuery, LiveView]:
    """Feed keyed rows into the live view at ``root``.

    Update mode: only windows changed by a micro-batch are written.  The batch is
    written once and not counted or collected first.  ``order`` picks the row of a key
    that a batch can hold twice.  Checkpoint and root belong together: batch numbers of a
    new checkpoint start over, so one over a root that has rows already is refused.
    """
    spark = rows.sparkSession
    view = view_of(spark, rows, root, key)
    if view.last_version() >= 0 and not _has_started(spark, options.checkpoint):
        raise ValueError(f"{root} holds micro-batches up to {view.last_version()}, but {options.checkpoint} "
                         "is a new checkpoint; its batches would never be read")

    def write(batch: DataFrame, batch_id: int) -> None:
        view.upsert(batch, batch_id, order)

    writer = rows.writeStream.outputMode("update").foreachBatch(write)
    return _start(writer, options), view


def start_live_windows(raw: DataFrame, row_type: str, root: str, options: StreamOptions,
                       settings: Settings = Settings(),
                       truncate: int | None = None) -> tuple[StreamingQuery, LiveView]:
    """Raw messages -> live windows of one row type -> live view."""
    rows = views.live_view(WINDOWS_OF[row_type](raw, settings), row_type, truncate)
    return start_upsert(rows, root, options, order="window_end" if truncate else None)


def start_event_rows(events: DataFrame, root: str,
                     options: StreamOptions) -> tuple[StreamingQuery, LiveView]:
    """Older format: one live row per event, without aggregation.

    Numbered events are keyed by ``event_key``, so all that share a row key stay; without
    numbers a row key keeps one event.
    """
    keep = (NUMBER,) if NUMBER in events.columns else ()
    rows = views.event_view(views.legacy_live_frame(events, keep))
    if keep:
        return start_upsert(rows, root, options, order="window_end", key=EVENT_KEY)
    return start_upsert(rows, root, options, order="window_end")


def start_parquet(aggregated: DataFrame, path: str, options: StreamOptions) -> StreamingQuery:
    """Append finished windows: a window is written once the watermark passed its end."""
    writer = aggregated.writeStream.outputMode("append").format("parquet").option("path", path)
    return _start(writer, options)


def start_kafka(rows: DataFrame, servers: str, topic: str, options: StreamOptions) -> StreamingQuery:
    """Changed rows as JSON messages, keyed by row key; needs the Spark Kafka package."""
    keyed = rows.selectExpr("rowkey AS key", "to_json(struct(*)) AS value")
    writer = (keyed.writeStream.outputMode("update").format("kafka")
              .option("kafka.bootstrap.servers", servers).option("topic", topic))
    return _start(writer, options)


def start_console(rows: DataFrame, options: StreamOptions) -> StreamingQuery:
    writer = rows.writeStream.outputMode("update").format("console").option("truncate", False)
    return _start(writer, options)
