"""Running several streaming queries together and reporting on them."""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from oddsline.sinks.folders import Folders

PROGRESS_SCHEMA = ("name string, batch_id bigint, input_rows bigint, dropped_late_rows bigint, "
                   "state_rows bigint, duration_ms bigint, watermark string")


class ProgressLog(StreamingQueryListener):
    """Totals per query, in particular rows dropped behind the watermark, which Spark
    otherwise leaves out of the results silently."""

    def __init__(self) -> None:
        self.input_rows: dict[str, int] = {}
        self.dropped_late_rows: dict[str, int] = {}
        self.failures: dict[str, str] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        key = progress.name or str(progress.id)
        dropped = sum(op.numRowsDroppedByWatermark for op in progress.stateOperators)
        self.input_rows[key] = self.input_rows.get(key, 0) + progress.numInputRows
        self.dropped_late_rows[key] = self.dropped_late_rows.get(key, 0) + dropped

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            self.failures[str(event.id)] = event.exception


OBSERVED = "observed"
TOTALS_SCHEMA = ("query string, batch_id bigint, input_rows bigint, dropped_by_state bigint, "
                 "observed map<string, bigint>")


def observed(rows: DataFrame, **counts) -> DataFrame:
    """Rows of a stream with counts (aggregate columns) that reach the table of totals."""
    return rows.observe(OBSERVED, *[column.cast("bigint").alias(name) for name, column in counts.items()])


class ProgressTable(StreamingQueryListener):
    """What each micro-batch of the session's named queries did, in a table that outlives it.

    One small file for each query and micro-batch, below ``root``. A restart goes on in the
    same table, and a micro-batch that is run again replaces its file, so nothing is counted
    twice. Spark reports progress some time after the batch; ``wait_for`` waits for it.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._folders = Folders(spark, root)
        self._folders.make()

    def _file(self, query: str, batch_id: int) -> str:
        return f"{query}-{batch_id}.json"

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if not progress.name:
            return
        counts = progress.observedMetrics.get(OBSERVED)
        entry = {"query": progress.name, "batch_id": progress.batchId, "input_rows": progress.numInputRows,
                 "dropped_by_state": sum(op.numRowsDroppedByWatermark for op in progress.stateOperators),
                 "observed": {} if counts is None else counts.asDict()}
        name = self._file(progress.name, progress.batchId)
        if not progress.numInputRows and self._folders.exists(name):
            return  # a batch without data that reports the last one's number
        self._folders.write(name, json.dumps(entry))

    def wait_for(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Until the last micro-batch of a query that has ended is in the table."""
        last = query.lastProgress
        name = last and self._file(last["name"], last["batchId"])
        ends = time.time() + seconds
        while name and not self._folders.exists(name):
            if time.time() > ends:
                raise TimeoutError(f"no progress of {name}")
            time.sleep(0.05)

    def batches(self) -> DataFrame:
        return self.spark.read.schema(TOTALS_SCHEMA).json(self.root)

    def totals(self) -> DataFrame:
        """Per query over all its runs: batches, input_rows, dropped_by_state (groups that the
        aggregation refused as late), and the sum of each observed count by name."""
        rows = self.batches()
        sums = rows.groupBy("query").agg(F.count("*").alias("batches"), F.sum("input_rows").alias("input_rows"),
                                         F.sum("dropped_by_state").alias("dropped_by_state"))
        counts = (rows.select("query", F.explode("observed").alias("name", "value"))
                  .groupBy("query", "name").agg(F.sum("value").alias("value"))
                  .groupBy("query").agg(F.map_from_entries(F.collect_list(F.struct("name", "value"))).alias("observed")))
        return sums.join(counts, "query", "left")


def progress_report(spark: SparkSession, queries: list[StreamingQuery]) -> DataFrame:
    """One row per recent micro-batch of each query.

    Spark keeps only the newest ones (``spark.sql.streaming.numRecentProgressUpdates``);
    totals over a whole run come from :class:`ProgressLog`.
    """
    rows = []
    for query in queries:
        for progress in query.recentProgress:
            entry = progress if isinstance(progress, dict) else json.loads(progress.json)
            operators = entry.get("stateOperators", [])
            rows.append((query.name or str(query.id), entry["batchId"], entry["numInputRows"],
                         sum(op.get("numRowsDroppedByWatermark", 0) for op in operators),
                         sum(op.get("numRowsTotal", 0) for op in operators),
                         entry.get("durationMs", {}).get("triggerExecution", 0),
                         entry.get("eventTime", {}).get("watermark")))
    return spark.createDataFrame(rows, PROGRESS_SCHEMA)


def stop_all(spark: SparkSession) -> None:
    for query in spark.streams.active:
        query.stop()


def run_until_any_ends(spark: SparkSession) -> None:
    """Block until one query ends or fails, then stop the others; failures are raised."""
    try:
        spark.streams.awaitAnyTermination()
    finally:
        stop_all(spark)


def drain(*queries: StreamingQuery) -> None:
    """Wait for queries that stop by themselves; the first failure is raised after all stopped."""
    try:
        for query in queries:
            query.awaitTermination()
    finally:
        for query in queries:
            if query.isActive:
                query.stop()
