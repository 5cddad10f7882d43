"""Queries over the stored views: scans, merged timeline, current state, accuracy.

``now`` is always a parameter (epoch seconds), so results do not depend on the clock.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from oddsline.config import (BATCH_CELLS, BATCH_KEY_SEPARATOR, KEY_SEPARATOR, PRICE_ROWS,
                             QUOTE_SUFFIX, RESULTS, REVERSE_TIME_BASE, Settings)
from oddsline.functions import rowkeys

WINDOW_SECONDS = 900
DAY_SECONDS = 86400


# --- scans ------------------------------------------------------------------

def point_lookup(view: DataFrame, key: str) -> DataFrame:
    return view.filter(F.col("rowkey") == key)


def prefix_scan(view: DataFrame, prefix: str) -> DataFrame:
    """Rows whose key starts with ``prefix``; pushed to Parquet, where row groups of a
    view sorted by key are skipped."""
    return view.filter(F.col("rowkey").startswith(prefix))


def sample_view(view: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` rows in key order."""
    return view.orderBy("rowkey").limit(n)


def batch_prefix(pair: str) -> str:
    return f"{pair}{BATCH_KEY_SEPARATOR}"


def live_prefix(pair: str, row_type: str = PRICE_ROWS) -> str:
    return f"{row_type}{KEY_SEPARATOR}{pair}{KEY_SEPARATOR}"


def batch_records(view: DataFrame) -> DataFrame:
    """Batch rows with ``symbol`` and the epoch seconds in their key; malformed keys drop out."""
    return (view.withColumn("_key", rowkeys.parse_batch_rowkey("rowkey"))
            .filter(F.col("_key").isNotNull())
            .withColumns({"symbol": F.col("_key.symbol"), "window_ts": F.col("_key.epoch_s")})
            .drop("_key"))


def live_records(view: DataFrame) -> DataFrame:
    """Live rows with type, identifier and epoch milliseconds; malformed keys drop out."""
    return (view.withColumn("_key", rowkeys.parse_live_rowkey("rowkey"))
            .filter(F.col("_key").isNotNull())
            .withColumns({"row_type": F.col("_key.row_type"),
                          "identifier": F.col("_key.identifier"),
                          "epoch_ms": F.col("_key.epoch_ms")})
            .drop("_key"))


def _pruned(view: DataFrame, start_s: int | None, end_s: int | None, pair: str | None = None) -> DataFrame:
    """The batch view with the stored columns bounded by a time range: the ``date`` folders,
    and for one pair its row keys.  The exact bound on the parsed time is still to follow."""
    def day(seconds: int) -> Column:
        return F.lit(dt.datetime.fromtimestamp(seconds, dt.timezone.utc).date())

    def key(epoch_ms: int) -> str | None:
        number = str(REVERSE_TIME_BASE - epoch_ms)
        return batch_prefix(pair) + number if len(number) == len(str(REVERSE_TIME_BASE)) else None
    if "date" in view.columns:
        view = view.filter(F.col("date") >= day(start_s)) if start_s is not None else view
        view = view.filter(F.col("date") <= day(end_s)) if end_s is not None else view
    if pair is not None:
        newest = key(end_s * 1000 + 999) if end_s is not None else None
        oldest = key(start_s * 1000) if start_s is not None else None
        view = view.filter(F.col("rowkey") >= newest) if newest else view
        view = view.filter(F.col("rowkey") <= oldest) if oldest else view
    return view


def range_scan(view: DataFrame, start_s: int, end_s: int, symbol: str | None = None) -> DataFrame:
    """Batch rows (of one symbol) with start <= time <= end; other dates are not read."""
    pair = None if symbol is None else _pair(symbol)
    if pair is not None:
        view = prefix_scan(view, batch_prefix(pair))
    return (batch_records(_pruned(view, start_s, end_s, pair))
            .filter(F.col("window_ts").between(start_s, end_s)))


def newest_per_key(df: DataFrame, key: str, n: int, *order: Column) -> DataFrame:
    """The first ``n`` rows of each key.

    Spark limits every input partition to ``n`` rows per key before it shuffles, so
    even a key with most of the rows reaches one task as few rows.
    """
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


def latest_live(view: DataFrame, n: int = Settings.live_scan_limit, pair: str | None = None,
                row_type: str = PRICE_ROWS) -> DataFrame:
    """Newest ``n`` live rows of a pair, or of every pair."""
    if pair is not None:
        rows = prefix_scan(view, live_prefix(pair, row_type))
        return live_records(rows).orderBy("rowkey").limit(n)
    rows = prefix_scan(view, f"{row_type}{KEY_SEPARATOR}")
    return newest_per_key(live_records(rows), "identifier", n, F.col("rowkey"))


def latest_events(view: DataFrame, symbol: str, n: int = 10) -> DataFrame:
    """Newest ``n`` rows of a symbol in the older one-row-per-event format."""
    return prefix_scan(view, f"{symbol.upper()}{KEY_SEPARATOR}").orderBy("rowkey").limit(n)


def latest_windows(view: DataFrame, n: int = Settings.accuracy_windows) -> DataFrame:
    """Newest ``n`` batch windows of every symbol."""
    return newest_per_key(batch_records(view), "symbol", n, F.desc("window_ts"), F.col("rowkey"))


# --- merged timeline --------------------------------------------------------

def _pair(symbol: str) -> str:
    return symbol if symbol.endswith(QUOTE_SUFFIX) else symbol + QUOTE_SUFFIX


def _live_points(live: DataFrame, pair: str | None) -> DataFrame:
    prefix = f"{PRICE_ROWS}{KEY_SEPARATOR}" if pair is None else live_prefix(pair)
    return live_records(prefix_scan(live, prefix))


def _payload(columns: dict[str, str]) -> Column:
    return F.struct(*[F.col(c).alias(q) for q, c in columns.items()])


def merged_timeline(batch: DataFrame, live: DataFrame | None, symbol: str | None = None,
                    start_s: int | None = None, end_s: int | None = None,
                    now: int | None = None, live_limit: int | None = None,
                    live_minutes: int | None = None, boundary: str = "end") -> DataFrame:
    """Batch windows, and live points after the last batch window, newest first.

    Batch windows are authoritative once complete: with ``boundary="end"`` live points
    count only after the *end* of the symbol's last batch window of the whole view, whether
    or not that lies in the range asked for; ``"start"`` compares with its start, as older
    dashboards did.  Symbols without batch rows keep all live points.  ``start_s`` and
    ``end_s`` bound windows and points, both included; they default to the day before
    ``now``, and to no bound without ``now``; ``live_minutes`` counts back from ``now``.
    ``live_limit`` keeps the newest points per symbol of those that count; by default all
    are kept.
    """
    if boundary not in ("end", "start"):
        raise ValueError("boundary must be 'end' or 'start'")
    if live_minutes is not None and now is None:
        raise ValueError("live_minutes counts back from now, which is missing")
    if end_s is None:
        end_s = now
    if start_s is None and end_s is not None:
        start_s = end_s - DAY_SECONDS
    pair = None if symbol is None else _pair(symbol)
    shift = WINDOW_SECONDS if boundary == "end" else 0
    first, last = (None if t is None else t - shift for t in (start_s, end_s))
    stored = batch if pair is None else prefix_scan(batch, batch_prefix(pair))

    def stamped(rows: DataFrame, last: int | None) -> DataFrame:
        # "_stamp": the analysis family has a text column "timestamp" of its own
        return batch_records(_pruned(rows, first, last, pair)).withColumn("_stamp", F.col("window_ts") + F.lit(shift))

    def within(rows: DataFrame, time: str) -> DataFrame:
        rows = rows.filter(F.col(time) >= start_s) if start_s is not None else rows
        return rows.filter(F.col(time) <= end_s) if end_s is not None else rows

    history = within(stamped(stored, last), "_stamp").select(
        "symbol", F.col("_stamp").alias("timestamp"), F.lit("batch").alias("source"),
        F.lit("window_summary").alias("type"),
        *[_payload(columns).alias(family) for family, columns in BATCH_CELLS.items()])
    if live is None:
        merged = history
    else:
        points = _live_points(live, pair)
        if live_minutes is not None:
            points = points.filter(F.col("epoch_ms") >= (now - live_minutes * 60) * 1000)
        cells = [c for c in points.columns
                 if c not in ("rowkey", "identifier", "row_type", "epoch_ms")]
        points = points.select(F.col("identifier").alias("symbol"),
                               F.call_function("div", F.col("epoch_ms"), F.lit(1000)).alias("timestamp"),
                               F.lit("speed").alias("source"), F.lit("live_point").alias("type"),
                               F.struct(*cells).alias("data"))
        keys = [c for c in ("rowkey", "date") if c in stored.columns]
        # Windows before the range can't hide a point in it, so older folders are not read;
        # of the newer ones the keys are.
        newest = stamped(stored.select(*keys), None).groupBy("symbol").agg(F.max("_stamp").alias("_last"))
        fresh = (within(points, "timestamp").join(newest, "symbol", "left")
                 .filter(F.col("timestamp") > F.coalesce("_last", F.lit(0))).drop("_last"))
        if live_limit is not None:
            fresh = newest_per_key(fresh, "symbol", live_limit, F.desc("timestamp"))
        merged = history.unionByName(fresh, allowMissingColumns=True)
    return (merged.withColumn("time", F.timestamp_seconds("timestamp"))
            .orderBy(F.desc("timestamp"), "symbol", "source"))


def current_state(batch: DataFrame, live: DataFrame, now: int,
                  fallback_seconds: int = 3600) -> DataFrame:
    """One row per symbol: its newest live point, else its newest batch window of the
    last hour; symbols with neither are absent.

    Both are the first row per symbol, limited in every input partition before the
    shuffle; of the batch view only the dates of the last hour are read.
    """
    points = live_records(prefix_scan(live, f"{PRICE_ROWS}{KEY_SEPARATOR}"))
    cells = [c for c in points.columns if c not in ("rowkey", "identifier", "row_type", "epoch_ms")]
    newest_point = (newest_per_key(points, "identifier", 1, F.col("rowkey"))
                    .select(F.col("identifier").alias("symbol"), "epoch_ms", F.struct(*cells).alias("_data")))
    recent = range_scan(batch, now - fallback_seconds, now)
    newest_window = (newest_per_key(recent, "symbol", 1, F.desc("window_ts"), F.col("rowkey"))
                     .select("symbol", "window_ts", *[_payload(c).alias(f) for f, c in BATCH_CELLS.items()]))
    has_point = F.col("epoch_ms").isNotNull()
    # Live times are milliseconds, batch times seconds, as the dashboards expect.
    return newest_point.join(newest_window, "symbol", "full").select(
        "symbol", F.when(has_point, "speed").otherwise("batch").alias("source"),
        F.when(has_point, F.col("epoch_ms")).otherwise(F.col("window_ts")).alias("timestamp"),
        F.when(has_point, F.timestamp_millis("epoch_ms"))
         .otherwise(F.timestamp_seconds("window_ts")).alias("time"),
        F.col("_data").alias("data"),
        *[F.when(~has_point, F.col(f)).alias(f) for f in BATCH_CELLS])


# --- accuracy ---------------------------------------------------------------

def recent_accuracy(batch: DataFrame, n: int = Settings.accuracy_windows) -> DataFrame:
    """Per symbol over its newest ``n`` windows: share of results that are CORRECT_*;
    everything else, also UNCERTAIN, counts as wrong."""
    correct = F.count_if(F.col("prediction_result").startswith("CORRECT"))
    total = F.count(F.lit(1))
    return latest_windows(batch, n).groupBy("symbol").agg(
        total.alias("windows_analyzed"), correct.alias("correct_predictions"),
        (total - correct).alias("wrong_predictions"), F.try_divide(correct, total).alias("accuracy"),
        F.timestamp_seconds(F.min("window_ts")).alias("first_window"),
        F.timestamp_seconds(F.max("window_ts")).alias("last_window"))


def symbol_accuracy(batch: DataFrame, symbol: str, n: int = Settings.accuracy_windows) -> DataFrame:
    """Accuracy of one symbol; a symbol without windows gives one row with 0 windows."""
    pair = _pair(symbol)
    asked = batch.sparkSession.range(1).select(F.lit(pair).alias("symbol"))
    found = recent_accuracy(prefix_scan(batch, batch_prefix(pair)), n)
    counts = ("windows_analyzed", "correct_predictions", "wrong_predictions")
    return (asked.join(found, "symbol", "left")
            .withColumns({c: F.coalesce(c, F.lit(0).cast("long")) for c in counts}))


def outcome_counts(analysis: DataFrame, *by: str) -> DataFrame:
    return (analysis.groupBy(*by, "prediction_result").agg(F.count(F.lit(1)).alias("count")))


def outcome_report(analysis: DataFrame) -> DataFrame:
    """Counts per result overall (null symbol) and per symbol, from one scan."""
    return (analysis.groupingSets([["prediction_result"], ["symbol", "prediction_result"]],
                                  "symbol", "prediction_result")
            .agg(F.grouping("symbol").cast("boolean").alias("overall"),
                 F.count(F.lit(1)).alias("count")))


def accuracy_summary(view: DataFrame) -> DataFrame:
    """Count and percentage of each known result (zeros included), with the overall
    accuracy in percent of the decided windows; unknown results count only in the total."""
    result = F.col("prediction_result")
    counts = view.agg(F.count(F.lit(1)).alias("total"),
                      *[F.count_if(result == r).alias(r) for r in RESULTS])
    correct = F.col("CORRECT_BULL") + F.col("CORRECT_BEAR")
    decided = correct + F.col("FAILED_BULL") + F.col("FAILED_BEAR")
    entries = F.array(*[F.struct(F.lit(r).alias("prediction_result"), F.col(r).alias("count"))
                        for r in RESULTS])
    return (counts.select("total", F.try_divide(correct * 100.0, decided).alias("overall_accuracy"),
                          F.explode(entries).alias("entry"))
            .select("entry.prediction_result", "entry.count",
                    F.coalesce(F.try_divide(F.col("entry.count") * 100.0, F.col("total")),
                               F.lit(0.0)).alias("percent"),
                    "total", "overall_accuracy"))


def expire(view: DataFrame, now: int, ttl_seconds: int, column: str, per_second: int = 1) -> DataFrame:
    """Rows whose whole epoch seconds are younger than the time to live.

    ``column`` counts ``per_second`` units; it is compared as stored, so the bound
    reaches the scan.
    """
    return view.filter(F.col(column) >= F.lit((now - ttl_seconds + 1) * per_second))
