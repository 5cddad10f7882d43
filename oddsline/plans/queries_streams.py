"""Queries that run a stream over a whole table and return what its sink holds."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from oddsline.config import BOOK_ROWS, PRICE_ROWS, TRADE_ROWS, Settings
from oddsline.operators import windows
from oddsline.plans import live, oracle_feeds as o
from oddsline.plans.queries_sinks import RESULT_COLUMNS, RESULT_SQL
from oddsline.plans.queries_views import LEGACY_LIVE_SQL, legacy_live_events, price_view
from oddsline.plans.queries_windows import THIN_SECONDS
from oddsline.plans.registry import ORACLES, query, rounded
from oddsline.session import work_folder
from oddsline.sources import feeds, messages, streams
from oddsline.streaming import jobs, monitor, thinning
from oddsline.streaming.cleansing import KINDS, CleansedTables
from oddsline.streaming.dedup import drop_repeated_within

# Files of a table carry no arrival order, so they form one micro-batch and no row is late.
ALL_FILES = 2 ** 31 - 1


def _events(spark, folder):
    return streams.table_stream(spark, f"{folder}/events.parque[t]", feeds.EVENTS_SCHEMA, ALL_FILES)


def _options(spark, name):
    return jobs.StreamOptions(work_folder(spark, f"checkpoint-{name}"), trigger=None)


def _live(spark, raw, row_type):
    root = work_folder(spark, f"live-{row_type}")
    running, view = jobs.start_live_windows(raw, row_type, root, _options(spark, row_type))
    monitor.drain(running)
    return view


@query("stream_live_price", f"""WITH {o.KLINES}, {o.live_price()}, {o.LIVE_PRICE_VIEW}
SELECT * REPLACE (round(avg_price, 6) AS avg_price, round(volatility, 6) AS volatility,
  round(total_volume, 4) AS total_volume, round(avg_sentiment, 6) AS avg_sentiment) FROM live_rows""")
def stream_live_price(spark, folder):
    view = _live(spark, feeds.kline_messages(_events(spark, folder)), PRICE_ROWS).read()
    view = rounded(view, "avg_price", "volatility", "avg_sentiment")
    return rounded(view, "total_volume", digits=4)


@query("stream_live_book", f"""WITH {o.SOURCE}, {o.BOOKS}, {o.LIVE_BOOK}
SELECT 'PB#' || market_id || '#' || CAST(9999999999999 - epoch_ms(window_end) AS VARCHAR) AS rowkey,
  market_id AS identifier, current_prob, current_spread, current_imbalance,
  round(avg_prob, 6) AS avg_prob, min_prob, max_prob, round(avg_imbalance, 6) AS avg_imbalance,
  round(avg_spread, 6) AS avg_spread, num_updates, market_id, epoch_ms(window_end) AS window_end
FROM live_book""")
def stream_live_book(spark, folder):
    view = _live(spark, feeds.market_messages(_events(spark, folder)), BOOK_ROWS).read()
    return rounded(view, "avg_prob", "avg_imbalance", "avg_spread")


@query("stream_live_trades", f"""WITH {o.SOURCE}, {o.MARKETS}, {o.LIVE_TRADES}
SELECT 'PT#' || market_id || '#' || CAST(9999999999999 - epoch_ms(window_end) AS VARCHAR) AS rowkey,
  market_id AS identifier, round(total_shares_traded, 4) AS total_shares, num_trades, market_id,
  epoch_ms(window_end) AS window_end FROM live_trades""")
def stream_live_trades(spark, folder):
    view = _live(spark, feeds.market_messages(_events(spark, folder)), TRADE_ROWS).read()
    return rounded(view, "total_shares", digits=4)


# Two micro-batches of the same keys: the second leaves some cells null, which must not
# erase the first; then a compaction.
@query("live_view_upsert", f"""WITH {o.KLINES}, {o.live_price()}, {o.LIVE_PRICE_VIEW}
SELECT rowkey, window_end, current_price,
  current_price + CASE WHEN ticks > 1 THEN 1 ELSE 0 END AS latest_price, ticks FROM live_rows""")
def live_view_upsert(spark, folder):
    rows = feeds.kline_messages(feeds.events(spark, folder))
    first = windows.live_price(messages.ticks_of(rows, carry=messages.ordering(rows))).select(
        F.concat(F.lit("BIN#"), "symbol", F.lit("#"),
                 (F.lit(9999999999999) - F.unix_millis("window_end")).cast("string")).alias("rowkey"),
        F.unix_millis("window_end").alias("window_end"), "current_price",
        F.col("current_price").alias("latest_price"), "ticks")
    view = jobs.view_of(spark, first, work_folder(spark, "upsert"))
    view.upsert(first, 0)
    stored = view.read()
    view.upsert(stored.select(
        "rowkey", "window_end", F.lit(None).cast("double").alias("current_price"),
        F.when(F.col("ticks") > 1, F.col("latest_price") + 1).alias("latest_price"),
        F.lit(None).cast("bigint").alias("ticks")), 1)
    view.compact()
    return view.read()


# A base, and two micro-batches after it: one with new ticks for a part of the rows and their
# other cells null, one with rows that the base does not have. Dashboards ask for bounds.
_SERVED_SINCE = 1705276800000  # 2024-01-15


def _fed_view(spark, folder):
    rows = price_view(spark, folder).select("rowkey", "identifier", "window_end", "current_price", "ticks")
    part = F.pmod(F.xxhash64("rowkey"), F.lit(4))
    view = jobs.view_of(spark, rows, work_folder(spark, "bounded"))
    view.upsert(rows.filter(part < 3).withColumn("ticks", F.when(part != 1, F.col("ticks"))), 0)
    view.compact()
    view.upsert(rows.filter(part == 1).withColumn("current_price", F.lit(None).cast("double")), 1)
    view.upsert(rows.filter(part == 3), 2)
    return view


_LIVE_ROWS = f"""WITH {o.KLINES}, {o.live_price()}, {o.LIVE_PRICE_VIEW}
SELECT rowkey, identifier, window_end, current_price, ticks FROM live_rows"""


@query("live_view_newer", f"{_LIVE_ROWS} WHERE identifier = 'ETHUSDT' AND window_end > {_SERVED_SINCE}")
def live_view_newer(spark, folder):
    """Rows of one symbol since a time: bounds on the key and the time reach all scans."""
    return _fed_view(spark, folder).read(prefix="BIN#ETHUSDT#", newer_than=_SERVED_SINCE)


@query("live_view_lookup", f"""{_LIVE_ROWS}
WHERE rowkey = (SELECT min(rowkey) FROM live_rows WHERE identifier = 'SOLUSDT')""")
def live_view_lookup(spark, folder):
    """One row by its key, from one bucket of the base."""
    view = _fed_view(spark, folder)
    return view.read(key=view.read(prefix="BIN#SOLUSDT#").agg(F.min("rowkey")).first()[0])


# Raw files arrive twice. The second arrival brings newer days, and late rows of a few old ones;
# only these days are judged again.
_ARRIVED, _LATE_DAY = "2024-01-20", "2024-01-10"


def arrivals(spark, folder):
    """(raw candles, raw market events, arrived at first) of the events, all as text."""
    events = feeds.events(spark, folder)
    late = (F.to_date("ts") == F.lit(_LATE_DAY).cast("date")) & (F.col("event_id") % 3 == 0)
    for first in (True, False):
        part = events.filter(((F.col("ts") < F.lit(_ARRIVED)) & ~late) == F.lit(first))
        klines = feeds.klines(part)
        text = [F.col(c).cast("string").alias(c) for c in klines.columns if c not in ("date", "event_id")]
        yield klines.select(*text), feeds.stored_market_events(part).drop("date")


@query("incremental_verdicts", RESULT_SQL)
def incremental_verdicts(spark, folder):
    root, out = work_folder(spark, "incremental"), work_folder(spark, "incremental-verdicts")
    tables = CleansedTables(spark, root, "ns")

    def take(kind, rows):
        rows.write.mode("append").parquet(f"{root}/raw/{kind}")
        stream = streams.table_stream(spark, f"{root}/raw/{kind}", rows.schema)
        monitor.drain(tables.start(kind, stream, f"{root}/checkpoints/{kind}"))

    with ThreadPoolExecutor(len(KINDS)) as side_by_side:
        for arrived in arrivals(spark, folder):
            list(side_by_side.map(take, KINDS, arrived))
            tables.judge(out)
    return rounded(spark.read.parquet(f"{out}/analysis").select(*RESULT_COLUMNS), "avg_volume", "avg_probability")


@query("legacy_live_view", f"""{LEGACY_LIVE_SQL}
SELECT symbol || '#' || CAST(9999999999999 - "timestamp" AS VARCHAR) AS rowkey, symbol AS identifier,
  "timestamp" AS window_end, binance_price, poly_last_trade, poly_best_bid, poly_best_ask, implied_prob
FROM legacy""")
def legacy_live_view(spark, folder):
    running, view = jobs.start_event_rows(
        legacy_live_events(_events(spark, folder)), work_folder(spark, "legacy-live"),
        _options(spark, "legacy"))
    monitor.drain(running)
    return view.read().drop("event_key")


def _arrive(rows, root, *slices):
    """Appends slices of a table as files, each as many, so that one slice can be one micro-batch;
    returns the number of files of a slice."""
    files = rows.sparkSession.sparkContext.defaultParallelism
    for part in slices:
        rows.filter(part).repartition(files).write.mode("append").parquet(root)
    written = len(rows.sparkSession.read.parquet(root).inputFiles())
    return max(1, written // len(slices))


# Events arrive in three batches by time; some of the first come again with a fourth, long behind
# the watermark, and are dropped. Every window is updated by the batch that it lies in.
FIRST, SECOND = "2024-01-10", "2024-01-20"


def _by_time():
    return (F.col("ts") < F.lit(FIRST), (F.col("ts") >= F.lit(FIRST)) & (F.col("ts") < F.lit(SECOND)),
            F.col("ts") >= F.lit(SECOND))


# Also how many were dropped: rows that came, by the lasting table of totals, less those in a window.
@query("stream_late_rows", f"""WITH {o.KLINES.replace("klines AS", "all_klines AS", 1)}, klines AS (
  SELECT * FROM all_klines WHERE NOT (ts < TIMESTAMP '{FIRST}' AND event_id % 20 = 0)),
{o.live_price()}, {o.LIVE_PRICE_VIEW}
SELECT rowkey, window_end, current_price, min_price, max_price, ticks,
  (SELECT count(*) FROM all_klines WHERE ts < TIMESTAMP '{FIRST}' AND event_id % 20 = 0) AS dropped FROM live_rows""")
def stream_late_rows(spark, folder):
    root, events = work_folder(spark, "arrivals"), feeds.events(spark, folder)
    first, second, third = _by_time()
    late = first & (F.col("event_id") % 20 == 0)
    files = _arrive(events, root, first & ~late, second, third, late)
    stream = streams.table_stream(spark, root, feeds.EVENTS_SCHEMA, files)
    view, progress = _counted(spark, stream, work_folder(spark, "totals"))
    arrived = progress.totals().select(F.col("observed.ticks").alias("_arrived"))
    shown = view.agg(F.sum("ticks").alias("_shown"))
    dropped = arrived.crossJoin(shown).select((F.col("_arrived") - F.col("_shown")).alias("dropped"))  # one row
    return view.select("rowkey", "window_end", "current_price", "min_price", "max_price", "ticks").crossJoin(dropped)


def _counted(spark, events, totals):
    """The live price view of a stream, and the table of what its micro-batches did."""
    progress = monitor.ProgressTable(spark, totals)
    spark.streams.addListener(progress)
    try:
        raw = monitor.observed(feeds.kline_messages(events), ticks=F.count(F.lit(1)))
        options = jobs.StreamOptions(work_folder(spark, "checkpoint-counted"), trigger=None, name="counted-prices")
        running, view = jobs.start_live_windows(raw, PRICE_ROWS, work_folder(spark, "live-counted"), options)
        monitor.drain(running)
        progress.wait_for(running)
    finally:
        spark.streams.removeListener(progress)
    return view.read(), progress


# Every slice but the first begins with the last hours of the one before, as a backfill does.
@query("stream_drop_repeated", f"WITH {o.KLINES} SELECT event_id, symbol, snapshot_time, close FROM klines")
def stream_drop_repeated(spark, folder):
    root, path = work_folder(spark, "backfill"), work_folder(spark, "stream-distinct")
    starts = ["2024-01-01", FIRST, "2024-01-15", SECOND, "2024-01-25", "2025-01-01"]
    slices = [(F.col("ts") >= F.lit(begin).cast("timestamp") - F.expr("INTERVAL 6 HOURS")) & (F.col("ts") < F.lit(end))
              for begin, end in zip(starts, starts[1:])]
    files = _arrive(feeds.events(spark, folder), root, *slices)
    captured = feeds.klines(streams.table_stream(spark, root, feeds.EVENTS_SCHEMA, files))
    distinct = drop_repeated_within(captured, "12 hours")
    monitor.drain(jobs.start_parquet(distinct, path, _options(spark, "distinct")))
    return spark.read.parquet(path).select("event_id", "symbol", "snapshot_time", "close")


# A backlog taken in micro-batches of bounded bytes: a slice of files each, whatever their number.
@query("stream_admission", f"""WITH {o.KLINES}, {o.live_price()}, {o.LIVE_PRICE_VIEW}
SELECT identifier, sum(ticks)::BIGINT AS ticks, true AS bounded FROM live_rows GROUP BY 1""")
def stream_admission(spark, folder):
    root = work_folder(spark, "backlog")
    files = _arrive(feeds.events(spark, folder), root, *_by_time())
    sizes = [r[0] for r in spark.read.format("binaryFile").load(root).select("length").collect()]  # a row a file
    limit = max(max(sizes), sum(sizes) // 4)
    stream = streams.table_stream(spark, root, feeds.EVENTS_SCHEMA, max_bytes=limit)
    # Bytes cut the files of a slice, whose rows span its whole time: none of them counts as late.
    running, view = jobs.start_live_windows(feeds.kline_messages(stream), PRICE_ROWS, work_folder(spark, "admitted"),
                                            _options(spark, "admitted"), Settings(watermark="60 days"))
    monitor.drain(running)
    taken = sum(p["numInputRows"] > 0 for p in running.recentProgress)
    bounded = -(-sum(sizes) // limit) <= taken <= len(sizes) and files >= 1
    return view.read().groupBy("identifier").agg(F.sum("ticks").alias("ticks")).withColumn("bounded", F.lit(bounded))


# The three queries of the live job, side by side on the same session.
@query("live_job", f"""WITH {o.KLINES}, {o.live_price()}, {o.BOOKS},
{o.LIVE_BOOK}, {o.LIVE_TRADES}
SELECT 'BIN' AS row_type, symbol AS identifier, count(*) AS windows, sum(ticks)::BIGINT AS messages
FROM live_price GROUP BY ALL
UNION ALL SELECT 'PB', market_id, count(*), sum(num_updates)::BIGINT FROM live_book GROUP BY ALL
UNION ALL SELECT 'PT', market_id, count(*), sum(num_trades)::BIGINT FROM live_trades GROUP BY ALL""")
def live_job(spark, folder):
    started = live.start_all(
        feeds.kline_messages(_events(spark, folder)), feeds.market_messages(_events(spark, folder)),
        work_folder(spark, "live-job"), work_folder(spark, "live-job-checkpoints"), trigger=None)
    monitor.drain(*[running for running, _ in started.values()])
    counted = {PRICE_ROWS: "ticks", BOOK_ROWS: "num_updates", TRADE_ROWS: "num_trades"}
    parts = [started[kind][1].read().groupBy("identifier").agg(
        F.count(F.lit(1)).alias("windows"), F.sum(column).alias("messages"))
        .select(F.lit(kind).alias("row_type"), "identifier", "windows", "messages") for kind, column in counted.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# Append mode writes a window once the watermark (newest event less two minutes) passed its end.
@query("stream_to_parquet", f"""WITH {o.KLINES}, {o.live_price()}
SELECT window_start, window_end, symbol, current_price, min_price, max_price, ticks FROM live_price
WHERE window_end <= (SELECT date_trunc('milliseconds', max(ts)) FROM klines) - INTERVAL '2 minutes'""")
def stream_to_parquet(spark, folder):
    path = work_folder(spark, "stream-parquet")
    live = jobs.price_windows(feeds.kline_messages(_events(spark, folder)))
    monitor.drain(jobs.start_parquet(live, path, _options(spark, "parquet")))
    return spark.read.parquet(path).select("window_start", "window_end", "symbol", "current_price",
                                           "min_price", "max_price", "ticks")


# Slices by time in several micro-batches; the query stops in between and goes on from its checkpoint.
@query("stream_sample_snapshots", ORACLES["sample_snapshots"])
def stream_sample_snapshots(spark, folder):
    root, path, checkpoint = (work_folder(spark, name) for name in ("captured", "thinned", "checkpoint-thinned"))
    events = feeds.events(spark, folder)
    first, second, third = _by_time()
    for slices in ((first, second), (third,)):
        files = _arrive(events, root, *slices)
        captured = feeds.klines(streams.table_stream(spark, root, feeds.EVENTS_SCHEMA, files))
        with thinning.keyed_state(spark):
            running = jobs.start_parquet(thinning.thinned(captured, THIN_SECONDS, tie="event_id"), path,
                                         jobs.StreamOptions(checkpoint, trigger=None))
        monitor.drain(running)
    return spark.read.parquet(path).select("event_id", "symbol", "snapshot_time", "is_closed")
