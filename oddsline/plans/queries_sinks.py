"""Queries that write a table below the shared folder and read it back."""

from __future__ import annotations

import atexit
import datetime as dt
import uuid

from pyspark.sql import functions as F

from oddsline import schemas
from oddsline.functions import rowkeys
from oddsline.operators import views
from oddsline.plans import batch, oracle_feeds as o
from oddsline.plans.queries_views import VIEW_SELECT, round_view
from oddsline.plans.queries_windows import token_verdicts, verdicts
from oddsline.plans.registry import query, rounded
from oddsline.session import work_folder
from oddsline.sinks import tables as sinks
from oddsline.sources import feeds, footers, metadata, tables


_TABLES: dict[tuple[str, str], str] = {}


def _klines_table(spark, folder):
    """An external candle table over date folders, made once per session and folder and
    dropped from the catalog at the end; returns its name."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _TABLES:
        path = work_folder(spark, "klines")
        klines = feeds.klines(feeds.events(spark, folder)).drop("event_id")
        sinks.write_cleansed(klines, path, sort=("symbol",))
        name = f"klines_{uuid.uuid4().hex[:12]}"
        tables.create_klines_table(spark, name, path)
        tables.repair_partitions(spark, name)
        _TABLES[key] = name
        atexit.register(_drop, spark, key)
    return _TABLES[key]


def _drop(spark, key):
    name = _TABLES.pop(key)
    try:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    except Exception:  # the session, and its catalog with it, has ended before
        return


_SCAN = f"""WITH {o.KLINES}
SELECT ts AS binance_time, crypto, symbol, open, high, low, close, volume, date FROM klines"""


@query("klines_table_scan", _SCAN)
def klines_table_scan(spark, folder):
    return tables.load_klines(spark.table(_klines_table(spark, folder)))


# The date argument of a daily run: only that partition is read.
@query("klines_of_date", f"{_SCAN} WHERE date = DATE '2024-01-15'")
def klines_of_date(spark, folder):
    return tables.load_klines(spark.table(_klines_table(spark, folder)), date="2024-01-15")


@query("list_partitions", f"""WITH {o.KLINES}
SELECT DISTINCT 'date=' || CAST(date AS VARCHAR) AS partition FROM klines""")
def list_partitions(spark, folder):
    return tables.list_partitions(spark, _klines_table(spark, folder))


@query("expired_partitions", f"""WITH {o.KLINES}
SELECT DISTINCT 'date=' || CAST(date AS VARCHAR) AS partition, date FROM klines
WHERE date < DATE '2024-02-10' - INTERVAL 30 DAY""")
def expired_partitions(spark, folder):
    listed = tables.list_partitions(spark, _klines_table(spark, folder))
    return sinks.expired_partitions(listed, dt.date(2024, 2, 10))


# Answers from the footers of the stored files.
def _stored_paths(spark, folder):
    events = feeds.events(spark, folder)
    paths = work_folder(spark, "footer-klines"), work_folder(spark, "footer-events")
    klines = feeds.klines(events).withColumn("timestamp", F.col("snapshot_time"))
    sinks.write_cleansed(sinks.cleanse_klines(klines.drop("date")), paths[0], sort=("symbol",))
    sinks.write_cleansed(sinks.cleanse_market_events(feeds.stored_market_events(events)), paths[1], sort=("market",))
    return paths


@query("stored_bounds", f"""WITH {o.KLINES}
SELECT date, count(*) AS rows, min(snapshot_time) AS min_snapshot_time, max(snapshot_time) AS max_snapshot_time,
  min(close) AS min_close, max(close) AS max_close, min(trades) AS min_trades, max(trades) AS max_trades
FROM klines WHERE date BETWEEN DATE '2024-01-05' AND DATE '2024-01-25' GROUP BY date""")
def stored_bounds(spark, folder):
    path, _ = _stored_paths(spark, folder)
    return footers.stored_bounds(spark, path, schemas.CLEANSED_KLINES, "snapshot_time", "close", "trades",
                                 date="2024-01-05", until="2024-01-25")


@query("stored_coverage", f"""WITH {o.KLINES}, {o.MARKETS}
SELECT 'klines' AS table_name, min(date) AS first_date, max(date) AS last_date, count(DISTINCT date) AS dates,
  count(*) AS rows FROM klines
UNION ALL SELECT 'events', min(date), max(date), count(DISTINCT date), count(*) FROM markets""")
def stored_coverage(spark, folder):
    klines, events = _stored_paths(spark, folder)
    return footers.stored_coverage(spark, klines=(klines, schemas.CLEANSED_KLINES),
                                   events=(events, schemas.CLEANSED_EVENTS))


@query("stored_rows", "SELECT count(*) AS rows FROM events")
def stored_rows(spark, folder):
    return footers.stored_rows(spark, _stored_paths(spark, folder)[0])


RESULT_COLUMNS = ("window_start", "crypto", "symbol", "window_open", "window_high", "window_low", "window_close",
                  "avg_volume", "avg_probability", "max_probability", "bet_activity_count", "price_movement",
                  "actual_direction", "predicted_direction", "prediction_result")
RESULT_SQL = f"""{o.VERDICTS}
SELECT window_start, crypto, symbol, window_open, window_high, window_low, window_close,
  round(avg_volume, 6) AS avg_volume, round(avg_probability, 6) AS avg_probability, max_probability,
  bet_activity_count, price_movement, actual_direction, predicted_direction, prediction_result
FROM analysis"""


@query("write_result", RESULT_SQL)
def write_result(spark, folder):
    """All days, then one of them again: the others stay."""
    path = work_folder(spark, "analysis")
    analysis = verdicts(spark, folder)
    sinks.write_result(analysis, path)
    sinks.write_result(analysis.filter(F.to_date("window_start") == F.lit("2024-01-15").cast("date")), path)
    return rounded(spark.read.parquet(path).drop("date"), "avg_volume", "avg_probability")


# The bets of a day, and of all days of a range, are withdrawn; judging them again leaves them empty.
_WITHDRAWN, _WITHDRAWN_FROM = "2024-01-15", "2024-01-28"


@query("rejudged_days", f"""{RESULT_SQL}
WHERE CAST(window_start AS DATE) <> DATE '{_WITHDRAWN}' AND CAST(window_start AS DATE) < DATE '{_WITHDRAWN_FROM}'""")
def rejudged_days(spark, folder):
    """The batch job over all days, then again over a day and a range without bets."""
    out, events = work_folder(spark, "rejudged"), feeds.events(spark, folder)
    klines, market = feeds.klines(events), feeds.stored_market_events(events)
    day = F.col("date")
    left = market.filter((day != F.lit(_WITHDRAWN).cast("date")) & (day < F.lit(_WITHDRAWN_FROM).cast("date")))
    batch.run(spark, klines, market, out)
    batch.run(spark, klines, left, out, date=_WITHDRAWN)
    batch.run(spark, klines, left, out, date=_WITHDRAWN_FROM, until="2024-12-31")
    judged = spark.read.parquet(f"{out}/analysis")
    keys = spark.read.parquet(f"{out}/view").select("rowkey").distinct()
    kept = judged.withColumn("rowkey", rowkeys.batch_rowkey("symbol", "window_start")).join(keys, "rowkey")
    return rounded(kept.drop("date", "rowkey").select(*RESULT_COLUMNS), "avg_volume", "avg_probability")


def cleansed_tables(spark, folder):
    """Raw candles (nanoseconds, as text) and market events, cleansed, stored and read again."""
    events = feeds.events(spark, folder)
    klines = feeds.klines(events)
    raw = klines.select(*[F.col(c).cast("string").alias(c) for c in klines.columns if c != "date"])
    paths = work_folder(spark, "cleansed-klines"), work_folder(spark, "cleansed-events")
    sinks.write_cleansed(sinks.cleanse_klines(raw, "ns"), paths[0], sort=("symbol",))
    sinks.write_cleansed(sinks.cleanse_market_events(feeds.stored_market_events(events)), paths[1], sort=("market",))
    return tuple(spark.read.parquet(path) for path in paths)


@query("cleansed_verdicts", RESULT_SQL)
def cleansed_verdicts(spark, folder):
    """The whole chain: raw, cleansed, stored, loaded without a unit, judged."""
    return rounded(batch.verdicts(*cleansed_tables(spark, folder)), "avg_volume", "avg_probability")


@query("market_events_table", f"""WITH {o.SOURCE}, {o.MARKETS}
SELECT market, asset_id, poly_time AS event_time,
  CASE WHEN raw_type <> 'click' THEN CAST(price AS DOUBLE) END AS last_trade_price, event_type, date FROM markets""")
def market_events_table(spark, folder):
    """The catalog table of cleansed market events."""
    path = work_folder(spark, "cleansed-events")
    stored = feeds.stored_market_events(feeds.events(spark, folder))
    sinks.write_cleansed(sinks.cleanse_market_events(stored), path, sort=("market",))
    name = f"market_events_{uuid.uuid4().hex[:12]}"
    tables.create_market_events_table(spark, name, path, cleansed=True)
    tables.repair_partitions(spark, name)
    rows = spark.table(name).select("market", "asset_id", "event_time", "last_trade_price", "event_type", "date")
    _TABLES[spark.sparkContext.applicationId, path] = name
    atexit.register(_drop, spark, (spark.sparkContext.applicationId, path))
    return rows


@query("write_batch_view", f"{o.VIEW_VERDICTS} {VIEW_SELECT}")
def write_batch_view(spark, folder):
    path = work_folder(spark, "batch-view")
    analysis = work_folder(spark, "analysis")
    sinks.write_result(token_verdicts(spark, folder), analysis)
    view = views.batch_view(spark.read.parquet(analysis))
    sinks.write_batch_view(view, path)
    sinks.write_batch_view(view, path)  # running the job again must not change the view
    return round_view(sinks.read_batch_view(spark, path).drop("date"))


@query("write_raw_klines", f"""WITH {o.KLINES}
SELECT event_id, symbol, date, snapshot_time AS "timestamp", close, is_closed FROM klines""")
def write_raw_klines(spark, folder):
    path = work_folder(spark, "raw-klines")
    captured = feeds.klines(feeds.events(spark, folder)).withColumn("timestamp", F.col("snapshot_time"))
    sinks.write_raw_klines(captured.drop("date"), path)
    return spark.read.parquet(path).select("event_id", "symbol", "date", "timestamp", "close", "is_closed")


@query("cleanse_klines", f"""WITH {o.KLINES}
SELECT snapshot_time AS "timestamp", epoch_ms(snapshot_time) AS event_time, snapshot_time, open, high, low, close, volume, close_time,
  quote_asset_volume, trades, taker_buy_base, taker_buy_quote, symbol, is_closed, date FROM klines""")
def cleanse_klines(spark, folder):
    path = work_folder(spark, "cleansed-klines")
    klines = feeds.klines(feeds.events(spark, folder)).withColumn("timestamp", F.col("snapshot_time"))
    raw = klines.select(*[F.col(c).cast("string").alias(c) for c in klines.columns if c != "date"])
    sinks.write_cleansed(sinks.cleanse_klines(raw), path, sort=("symbol",))
    return spark.read.parquet(path)


@query("cleanse_events", f"""WITH {o.SOURCE}, {o.MARKETS}
SELECT market, asset_id, poly_time AS event_time,
  CASE WHEN raw_type <> 'click' THEN CAST(price AS DOUBLE) END AS last_trade_price, event_type, date,
  bid1 AS first_bid FROM markets""")
def cleanse_events(spark, folder):
    path = work_folder(spark, "cleansed-events")
    stored = feeds.stored_market_events(feeds.events(spark, folder))
    sinks.write_cleansed(sinks.cleanse_market_events(stored), path, sort=("market",))
    return spark.read.parquet(path).select(
        "market", "asset_id", "event_time", "last_trade_price", "event_type", "date",
        F.try_element_at("bids", F.lit(1))["price"].try_cast("double").alias("first_bid"))


@query("write_metadata", f"""WITH {o.SOURCE}
SELECT CAST(floor(epoch(ts) / 900) AS BIGINT) * 900 AS start_s, CAST(ts AS DATE) AS date,
  CASE user_id % 4 WHEN 0 THEN 'btc' WHEN 1 THEN 'eth' WHEN 2 THEN 'sol' ELSE 'xrp' END AS crypto,
  position, CAST(event_id AS VARCHAR) || suffix AS token_id
FROM src, (VALUES (CAST(0 AS INTEGER), '-up'), (CAST(1 AS INTEGER), '-down')) AS t(position, suffix)""")
def write_metadata(spark, folder):
    path = work_folder(spark, "metadata")
    sinks.write_metadata(feeds.metadata_messages(feeds.markets_of_events(feeds.events(spark, folder))), path)
    stored = spark.read.schema("start_s bigint, value string, date date").json(path)
    return metadata.token_ids(stored, carry=("start_s", "date"))
