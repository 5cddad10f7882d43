"""Queries over row keys, views, cells and the serving operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from oddsline.config import BATCH_CELLS, BOOK_ROWS, LIVE_CELLS, PRICE_ROWS, TRADE_ROWS
from oddsline.functions import rowkeys
from oddsline.functions.book import mid_probability, with_top_of_book
from oddsline.functions.rounding import half_away
from oddsline.operators import serving, views, windows
from oddsline.plans import batch, oracle_feeds as o
from oddsline.plans.queries_windows import (books, stored, ticks, token_verdicts, tokens,
                                            trades, verdicts)
from oddsline.plans.registry import query, rounded
from oddsline.sources import feeds, tables


def served_batch_view(spark, folder):
    """The stored batch view as of the last batch run."""
    events = feeds.events(spark, folder)
    klines = feeds.klines(events).filter(
        F.timestamp_micros(F.call_function("div", F.col("timestamp"), F.lit(1000)))
        < F.lit(o.CUTOFF).cast("timestamp"))
    analysis = batch.verdicts(klines, feeds.stored_market_events(events),
                              tokens=tokens(spark, folder))
    return stored(spark, views.batch_view(analysis), "served-view")


def stored_batch_view(spark, folder):
    """The stored batch view over all windows."""
    return stored(spark, views.batch_view(token_verdicts(spark, folder)), "batch-view")


def price_view(spark, folder):
    return views.live_view(windows.live_price(ticks(spark, folder)), PRICE_ROWS)


def stored_price_view(spark, folder):
    return stored(spark, price_view(spark, folder), "price-view")


# --- row keys ---------------------------------------------------------------

@query("batch_rowkey", f"""{o.VIEW_VERDICTS} SELECT rowkey, symbol, window_start FROM view_rows""")
def batch_rowkey(spark, folder):
    return token_verdicts(spark, folder).select(
        rowkeys.batch_rowkey("symbol", "window_start").alias("rowkey"), "symbol", "window_start")


@query("rowkeys", f"""WITH {o.KLINES}
SELECT event_id, upper(crypto) || '#' || CAST(snapshot_time // 1000 AS VARCHAR) AS window_end_key,
  upper(crypto) || '#' || CAST(9999999999999 - snapshot_time AS VARCHAR) AS event_key FROM klines""")
def all_rowkeys(spark, folder):
    loaded = tables.load_klines(feeds.klines(feeds.events(spark, folder)),
                                keep=("event_id", "snapshot_time"))
    seconds = F.call_function("div", F.col("snapshot_time"), F.lit(1000))
    return loaded.select("event_id", rowkeys.window_end_rowkey("crypto", seconds).alias("window_end_key"),
                         rowkeys.event_rowkey("crypto", "snapshot_time").alias("event_key"))


@query("live_rowkey", f"""WITH {o.KLINES}, {o.BOOKS}, {o.live_price()}, {o.LIVE_BOOK}, {o.LIVE_TRADES},
ends AS (
  SELECT 'BIN' AS row_type, symbol AS identifier, epoch_ms(window_end) AS end_ms FROM live_price
  UNION ALL SELECT 'PB', market_id, epoch_ms(window_end) FROM live_book
  UNION ALL SELECT 'PT', market_id, epoch_ms(window_end) FROM live_trades)
SELECT row_type, identifier,
  row_type || '#' || identifier || '#' || CAST(9999999999999 - end_ms AS VARCHAR) AS rowkey,
  row_type || '#' || left(identifier, 4) || '#' || CAST(9999999999999 - end_ms AS VARCHAR) AS short_key
FROM ends""")
def live_rowkey(spark, folder):
    ends = (
        (PRICE_ROWS, "symbol", windows.live_price(ticks(spark, folder))),
        (BOOK_ROWS, "market_id", windows.live_book(books(spark, folder))),
        (TRADE_ROWS, "market_id", windows.live_trades(trades(spark, folder))))
    parts = [live.select(
        F.lit(row_type).alias("row_type"), F.col(name).alias("identifier"),
        rowkeys.live_rowkey(row_type, name, F.unix_millis("window_end")).alias("rowkey"),
        rowkeys.live_rowkey(row_type, name, F.unix_millis("window_end"), 4).alias("short_key"))
        for row_type, name, live in ends]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# One key per event, of a form chosen by its number: three valid forms and two broken ones.
@query("parse_rowkeys", f"""WITH {o.KLINES}, forms AS (
  SELECT event_id, symbol, snapshot_time, trades % 5 AS form FROM klines)
SELECT event_id,
  CASE form WHEN 0 THEN symbol END AS batch_symbol,
  CASE form WHEN 0 THEN snapshot_time // 1000 END AS batch_epoch_s,
  CASE form WHEN 1 THEN 'BIN' END AS live_type,
  CASE WHEN form IN (1, 2) THEN symbol END AS live_identifier,
  CASE WHEN form IN (1, 2) THEN snapshot_time END AS live_epoch_ms,
  CASE form WHEN 2 THEN 9999999999999 - snapshot_time END AS plain_stamp
FROM forms""")
def parse_rowkeys(spark, folder):
    klines = feeds.klines(feeds.events(spark, folder))
    form = F.col("trades") % 5
    seconds = F.timestamp_seconds(F.call_function("div", F.col("snapshot_time"), F.lit(1000)))
    key = (F.when(form == 0, rowkeys.batch_rowkey("symbol", seconds))
           .when(form == 1, rowkeys.live_rowkey(PRICE_ROWS, "symbol", "snapshot_time"))
           .when(form == 2, rowkeys.event_rowkey("symbol", "snapshot_time"))
           .when(form == 3, F.concat(F.lit("no separator "), F.col("event_id").cast("string")))
           .otherwise(F.lit("")))
    parsed = klines.select("event_id", key.alias("key")).select(
        "event_id", rowkeys.parse_batch_rowkey("key").alias("b"),
        rowkeys.parse_live_rowkey("key").alias("l"), rowkeys.parse_plain_rowkey("key").alias("p"))
    return parsed.select(
        "event_id", F.col("b.symbol").alias("batch_symbol"), F.col("b.epoch_s").alias("batch_epoch_s"),
        F.col("l.row_type").alias("live_type"), F.col("l.identifier").alias("live_identifier"),
        F.col("l.epoch_ms").alias("live_epoch_ms"), F.col("p.stamp").alias("plain_stamp"))


# --- views and cells --------------------------------------------------------

VIEW_SELECT = """SELECT rowkey, "timestamp", crypto, symbol, price_open, price_close, price_high, price_low,
  round(avg_volume, 6) AS avg_volume, round(avg_probability, 6) AS avg_probability, max_probability,
  bet_activity_count, price_movement, actual_direction, predicted_direction, prediction_result
FROM view_rows"""


def round_view(df):
    return rounded(df, "avg_volume", "avg_probability")


@query("batch_view", f"{o.VIEW_VERDICTS} {VIEW_SELECT}")
def batch_view(spark, folder):
    return round_view(views.batch_view(token_verdicts(spark, folder)))


@query("live_view", f"""WITH {o.KLINES}, {o.live_price()}, {o.LIVE_PRICE_VIEW}
SELECT * REPLACE (round(avg_price, 6) AS avg_price, round(volatility, 6) AS volatility,
  round(total_volume, 4) AS total_volume, round(avg_sentiment, 6) AS avg_sentiment) FROM live_rows""")
def live_view(spark, folder):
    view = rounded(price_view(spark, folder), "avg_price", "volatility", "avg_sentiment")
    return rounded(view, "total_volume", digits=4)


_NUMERIC = {c for c in ("price_open", "price_close", "price_high", "price_low", "avg_volume",
                        "avg_probability", "max_probability", "bet_activity_count", "price_movement")}
_CELL_SQL = " UNION ALL ".join(
    f"SELECT rowkey, '{family}' AS family, '{qualifier}' AS qualifier, "
    + (f'round(CAST("{column}" AS DOUBLE), 6) AS number, CAST(NULL AS VARCHAR) AS word'
       if column in _NUMERIC else f'CAST(NULL AS DOUBLE) AS number, "{column}" AS word')
    + f' FROM view_rows WHERE "{column}" IS NOT NULL'
    for family, cells in BATCH_CELLS.items() for qualifier, column in cells.items())


@query("view_cells", f"{o.VIEW_VERDICTS} {_CELL_SQL}")
def view_cells(spark, folder):
    cells = views.to_cells(stored_batch_view(spark, folder), views.batch_cells())
    parsed = cells.withColumn("parsed", rowkeys.parse_cell("value"))
    number = F.coalesce(F.col("parsed.number"), F.col("parsed.whole").cast("double"))
    return parsed.select("rowkey", "family", "qualifier", half_away(number, 6).alias("number"),
                         F.col("parsed.word").alias("word"))


_BOOK_FAMILY, _BOOK_CELLS = LIVE_CELLS[BOOK_ROWS]
_BOOK_CELL_SQL = " UNION ALL ".join(
    f"SELECT rowkey, '{_BOOK_FAMILY}' AS family, '{qualifier}' AS qualifier, "
    + ('CAST(NULL AS DOUBLE) AS number, market_id AS word' if qualifier == "market_id"
       else f'round(CAST("{column}" AS DOUBLE), 6) AS number, CAST(NULL AS VARCHAR) AS word')
    + f' FROM book_rows WHERE "{column}" IS NOT NULL'
    for qualifier, column in _BOOK_CELLS.items())


@query("live_view_cells", f"""WITH {o.SOURCE}, {o.BOOKS}, {o.LIVE_BOOK}, book_rows AS (
  SELECT *, epoch_ms(window_end) AS window_end_ms,
    'PB#' || market_id || '#' || CAST(9999999999999 - epoch_ms(window_end) AS VARCHAR) AS rowkey
  FROM live_book) {_BOOK_CELL_SQL}""")
def live_view_cells(spark, folder):
    view = stored(spark, views.live_view(windows.live_book(books(spark, folder)), BOOK_ROWS), "book-view")
    cells = views.to_cells(view, views.live_cells(BOOK_ROWS))
    parsed = cells.withColumn("parsed", rowkeys.parse_cell("value"))
    number = F.coalesce(F.col("parsed.number"), F.col("parsed.whole").cast("double"))
    return parsed.select("rowkey", "family", "qualifier", half_away(number, 6).alias("number"),
                         F.col("parsed.word").alias("word"))


_TYPES = {"open": "double", "close": "double", "high": "double", "low": "double", "volume": "double",
          "avg_prob": "double", "max_prob": "double", "activity": "bigint", "price_movement": "double",
          "result": "string", "symbol": "string"}


@query("cells_to_rows", f"""{o.VIEW_VERDICTS}
SELECT rowkey, price_open AS open, price_close AS close, price_high AS high, price_low AS low,
  round(avg_volume, 6) AS volume, round(avg_probability, 6) AS avg_prob, max_probability AS max_prob,
  CAST(bet_activity_count AS BIGINT) AS activity, price_movement, prediction_result AS result, symbol
FROM view_rows""")
def cells_to_rows(spark, folder):
    cells = views.to_cells(stored_batch_view(spark, folder), views.batch_cells())
    return rounded(views.from_cells(cells, _TYPES), "volume", "avg_prob")


@query("view_families", f"""{o.VIEW_VERDICTS}
SELECT rowkey, price_close AS close, max_probability AS max_prob, prediction_result AS result
FROM view_rows""")
def view_families(spark, folder):
    grouped = views.families(stored_batch_view(spark, folder))
    return grouped.select("rowkey", "price_data.close", "bet_data.max_prob", "analysis.result")


@query("legacy_batch_frame", f"""{o.VERDICTS}
SELECT symbol, CAST(epoch(window_end) AS BIGINT) AS window_end_ts, window_open AS open,
  window_close AS close, window_high AS high, window_low AS low, round(avg_volume, 6) AS volume,
  CAST(NULL AS DOUBLE) AS volatility, round(avg_probability, 6) AS avg_prob_up,
  CAST(NULL AS DOUBLE) AS avg_prob_down, CAST(bet_activity_count AS DOUBLE) AS total_bet_vol,
  CAST(NULL AS DOUBLE) AS sentiment_score, prediction_result, CAST(NULL AS DOUBLE) AS divergence,
  upper(symbol) || '#' || CAST(CAST(epoch(window_end) AS BIGINT) AS VARCHAR) AS rowkey
FROM analysis""")
def legacy_batch_frame(spark, folder):
    given = verdicts(spark, folder).select(
        "symbol", (F.unix_seconds("window_start") + 900).alias("window_end_ts"),
        F.col("window_open").alias("open"), F.col("window_close").alias("close"),
        F.col("window_high").alias("high"), F.col("window_low").alias("low"),
        half_away("avg_volume", 6).alias("volume"), half_away("avg_probability", 6).alias("avg_prob_up"),
        F.col("bet_activity_count").alias("total_bet_vol"), "prediction_result")
    return views.legacy_batch_view(views.legacy_batch_frame(given))


LEGACY_LIVE_SQL = f"""WITH {o.KLINES}, {o.BOOKS}, legacy AS (
  SELECT symbol, snapshot_time AS "timestamp", close AS binance_price,
    CASE WHEN m.event_type = 'last_trade_price' THEN CAST(m.price AS DOUBLE) END AS poly_last_trade,
    b.best_bid AS poly_best_bid, b.best_ask AS poly_best_ask, b.mid_price_prob AS implied_prob
  FROM klines JOIN markets m USING (event_id) LEFT JOIN books b USING (event_id))"""


def legacy_live_events(events):
    """Older per-event live records: candle price with the market state of the same event."""
    tops = F.col("event_type") == "book"
    books = with_top_of_book(feeds.market_events(events))
    symbol = F.element_at(F.array(*[F.lit(s) for s in (
        "BTCUSDT", "ETHUSDT", "SOLUSDT", "XRPUSDT", "DOGEUSDT")]),
        (F.regexp_extract("asset_id", "([0-9]+)", 1).cast("bigint") % 5 + 1).cast("int"))
    price = F.lit(100.0) + F.regexp_extract("price", r"\.([0-9]+)", 1).cast("double") / F.lit(100.0)
    return books.select(
        "event_id", symbol.alias("symbol"), F.unix_millis("ts").alias("timestamp"), price.alias("binance_price"),
        F.when(~tops, F.col("price").try_cast("double")).alias("poly_last_trade"),
        F.when(tops, F.col("best_bid")).alias("poly_best_bid"),
        F.when(tops, F.col("best_ask")).alias("poly_best_ask"),
        F.when(tops, mid_probability("best_bid", "best_ask")).alias("implied_prob"))


@query("legacy_frames", f"{LEGACY_LIVE_SQL} SELECT * FROM legacy")
def legacy_frames(spark, folder):
    return views.legacy_live_frame(legacy_live_events(feeds.events(spark, folder)))


# --- scans over the views ---------------------------------------------------

@query("point_lookup", f"{o.VIEW_VERDICTS} {VIEW_SELECT} WHERE rowkey = (SELECT max(rowkey) FROM view_rows)")
def point_lookup(spark, folder):
    view = stored_batch_view(spark, folder)
    return round_view(serving.point_lookup(view, view.agg(F.max("rowkey")).first()[0]))


@query("prefix_scan", f"{o.VIEW_VERDICTS} {VIEW_SELECT} WHERE starts_with(rowkey, 'BTCUSDT_')")
def prefix_scan(spark, folder):
    view = stored_batch_view(spark, folder)
    return round_view(serving.prefix_scan(view, serving.batch_prefix("BTCUSDT")))


@query("range_scan", f"""{o.VIEW_VERDICTS}
SELECT rowkey, symbol, window_ts, prediction_result FROM view_rows
WHERE window_ts BETWEEN 1704672000 AND 1705276800""")
def range_scan(spark, folder):
    view = stored_batch_view(spark, folder)
    return serving.range_scan(view, 1704672000, 1705276800).select(
        "rowkey", "symbol", "window_ts", "prediction_result")


@query("sample_view", f"{o.VIEW_VERDICTS} {VIEW_SELECT} ORDER BY rowkey LIMIT 10")
def sample_view(spark, folder):
    return round_view(serving.sample_view(stored_batch_view(spark, folder), 10))


_LATEST_LIVE = f"""WITH {o.KLINES}, {o.live_price()}, {o.LIVE_PRICE_VIEW}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY identifier ORDER BY rowkey) AS rn FROM live_rows)
SELECT rowkey, identifier, window_end, current_price, ticks FROM ranked"""


@query("latest_live", f"{_LATEST_LIVE} WHERE rn <= 100")
def latest_live(spark, folder):
    return serving.latest_live(stored_price_view(spark, folder)).select(
        "rowkey", "identifier", "window_end", "current_price", "ticks")


@query("latest_live_pair", f"{_LATEST_LIVE} WHERE rn <= 20 AND identifier = 'SOLUSDT'")
def latest_live_pair(spark, folder):
    return serving.latest_live(stored_price_view(spark, folder), 20, "SOLUSDT").select(
        "rowkey", "identifier", "window_end", "current_price", "ticks")


@query("latest_events", f"""{LEGACY_LIVE_SQL}
SELECT 'ETHUSDT#' || CAST(9999999999999 - "timestamp" AS VARCHAR) AS rowkey, binance_price,
  poly_last_trade, poly_best_bid, poly_best_ask, implied_prob FROM legacy WHERE symbol = 'ETHUSDT'
ORDER BY "timestamp" DESC LIMIT 10""")
def latest_events(spark, folder):
    frame = views.legacy_live_frame(legacy_live_events(feeds.events(spark, folder)))
    view = stored(spark, views.event_view(frame), "event-view")
    return serving.latest_events(view, "ethusdt", 10).drop("identifier", "window_end")


@query("latest_n_windows", f"""{o.VIEW_VERDICTS}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY window_ts DESC) AS rn FROM view_rows)
SELECT rowkey, symbol, window_ts, prediction_result FROM ranked WHERE rn <= 96""")
def latest_n_windows(spark, folder):
    view = stored_batch_view(spark, folder)
    return serving.latest_windows(view).select("rowkey", "symbol", "window_ts", "prediction_result")


# --- merged views -----------------------------------------------------------

def _timeline_sql(shift: int) -> str:
    return f"""{o.SERVED_BOTH}, last AS (
  SELECT symbol, max(window_ts) + {shift} AS last_ts FROM view_rows GROUP BY symbol), points AS (
  SELECT identifier AS symbol, window_end // 1000 AS ts_s, current_price, ticks FROM live_rows)
SELECT symbol, window_ts + {shift} AS "timestamp", 'batch' AS source, 'window_summary' AS type,
  price_close AS close, prediction_result AS result, CAST(NULL AS DOUBLE) AS current_price,
  CAST(NULL AS BIGINT) AS ticks FROM view_rows
UNION ALL
SELECT p.symbol, ts_s, 'speed', 'live_point', NULL, NULL, current_price, ticks
FROM points p LEFT JOIN last l ON p.symbol = l.symbol WHERE ts_s > coalesce(last_ts, 0)"""


def _timeline(spark, folder, **options):
    merged = serving.merged_timeline(served_batch_view(spark, folder), stored_price_view(spark, folder), **options)
    return merged.select(
        "symbol", "timestamp", "source", "type", F.col("price_data.close").alias("close"),
        F.col("analysis.result").alias("result"), F.col("data.current_price").alias("current_price"),
        F.col("data.ticks").alias("ticks"))


@query("merged_timeline", _timeline_sql(900))
def merged_timeline(spark, folder):
    return _timeline(spark, folder, boundary="end")


@query("merged_timeline_by_start", _timeline_sql(0))
def merged_timeline_by_start(spark, folder):
    return _timeline(spark, folder, boundary="start")


# 2024-01-30 12:30 UTC, half an hour after the last batch run
NOW = 1706617800


@query("merged_timeline_of_symbol", f"""{o.SERVED_BOTH}, own AS (
  SELECT * FROM view_rows WHERE symbol = 'BTCUSDT' AND window_ts + 900 BETWEEN {NOW} - 86400 AND {NOW}), points AS (
  SELECT window_end // 1000 AS ts_s, current_price, ticks FROM live_rows
  WHERE identifier = 'BTCUSDT' AND window_end >= ({NOW} - 720 * 60)::BIGINT * 1000
    AND window_end // 1000 BETWEEN {NOW} - 86400 AND {NOW})
SELECT symbol, window_ts + 900 AS "timestamp", 'batch' AS source, 'window_summary' AS type,
  price_close AS close, prediction_result AS result, CAST(NULL AS DOUBLE) AS current_price,
  CAST(NULL AS BIGINT) AS ticks FROM own
UNION ALL
SELECT 'BTCUSDT', ts_s, 'speed', 'live_point', NULL, NULL, current_price, ticks
FROM points WHERE ts_s > coalesce((SELECT max(window_ts) + 900 FROM view_rows WHERE symbol = 'BTCUSDT'), 0)""")
def merged_timeline_of_symbol(spark, folder):
    """One symbol as a dashboard asks for it: the last 24 hours, live points of the last 12."""
    return _timeline(spark, folder, symbol="BTC", now=NOW, live_minutes=720)


# The symbols' last batch windows end at different times shortly before this range ends, and some
# symbols have windows after it: points count by the last window of the whole view.
PAST_FROM, PAST_UNTIL = 1706572800, 1706616900  # 2024-01-30 00:00 and 12:15


def _past_sql(start: int, end: int) -> str:
    return f"""{o.SERVED_BOTH}, last AS (
  SELECT symbol, max(window_ts) + 900 AS last_ts FROM view_rows GROUP BY symbol)
SELECT symbol, window_ts + 900 AS "timestamp", 'batch' AS source, price_close AS close,
  CAST(NULL AS DOUBLE) AS current_price FROM view_rows WHERE window_ts + 900 BETWEEN {start} AND {end}
UNION ALL
SELECT identifier, window_end // 1000, 'speed', NULL, current_price
FROM live_rows p LEFT JOIN last l ON p.identifier = l.symbol
WHERE window_end // 1000 BETWEEN {start} AND {end} AND window_end // 1000 > coalesce(last_ts, 0)"""


def _past(spark, folder, start, end):
    merged = serving.merged_timeline(served_batch_view(spark, folder), stored_price_view(spark, folder),
                                     start_s=start, end_s=end)
    return merged.select("symbol", "timestamp", "source", F.col("price_data.close").alias("close"),
                         F.col("data.current_price").alias("current_price"))


@query("merged_timeline_past", _past_sql(PAST_FROM - 10 * 86400, PAST_FROM))
def merged_timeline_past(spark, folder):
    """Ten days of the past, with batch windows after them: live points only of symbols without any."""
    return _past(spark, folder, PAST_FROM - 10 * 86400, PAST_FROM)


@query("merged_timeline_at_the_boundary", _past_sql(PAST_FROM, PAST_UNTIL))
def merged_timeline_at_the_boundary(spark, folder):
    return _past(spark, folder, PAST_FROM, PAST_UNTIL)


@query("current_state", f"""{o.SERVED_BOTH}, newest_live AS (
  SELECT identifier AS symbol, max(window_end) AS ms, arg_max(current_price, window_end) AS current_price
  FROM live_rows GROUP BY identifier), newest_batch AS (
  SELECT symbol, max(window_ts) AS s, arg_max(price_close, window_ts) AS close FROM view_rows
  WHERE window_ts BETWEEN {NOW} - 3600 AND {NOW} GROUP BY symbol)
SELECT coalesce(l.symbol, b.symbol) AS symbol,
  CASE WHEN l.symbol IS NULL THEN 'batch' ELSE 'speed' END AS source, coalesce(ms, s) AS "timestamp",
  current_price, CASE WHEN l.symbol IS NULL THEN close END AS close
FROM newest_live l FULL JOIN newest_batch b ON l.symbol = b.symbol""")
def current_state(spark, folder):
    state = serving.current_state(served_batch_view(spark, folder), stored_price_view(spark, folder), NOW)
    return state.select("symbol", "source", "timestamp",
                        F.col("data.current_price").alias("current_price"),
                        F.col("price_data.close").alias("close"))


@query("accuracy_recent", f"""{o.VIEW_VERDICTS}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY window_ts DESC) AS rn FROM view_rows)
SELECT symbol, count(*) AS windows_analyzed,
  count(*) FILTER (prediction_result LIKE 'CORRECT%') AS correct_predictions,
  count(*) FILTER (prediction_result NOT LIKE 'CORRECT%') AS wrong_predictions,
  CAST(count(*) FILTER (prediction_result LIKE 'CORRECT%') AS DOUBLE) / count(*) AS accuracy,
  min(window_start) AS first_window, max(window_start) AS last_window
FROM ranked WHERE rn <= 96 GROUP BY symbol""")
def accuracy_recent(spark, folder):
    return serving.recent_accuracy(stored_batch_view(spark, folder))


@query("accuracy_summary", f"""{o.VIEW_VERDICTS}, totals AS (
  SELECT count(*) AS total, count(*) FILTER (prediction_result LIKE 'CORRECT%') AS good,
    count(*) FILTER (prediction_result LIKE 'CORRECT%' OR prediction_result LIKE 'FAILED%') AS decided
  FROM view_rows), classes(prediction_result) AS (VALUES {o.RESULT_LIST}), counted AS (
  SELECT c.prediction_result, count(v.rowkey) AS n FROM classes c
  LEFT JOIN view_rows v ON v.prediction_result = c.prediction_result GROUP BY ALL)
SELECT prediction_result, n AS count,
  CASE WHEN total > 0 THEN CAST(n AS DOUBLE) * 100 / total ELSE CAST(0 AS DOUBLE) END AS percent, total,
  CASE WHEN decided > 0 THEN CAST(good AS DOUBLE) * 100 / decided END AS overall_accuracy
FROM counted, totals""")
def accuracy_summary(spark, folder):
    return serving.accuracy_summary(stored_batch_view(spark, folder))


@query("expire_view", f"""WITH {o.KLINES}, {o.live_price()}, {o.LIVE_PRICE_VIEW}
SELECT rowkey, window_end, ticks FROM live_rows WHERE window_end // 1000 > {NOW} - 86400""")
def expire_view(spark, folder):
    view = stored_price_view(spark, folder)
    return serving.expire(view, NOW, 86400, "window_end", 1000).select("rowkey", "window_end", "ticks")


_SYMBOL_ACCURACY = f"""{o.VIEW_VERDICTS}, ranked AS (
  SELECT *, row_number() OVER (ORDER BY window_ts DESC) AS rn FROM view_rows WHERE symbol = '{{0}}')
SELECT '{{0}}' AS symbol, count(*) AS windows_analyzed,
  count(*) FILTER (prediction_result LIKE 'CORRECT%') AS correct_predictions,
  count(*) FILTER (prediction_result NOT LIKE 'CORRECT%') AS wrong_predictions,
  CASE WHEN count(*) > 0 THEN CAST(count(*) FILTER (prediction_result LIKE 'CORRECT%') AS DOUBLE) / count(*) END AS accuracy,
  min(window_start) AS first_window, max(window_start) AS last_window
FROM ranked WHERE rn <= 96"""


@query("symbol_accuracy", _SYMBOL_ACCURACY.format("ETHUSDT"))
def symbol_accuracy(spark, folder):
    return serving.symbol_accuracy(stored_batch_view(spark, folder), "ETH")


@query("symbol_accuracy_without_windows", _SYMBOL_ACCURACY.format("NONEUSDT"))
def symbol_accuracy_without_windows(spark, folder):
    return serving.symbol_accuracy(stored_batch_view(spark, folder), "NONE")
