"""Queries over scans, message decoding, metadata and derived columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from oddsline.config import CRYPTO_KEYWORDS
from oddsline.functions import book, symbols, times, verdict
from oddsline.plans import oracle_feeds as o
from oddsline.plans.registry import query
from oddsline.sources import feeds, messages, metadata, tables

# --- scans ------------------------------------------------------------------


@query("load_klines", f"""WITH {o.KLINES}
SELECT ts AS binance_time, crypto, symbol, open, high, low, close, volume, date FROM klines""")
def load_klines(spark, folder):
    return tables.load_klines(feeds.klines(feeds.events(spark, folder)))


@query("load_probabilities", f"""WITH {o.SOURCE}, {o.PROBABILITIES}
SELECT poly_time, crypto, asset_id, market, price, event_type, date FROM probabilities""")
def load_probabilities(spark, folder):
    return tables.load_probabilities(feeds.stored_market_events(feeds.events(spark, folder)))


@query("kline_count", f"WITH {o.KLINES} SELECT count(*) AS rows FROM klines")
def kline_count(spark, folder):
    return feeds.klines(feeds.events(spark, folder)).agg(F.count(F.lit(1)).alias("rows"))


@query("distinct_symbols", f"WITH {o.KLINES} SELECT DISTINCT symbol FROM klines")
def distinct_symbols(spark, folder):
    return feeds.klines(feeds.events(spark, folder)).select("symbol").distinct()


@query("latest_snapshots", f"""WITH {o.KLINES}
SELECT symbol, "timestamp", snapshot_time, close FROM klines WHERE snapshot_time IS NOT NULL
ORDER BY snapshot_time DESC, symbol, "timestamp" DESC, close DESC LIMIT 5""")
def latest_snapshots(spark, folder):
    return tables.latest_snapshots(feeds.klines(feeds.events(spark, folder)))


@query("source_row_counts", f"""WITH {o.KLINES}, {o.MARKETS}
SELECT 'klines' AS table_name, count(*) AS rows FROM klines
UNION ALL SELECT 'market_events' AS table_name, count(*) AS rows FROM markets""")
def source_row_counts(spark, folder):
    events = feeds.events(spark, folder)
    return tables.row_counts(klines=feeds.klines(events),
                             market_events=feeds.stored_market_events(events))


@query("date_coverage", f"""WITH {o.KLINES}, {o.MARKETS}
SELECT 'klines' AS table_name, min(date) AS first_date, max(date) AS last_date,
  count(DISTINCT date) AS dates, count(*) AS rows FROM klines
UNION ALL
SELECT 'market_events' AS table_name, min(date) AS first_date, max(date) AS last_date,
  count(DISTINCT date) AS dates, count(*) AS rows FROM markets""")
def date_coverage(spark, folder):
    events = feeds.events(spark, folder)
    return tables.date_coverage(klines=feeds.klines(events),
                                market_events=feeds.stored_market_events(events))


@query("rows_per_date_symbol", f"""WITH {o.KLINES}
SELECT date, symbol, count(*) AS rows FROM klines GROUP BY ALL""")
def rows_per_date_symbol(spark, folder):
    return tables.counts_per(feeds.klines(feeds.events(spark, folder)), "date", "symbol")


# --- messages ---------------------------------------------------------------

@query("decode_klines_json", f"""WITH {o.KLINES}
SELECT event_id, snapshot_time AS "timestamp", snapshot_time, symbol, close, volume,
  quote_asset_volume, trades, taker_buy_base, taker_buy_quote FROM klines""")
def decode_klines_json(spark, folder):
    return messages.decode_klines(feeds.kline_messages(feeds.events(spark, folder)),
                                  carry=("event_id",))


@query("decode_market_events", f"""WITH {o.SOURCE}, {o.MARKETS}
SELECT event_id, market AS market_id, event_type, event_time, CAST(price AS DOUBLE) AS price,
  value AS size, bid1 AS first_bid, ask2 AS last_ask, CAST(2 AS INTEGER) AS bid_levels FROM markets""")
def decode_market_events(spark, folder):
    decoded = messages.decode_market_events(feeds.market_messages(feeds.events(spark, folder)),
                                            carry=("event_id",))
    return decoded.select(
        "event_id", "market_id", "event_type", "event_time",
        F.col("price").try_cast("double").alias("price"),
        F.col("size").try_cast("double").alias("size"),
        F.try_element_at("bids", F.lit(1))["price"].try_cast("double").alias("first_bid"),
        F.try_element_at("asks", F.lit(-1))["price"].try_cast("double").alias("last_ask"),
        F.size("bids").alias("bid_levels"))


@query("clean_message_log", f"""WITH {o.SOURCE}
SELECT event_id, '{{"event_type":"' || event_type || '","user":' || CAST(user_id AS VARCHAR)
  || ',"k":' || CAST(k AS VARCHAR) || '}}' AS value FROM src WHERE k >= 10""")
def clean_message_log(spark, folder):
    return messages.clean_message_log(feeds.log_lines(feeds.events(spark, folder)))


@query("decode_historical_klines", f"""WITH {o.KLINES}
SELECT event_id, symbol, snapshot_time AS "timestamp", open, high, low, close, volume, close_time,
  quote_asset_volume, trades, taker_buy_base, taker_buy_quote, true AS is_closed,
  close_time AS snapshot_time, date FROM klines""")
def decode_historical_klines(spark, folder):
    return messages.decode_historical_klines(
        feeds.historical_messages(feeds.events(spark, folder)), carry=("event_id",))


# --- metadata ---------------------------------------------------------------

def _markets(spark, folder):
    return feeds.markets_of_orders(feeds.table(spark, folder, "orders"))


@query("token_ids", f"""WITH {o.ORDERS}
SELECT event_id, crypto, position, CAST(event_id AS VARCHAR) || suffix AS token_id
FROM info, (VALUES (CAST(0 AS INTEGER), '-up'), (CAST(1 AS INTEGER), '-down')) AS t(position, suffix)""")
def token_ids(spark, folder):
    return metadata.token_ids(feeds.metadata_messages(_markets(spark, folder)),
                              carry=("event_id",))


@query("market_outcomes", f"""WITH {o.ORDERS}
SELECT event_id, CAST(event_id AS VARCHAR) AS market_id, slug, position, outcome,
  CAST('0.' || lpad(CAST(CASE position WHEN 0 THEN up ELSE 99 - up END AS VARCHAR), 2, '0') AS DOUBLE)
    AS price, CAST(event_id AS VARCHAR) || suffix AS token_id
FROM info, (VALUES (CAST(0 AS INTEGER), 'Up', '-up'), (CAST(1 AS INTEGER), 'Down', '-down'))
  AS t(position, outcome, suffix)""")
def market_outcomes(spark, folder):
    return metadata.market_outcomes(feeds.market_objects(_markets(spark, folder)),
                                    carry=("event_id",))


@query("event_slug", f"""WITH {o.KLINES}
SELECT event_id, crypto || '-updown-15m-'
    || CAST(CAST(floor(epoch(ts) / 900) AS BIGINT) * 900 AS VARCHAR) AS slug,
  left(crypto, 3) AS crypto_key, CAST(floor(epoch(ts) / 900) AS BIGINT) * 900 AS start_s FROM klines""")
def event_slug(spark, folder):
    loaded = feeds.klines(feeds.events(spark, folder))
    slugs = loaded.select("event_id", symbols.event_slug(
        symbols.symbol_to_crypto("symbol"), times.epoch_to_timestamp("timestamp", "ns")).alias("slug"))
    return slugs.select("event_id", "slug", symbols.slug_crypto("slug").alias("crypto_key"),
                        symbols.slug_epoch("slug").alias("start_s"))


@query("closed_events", f"""WITH {o.ORDERS}
SELECT event_id, crypto, slug, title, closed, start_s FROM info WHERE closed""")
def closed_events(spark, folder):
    return metadata.events_page(feeds.stored_events(_markets(spark, folder)), closed=True)


@query("events_page", f"""WITH {o.ORDERS}
SELECT event_id, crypto, slug, title, closed, start_s FROM info WHERE NOT closed
ORDER BY event_id LIMIT 50 OFFSET 100""")
def events_page(spark, folder):
    return metadata.events_page(feeds.stored_events(_markets(spark, folder)),
                                closed=False, limit=50, offset=100, order="event_id")


# --- derived columns --------------------------------------------------------

@query("event_time_ms", f"""WITH {o.KLINES}
SELECT event_id, date_trunc('milliseconds', ts) AS event_time FROM klines""")
def event_time_ms(spark, folder):
    return feeds.klines(feeds.events(spark, folder)).select(
        "event_id", times.epoch_to_timestamp("snapshot_time", "ms").alias("event_time"))


@query("parse_mixed_timestamp", f"""WITH {o.SOURCE}, {o.MARKETS}
SELECT event_id, raw_type = 'signup' AS is_text, poly_time AS event_time FROM markets""")
def parse_mixed_timestamp(spark, folder):
    return feeds.market_events(feeds.events(spark, folder)).select(
        "event_id", F.col("timestamp").contains("T").alias("is_text"),
        times.mixed_timestamp("timestamp").alias("event_time"))


@query("symbol_to_crypto", f"WITH {o.KLINES} SELECT event_id, symbol, crypto FROM klines")
def symbol_to_crypto(spark, folder):
    return feeds.klines(feeds.events(spark, folder)).select(
        "event_id", "symbol", symbols.symbol_to_crypto("symbol").alias("crypto"))


@query("normalize_symbol", f"""WITH {o.KLINES}
SELECT event_id, CASE WHEN is_closed THEN symbol ELSE left(symbol, length(symbol) - 4) END AS given,
  symbol FROM klines""")
def normalize_symbol(spark, folder):
    given = feeds.klines(feeds.events(spark, folder)).select("event_id", F.when(
        F.col("is_closed"), F.col("symbol")).otherwise(
        F.regexp_replace("symbol", "USDT$", "")).alias("given"))
    return given.withColumn("symbol", symbols.normalize_symbol("given"))


@query("buy_sentiment", f"""WITH {o.KLINES}
SELECT event_id, CASE WHEN quote_asset_volume > 0 THEN taker_buy_quote / quote_asset_volume END
  AS buy_sentiment FROM klines""")
def buy_sentiment(spark, folder):
    return feeds.klines(feeds.events(spark, folder)).select(
        "event_id", book.buy_sentiment("taker_buy_quote", "quote_asset_volume").alias("buy_sentiment"))


@query("route_events", f"""WITH {o.SOURCE}, {o.MARKETS}
SELECT event_id, market AS market_id, event_time, event_type AS route,
  CASE WHEN event_type = 'last_trade_price' THEN value END AS trade_size FROM markets""")
def route_events(spark, folder):
    parsed = messages.decode_market_events(feeds.market_messages(feeds.events(spark, folder)),
                                           carry=("event_id",))
    books = messages.book_updates(parsed, carry=("event_id",)).select(
        "event_id", "market_id", "event_time", F.lit("book").alias("route"))
    trades = messages.trades(parsed, carry=("event_id",)).select(
        "event_id", "market_id", "event_time", F.lit("last_trade_price").alias("route"), "trade_size")
    return books.unionByName(trades, allowMissingColumns=True)


@query("price_movement", f"WITH {o.KLINES} SELECT event_id, (close - open) / open AS price_movement FROM klines")
def price_movement(spark, folder):
    return feeds.klines(feeds.events(spark, folder)).select(
        "event_id", verdict.price_movement("open", "close").alias("price_movement"))


@query("actual_direction", f"""WITH {o.KLINES}
SELECT event_id, CASE WHEN (close - open) / open > CAST(0.001 AS DOUBLE) THEN 'UP'
  WHEN (close - open) / open < CAST(-0.001 AS DOUBLE) THEN 'DOWN' ELSE 'FLAT' END AS actual_direction
FROM klines""")
def actual_direction(spark, folder):
    return feeds.klines(feeds.events(spark, folder)).select(
        "event_id",
        verdict.actual_direction(verdict.price_movement("open", "close")).alias("actual_direction"))


@query("predicted_direction", f"""WITH {o.SOURCE}, {o.MARKETS}
SELECT event_id, CASE WHEN CAST(price AS DOUBLE) > CAST(0.6 AS DOUBLE) THEN 'UP'
  WHEN CAST(price AS DOUBLE) < CAST(1 AS DOUBLE) - CAST(0.6 AS DOUBLE) THEN 'DOWN'
  ELSE 'UNCERTAIN' END AS predicted_direction FROM markets""")
def predicted_direction(spark, folder):
    return feeds.market_events(feeds.events(spark, folder)).select(
        "event_id", verdict.predicted_direction(
            F.col("price").try_cast("double")).alias("predicted_direction"))


_KEYWORD_SQL = " OR ".join(f"contains(lower({{0}}), '{k}')" for k in CRYPTO_KEYWORDS)


@query("keyword_market_filter",
       f"SELECT doc_id, {_KEYWORD_SQL.format('text')} AS is_crypto FROM documents")
def keyword_market_filter(spark, folder):
    return feeds.table(spark, folder, "documents").select(
        "doc_id", symbols.is_crypto_title("text").alias("is_crypto"))


# Titles of markets, made from part names: some hold a keyword, in any case, some don't.
_TITLE_WORDS = ("Bitcoin up in the ", "will ETH close above ", "Solana and ", "XRP or ", "weather in ", "election: ", "")


@query("crypto_titles", f"""WITH titles AS (SELECT p_partkey, CASE p_partkey % {len(_TITLE_WORDS)} {' '.join(
    f"WHEN {i} THEN '{w}'" for i, w in enumerate(_TITLE_WORDS))} END || p_name AS title FROM part)
SELECT p_partkey, title FROM titles WHERE {_KEYWORD_SQL.format('title')}""")
def crypto_titles(spark, folder):
    start = F.element_at(F.array(*[F.lit(w) for w in _TITLE_WORDS]),
                         (F.col("p_partkey") % len(_TITLE_WORDS) + 1).cast("int"))
    titles = feeds.table(spark, folder, "part").select("p_partkey", F.concat(start, "p_name").alias("title"))
    return titles.filter(symbols.is_crypto_title("title"))


@query("quarter_floor", f"""WITH {o.SOURCE}
SELECT event_id, CAST(floor(epoch(ts) / 900) AS BIGINT) * 900 AS window_start_s,
  CAST(floor(epoch(ts) / 900) AS BIGINT) * 900 + 900 AS window_end_s FROM src""")
def quarter_floor(spark, folder):
    start = times.quarter_floor(F.col("ts").cast("timestamp"))
    return feeds.events(spark, folder).select(
        "event_id", start.alias("window_start_s"),
        (start + times.QUARTER_SECONDS).alias("window_end_s"))


# --- order books ------------------------------------------------------------

def _books(spark, folder, string_compare=False):
    return messages.books_of(feeds.market_messages(feeds.events(spark, folder)),
                             string_compare=string_compare, carry=("event_id",))


@query("best_bid_ask", f"""WITH {o.SOURCE}, {o.BOOKS}
SELECT event_id, market_id, best_bid, best_ask FROM books""")
def best_bid_ask(spark, folder):
    return _books(spark, folder).select("event_id", "market_id", "best_bid", "best_ask")


@query("top_depth", f"WITH {o.SOURCE}, {o.BOOKS} SELECT event_id, bid_depth, ask_depth FROM books")
def top_depth(spark, folder):
    return _books(spark, folder).select("event_id", "bid_depth", "ask_depth")


# All prices of the feed have two digits, so text order is number order here.
@query("top_depth_by_text",
       f"WITH {o.SOURCE}, {o.BOOKS} SELECT event_id, bid_depth, ask_depth FROM books")
def top_depth_by_text(spark, folder):
    return _books(spark, folder, string_compare=True).select("event_id", "bid_depth", "ask_depth")


@query("book_metrics", f"""WITH {o.SOURCE}, {o.BOOKS}
SELECT event_id, market_id, event_time, spread, mid_price_prob, book_imbalance FROM books""")
def book_metrics(spark, folder):
    return _books(spark, folder).select("event_id", "market_id", "event_time", "spread",
                                        "mid_price_prob", "book_imbalance")
