"""SQL forms of the feeds in ``sources.feeds``, as common table expressions."""

from __future__ import annotations

from oddsline.config import RESULTS

SOURCE = """src AS (
  SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k, epoch_us(ts) // 1000 AS ms
  FROM events)"""

KLINES = SOURCE + """, klines AS (
  SELECT event_id, ts, epoch_us(ts) * 1000 AS "timestamp", ms AS snapshot_time,
    100 + value / 100 AS open,
    greatest(100 + value / 100, 100 + CAST(k AS DOUBLE) / 100) + CAST(0.5 AS DOUBLE) AS high,
    least(100 + value / 100, 100 + CAST(k AS DOUBLE) / 100) - CAST(0.5 AS DOUBLE) AS low,
    100 + CAST(k AS DOUBLE) / 100 AS close,
    value * 10 AS volume, ms - ms % 60000 + 59999 AS close_time,
    CASE WHEN event_type = 'error' THEN CAST(0 AS DOUBLE) ELSE value * 100 END AS quote_asset_volume,
    CAST(k AS BIGINT) AS trades, value * k / 100 AS taker_buy_base, value * k AS taker_buy_quote,
    CASE user_id % 5 WHEN 0 THEN 'BTCUSDT' WHEN 1 THEN 'ETHUSDT' WHEN 2 THEN 'SOLUSDT'
      WHEN 3 THEN 'XRPUSDT' ELSE 'DOGEUSDT' END AS symbol,
    CASE user_id % 5 WHEN 0 THEN 'btc' WHEN 1 THEN 'eth' WHEN 2 THEN 'sol'
      WHEN 3 THEN 'xrp' ELSE 'unknown' END AS crypto,
    event_type <> 'click' AS is_closed, CAST(ts AS DATE) AS date
  FROM src)"""

MARKETS = """markets AS (
  SELECT event_id, ts, CAST(ts AS DATE) AS date, user_id, k, value, event_type AS raw_type,
    date_trunc('milliseconds', ts) AS event_time,
    CASE WHEN event_type = 'signup' THEN ts ELSE date_trunc('milliseconds', ts) END AS poly_time,
    'market-' || CAST(user_id % 7 AS VARCHAR) AS market,
    'asset-' || CAST(user_id AS VARCHAR) AS asset_id,
    CASE WHEN event_type IN ('view', 'click') THEN 'book' ELSE 'last_trade_price' END AS event_type,
    '0.' || lpad(CAST(k AS VARCHAR), 2, '0') AS price,
    CAST('0.' || lpad(CAST(k % 50 AS VARCHAR), 2, '0') AS DOUBLE) AS bid1,
    CAST('0.' || lpad(CAST(k % 37 AS VARCHAR), 2, '0') AS DOUBLE) AS bid2,
    CAST('0.' || CAST(50 + k % 50 AS VARCHAR) AS DOUBLE) AS ask1,
    CAST('0.' || CAST(50 + k % 37 AS VARCHAR) AS DOUBLE) AS ask2,
    CAST(user_id AS DOUBLE) AS bid1_size, CAST(event_id % 97 AS DOUBLE) AS bid2_size,
    CAST(event_id % 89 AS DOUBLE) AS ask1_size, CAST(user_id % 13 AS DOUBLE) AS ask2_size
  FROM src)"""

BOOKS = MARKETS + """, tops AS (
  SELECT event_id, market AS market_id, event_time, greatest(bid1, bid2) AS best_bid,
    least(ask1, ask2) AS best_ask,
    CASE WHEN bid1 >= bid2 THEN bid1_size ELSE bid2_size END AS bid_depth,
    CASE WHEN ask1 <= ask2 THEN ask1_size ELSE ask2_size END AS ask_depth
  FROM markets WHERE event_type = 'book'), books AS (
  SELECT *, abs(best_ask - best_bid) AS spread, (best_bid + best_ask) / 2 AS mid_price_prob,
    CASE WHEN bid_depth + ask_depth > 0
      THEN (bid_depth - ask_depth) / (bid_depth + ask_depth) END AS book_imbalance
  FROM tops)"""

PROBABILITIES = MARKETS + """, probabilities AS (
  SELECT event_id, poly_time, 'btc' AS crypto, asset_id, market, CAST(price AS DOUBLE) AS price,
    event_type, date, user_id
  FROM markets WHERE raw_type <> 'click'), tagged AS (
  SELECT * REPLACE (CASE user_id % 5 WHEN 0 THEN 'btc' WHEN 1 THEN 'eth' WHEN 2 THEN 'sol'
      WHEN 3 THEN 'xrp' END AS crypto)
  FROM probabilities WHERE user_id % 5 <> 4)"""


def ohlc(source: str = "klines", name: str = "ohlc", condition: str = "true") -> str:
    return f"""{name} AS (
  SELECT time_bucket(INTERVAL '15 minutes', ts) AS window_start,
    time_bucket(INTERVAL '15 minutes', ts) + INTERVAL '15 minutes' AS window_end, crypto, symbol,
    arg_min(open, ts) AS window_open, max(high) AS window_high, min(low) AS window_low,
    arg_max(close, ts) AS window_close, avg(volume) AS avg_volume, count(*) AS candle_count
  FROM {source} WHERE {condition} GROUP BY ALL)"""


def odds(source: str = "probabilities", name: str = "odds") -> str:
    return f"""{name} AS (
  SELECT time_bucket(INTERVAL '15 minutes', poly_time) AS window_start,
    time_bucket(INTERVAL '15 minutes', poly_time) + INTERVAL '15 minutes' AS window_end, crypto,
    round(avg(price), 12) AS avg_probability, max(price) AS max_probability, min(price) AS min_probability,
    arg_max(price, poly_time) AS last_probability, count(*) AS bet_activity_count
  FROM {source} GROUP BY ALL)"""


ANALYSIS = """joined AS (
  SELECT o.window_start, o.window_end, o.crypto, symbol, window_open, window_high, window_low,
    window_close, avg_volume, candle_count, avg_probability, max_probability, min_probability,
    last_probability, bet_activity_count
  FROM ohlc o JOIN odds p ON o.window_start = p.window_start AND o.crypto = p.crypto), moved AS (
  SELECT *, (window_close - window_open) / nullif(window_open, 0) AS price_movement FROM joined
), directed AS (
  SELECT *,
    CASE WHEN price_movement > CAST(0.001 AS DOUBLE) THEN 'UP'
         WHEN price_movement < CAST(-0.001 AS DOUBLE) THEN 'DOWN' ELSE 'FLAT' END AS actual_direction,
    CASE WHEN avg_probability > CAST(0.6 AS DOUBLE) THEN 'UP'
         WHEN avg_probability < CAST(1 AS DOUBLE) - CAST(0.6 AS DOUBLE) THEN 'DOWN'
         ELSE 'UNCERTAIN' END AS predicted_direction
  FROM moved), analysis AS (
  SELECT *, CASE
      WHEN predicted_direction = 'UP' AND actual_direction = 'UP' THEN 'CORRECT_BULL'
      WHEN predicted_direction = 'DOWN' AND actual_direction = 'DOWN' THEN 'CORRECT_BEAR'
      WHEN predicted_direction = 'UP' AND actual_direction = 'DOWN' THEN 'FAILED_BULL'
      WHEN predicted_direction = 'DOWN' AND actual_direction = 'UP' THEN 'FAILED_BEAR'
      ELSE 'UNCERTAIN' END AS prediction_result
  FROM directed)"""

# Default asset for every market.
VERDICTS = "WITH " + ", ".join([KLINES, PROBABILITIES, ohlc(), odds(), ANALYSIS])
# Markets tagged by token.
TOKEN_VERDICTS = "WITH " + ", ".join([KLINES, PROBABILITIES, ohlc(), odds("tagged"), ANALYSIS])

VIEW = """view_rows AS (
  SELECT symbol || '_' || CAST(9999999999999 - CAST(epoch(window_start) AS BIGINT) * 1000 AS VARCHAR)
      AS rowkey,
    CAST(window_start AS VARCHAR) AS "timestamp", crypto, symbol, window_open AS price_open,
    window_close AS price_close, window_high AS price_high, window_low AS price_low, avg_volume,
    avg_probability, max_probability, CAST(bet_activity_count AS INTEGER) AS bet_activity_count,
    price_movement, actual_direction, predicted_direction, prediction_result, window_start,
    CAST(epoch(window_start) AS BIGINT) AS window_ts
  FROM analysis)"""

VIEW_VERDICTS = f"{TOKEN_VERDICTS}, {VIEW}"

# The batch view as of the last batch run, and the whole live price view.
CUTOFF = "2024-01-30 12:00:00"
SERVED = "WITH " + ", ".join([
    KLINES, PROBABILITIES, ohlc(condition=f"ts < TIMESTAMP '{CUTOFF}'"), odds("tagged"), ANALYSIS, VIEW])


def live_price(name: str = "live_price") -> str:
    return f"""{name} AS (
  SELECT time_bucket(INTERVAL '1 minute', event_time) AS window_start,
    time_bucket(INTERVAL '1 minute', event_time) + INTERVAL '1 minute' AS window_end, symbol,
    arg_max(price, ts) AS current_price,
    arg_max_null(buy_sentiment, ts) AS current_sentiment,
    avg(price) AS avg_price, min(price) AS min_price, max(price) AS max_price,
    stddev_samp(price) AS volatility, sum(usdt_volume) AS total_usdt_volume,
    avg(buy_sentiment) AS avg_sentiment, count(*) AS ticks
  FROM (SELECT ts, date_trunc('milliseconds', ts) AS event_time, symbol, close AS price,
          quote_asset_volume AS usdt_volume,
          CASE WHEN quote_asset_volume > 0 THEN taker_buy_quote / quote_asset_volume END
            AS buy_sentiment
        FROM klines) AS ticks GROUP BY ALL)"""


LIVE_BOOK = """live_book AS (
  SELECT time_bucket(INTERVAL '1 minute', event_time) AS window_start,
    time_bucket(INTERVAL '1 minute', event_time) + INTERVAL '1 minute' AS window_end, market_id,
    arg_max_null(mid_price_prob, event_time) AS current_prob,
    arg_max_null(spread, event_time) AS current_spread,
    arg_max_null(book_imbalance, event_time) AS current_imbalance,
    avg(mid_price_prob) AS avg_prob, min(mid_price_prob) AS min_prob, max(mid_price_prob) AS max_prob,
    avg(book_imbalance) AS avg_imbalance, avg(spread) AS avg_spread, count(*) AS num_updates
  FROM books GROUP BY ALL)"""

LIVE_TRADES = """live_trades AS (
  SELECT time_bucket(INTERVAL '1 minute', event_time) AS window_start,
    time_bucket(INTERVAL '1 minute', event_time) + INTERVAL '1 minute' AS window_end,
    market AS market_id, sum(value) AS total_shares_traded, count(*) AS num_trades
  FROM markets WHERE event_type = 'last_trade_price' GROUP BY ALL)"""

LIVE_PRICE_VIEW = """live_rows AS (
  SELECT 'BIN#' || symbol || '#' || CAST(9999999999999 - epoch_ms(window_end) AS VARCHAR) AS rowkey,
    symbol AS identifier, current_price, current_sentiment, avg_price, min_price, max_price,
    volatility, total_usdt_volume AS total_volume, avg_sentiment, ticks,
    epoch_ms(window_end) AS window_end
  FROM live_price)"""

SERVED_BOTH = f"{SERVED}, {live_price()}, {LIVE_PRICE_VIEW}"

ORDERS = """market_info AS (
  SELECT o_orderkey AS event_id, o_custkey,
    CASE o_custkey % 4 WHEN 0 THEN 'btc' WHEN 1 THEN 'eth' WHEN 2 THEN 'sol' ELSE 'xrp' END AS crypto,
    CAST(epoch(o_orderdate) AS BIGINT) - CAST(epoch(o_orderdate) AS BIGINT) % 900 AS start_s,
    o_orderstatus = 'F' AS closed, o_custkey % 100 AS up
  FROM orders), info AS (
  SELECT *, crypto || '-updown-15m-' || CAST(start_s AS VARCHAR) AS slug,
    upper(crypto) || ' Up or Down' AS title
  FROM market_info)"""

RESULT_LIST = ", ".join(f"('{r}')" for r in RESULTS)
