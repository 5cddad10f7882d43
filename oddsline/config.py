"""Settings and fixed values shared by all operators."""

from __future__ import annotations

from dataclasses import dataclass

# --- Fixed values: they must equal what existing feeds, keys and dashboards use ---

# Traded pair -> short asset name.
PAIR_TO_CRYPTO = (
    ("BTCUSDT", "btc"),
    ("ETHUSDT", "eth"),
    ("SOLUSDT", "sol"),
    ("XRPUSDT", "xrp"),
)
UNKNOWN_CRYPTO = "unknown"
QUOTE_SUFFIX = "USDT"

# Words that mark a market title as crypto related (matched as substrings).
CRYPTO_KEYWORDS = (
    "bitcoin", "btc", "ethereum", "eth", "solana", "sol", "cardano", "ada", "polkadot", "dot",
    "avalanche", "avax", "polygon", "matic", "chainlink", "link", "uniswap", "uni", "ripple", "xrp",
    "dogecoin", "doge", "shiba", "shib", "litecoin", "ltc", "cosmos", "atom", "algorand", "algo",
    "tezos", "xtz", "monero", "xmr", "stellar", "xlm", "crypto", "cryptocurrency", "defi", "nft",
    "nfts", "blockchain", "token", "coin", "altcoin", "stablecoin", "memecoin", "binance", "bnb",
    "coinbase", "ftx", "opensea", "metamask", "aave", "compound", "synthetix",
)

# Slug of a 15-minute event: "<crypto>" + SLUG_INFIX + "<epoch seconds>".
SLUG_INFIX = "-updown-15m-"

# Row keys.
REVERSE_TIME_BASE = 9999999999999
KEY_SEPARATOR = "#"
BATCH_KEY_SEPARATOR = "_"
PRICE_ROWS, BOOK_ROWS, TRADE_ROWS = "BIN", "PB", "PT"

# Columns that a feed may carry beside its rows: the instant of capture, finer than a message's own
# milliseconds, and a number that tells rows of the same instant apart.
CAPTURED = "captured"
NUMBER = "event_id"

# Market event types.
BOOK_EVENT = "book"
TRADE_EVENT = "last_trade_price"

# Prediction results, in report order.
RESULTS = ("CORRECT_BULL", "FAILED_BULL", "CORRECT_BEAR", "FAILED_BEAR", "UNCERTAIN")

# Cells of the batch view: family -> {qualifier: column of the flat view}.
BATCH_CELLS = {
    "price_data": {
        "open": "price_open", "close": "price_close", "high": "price_high",
        "low": "price_low", "volume": "avg_volume",
    },
    "bet_data": {
        "avg_prob": "avg_probability", "max_prob": "max_probability",
        "activity": "bet_activity_count",
    },
    "analysis": {
        "price_movement": "price_movement", "actual_direction": "actual_direction",
        "predicted_direction": "predicted_direction", "result": "prediction_result",
        "timestamp": "timestamp", "symbol": "symbol", "crypto": "crypto",
    },
}

# Cells of the live view: row type -> (family, {qualifier: aggregate column}).
LIVE_CELLS = {
    PRICE_ROWS: ("b", {
        "current_price": "current_price", "current_sentiment": "current_sentiment",
        "avg_price": "avg_price", "min_price": "min_price", "max_price": "max_price",
        "volatility": "volatility", "total_volume": "total_usdt_volume",
        "avg_sentiment": "avg_sentiment", "ticks": "ticks", "window_end": "window_end_ms",
    }),
    BOOK_ROWS: ("p", {
        "current_prob": "current_prob", "current_spread": "current_spread",
        "current_imbalance": "current_imbalance", "avg_prob": "avg_prob",
        "min_prob": "min_prob", "max_prob": "max_prob", "avg_imbalance": "avg_imbalance",
        "avg_spread": "avg_spread", "num_updates": "num_updates",
        "market_id": "market_id", "window_end": "window_end_ms",
    }),
    TRADE_ROWS: ("t", {
        "total_shares": "total_shares_traded", "num_trades": "num_trades",
        "market_id": "market_id", "window_end": "window_end_ms",
    }),
}

# Cells of per-event live rows (older format): family "d".
EVENT_FAMILY = "d"
EVENT_KEY = "event_key"
EVENT_CELLS = ("binance_price", "poly_last_trade", "poly_best_bid", "poly_best_ask", "implied_prob")


@dataclass(frozen=True)
class Settings:
    """Tunable values of the batch and live jobs."""

    batch_window: str = "15 minutes"
    live_window: str = "1 minute"
    watermark: str = "2 minutes"
    trigger: str = "5 seconds"
    prediction_threshold: float = 0.60
    min_movement: float = 0.001
    default_crypto: str = "btc"
    pairs: tuple[tuple[str, str], ...] = PAIR_TO_CRYPTO
    epoch_unit: str = "ns"
    snapshot_seconds: float = 1.0
    batch_ttl_days: int = 365
    live_ttl_days: int = 1
    retention_days: int = 30
    live_scan_limit: int = 100
    accuracy_windows: int = 96
