"""Tumbling-window aggregates, their join and the verdict on each window.

All aggregates keep fixed-width buffers, so Spark pre-aggregates by hash before the
only shuffle; a key that holds a third of all rows reaches its reducer as at most
one row per window and input partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from oddsline.config import CAPTURED, NUMBER, Settings
from oddsline.functions import verdict
from oddsline.functions.rounding import half_away
from oddsline.functions.times import (epoch_to_timestamp, exact_key, floor_time, interval_seconds, order_key,
                                      refined)

JOINED_COLUMNS = (
    "window_start", "window_end", "crypto", "symbol", "window_open", "window_high", "window_low",
    "window_close", "avg_volume", "candle_count", "avg_probability", "max_probability",
    "min_probability", "last_probability", "bet_activity_count",
)
ANALYSIS_COLUMNS = (
    "window_start", "crypto", "symbol", "window_open", "window_high", "window_low", "window_close",
    "avg_volume", "avg_probability", "max_probability", "bet_activity_count", "price_movement",
    "actual_direction", "predicted_direction", "prediction_result",
)


def _per_window(df: DataFrame, time: str, every: str, keys: tuple[str, ...],
                *aggregates: Column) -> DataFrame:
    """Aggregates per tumbling window and keys, as ``window_start, window_end, keys, ...``.

    Streams group by ``window``, whose state the watermark can drop.  Tables group by the
    start alone: a plain key suits the generated hash map, a struct does not.  Rows without
    time are left out after aggregation, as one group, and the start is stated non-null:
    a filter or a join on it would be pushed below the aggregate and parse each time again.
    """
    if df.isStreaming:
        grouped = df.groupBy(F.window(time, every), *keys).agg(*aggregates)
        rest = [c for c in grouped.columns if c != "window"]
        return grouped.select(F.col("window.start").alias("window_start"),
                              F.col("window.end").alias("window_end"), *rest)
    grouped = df.groupBy(floor_time(time, every).alias("window_start"), *keys).agg(
        *aggregates, F.count(time).alias("_timed")).filter(F.col("_timed") > 0)
    start = F.coalesce("window_start", F.timestamp_seconds(F.lit(0)))
    rest = [c for c in grouped.columns if c not in ("window_start", "_timed")]
    return grouped.select(start.alias("window_start"),
                          (start + F.expr(f"INTERVAL {every}")).alias("window_end"), *rest)


def _watermarked(df: DataFrame, time: str, delay: str | None) -> DataFrame:
    return df.withWatermark(time, delay) if delay and df.isStreaming else df


def _first_and_last(df: DataFrame, instant: Column, ties: tuple[str, ...]) -> tuple[Column, Column]:
    """Keys whose smallest names the first row of a window, and whose largest names the last one.

    Of rows of the same microsecond the one with the smallest number counts, as a table in
    the order of its numbers gives it; without numbers a hash of ``ties`` decides.
    """
    if NUMBER in df.columns:
        return exact_key(instant, NUMBER), exact_key(instant, NUMBER, descending=True)
    key = exact_key(instant, F.xxhash64(*ties))
    return key, key


def ohlc_windows(klines: DataFrame, every: str = Settings.batch_window,
                 time: str = "binance_time", sequence: str | None = "snapshot_time",
                 ties: tuple[str, ...] = ("open", "close")) -> DataFrame:
    """Open, high, low, close, mean volume and count per window and symbol.

    First and last are by the epoch milliseconds in ``sequence``, as all snapshots of a
    candle share its time, and by ``time`` where that is null, out of range or no column.
    ``time`` also orders snapshots within a millisecond; for ties see ``_first_and_last``.
    """
    if sequence is None or sequence not in klines.columns:
        instant = F.col(time)
    else:
        instant = F.coalesce(refined(epoch_to_timestamp(sequence, "ms"), time), F.col(time))
    first, last = _first_and_last(klines, instant, ties)
    return _per_window(
        klines, time, every, ("crypto", "symbol"),
        F.min_by("open", first).alias("window_open"), F.max("high").alias("window_high"),
        F.min("low").alias("window_low"), F.max_by("close", last).alias("window_close"),
        F.avg("volume").alias("avg_volume"), F.count(F.lit(1)).alias("candle_count"))


def probability_windows(probabilities: DataFrame, every: str = Settings.batch_window,
                        time: str = "poly_time",
                        ties: tuple[str, ...] = ("price",)) -> DataFrame:
    """Mean, extreme and last probability and number of bets per window and asset.

    The last bits of a mean of doubles depend on the order of addition, which would make
    the strict thresholds of a verdict flip between runs for means right on them; the
    mean is therefore rounded to 12 places.
    """
    order = order_key(time, *ties, span_seconds=interval_seconds(every))
    return _per_window(
        probabilities, time, every, ("crypto",),
        half_away(F.avg("price"), 12).alias("avg_probability"), F.max("price").alias("max_probability"),
        F.min("price").alias("min_probability"), F.max_by("price", order).alias("last_probability"),
        F.count(F.lit(1)).alias("bet_activity_count"))


def token_probability_windows(probabilities: DataFrame, tokens: DataFrame,
                              every: str = Settings.batch_window, time: str = "poly_time",
                              ties: tuple[str, ...] = ("price",)) -> DataFrame:
    """``probability_windows`` of events tagged by token, see ``tag_markets``.

    Events are reduced to one row per window and token before the join, so the join
    never moves the raw events of a busy token; sums, counts, extremes and ordered last
    values combine exactly into the windows per asset.
    """
    order = order_key(time, *ties, span_seconds=interval_seconds(every))
    per_token = _per_window(
        probabilities, time, every, ("asset_id",),
        F.sum("price").alias("total"), F.count(F.lit(1)).alias("n"), F.max("price").alias("highest"),
        F.min("price").alias("lowest"), F.max(order).alias("newest"),
        F.max_by("price", order).alias("last"))
    known = tokens.select(F.col("token_id").alias("asset_id"), "crypto")
    return per_token.join(known, "asset_id").groupBy("window_start", "window_end", "crypto").agg(
        half_away(F.sum("total") / F.sum("n"), 12).alias("avg_probability"),
        F.max("highest").alias("max_probability"), F.min("lowest").alias("min_probability"),
        F.max_by("last", "newest").alias("last_probability"),
        F.sum("n").alias("bet_activity_count"))


def tag_markets(probabilities: DataFrame, tokens: DataFrame) -> DataFrame:
    """Replace the default asset by the one of each event's token.

    ``tokens`` is (token_id, crypto), unique by token; events of unknown tokens drop out.
    It grows with the number of markets, so the planner picks the join by its size.
    """
    return (probabilities.drop("crypto")
            .join(tokens.select(F.col("token_id").alias("asset_id"), "crypto"), "asset_id"))


def join_windows(prices: DataFrame, probabilities: DataFrame) -> DataFrame:
    """Windows present on both sides."""
    odds = probabilities.drop("window_end")
    return prices.join(odds, ["window_start", "crypto"]).select(*JOINED_COLUMNS)


def with_verdict(joined: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Price movement, both directions and the prediction result."""
    return (joined
            .withColumn("price_movement", verdict.price_movement("window_open", "window_close"))
            .withColumns({
                "actual_direction":
                    verdict.actual_direction("price_movement", settings.min_movement),
                "predicted_direction":
                    verdict.predicted_direction("avg_probability", settings.prediction_threshold)})
            .withColumn("prediction_result",
                        verdict.prediction_result("predicted_direction", "actual_direction")))


def analyze(prices: DataFrame, probabilities: DataFrame,
            settings: Settings = Settings()) -> DataFrame:
    return with_verdict(join_windows(prices, probabilities), settings).select(*ANALYSIS_COLUMNS)


def _live(df: DataFrame, key: str, every: str, watermark: str | None, *aggregates: Column) -> DataFrame:
    return _per_window(_watermarked(df, "event_time", watermark), "event_time", every, (key,),
                       *aggregates)


def live_price(ticks: DataFrame, every: str = Settings.live_window,
               watermark: str | None = Settings.watermark) -> DataFrame:
    """Latest and aggregate price, volume and sentiment per window and symbol.

    Ticks of the same millisecond are ordered by the instant of their capture, if they carry it.
    """
    instant = refined("event_time", CAPTURED) if CAPTURED in ticks.columns else F.col("event_time")
    _, order = _first_and_last(ticks, instant, ("price", "buy_sentiment"))
    return _live(
        ticks, "symbol", every, watermark,
        F.max_by("price", order).alias("current_price"),
        F.max_by("buy_sentiment", order).alias("current_sentiment"),
        F.avg("price").alias("avg_price"), F.min("price").alias("min_price"),
        F.max("price").alias("max_price"), F.stddev_samp("price").alias("volatility"),
        F.sum("usdt_volume").alias("total_usdt_volume"),
        F.avg("buy_sentiment").alias("avg_sentiment"), F.count(F.lit(1)).alias("ticks"))


def live_book(books: DataFrame, every: str = Settings.live_window,
              watermark: str | None = Settings.watermark) -> DataFrame:
    """Latest and aggregate probability, spread and imbalance per window and market."""
    _, order = _first_and_last(books, F.col("event_time"), ("mid_price_prob", "spread", "book_imbalance"))
    return _live(
        books, "market_id", every, watermark,
        F.max_by("mid_price_prob", order).alias("current_prob"),
        F.max_by("spread", order).alias("current_spread"),
        F.max_by("book_imbalance", order).alias("current_imbalance"),
        F.avg("mid_price_prob").alias("avg_prob"), F.min("mid_price_prob").alias("min_prob"),
        F.max("mid_price_prob").alias("max_prob"), F.avg("book_imbalance").alias("avg_imbalance"),
        F.avg("spread").alias("avg_spread"), F.count(F.lit(1)).alias("num_updates"))


def live_trades(trades: DataFrame, every: str = Settings.live_window,
                watermark: str | None = Settings.watermark) -> DataFrame:
    """Traded shares and number of trades per window and market."""
    return _live(trades, "market_id", every, watermark,
                 F.sum("trade_size").alias("total_shares_traded"),
                 F.count(F.lit(1)).alias("num_trades"))


def with_price_ranges(live: DataFrame) -> DataFrame:
    """Trading range and momentum of a live price window."""
    return live.withColumns({
        "price_range": F.col("max_price") - F.col("min_price"),
        "momentum": F.col("current_price") - F.col("avg_price")})


def with_probability_range(live: DataFrame) -> DataFrame:
    return live.withColumns({
        "prob_range": F.col("max_prob") - F.col("min_prob"),
        "prob_shift": F.col("current_prob") - F.col("avg_prob")})


def with_trade_size(live: DataFrame) -> DataFrame:
    return live.withColumn("avg_trade_size",
                           F.try_divide("total_shares_traded", "num_trades"))
