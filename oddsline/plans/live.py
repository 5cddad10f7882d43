"""The live job: candle and market topics -> three live windows -> live view.

Install the package on the cluster (``pip install .``), or ship it with ``--py-files``:

    spark-submit --py-files oddsline.zip oddsline/plans/live.py --servers HOST:PORT \\
        --root FOLDER --checkpoints FOLDER
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from oddsline.config import BOOK_ROWS, PRICE_ROWS, TRADE_ROWS, Settings
from oddsline.session import STREAM_OPTIONS, build_session
from oddsline.sources.streams import kafka_stream
from oddsline.streaming import jobs, monitor
from oddsline.streaming.live_view import LiveView


def start_all(kline_messages: DataFrame, market_messages: DataFrame, root: str, checkpoints: str,
              settings: Settings = Settings(), trigger: str | None = Settings.trigger,
              ) -> dict[str, tuple[StreamingQuery, LiveView]]:
    """Three independent queries, each with its own checkpoint and part of the view."""
    sources = {PRICE_ROWS: kline_messages, BOOK_ROWS: market_messages, TRADE_ROWS: market_messages}
    return {
        row_type: jobs.start_live_windows(
            raw, row_type, f"{root}/{row_type}",
            jobs.StreamOptions(f"{checkpoints}/{row_type}", trigger, f"live-{row_type}"), settings)
        for row_type, raw in sources.items()}


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--servers", required=True)
    parser.add_argument("--kline-topic", default="klines")
    parser.add_argument("--market-topic", default="market_events")
    parser.add_argument("--root", required=True)
    parser.add_argument("--checkpoints", required=True)
    parser.add_argument("--max-offsets", type=int)
    args = parser.parse_args(argv)
    spark = build_session("live-windows", **STREAM_OPTIONS,
                          **{"spark.streaming.stopGracefullyOnShutdown": "true"})
    spark.streams.addListener(monitor.ProgressLog())
    started = start_all(kafka_stream(spark, args.servers, args.kline_topic, max_offsets=args.max_offsets),
                        kafka_stream(spark, args.servers, args.market_topic, max_offsets=args.max_offsets),
                        args.root, args.checkpoints)
    maintainer = jobs.Maintainer([view for _, view in started.values()], jobs.Maintenance()).start()
    try:
        monitor.run_until_any_ends(spark)
    finally:
        maintainer.stop()


if __name__ == "__main__":
    main()
