"""The batch job: stored candles and market events -> window verdicts -> batch view.

Install the package on the cluster (``pip install .``), or ship it with ``--py-files``:

    spark-submit --py-files oddsline.zip oddsline/plans/batch.py --klines TABLE --events TABLE \\
        --out FOLDER --unit ms [--date D [--until D]] [--tokens TABLE]
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from oddsline.config import NUMBER, Settings
from oddsline.operators import serving, views, windows
from oddsline.session import BATCH_OPTIONS, build_session, use_utc
from oddsline.sinks import tables as sinks
from oddsline.sources import tables as sources


# Fixed value: no exchange price is older.
EARLIEST = "2009-01-01"


def verdicts(klines: DataFrame, events: DataFrame, date: str | None = None,
             settings: Settings = Settings(), tokens: DataFrame | None = None,
             sequence: str | None = "snapshot_time", until: str | None = None) -> DataFrame:
    """Verdict of every window that has both prices and bets, from raw or cleansed tables.

    With a ``date`` (or dates up to ``until``) only windows that start then are judged.
    ``tokens`` tags markets by token instead of the default asset; ``sequence`` orders
    several snapshots of one candle time, and their number those of the same microsecond.
    """
    keep = tuple(c for c in (sequence, NUMBER) if c in klines.columns)
    prices = sources.load_klines(klines, date, settings, keep, until)
    odds = sources.load_probabilities(events, date, settings, until)
    if tokens is None:
        probabilities = windows.probability_windows(odds, settings.batch_window)
    else:
        probabilities = windows.token_probability_windows(odds, tokens, settings.batch_window)
    judged = windows.analyze(
        windows.ohlc_windows(prices, settings.batch_window, sequence=sequence), probabilities, settings)
    day = F.to_date("window_start")
    first, last = date, until if until is not None else date
    judged = judged if first is None else judged.filter(day >= F.lit(first).cast("date"))
    return judged if last is None else judged.filter(day <= F.lit(last).cast("date"))


def check_times(klines: DataFrame, settings: Settings, date: str | None = None, until: str | None = None,
                now: dt.datetime | None = None) -> None:
    """Raise if candles lie at implausible times, as with a wrong unit.

    Looked at is the newest of the dates to be judged, so the time column of no other date
    is read. Its candles have to lie near that date, not before any exchange, and
    not a year after ``now``, if that is given.
    """
    newest = sources.on_dates(klines, date, until).agg(F.max("date")).first()[0]
    if newest is None:
        return
    times = sources.load_klines(klines, str(newest), settings).agg(
        F.min("binance_time").alias("first"), F.max("binance_time").alias("last"))
    day = F.lit(newest).cast("timestamp")
    wrong = ((F.col("first") < F.lit(EARLIEST).cast("timestamp"))
             | (F.col("first") < day - F.expr("INTERVAL 2 DAYS")) | (F.col("last") >= day + F.expr("INTERVAL 3 DAYS"))
             | (F.lit(False) if now is None else F.col("last") > F.lit(now) + F.expr("INTERVAL 1 YEAR")))
    row = times.select("first", "last", (F.col("last").isNull() | wrong).alias("wrong"),
                       F.date_format("last", "yyyy-MM-dd").alias("shown")).first()
    if row["wrong"]:
        raise ValueError(f"candles of {newest} lie at {row['shown']}: is the time unit {settings.epoch_unit!r} right?")


def run(spark: SparkSession, klines: DataFrame, events: DataFrame, out: str,
        date: str | None = None, settings: Settings = Settings(),
        tokens: DataFrame | None = None, sequence: str | None = "snapshot_time",
        until: str | None = None, now: dt.datetime | None = None) -> DataFrame:
    """Write ``<out>/analysis`` and ``<out>/view``; returns the outcome counts of all that is stored.

    The dates asked for are replaced as a whole: those that now have no verdict are emptied, and
    the others stay.  Without a date all are replaced.  The view is made from the stored
    analysis, so the heavy scan runs once.  Any error is raised and fails the job.
    """
    use_utc(spark)
    check_times(klines, settings, date, until, now)
    judged = sinks.dated_result(verdicts(klines, events, date, settings, tokens, sequence, until))
    first, last = date, until if until is not None else date
    sinks.replace_range(judged, f"{out}/analysis", first, last)
    analysis = sinks.read_dated(spark, f"{out}/analysis", judged.schema)
    view = sinks.dated_view(views.batch_view(sources.on_dates(analysis, date, until)))
    sinks.replace_range(view, f"{out}/view", first, last, sort=("rowkey",))
    return serving.outcome_report(analysis)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--klines", required=True, help="candle table name")
    parser.add_argument("--events", required=True, help="market event table name")
    parser.add_argument("--out", required=True)
    parser.add_argument("--unit", required=True, choices=("s", "ms", "us", "ns"),
                        help="unit of candle times; cleansed tables are in ms")
    parser.add_argument("--date", help="only this partition, or the first with --until (YYYY-MM-DD)")
    parser.add_argument("--until", help="last partition (YYYY-MM-DD)")
    parser.add_argument("--tokens", help="table (token_id, crypto) to tag markets by")
    args = parser.parse_args(argv)
    spark = build_session("batch-verdicts", **BATCH_OPTIONS)
    run(spark, spark.table(args.klines), spark.table(args.events), args.out, args.date,
        Settings(epoch_unit=args.unit), spark.table(args.tokens) if args.tokens else None,
        until=args.until, now=dt.datetime.now(dt.timezone.utc)).show()
    spark.stop()


if __name__ == "__main__":
    main()
