"""Batch sinks: partitioned Parquet tables that can be re-run safely.

``rebalance`` lets adaptive execution split a partition value holding much of the
data over several writers and pack small ones together, so a hot symbol neither
stalls one task nor do cold ones leave thousands of tiny files.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from oddsline import schemas
from oddsline.config import Settings
from oddsline.functions import book, rowkeys
from oddsline.functions.times import epoch_to_timestamp, mixed_timestamp
from oddsline.sinks.folders import Folders

_DAY, _STAGED, _SWAP = "date=", "_staged-", "_swap.json"


def write_partitioned(df: DataFrame, path: str, by: tuple[str, ...], mode: str = "overwrite",
                      sort: tuple[str, ...] = (), file_format: str = "parquet", whole: bool = False) -> None:
    """Write ``df`` below ``path`` in folders by ``by``.

    Overwriting replaces only the partitions present in ``df``, so running a day again
    leaves the others alone, or all that ``path`` holds, if ``whole``.
    """
    balanced = df.hint("rebalance", *by) if by else df.hint("rebalance")
    if by or sort:
        balanced = balanced.sortWithinPartitions(*by, *sort)
    writer = balanced.write.format(file_format).mode(mode)
    if mode == "overwrite" and by:
        writer = writer.option("partitionOverwriteMode", "static" if whole else "dynamic")
    if by:
        writer = writer.partitionBy(*by)
    writer.save(path)


def replace_range(df: DataFrame, path: str, first: str | None = None, last: str | None = None,
                  sort: tuple[str, ...] = ()) -> None:
    """Make ``df``, which has a column ``date``, all that ``path`` holds from ``first`` to ``last``.

    Days of the range (both ends included, either may be open) that ``df`` has no rows of are
    emptied, and days outside it stay: rows of ``df`` there are refused. See ``_publish``.
    """
    _publish(df, path, lambda day: (first is None or day >= first) and (last is None or day <= last), sort)


def replace_days(df: DataFrame, path: str, days: list[str], sort: tuple[str, ...] = ()) -> None:
    """The same for single days; the number of days is that of one run."""
    _publish(df, path, frozenset(days).__contains__, sort)


def _publish(df: DataFrame, path: str, covers: Callable[[str], bool], sort: tuple[str, ...]) -> None:
    """Stage all rows beside the table, then swap whole days by renaming folders.

    Until everything is staged the table is untouched. The swap is listed first, so one
    that was interrupted is finished by the next run, or by ``finish_swaps``. Readers see
    each day old, new, or for a moment missing. One writer at a time.
    """
    spark = df.sparkSession
    folders = Folders(spark, path)
    folders.make()
    finish_swaps(spark, path)
    staged = f"{_STAGED}{uuid.uuid4().hex[:12]}"
    write_partitioned(df, f"{path}/{staged}/rows", ("date",), sort=sort)
    new = folders.names(f"{staged}/rows", f"{_DAY}*")
    outside = [day for day in new if not covers(day[len(_DAY):])]
    if outside:
        folders.remove(staged)
        raise ValueError(f"rows of {outside[0]} lie outside the days to be replaced")
    gone = [day for day in folders.names("", f"{_DAY}*") if covers(day[len(_DAY):]) and day not in new]
    folders.write(f"{staged}/{_SWAP}", json.dumps({"new": new, "gone": gone}))
    _swap(folders, staged)


def _swap(folders: Folders, staged: str) -> None:
    """Puts staged days in place and takes others away; may be run again at any point."""
    swap = json.loads(folders.read(f"{staged}/{_SWAP}"))
    folders.make(f"{staged}/old")
    for day in swap["new"]:
        if folders.exists(f"{staged}/rows/{day}"):
            if folders.exists(day):
                folders.remove(f"{staged}/old/{day}")
                folders.move(day, f"{staged}/old/{day}")
            folders.move(f"{staged}/rows/{day}", day)
    for day in swap["gone"]:
        folders.remove(day)
    folders.remove(staged)


def finish_swaps(spark: SparkSession, path: str) -> None:
    """Finish a swap that was interrupted, and drop what was staged by a run that failed before."""
    folders = Folders(spark, path)
    for staged in folders.names("", f"{_STAGED}*"):
        if folders.exists(f"{staged}/{_SWAP}"):
            _swap(folders, staged)
        else:
            folders.remove(staged)


def read_dated(spark: SparkSession, path: str, like: T.StructType) -> DataFrame:
    """A table by date that may hold no day at all, with the columns of ``like`` and ``date``."""
    fields = [T.StructField(f.name, f.dataType) for f in like if f.name != "date"]
    return spark.read.schema(T.StructType([*fields, T.StructField("date", T.DateType())])).parquet(path)


def dated_result(analysis: DataFrame) -> DataFrame:
    return analysis.withColumn("date", F.to_date("window_start"))


def dated_view(view: DataFrame) -> DataFrame:
    """A batch view with the date in its keys."""
    return view.withColumn("date", F.to_date(F.timestamp_seconds(rowkeys.parse_batch_rowkey("rowkey")["epoch_s"])))


def write_result(analysis: DataFrame, path: str) -> None:
    """Store the analysis result by date of its windows; days not in it stay as they are."""
    write_partitioned(dated_result(analysis), path, ("date",))


def write_batch_view(view: DataFrame, path: str) -> None:
    """Store the flat batch view by date, sorted by key inside files.

    Keys are unique per window, and a day's windows always fall in that day's folder,
    so writing a day again replaces exactly its rows.  A day has few rows per symbol,
    so symbols share files; the sort lets key scans skip row groups.  Errors are raised.
    """
    write_partitioned(dated_view(view), path, ("date",), sort=("rowkey",))


def read_batch_view(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_raw_klines(klines: DataFrame, path: str, unit: str = "ms") -> None:
    """Append captured candles by symbol and (UTC) date of the candle open time."""
    dated = klines.withColumn("date", F.to_date(epoch_to_timestamp("timestamp", unit)))
    write_partitioned(dated, path, ("symbol", "date"), mode="append")


def cleanse_klines(raw: DataFrame, unit: str = "ms") -> DataFrame:
    """Raw candles of any column types -> the typed candle table.

    ``unit`` is that of the raw ``timestamp``; it is converted here once. The stored
    ``timestamp`` is in milliseconds, and ``event_time`` the same as a timestamp.
    """
    time = epoch_to_timestamp(F.col("timestamp").try_cast("bigint"), unit)
    dated = raw.withColumns({"event_time": time, "date": F.to_date(time), "timestamp": F.unix_millis(time)})
    return dated.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schemas.CLEANSED_KLINES])


def cleanse_market_events(raw: DataFrame) -> DataFrame:
    """All-text market events -> typed events with event time and numeric price.

    The typed price can be filtered inside the Parquet scan, which a cast at read time
    prevents.  The date is that of the event; unreadable times give a null date.
    """
    time = mixed_timestamp("timestamp")
    return raw.select(
        "market", "asset_id", time.alias("event_time"),
        F.col("last_trade_price").try_cast("double").alias("last_trade_price"),
        book.levels("bids").alias("bids"),
        book.levels("asks").alias("asks"),
        "event_type", F.to_date(time).alias("date"))


def write_cleansed(table: DataFrame, path: str, sort: tuple[str, ...] = ()) -> None:
    write_partitioned(table, path, ("date",), sort=sort)


def write_metadata(metadata: DataFrame, path: str, start: str = "start_s",
                   value: str = "value") -> None:
    """Event metadata as JSON lines by UTC date of its quarter hour."""
    dated = metadata.select(F.col(start).alias("start_s"), F.col(value).alias("value"),
                            F.to_date(F.timestamp_seconds(F.col(start))).alias("date"))
    write_partitioned(dated, path, ("date",), file_format="json", sort=("start_s",))


def expired_partitions(partitions: DataFrame, today: dt.date,
                       days: int = Settings.retention_days) -> DataFrame:
    """(partition, date) of listed ``date=...`` partitions older than the retention."""
    date = F.regexp_extract("partition", r"date=(\d{4}-\d{2}-\d{2})", 1).try_cast("date")
    return (partitions.select("partition", date.alias("date"))
            .filter(F.col("date") < F.lit(today - dt.timedelta(days=days))))


def drop_partitions(spark: SparkSession, table: str, expired: DataFrame) -> int:
    """Drop the given date partitions from a catalog table; returns how many.

    One row per day is collected, never data.  Folders of an external table stay
    until storage removes them.
    """
    dates = [row["date"] for row in expired.select("date").distinct().collect()]
    for date in dates:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (`date` = DATE'{date}')")
    return len(dates)
