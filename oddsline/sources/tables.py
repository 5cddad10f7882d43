"""Stored tables: definitions, scans and inspection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from oddsline import schemas
from oddsline.config import Settings
from oddsline.functions.symbols import symbol_to_crypto
from oddsline.functions.times import epoch_to_timestamp, mixed_timestamp

KLINE_COLUMNS = ("binance_time", "crypto", "symbol", "open", "high", "low", "close", "volume", "date")
PROBABILITY_COLUMNS = ("poly_time", "crypto", "asset_id", "market", "price", "event_type", "date")


def on_dates(df: DataFrame, date: str | None, until: str | None = None) -> DataFrame:
    """Bounds on the partition column, so that a stored table is pruned to these folders:
    one date, or all from ``date`` to ``until`` (both included, either may be open)."""
    if until is None:
        return df if date is None else df.filter(F.col("date") == F.lit(date).cast("date"))
    df = df if date is None else df.filter(F.col("date") >= F.lit(date).cast("date"))
    return df.filter(F.col("date") <= F.lit(until).cast("date"))


def is_cleansed(table: DataFrame) -> bool:
    """Whether a table holds cleansed rows, which carry their time as a timestamp."""
    return "event_time" in table.columns


def load_klines(klines: DataFrame, date: str | None = None, settings: Settings = Settings(),
                keep: tuple[str, ...] = (), until: str | None = None) -> DataFrame:
    """Candle snapshots, raw or cleansed, with event time and asset name.

    Raw tables count ``timestamp`` in ``settings.epoch_unit``; cleansed ones need no unit.
    ``keep`` carries further columns along, e.g. ``snapshot_time`` to order snapshots
    of one candle.
    """
    time = (F.col("event_time") if is_cleansed(klines)
            else epoch_to_timestamp("timestamp", settings.epoch_unit))
    return on_dates(klines, date, until).withColumns({
        "binance_time": time,
        "crypto": symbol_to_crypto("symbol", settings.pairs),
    }).select(*KLINE_COLUMNS, *keep)


def load_probabilities(events: DataFrame, date: str | None = None,
                       settings: Settings = Settings(), until: str | None = None) -> DataFrame:
    """Market events, raw or cleansed, with a readable price; bids and asks are never read.

    The typed price of a cleansed table is filtered inside its scan.  All markets carry
    the default asset; see ``operators.windows.tag_markets`` for tagging by token.
    """
    events = on_dates(events, date, until)
    if is_cleansed(events):
        time, price = F.col("event_time"), F.col("last_trade_price")
        events = events.filter(price.isNotNull())
    else:
        time, price = mixed_timestamp("timestamp"), F.col("last_trade_price").try_cast("double")
    return (events.select(time.alias("poly_time"), F.lit(settings.default_crypto).alias("crypto"),
                          "asset_id", "market", price.alias("price"), "event_type", "date")
            .filter(F.col("price").isNotNull()))


def create_table(spark: SparkSession, name: str, schema: T.StructType, location: str,
                 partition: str = "date") -> None:
    """External Parquet table over date folders (existing folders need ``repair_partitions``)."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
              f"OPTIONS (compression 'snappy') PARTITIONED BY (`{partition}`) LOCATION '{location}'")


def create_klines_table(spark: SparkSession, name: str, location: str) -> None:
    create_table(spark, name, schemas.KLINES, location)


def create_market_events_table(spark: SparkSession, name: str, location: str, cleansed: bool = False) -> None:
    create_table(spark, name, schemas.CLEANSED_EVENTS if cleansed else schemas.MARKET_EVENTS, location)


def repair_partitions(spark: SparkSession, name: str) -> None:
    """Register folders that were added since the last call."""
    spark.catalog.recoverPartitions(name)


def list_partitions(spark: SparkSession, name: str) -> DataFrame:
    """Partitions known to the catalog; no data file is opened."""
    return spark.sql(f"SHOW PARTITIONS {name}")


def read_files(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All Parquet files below a folder, whatever its layout."""
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path)


def latest_snapshots(klines: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` newest snapshots (a bounded top-k, merged from per-partition heaps)."""
    return (klines.filter(F.col("snapshot_time").isNotNull())
            .select("symbol", "timestamp", "snapshot_time", "close")
            .orderBy(F.desc("snapshot_time"), "symbol", F.desc("timestamp"), F.desc("close"))
            .limit(n))


def row_counts(**tables: DataFrame) -> DataFrame:
    """One row (table_name, rows) per given table."""
    counts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
              for name, df in tables.items()]
    result = counts[0]
    for other in counts[1:]:
        result = result.unionByName(other)
    return result


def date_coverage(**tables: DataFrame) -> DataFrame:
    """First and last date, number of dates and rows of each table."""
    parts = [df.groupBy("date").agg(F.count(F.lit(1)).alias("n"))
             .agg(F.min("date").alias("first_date"), F.max("date").alias("last_date"),
                  F.count("date").alias("dates"), F.sum("n").alias("rows"))
             .select(F.lit(name).alias("table_name"), "first_date", "last_date", "dates", "rows")
             for name, df in tables.items()]
    result = parts[0]
    for other in parts[1:]:
        result = result.unionByName(other)
    return result


def counts_per(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
