"""Registration of queries and of the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from oddsline.functions.rounding import half_away
from oddsline.session import use_utc

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; timestamps leave it without zone, as the oracle has them."""
    def register(function: Query) -> Query:
        @wraps(function)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return without_zone(function(use_utc(spark), folder))
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run
    return register


def without_zone(df: DataFrame) -> DataFrame:
    zoned = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned}) if zoned else df


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Round sums and means, whose last bits depend on the order of addition."""
    return df.withColumns({c: half_away(c, digits).alias(c) for c in columns})
