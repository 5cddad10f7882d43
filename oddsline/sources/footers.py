"""Counts and bounds of stored tables from the footers of their files, without reading a column.

Parquet keeps the number of rows and the smallest and largest value of each column chunk.
Spark answers count, min and max from them where its newer file source reads the table, which
a session has to be told; a copy of the caller's session is, the caller's own stays as it is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from oddsline.sources.tables import on_dates

_SETTINGS = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}
#: Types of whole numbers and the like; for texts and timestamps footers don't bind.
BOUNDED = (T.LongType, T.IntegerType, T.ShortType, T.ByteType, T.DoubleType, T.FloatType, T.BooleanType, T.DateType)


def footer_session(spark: SparkSession) -> SparkSession:
    """A session with the settings and views of ``spark`` that answers from footers."""
    copy = SparkSession(spark.sparkContext, spark._jsparkSession.cloneSession())
    for key, value in _SETTINGS.items():
        copy.conf.set(key, value)
    return copy


def stored_rows(spark: SparkSession, path: str) -> DataFrame:
    """One row: how many rows the Parquet files below a folder hold, whatever its layout."""
    files = footer_session(spark).read.option("recursiveFileLookup", "true").parquet(path)
    return files.agg(F.count(F.lit(1)).alias("rows"))


def stored_bounds(spark: SparkSession, path: str, schema: T.StructType, *columns: str,
                  date: str | None = None, until: str | None = None) -> DataFrame:
    """Per ``date`` folder: date, rows, and ``min_c`` and ``max_c`` of each of the columns.

    ``date`` and ``until`` name the folders to look into, as in ``on_dates``. Only columns whose
    bounds footers give are accepted.
    """
    for column in columns:
        if not isinstance(schema[column].dataType, BOUNDED):
            raise ValueError(f"footers don't bound {column} ({schema[column].dataType.simpleString()})")
    stored = on_dates(footer_session(spark).read.schema(schema).parquet(path), date, until)
    bounds = [f(c).alias(f"{name}_{c}") for c in columns for name, f in (("min", F.min), ("max", F.max))]
    return stored.groupBy("date").agg(F.count(F.lit(1)).alias("rows"), *bounds)


def stored_coverage(spark: SparkSession, **tables: tuple[str, T.StructType]) -> DataFrame:
    """First and last date, number of dates and rows of each table, given by path and schema."""
    out = None
    for name, (path, schema) in tables.items():
        days = stored_bounds(spark, path, schema)
        part = days.agg(F.min("date").alias("first_date"), F.max("date").alias("last_date"),
                        F.count("date").alias("dates"), F.sum("rows").alias("rows")).select(
                            F.lit(name).alias("table_name"), "first_date", "last_date", "dates", "rows")
        out = part if out is None else out.unionByName(part)
    return out
