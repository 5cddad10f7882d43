"""Shared pieces of the text operators: reading, written intermediates, words, running sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from oddsline.session import work_folder

#: Words are runs of anything but these white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read again.

    Cuts the lineage, survives lost executors, and gives the planner the true size.
    """
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of narrow keys up to which they are sent to every executor (some 20 MB), so that
#: what they are looked up in stays where it is; more of them are met by sort-merge.
SENT_KEYS = 200_000


def sent(keys: DataFrame, most: int | None = None) -> DataFrame:
    """Keys of a join as a broadcast side if they are few, else for a sort-merge join.

    Give written or otherwise cheap rows, as they are counted unless their number is proved
    to be ``most`` at most.
    """
    few = (most is not None and most <= SENT_KEYS) or keys.limit(SENT_KEYS + 1).count() <= SENT_KEYS
    return F.broadcast(keys) if few else keys.hint("merge")


def row_batches(spark: SparkSession, rows: int = 512) -> None:
    """Bounds the rows that go to Python at once, so that long texts don't add up."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def lower_ascii(text: Column) -> Column:
    """Only A-Z are lower-cased; other letters stay."""
    return F.translate(text, UPPER, LOWER)


def row_hash(*columns: str | Column) -> Column:
    """A 64-bit hash of a row's content; nulls are told apart from empty texts."""
    given = [F.col(c) if isinstance(c, str) else c for c in columns]
    return F.xxhash64(*given, *[c.isNull() for c in given])


def unit(hashed: Column) -> Column:
    """A 64-bit hash as a number from 0 up to 1 (53 bits)."""
    return F.shiftrightunsigned(hashed, 11) / F.lit(float(1 << 53))


def join_nulls(left: DataFrame, right: DataFrame, columns: list[str], how: str = "inner") -> DataFrame:
    """Equi-join in which null keys meet; the right side's keys are dropped."""
    renamed = right.withColumnsRenamed({c: f"_right_{c}" for c in columns})
    condition = None
    for c in columns:
        same = F.col(c).eqNullSafe(F.col(f"_right_{c}"))
        condition = same if condition is None else condition & same
    return left.join(renamed, condition, how).drop(*[f"_right_{c}" for c in columns])


def running(df: DataFrame, group: str, order: str, value: str) -> DataFrame:
    """Adds ``_before`` (sum of ``value`` of all earlier rows of the group) and ``_rank``.

    ``order`` is a 64-bit hash. No task holds a group: a group of n rows is cut by the
    hash into about sqrt(n) ranges, whose totals are summed first; then each range is
    numbered alone. Rows with equal hashes must be equal rows, or their order is open.
    """
    groups = written(df.groupBy(group).agg(F.ceil(F.sqrt(F.count("*"))).alias("_ranges")), "groups")
    cut = (join_nulls(df, groups, [group])
           .withColumn("_range", F.floor(unit(F.col(order)) * F.col("_ranges"))))
    totals = cut.groupBy(group, "_range").agg(F.sum(value).alias("_sum"), F.count("*").alias("_n"))
    earlier = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(group, "_range", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_sum"),
                           F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_n"))
    inside = (Window.partitionBy(group, "_range").orderBy(F.shiftrightunsigned(order, 1), order)
              .rowsBetween(Window.unboundedPreceding, -1))
    return (join_nulls(cut, starts, [group, "_range"])
            .withColumn("_before", F.col("_sum") + F.coalesce(F.sum(value).over(inside), F.lit(0)))
            .withColumn("_rank", F.col("_n") + F.count("*").over(inside))
            .drop("_ranges", "_range", "_sum", "_n"))
