"""Mixing sources to target weights along a training curriculum, in DataFrame operations only.

Every source has a weight that changes linearly over training time (0 to 1). Its integral
is the source's share of all words; what a source is to give in all, and until any time,
follows from it. Documents stand in a fixed pseudo-random order within their source, pass
after pass; the number of words before a document, looked up in the inverse of the
source's cumulative demand, is the document's training time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from oddsline.llm.common import WORD, join_nulls, row_hash, running, written

PASSES = 3


def schedules(sources: DataFrame) -> DataFrame:
    """The default schedule of each source: (source, begin, end).

    Sources by code point, null last, have mean weights 1, 2, 3, repeating. Weight 1
    fades out over training, weight 2 is constant and weight 3 grows.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    mean = ((rank - 1) % 3 + 1).cast("double")
    slope = (mean - 2) / 2
    return (sources.select("source").withColumn("_mean", mean).withColumn("_slope", slope)
            .select("source", (F.col("_mean") * (1 - F.col("_slope"))).alias("begin"),
                    (F.col("_mean") * (1 + F.col("_slope"))).alias("end")))


def targets(sources: DataFrame, schedule: DataFrame) -> DataFrame:
    """(source, source_size) and (source, begin, end) to source, source_size, target, slope.

    All sizes are shared by the integral of the weights; a target stops at three times
    its source's size, and the excess is shared anew until none is above. That level is
    found at once: by rising limit per weight, a source is at its limit when the level
    that the sources before it leave is higher. Works on one row per source.
    """
    rows = (join_nulls(sources, schedule, ["source"])
            .withColumn("_weight", (F.col("begin") + F.col("end")) / 2)
            .withColumn("_limit", PASSES * F.col("source_size")))
    whole = Window.partitionBy(F.lit(1))
    before = (Window.partitionBy(F.lit(1)).orderBy(F.col("_limit") / F.col("_weight"), F.col("source").asc_nulls_last())
              .rowsBetween(Window.unboundedPreceding, -1))
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum("_limit").over(before), F.lit(0))
    weights = F.sum("_weight").over(whole) - F.coalesce(F.sum("_weight").over(before), F.lit(0.0))
    leveled = rows.withColumn("_level", left / weights)
    free = F.col("_weight") * F.col("_level") <= F.col("_limit")
    level = F.max(F.when(free, F.col("_level"))).over(whole)
    target = F.least(F.col("_limit").cast("double"), F.col("_weight") * F.coalesce(level, F.lit(0.0)))
    slope = (F.col("end") - F.col("begin")) / (F.col("end") + F.col("begin"))
    return leveled.withColumn("target", target).select("source", "source_size", "target", slope.alias("slope"))


def training_time(share: Column, slope: Column) -> Column:
    """When the demand reaches a share of the total: solves (1 - s) t + s t^2 = share."""
    root = F.sqrt(F.pow(1 - slope, F.lit(2)) + 4 * slope * share)
    return F.when(F.abs(slope) < 1e-12, share).otherwise((root - (1 - slope)) / (2 * slope) + 0.0)


def mixed(docs: DataFrame, schedule: DataFrame | None = None) -> DataFrame:
    """Per row: doc_id, size, source_size, target, taken, position, and the row hash ``_h``.

    ``size`` counts words (null text: 0), ``taken`` the words that the mix takes, repeats
    counted: whole passes over the source, and of the last pass the documents first in
    the pseudo-random order, the last of them in part, so that a source's taken words
    equal its rounded target. ``position`` is the time of the first copy, null if none.
    Documents without words are never taken. Equal rows are told apart arbitrarily, so
    only their set of results is fixed. Extra columns are ignored.
    """
    rows = written(docs.select(
        "doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        row_hash("doc_id", "text").alias("_h")), "sizes")
    sources = written(rows.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    aims = written(targets(sources, schedule if schedule is not None else schedules(sources)), "targets")
    placed = join_nulls(running(rows, "source", "_h", "size"), aims, ["source"])
    words = F.least(F.round("target").cast("long"), PASSES * F.col("source_size"))
    full = F.when(F.col("source_size") > 0, F.floor(words / F.col("source_size"))).otherwise(0)
    rest = words - F.col("_full") * F.col("source_size")
    taken = (F.col("_full") * F.col("size")
             + F.least(F.col("size"), F.greatest(F.lit(0).cast("long"), rest - F.col("_before"))))
    share = F.when((F.col("taken") > 0), F.least(F.lit(1.0), F.col("_before") / F.col("target")))
    return (placed.withColumn("_full", full).withColumn("taken", taken.cast("long"))
            .withColumn("position", training_time(share, F.col("slope")))
            .select("doc_id", "size", "source_size", "target", "taken", "position", "slope", "_before", "_h"))


def in_order(rows: DataFrame) -> DataFrame:
    """Rows range-sorted by training time; those not taken come last."""
    return rows.orderBy(F.col("position").asc_nulls_last(), "doc_id")


def mixed_documents(docs: DataFrame, schedule: DataFrame | None = None) -> DataFrame:
    """``docs`` as the mix reads them: a row per copy, in training order, columns unchanged.

    Only whole documents: a copy is read if at least half of it lies within the target.
    Equal rows are read equally often.
    """
    plan = mixed(docs, schedule).filter("size > 0")
    copies = (plan.withColumn("_pass", F.explode(F.sequence(F.lit(0), F.lit(PASSES - 1))))
              .withColumn("_at", F.col("_pass") * F.col("source_size") + F.col("_before"))
              .filter(F.col("_at") + F.col("size") / 2 <= F.col("target"))
              .withColumn("_time", training_time(F.least(F.lit(1.0), F.col("_at") / F.col("target")), F.col("slope"))))
    once = copies.groupBy(F.col("doc_id").alias("_id"), F.col("_h").alias("_hash"), "_pass").agg(F.min("_time").alias("_time"))
    read = docs.select(F.struct("*").alias("_row"), "doc_id", row_hash("doc_id", "text").alias("_h"))
    rows = read.join(once, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_h") == F.col("_hash")))
    return rows.orderBy("_time", "_id").select("_row.*")
