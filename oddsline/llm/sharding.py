"""Sharding by a k-d tree with byte-weighted medians, in DataFrame operations only.

The rows are points in a space of metadata. A node with several shards is split along
its widest dimension (relative to the whole table) where its bytes divide in proportion to
the shards on either side. Split points come from histograms that are refined until one
bin holds next to nothing, for all nodes of a level at once, and no row is sorted. The tree is
data: a table of cuts for each level, which rows look up by the node they have come to.
Nodes, histograms and cuts stay tables at any number of shards; the driver sees
four widths, and how many searches go on.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from oddsline.llm.common import row_hash, running, sent, unit, written

BINS, MAX_PASSES = 1024, 8
#: A bin is small enough when it holds this share of its node's bytes.
TOLERANCE = 0.0002


def dimensions(docs: DataFrame) -> DataFrame:
    """Adds ``_size``, ``_h`` and the dimensions ``_k0`` to ``_k3``.

    These are: source, language (as codes), length (powers of two in 64 steps) and doc_id.
    The row hash as a fraction breaks ties, so a value that a third of all rows share can
    still be split anywhere. Nulls have a place of their own below all values.
    """
    text_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    marked = docs.withColumn("_size", text_bytes + 1).withColumn("_h", row_hash("doc_id", "text"))
    tie = unit(F.col("_h"))
    code = lambda c: F.when(F.col(c).isNull(), -1).otherwise(F.pmod(F.xxhash64(c), F.lit(1024)))
    return marked.withColumns({
        "_k0": code("source") + tie, "_k1": code("lang") + tie,
        "_k2": F.floor(F.log2("_size") * 64) + tie,
        "_k3": F.coalesce(F.col("doc_id").cast("double"), F.lit(-1.0)) + tie})


DIMENSIONS = ("_k0", "_k1", "_k2", "_k3")


def shards_for(rows: DataFrame, target_bytes: int) -> int:
    """How many leaves hold at most about ``target_bytes`` each."""
    total = rows.agg(F.sum("_size")).first()[0] or 0
    return max(1, math.ceil(total / target_bytes))


def value(dimension: Column) -> Column:
    """A row's place in a dimension that is given by number."""
    out = F.col(DIMENSIONS[0])
    for number, name in enumerate(DIMENSIONS[1:], 1):
        out = F.when(dimension == number, F.col(name)).otherwise(out)
    return out


def placed(rows: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """Adds ``shard``: the first shard of the node that a row comes to by the cuts of some levels.

    A level is small, at most a row a shard, and is sent to the rows; one too large for that
    is met by sort-merge. Rows of nodes that a level doesn't split stay where they are.
    """
    out = rows.withColumn("shard", F.lit(0))
    for depth, level in enumerate(levels):
        cuts = sent(level.select(F.col("first").alias("_first"), "left", "dimension", "cut"), 1 << depth)
        beyond = F.col("_first").isNotNull() & (value(F.col("dimension")) > F.col("cut"))
        out = (out.join(cuts, F.col("shard") == F.col("_first"), "left")
               .withColumn("shard", F.col("shard") + F.when(beyond, F.col("left")).otherwise(0))
               .drop("_first", "left", "dimension", "cut"))
    return out


def tree(rows: DataFrame, shards: int) -> list[DataFrame]:
    """The levels of the tree over ``rows`` (with the columns of :func:`dimensions`).

    Each has a row for every node that it splits: its ``first`` shard and number of ``shards``,
    the ``left`` ones of these for rows up to ``cut`` of the ``dimension``, the rest for
    those beyond.
    """
    spark = rows.sparkSession
    nodes = spark.range(1).select(F.lit(0).alias("first"), F.lit(shards).alias("shards"))
    levels: list[DataFrame] = []
    widths = None
    for _ in range(max(0, math.ceil(math.log2(shards)))):
        open_ = nodes.filter("shards > 1").withColumn("left", F.expr("(shards + 1) div 2").cast("int"))
        at = placed(rows, levels)
        bounds = at.groupBy("shard").agg(
            F.sum("_size").alias("bytes"), *[F.min(d).alias(f"lo{d}") for d in DIMENSIONS],
            *[F.max(d).alias(f"hi{d}") for d in DIMENSIONS])
        if widths is None:
            whole = bounds.first()
            widths = [max((whole[f"hi{d}"] - whole[f"lo{d}"]) if whole else 0, 1e-12) for d in DIMENSIONS]
        levels.append(cuts(at, open_.join(bounds.withColumnRenamed("shard", "first"), "first", "left"), widths,
                           1 << len(levels)))
        sides = F.array(F.struct("first", F.col("left").alias("shards")),
                        F.struct((F.col("first") + F.col("left")).alias("first"),
                                 (F.col("shards") - F.col("left")).alias("shards")))
        nodes = levels[-1].select(F.explode(sides).alias("_side")).select("_side.*")
    return levels


def cuts(rows: DataFrame, nodes: DataFrame, widths: list[float], most: int) -> DataFrame:
    """A level's nodes, ``most`` at most, with their cuts, by refined histograms.

    A search has an interval that the cut lies in, and the bytes below it. A pass cuts it
    into bins, adds up their bytes, and goes on in the one that crosses the goal. Nodes
    without rows are cut anywhere.
    """
    spread = [(F.col(f"hi{d}") - F.col(f"lo{d}")) / w for d, w in zip(DIMENSIONS, widths)]
    widest = F.lit(len(spread) - 1)
    for number in range(len(spread) - 2, -1, -1):
        widest = F.when(spread[number] == F.greatest(*spread), number).otherwise(widest)
    bound = lambda end: F.element_at(F.array(*[F.col(f"{end}{d}") for d in DIMENSIONS]), F.col("dimension") + 1)
    search = written(
        nodes.withColumn("dimension", F.coalesce(widest, F.lit(0))).select(
            "first", "shards", "left", "dimension", bound("lo").alias("lo"), bound("hi").alias("hi"), "bytes",
            (F.col("bytes") * F.col("left") / F.col("shards")).alias("goal"), F.lit(0).cast("long").alias("below"),
            F.lit(None).cast("double").alias("last"),
            F.when(F.col("bytes").isNull(), F.lit(0.0)).alias("cut")), "cuts")
    for _ in range(MAX_PASSES):
        if search.filter("cut IS NULL").isEmpty():
            break
        search = written(refined(rows, search, most), "cuts")
    # Equal rows only are left: they can't be told apart.
    return search.select("first", "shards", "left", "dimension", F.coalesce("cut", "hi").alias("cut"))


def refined(rows: DataFrame, search: DataFrame, most: int) -> DataFrame:
    """One pass of all searches of a level that have no cut yet."""
    asked = sent(search.filter("cut IS NULL").select(
        F.col("first").alias("shard"), "dimension", F.col("lo").alias("_lo"), F.col("hi").alias("_hi"), "goal",
        "below"), most)
    inside = (rows.join(asked, "shard").withColumn("_x", value(F.col("dimension")))
              .filter("_x >= _lo AND _x <= _hi"))
    step = F.when(F.col("_hi") > F.col("_lo"), (F.col("_x") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")))
    bin_ = F.least(F.lit(BINS - 1), F.floor(F.coalesce(step, F.lit(0.0)) * BINS))
    bins = inside.groupBy("shard", "goal", "below", bin_.alias("_bin")).agg(
        F.sum("_size").alias("_bytes"), F.min("_x").alias("_from"), F.max("_x").alias("_to"))
    earlier = Window.partitionBy("shard").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    under = bins.withColumns({"_under": F.col("below") + F.coalesce(F.sum("_bytes").over(earlier), F.lit(0)),
                              "_before": F.max("_to").over(earlier)})
    crossing = (under.filter((F.col("_under") < F.col("goal")) & (F.col("_under") + F.col("_bytes") >= F.col("goal")))
                .select(F.col("shard").alias("_shard"), "_bytes", "_from", "_to", "_under", "_before"))
    both = search.join(crossing, F.col("first") == F.col("_shard"), "left")
    last = F.coalesce("_before", "last")
    fine = (F.col("_from") == F.col("_to")) | (F.col("_bytes") <= TOLERANCE * F.col("bytes"))
    whole = (F.col("_under") + F.col("_bytes") - F.col("goal") <= F.col("goal") - F.col("_under")) | last.isNull()
    found = F.when(fine, F.when(whole, F.col("_to")).otherwise(last))
    met = F.col("_shard").isNotNull()
    return both.select(
        "first", "shards", "left", "dimension", F.when(met, F.col("_from")).otherwise(F.col("lo")).alias("lo"),
        F.when(met, F.col("_to")).otherwise(F.col("hi")).alias("hi"), "bytes", "goal",
        F.when(met, F.col("_under")).otherwise(F.col("below")).alias("below"),
        F.when(met, last).otherwise(F.col("last")).alias("last"),
        F.when(met, found).otherwise(F.col("cut")).alias("cut"))


def sharded(docs: DataFrame, shards: int) -> DataFrame:
    """Per row: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    ``size`` is the UTF-8 bytes of the text (null: none) plus 1; shards are near equal in
    bytes. ``slot`` numbers the rows of a shard from 0 without gaps. Equal rows can't be
    told apart by the tree and lie together. With fewer rows than shards some stay empty;
    an empty table gives an empty result. Extra columns are ignored.
    """
    rows = written(dimensions(docs.select("doc_id", "text", "source", "lang"))
                   .select("doc_id", F.crc32("text").alias("text_crc32"), "_size", "_h", *DIMENSIONS), "points")
    return running(placed(rows, tree(rows, shards)), "shard", "_h", "_size").select(
        "doc_id", F.col("_size").alias("size"), "text_crc32", F.lit("bytes").alias("law"), "shard",
        F.col("_rank").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def with_shard(docs: DataFrame, shards: int) -> DataFrame:
    """``docs`` with a column ``shard`` (an existing one is replaced); texts are not shuffled."""
    rows = written(dimensions(docs.select("doc_id", "text", "source", "lang")).select("_size", *DIMENSIONS), "points")
    needed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "shard"]).alias("_row"),
                         "doc_id", "text", "source", "lang")
    return placed(dimensions(needed), tree(rows, shards)).select("_row.*", "shard")
