"""Connected components of a large graph, without holding a component in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from oddsline.llm.common import written


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """(``id``, ``component``) for every end of an edge; the component is its smallest id.

    Alternates large-star and small-star steps: every node's neighbours are tied to its
    smallest one, which ends in one star per component after a few rounds. Each round is
    aggregates and equi-joins of narrow rows (skewed ones are split by adaptive
    execution) and is written to the shared folder. Edges with a null end are ignored;
    without edges the result is empty.
    """
    a, b = F.col(left).cast("long"), F.col(right).cast("long")
    current = written(edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
                      .filter("a > b").distinct(), "edges")
    state = fingerprint(current)
    while state[0]:
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        smallest = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (both.join(smallest, "a").filter("b > a AND m < b")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        large = written(large, "large")
        smallest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(smallest, "a").filter("b != m")
                 .select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(smallest.select("a", F.col("m").alias("b"))).distinct())
        current = written(small, "edges")
        before, state = state, fingerprint(current)
        if state == before:
            break
    roots = current.select(F.col("b").alias("id")).distinct()
    return (current.select(F.col("a").alias("id"), F.col("b").alias("component"))
            .union(roots.select("id", F.col("id").alias("component"))))


def fingerprint(edges: DataFrame) -> tuple[int, int]:
    """Number of edges and an order-free checksum of them."""
    mixed = F.xxhash64("a", "b").cast("decimal(38,0)")
    row = edges.agg(F.count("*").alias("n"), F.coalesce(F.sum(mixed), F.lit(0)).alias("s")).first()
    return int(row["n"]), int(row["s"])
