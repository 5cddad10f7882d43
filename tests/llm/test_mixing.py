"""Targets and taken words against plain code; order, repeats and odd rows."""

import random
import re
from collections import defaultdict

import pytest

from oddsline.llm import mixing as M
from tests.llm import edge


def sizes(rows):
    total = defaultdict(int)
    for r in rows:
        total[r[3]] += len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))
    return dict(total)


def brute_targets(total):
    """Shares the excess again and again, as the rule is worded."""
    names = sorted(total, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    capped: dict = {}
    while True:
        free = [s for s in names if s not in capped]
        left = sum(total.values()) - sum(capped.values())
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = [s for s in free if share[s] > 3 * total[s]]
        if not over:
            return capped | share
        capped |= {s: 3.0 * total[s] for s in over}


def mixed_rows(seed):
    rnd = random.Random(seed)
    return [(i, " ".join(["w"] * rnd.choice([0, 1, 5, 40, 300])), "en", rnd.choice(
        ["a", "B", "é", "z", None, "hot", "hot", "hot", "hot"]), 1) for i in range(300)]


@pytest.mark.parametrize("seed", [1, 2])
def test_targets_and_taken(spark, seed):
    rows = mixed_rows(seed) + [(1000 + i, "tiny", "en", f"t{i}", 1) for i in range(9)]
    got = M.mixed(edge.documents(spark, rows, clash=("size", "target", "_h", "weight"))).collect()
    want, total = brute_targets(sizes(rows)), sizes(rows)
    source = {r[0]: r[3] for r in rows}
    taken = defaultdict(int)
    for r in got:
        s = source[r["doc_id"]]
        assert r["source_size"] == total[s] and r["target"] == pytest.approx(want[s], rel=1e-9)
        assert 0 <= r["taken"] <= 3 * r["size"] and (r["position"] is None) == (r["taken"] == 0)
        assert r["position"] is None or 0 <= r["position"] <= 1
        taken[s] += r["taken"]
    assert len(got) == len(rows)
    for s in total:
        assert abs(taken[s] - want[s]) <= 0.5 + 1e-6
    again = M.mixed(edge.documents(spark, rows).repartition(7)).collect()
    assert sorted((r["doc_id"], r["taken"], r["position"] or 0) for r in got) == sorted(
        (r["doc_id"], r["taken"], r["position"] or 0) for r in again)


def test_training_time_inverts_the_demand(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(t / 20, s / 4) for t in range(21) for s in range(-4, 5)], "t double, s double")
    share = (1 - F.col("s")) * F.col("t") + F.col("s") * F.col("t") * F.col("t")
    assert df.filter(F.abs(M.training_time(share, F.col("s")) - F.col("t")) > 1e-6).count() == 0


def test_edge_rows(spark):
    docs = edge.documents(spark, clash=("_pass", "taken", "_row", "_id"))
    rows = M.mixed(docs).collect()
    assert len(rows) == docs.count()
    assert all(r["taken"] == 0 for r in rows if r["doc_id"] in (4, 5, 6))
    assert M.mixed(edge.empty(spark)).count() == 0
    out = M.mixed_documents(docs)
    assert out.columns == docs.columns
    counts = defaultdict(int)
    for r in out.collect():
        counts[r["doc_id"]] += 1
    assert max(counts.values()) <= 6 and not {4, 5, 6} & set(counts)  # doc 2 is there twice
    assert M.mixed_documents(edge.empty(spark)).count() == 0
    blank = [(i, None, "en", "a", 0) for i in range(3)]
    assert [r["taken"] for r in M.mixed(edge.documents(spark, blank)).collect()] == [0, 0, 0]
