"""Shards near equal in bytes, gapless slots, ties and odd rows."""

import random
import zlib
from collections import defaultdict

import pytest

from oddsline.llm import sharding as S
from tests.llm import edge


def check(rows, got, shards, slack):
    by = defaultdict(list)
    for r in got:
        by[r["shard"]].append(r)
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in got) == sorted(
        (str(d), len((t or "").encode()) + 1, None if t is None else zlib.crc32(t.encode())) for d, t, *_ in rows)
    for members in by.values():
        assert sorted(r["slot"] for r in members) == list(range(len(members)))
    total = [sum(r["size"] for r in by[s]) for s in range(shards)]
    assert max(total) - min(total) <= slack, total
    assert {r["law"] for r in got} <= {"bytes"} and {r["grown_shard"] for r in got} <= {None}


@pytest.mark.parametrize("shards", [16, 5, 1])
def test_near_equal_bytes(spark, shards):
    rnd = random.Random(3)
    rows = [(i, "x" * rnd.choice([0, 3, 50, 400]), rnd.choice(["en", "en", "de", None]),
             "hot" if rnd.random() < 0.4 else rnd.choice("abc"), 1) for i in range(1500)]
    check(rows, S.sharded(edge.documents(spark, rows, clash=("shard", "slot", "_k0")), shards).collect(), shards, 1700)


def test_third_of_rows_alike(spark):
    rows = [(i, "same text", "en", "s", 1) for i in range(900)]
    check(rows, S.sharded(edge.documents(spark, rows), 16).collect(), 16, 60)


def test_edge_rows(spark):
    docs = edge.documents(spark, clash=("shard", "_size", "_k0"))
    got = S.sharded(docs, 16).collect()
    check(edge.document_rows(), got, 16, 10**6)
    assert S.sharded(edge.empty(spark), 16).count() == 0
    one = edge.documents(spark, [(1, None, None, None, None)])
    assert [(r["size"], r["text_crc32"], r["slot"]) for r in S.sharded(one, 16).collect()] == [(1, None, 0)]
    out = S.with_shard(docs, 16)
    assert sorted(out.columns) == sorted(docs.columns)
    shard = {str(r["doc_id"]): r["shard"] for r in got}
    assert all(shard[str(r["doc_id"])] == r["shard"] for r in out.collect())


def test_shards_for(spark):
    rows = S.dimensions(edge.documents(spark))
    total = sum(len((r[1] or "").encode()) + 1 for r in edge.document_rows())
    assert S.shards_for(rows, 1000) == -(-total // 1000)
    assert S.shards_for(S.dimensions(edge.empty(spark)), 1000) == 1


def exact(points, shards):
    """Shard of each point by sorted, exact medians: (size, dimensions) in, first shards out."""
    spread = lambda ps: [max(p[1][d] for p in ps) - min(p[1][d] for p in ps) for d in range(4)]
    widths = [max(w, 1e-12) for w in spread(points)]
    out = {}

    def split(members, first, n):
        if n == 1 or not members:
            out.update((m, first) for m in members)
            return
        left = (n + 1) // 2
        wide = spread([points[m] for m in members])
        d = max(range(4), key=lambda k: (wide[k] / widths[k], -k))
        order = sorted(members, key=lambda m: points[m][1][d])
        goal = sum(points[m][0] for m in members) * left / n
        below, cut = 0, None
        for m in order:
            size, x = points[m][0], points[m][1][d]
            if below + size >= goal:
                cut = x if below + size - goal <= goal - below or cut is None else cut
                break
            below, cut = below + size, x
        split([m for m in members if points[m][1][d] <= cut], first, left)
        split([m for m in members if points[m][1][d] > cut], first + left, n - left)

    split(list(range(len(points))), 0, shards)
    return [out[m] for m in range(len(points))]


@pytest.mark.parametrize("shards", [2, 7, 16])
def test_cuts_are_exact_medians(spark, monkeypatch, shards):
    monkeypatch.setattr(S, "TOLERANCE", 0.0)  # until a bin holds one point
    rnd = random.Random(shards)
    rows = [(i * 17 % 1009, "x" * rnd.choice([0, 3, 50, 400]) + str(i), rnd.choice(["en", "de", None]),
             "hot" if rnd.random() < 0.4 else rnd.choice("abc"), 1) for i in range(400)]
    points = S.dimensions(edge.documents(spark, rows))
    table = S.placed(points, S.tree(points, shards)).select("_size", *S.DIMENSIONS, "shard").collect()
    assert [r["shard"] for r in table] == exact([(r["_size"], [r[d] for d in S.DIMENSIONS]) for r in table], shards)


def test_many_shards(spark):
    rnd = random.Random(1)
    rows = [(i, "x" * rnd.randrange(400), "en", rnd.choice("abc"), 1) for i in range(4000)]
    got = S.with_shard(edge.documents(spark, rows), 512).groupBy("shard").count().collect()
    assert len(got) == 512 and {r["shard"] for r in got} == set(range(512))


def test_large_levels_are_met_by_merge(spark, monkeypatch):
    rows = [(i, "x" * (i % 50), "en", "s", 1) for i in range(300)]
    docs = edge.documents(spark, rows)
    want = sorted((r["doc_id"], r["shard"]) for r in S.with_shard(docs, 8).collect())
    monkeypatch.setattr("oddsline.llm.common.SENT_KEYS", 1)
    assert sorted((r["doc_id"], r["shard"]) for r in S.with_shard(docs, 8).collect()) == want
