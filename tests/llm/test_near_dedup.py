"""Near-duplicate groups against all pairs, and the parts of the index."""

import random

import numpy as np
import pytest

from oddsline.llm import near_dedup as N
from oddsline.llm.components import components
from tests.llm import edge


def words(text):
    return (text or "").encode().lower().split()


def shingles(text):
    w = words(text)
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    """{doc_id: component} by comparing all pairs."""
    sets = [(d, shingles(t)) for d, t in rows if d is not None]
    root = {d: d for d, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= 85 * len(x | y):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {d: find(d) for d in root}


def near_copies(rnd, n):
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for base in range(n):
        text = [rnd.choice(vocabulary) for _ in range(rnd.randrange(3, 120))]
        for _ in range(rnd.randrange(1, 9)):
            copy = list(text)
            for _ in range(rnd.randrange(0, 5)):
                copy[rnd.randrange(len(copy))] = rnd.choice(vocabulary)
            rows.append((len(rows) * 7 % 1009, " ".join(copy)))
    return rows


@pytest.mark.parametrize("block_rows", [512, 3])
def test_against_all_pairs(spark, monkeypatch, block_rows):
    monkeypatch.setattr(N, "BLOCK_ROWS", block_rows)  # small blocks: clusters are compared block by block
    rows = near_copies(random.Random(4), 45)
    got = {r["doc_id"]: r["component_id"] for r in
           N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows)
    assert len(set(got.values())) < len(got)


def test_edge_rows(spark):
    got = {(r["doc_id"], r["n_shingles"]): (r["component_id"], r["kept"])
           for r in N.near_duplicates(edge.documents(spark, clash=("component_id", "kept", "key", "n"))).collect()}
    want = brute([(r[0], r[1]) for r in edge.document_rows()])
    assert {d: c for (d, _), (c, _) in got.items() if d is not None} == want
    assert got[(None, len(shingles(edge.document_rows()[0][1])))] == (None, True)
    assert got[(4, 0)] == (4, True) and got[(7, 1)] == (7, True) and got[(8, 1)] == (7, False)
    assert N.near_duplicates(edge.empty(spark)).count() == 0


def test_one_of_each_group_stays(spark):
    docs = edge.documents(spark, clash=("component_id", "_dropped"))
    kept = N.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] in (1, 2, 3, 7, 8)) == [1, 7]


def brute_rows(rows):
    """Component of each row, rows being apart unless their sets are equal or linked."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(d, least.get(find(i), d))
    return [least[find(i)] for i in range(len(rows))], [find(i) for i in range(len(rows))]


def test_rows_that_share_an_id_are_judged_by_their_own_text(spark):
    rnd = random.Random(9)
    a, b = (" ".join(f"{name}{rnd.randrange(10 ** 6)}" for _ in range(60)) for name in "ab")
    cases = [[(5, a + " tail"), (5, b + " tail"), (9, a), (12, b)],
             [(5, a), (5, b), (3, a)], [(7, a), (7, a), (7, a)], [(5, a), (5, a.upper()), (5, b), (5, b), (8, b)],
             [(4, None), (4, ""), (4, a), (4, ""), (2, a + " x")], [(1, a), (2, a), (2, a), (1, a), (1, b)]]
    rows = [(100 * i + d, t) for i, case in enumerate(cases) for d, t in case]
    # the texts of a case must not meet those of another one
    rows = [(d, t and " ".join(f"{w}q{d // 100}" if w != "tail" else w for w in t.split())) for d, t in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    component, group = brute_rows(rows)
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in N.near_duplicates(docs).collect())
    assert got == sorted((d, len(shingles(t)), c, d == c) for (d, t), c in zip(rows, component))
    kept = [(r["doc_id"], r["text"]) for r in N.keep_first(docs).collect()]
    for g in set(group):
        members = {rows[i] for i in range(len(rows)) if group[i] == g}
        stays = [r for r in kept if r in members]
        assert len(stays) == 1 and stays[0][0] == min(d for d, _ in members), members
    assert len(kept) == len({(g if shingles(t) else (d, t)) for g, (d, t) in zip(group, rows)})


def test_rows_with_copies_keep_one(spark):
    docs = edge.documents(spark, clash=("_id", "_hash", "_copies", "node"))
    rows = N.keep_first(docs).collect()
    assert sum(r["doc_id"] is None for r in rows) == 1 and sum(r["doc_id"] == 2 for r in rows) == 0
    twice = N.keep_first(docs.unionByName(docs))
    assert twice.columns == docs.columns
    key = lambda rs: sorted(str((r["doc_id"], r["text"])) for r in rs if r["doc_id"] is not None)
    assert key(twice.collect()) == key(rows)
    assert N.keep_first(edge.empty(spark)).count() == 0


def test_signature_distance_is_guaranteed():
    """Signatures up to 11 symbols apart share an index entry."""
    rnd = np.random.default_rng(5)
    import pyarrow as pa
    for errors in range(12):
        a = rnd.integers(0, 1 << 16, 32).astype(np.uint16)
        b = a.copy()
        b[rnd.choice(N.SYMBOLS, errors, replace=False)] ^= np.uint16(1)
        batch = pa.RecordBatch.from_arrays(
            [pa.array([0, 1]), *[pa.array([x.view(np.int64)[i] for x in (a, b)]) for i in range(8)]],
            names=["id", *[f"c{i}" for i in range(8)]])
        keys = [set(), set()]
        for out in N.entries([batch]):
            for key, i in zip(out.column("key").to_pylist(), out.column("id").to_pylist()):
                keys[i].add(key)
        assert keys[0] & keys[1]


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 103), (103, 101), (7, 7), (None, 3), (200, 200)]
    got = {r["id"]: r["component"] for r in components(
        spark.createDataFrame(chain, "x long, y long"), "x", "y").collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 103: 100}
    assert components(spark.createDataFrame([], "x long, y long"), "x", "y").count() == 0
