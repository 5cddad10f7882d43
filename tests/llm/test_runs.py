"""Periodic runs against plain loops over all periods."""

import hashlib
import random
import zlib

import pytest

from oddsline.llm import runs as R
from oddsline.llm.queries import QUERIES
from tests.conftest import DATA
from tests.llm import edge


def brute(words, least=6, repeats=4):
    n, out = len(words), {}
    for p in range(1, n // 2 + 1):
        start = 0
        while start + p < n:
            end = start
            while end + p < n and words[end] == words[end + p]:
                end += 1
            if end - start >= p:
                out.setdefault((start, end - start + p), p)
            start = max(end, start) + 1
    return sorted(((s, n, p) for (s, n), p in out.items() if n >= max(least, repeats * p)),
                  key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    drop = {i for s, n, p in runs for i in range(s + p, s + n)}
    return b" ".join(w for i, w in enumerate(words) if i not in drop)


def planted(doc_id, words):
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def digest(doc_id, text):
    words = planted(doc_id, (text or "").encode().split())
    found = brute(words)
    top = min(((-n, s, p) for s, n, p in found), default=None)
    four = (top[1], -top[0], top[2], 1000 * -top[0] // top[2]) if top else (None,) * 4
    lines = "".join(f"{s},{n},{p}\n" for s, n, p in found)
    return (doc_id, len(found), *four, hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(collapsed(words, found)).hexdigest())


@pytest.mark.parametrize("least,repeats", [(6, 4), (2, 2), (1, 3)])
def test_against_all_periods(least, repeats):
    rnd = random.Random(least)
    for _ in range(400):
        texts = []
        for _ in range(rnd.randrange(1, 4)):
            n, letters = rnd.randrange(40), rnd.choice([1, 2, 3])
            words = [b"%d" % rnd.randrange(letters) for _ in range(n)]
            if n and rnd.random() < 0.5:
                a = rnd.randrange(n)
                p = 1 + rnd.randrange(n - a)
                words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
            texts.append(words)
        assert R.block_runs(texts, least, repeats) == [brute(t, least, repeats) for t in texts]


def test_nested_runs():
    # aab repeated: the whole and, inside, nothing of four a's; then a run in the repeated part.
    words = b"x aab aab aab aab a a a a b a a a a b a a a a b a a a a b y".split()
    found = R.block_runs([words], 4, 4)[0]
    assert found == brute(words, 4, 4)
    assert {p for _, _, p in found} == {1, 5}


def test_long_documents():
    for words, want in (([b"a"] * 30000, [(0, 30000, 1)]),
                        ([b"%d" % (i % 900) for i in range(30000)], [(0, 30000, 900)]),
                        ([b"%d" % i for i in range(30000)], [])):
        assert R.block_runs([words, [b"a"], []], 6, 4) == [want, [], []]


def test_white_space_and_blocks(spark, monkeypatch):
    rows = [(1, "a\x0ba\x0ca\ra\na\ta a", "en", "a", 1), (2, "a\x1ca\x85a\xa0a a a", "en", "a", 1)]
    got = {r["doc_id"]: r for r in R.periodic_runs(edge.documents(spark, rows)).collect()}
    assert [tuple(r) for r in got[1]["runs"]] == [(0, 7, 1)] and got[1]["collapsed"] == "a"
    assert got[2]["runs"] == [] and got[2]["collapsed"] == rows[1][1]


def test_edge_rows(spark):
    docs = edge.documents(spark, clash=("runs", "collapsed", "_text", "start"))
    got = edge.rows_of(R.summarised(R.periodic_runs(R.with_planted_runs(docs))))
    want = [digest(d, t) for d, t, *_ in edge.document_rows()]
    assert got == sorted(want, key=lambda r: tuple((x is not None, str(x)) for x in r))
    assert any(r[1] for r in got) and any(not r[1] for r in got)
    assert R.summarised(R.periodic_runs(R.with_planted_runs(edge.empty(spark)))).count() == 0


def test_without_ids(spark):
    docs = edge.documents(spark, [(None, "a " * 9, "en", "a", 1), (None, None, None, None, None)])
    got = edge.rows_of(R.summarised(R.periodic_runs(R.with_planted_runs(docs))))
    assert got == sorted([digest(None, "a " * 9), digest(None, None)],
                         key=lambda r: tuple((x is not None, str(x)) for x in r))


def test_query_against_plain_code(spark):
    got = edge.rows_of(QUERIES["op13_periodic_run_detection"](spark, f"{DATA}/sf0.001"))
    texts = spark.read.parquet(f"{DATA}/sf0.001/documents.parquet").select("doc_id", "text").collect()
    want = [digest(d, t) if len((t or "").split()) < 2500 else None for d, t in texts]
    known = [w for w in want if w]
    assert len(got) == len(texts) and len(known) > 180
    assert set(known) <= set(got) and any(w[1] for w in known)
