"""Held-out accuracy, calibration, and odd rows."""

import zlib

import numpy as np

from oddsline.llm import language as L
from tests.conftest import DATA
from tests.llm import edge


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.01/documents.parquet")
    rows = L.identified(docs, L.fit(docs)).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert {r["doc_id"] for r in held} == {r["doc_id"] for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1}
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_temperature_mends_overconfidence():
    rng = np.random.default_rng(1)
    labels = rng.integers(0, 3, 400)
    logits = rng.normal(size=(400, 3))
    logits[np.arange(400), labels] += 1
    assert 4 < L.calibrated(logits * 6, labels) / L.calibrated(logits, labels) < 8
    assert L.calibrated(np.zeros((0, 2)), np.zeros(0, int)) == 1.0


def test_penalty_leaves_weights_at_zero():
    rows = [(np.array([k % 5, 100 + k % 7]), np.array([0.9, 0.1]), k % 2) for k in range(40)]
    weights, _ = L.follow_leader(rows, 2)
    assert np.count_nonzero(weights) <= 2 * 12


def test_terms():
    assert L.term_counts(None) is None and L.term_counts("12 !? _ \n") is None
    upper, lower = L.term_counts("Aé, b1"), L.term_counts("aé b")
    assert all((x == y).all() for x, y in zip(upper, lower))
    assert L.term_counts("x" * 300000)[1].sum() == 3 * 300002 - 3


def test_edge_rows(spark):
    docs = edge.documents(spark, clash=("held_out", "score"))
    rows = L.identified(docs, L.fit(docs)).collect()
    assert len(rows) == docs.count()
    by = {r["doc_id"]: r for r in rows}
    assert all(by[d]["lang_pred"] == "und" and by[d]["score"] == 0 for d in (4, 5, 6, 13))
    assert by[None]["held_out"] is False
    assert L.identified(edge.empty(spark), L.fit(edge.empty(spark))).count() == 0
    unlabelled = edge.documents(spark, [(1, "some text", None, "a", 1)])
    assert [r["lang_pred"] for r in L.identified(unlabelled, L.fit(unlabelled)).collect()] == ["und"]
