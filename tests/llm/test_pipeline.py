"""Every stage on its own input against plain code, and the whole run."""

import re
from collections import Counter

import corpus_pipeline as C
from oddsline.llm import mixing, quality
from oddsline.llm.common import table, written
from tests.conftest import DATA
from tests.llm.test_decontamination import brute as contaminated
from tests.llm.test_near_dedup import brute as groups

FOLDER = f"{DATA}/sf0.001"


def test_stages(spark):
    docs = table(spark, FOLDER, "documents")
    columns = docs.columns
    items = [tuple(r) for r in table(spark, FOLDER, "benchmark").collect()]
    seen = {r["doc_id"]: r for r in docs.collect()}
    ledger = {r["doc_id"] for r in quality.judged(quality.ledger(docs)).filter("kept").collect()}
    outputs = []
    for name, stage in C.STAGES:
        before = docs
        docs = written(stage(spark, docs, FOLDER), name)
        outputs.append((before, docs))
    ids = [[r["doc_id"] for r in after.collect()] for _, after in outputs]
    assert all(after.columns == columns for _, after in outputs[:-1])
    assert set(ids[0]) == ledger and 0 < len(ids[0]) < len(seen)
    root = groups([(d, seen[d]["text"]) for d in ids[0]])
    assert sorted(ids[1]) == sorted(set(root.values())) and len(ids[1]) < len(ids[0])
    assert sorted(ids[2]) == sorted(d for d in ids[1] if not contaminated(seen[d]["text"], items)[-1])
    assert len(ids[2]) < len(ids[1])
    size = {d: len(re.findall(r"[^\x20\x09-\x0D]+", seen[d]["text"])) for d in ids[2]}
    target = {}
    for r in mixing.mixed(outputs[3][0]).collect():
        target[seen[r["doc_id"]]["source"]] = r["target"]
    read = Counter()
    for d in ids[3]:
        read[seen[d]["source"]] += size[d]
    longest = {s: max(size[d] for d in size if seen[d]["source"] == s) for s in target}
    assert max(Counter(ids[3]).values()) <= 3
    assert all(abs(read[s] - target[s]) <= longest[s] / 2 + 1 for s in target)
    assert sorted(ids[4]) == sorted(ids[3])
    assert set(outputs[4][1].columns) == set(columns) | {"shard"}
    total = Counter()
    for r in outputs[4][1].collect():
        total[r["shard"]] += len(r["text"].encode()) + 1
    assert set(total) <= set(range(16)) and len(total) == 16


def test_run(spark):
    first, second = (C.run(spark, FOLDER) for _ in range(2))
    rows = lambda df: sorted((r["doc_id"], r["shard"]) for r in df.collect())
    assert rows(first) == rows(second) and rows(first)
