"""Contaminated words against plain code, short items and odd rows included."""

import hashlib
import random
import re

from oddsline.llm import decontamination as D
from tests.llm import edge

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(text, items):
    w, hit, named = words(text), set(), set()
    for item, content in items:
        c = words(content)
        n = min(10, len(c))
        wanted = {tuple(c[i:i + n]) for i in range(len(c) - n + 1)} if c else set()
        for i in range(len(w) - n + 1):
            if tuple(w[i:i + n]) in wanted:
                hit.update(range(i, i + n))
                named.add(item)
    ids = sorted(str(i) for i in named if i is not None)
    return len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)


def test_against_plain_code(spark):
    rnd = random.Random(8)
    vocabulary = [f"v{i}" for i in range(30)] + ["été", "X"]
    text = lambda n: rnd.choice([" ", ", ", "\n"]).join(rnd.choice(vocabulary) for _ in range(n))
    items = [(i, text(n)) for i, n in enumerate([1, 3, 4, 9, 10, 11, 12, 30, 30])]
    items += [(50, items[7][1]), (None, text(12)), (51, None), (52, ""), (53, "the the the the the the the the the the the")]
    docs = [(d, " ".join(rnd.choice([text(rnd.randrange(12)), (rnd.choice(items)[1] or "").upper(),
                                     " ".join(words(rnd.choice(items)[1])[1:11])]) for _ in range(rnd.randrange(5))))
            for d in range(60)] + [(60, "the " * 40), (61, None), (None, items[7][1]), (7, "again " + items[7][1])]
    got = edge.rows_of(D.contamination(spark.createDataFrame(docs, "doc_id long, text string").repartition(4),
                                       spark.createDataFrame(items, "item_id long, text string")))
    want = sorted(((d, *brute(t, items)) for d, t in docs), key=lambda r: tuple((x is not None, str(x)) for x in r))
    assert got == want


def test_edge_rows(spark):
    docs = edge.documents(spark, clash=("n_words", "_words", "_id"))
    items = spark.createDataFrame([(1, edge.document_rows()[0][1])], "item_id long, text string")
    clean = D.keep_clean(docs, items)
    assert clean.columns == docs.columns
    assert not {1, 2, 3, None} & {r["doc_id"] for r in clean.collect()}
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert D.contamination(docs, nothing).filter("contaminated").count() == 0
    assert D.keep_clean(docs, nothing).count() == docs.count()
    assert D.contamination(edge.empty(spark), items).count() == 0
