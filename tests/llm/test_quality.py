"""Measurements against plain code, the ledger's bits, policies and ablations."""

import random
from collections import Counter

from oddsline.llm import quality as Q
from oddsline.llm.queries import QUERIES
from tests.conftest import DATA
from tests.llm import edge


def brute_repeated(words, window=5):
    seen = Counter(tuple(words[i:i + window]) for i in range(len(words) - window + 1))
    return len({j for i in range(len(words) - window + 1) if seen[tuple(words[i:i + window])] > 1
                for j in range(i, i + window)})


def test_repeated_words():
    rnd = random.Random(2)
    for _ in range(500):
        words = [str(rnd.randrange(rnd.choice([2, 4, 50]))).encode() for _ in range(rnd.randrange(40))]
        assert Q.repeated_words(*Q.numbered(words)) == brute_repeated(words)
    long = [str(rnd.randrange(50000)).encode() for _ in range(60000)]
    long[-9:] = long[100:109]
    assert Q.repeated_words(*Q.numbered(long)) == brute_repeated(long)


def test_measures():
    got = dict(zip(Q.MEASURES, Q.measure("Ab  cé #|\nAb  cé #|\n\x0b\nSTOP!! idiot, idiot")))
    assert got == {"n_words": 9, "word_chars": 29, "n_symbols": 4, "n_dup_lines": 1, "n_repeat_words": 0, "n_lines": 3,
                   "n_shouted": 1, "n_marked": 1, "n_insults": 2, "n_unspaced": 0,
                   "n_endless": 0, "n_echoes": 0}
    assert set(Q.measure(None)) == set(Q.measure(" \n")) == {0}


def test_unspaced_scripts_and_endless_words(spark):
    plain = " ".join(f"word{i}" for i in range(400))
    rows = [(1, " ".join(["漢字仮名交" * 80] * 2 + ["文" * 300 + str(i) for i in range(9)])), (2, plain + " " + "x" * 1200),
            (3, plain + " " + "x" * 120), (4, " ".join(f"w{i}" for i in range(20)) + " " + "éz" * 501),
            (5, " ".join(["ab" * 20 + str(i) for i in range(20)])), (6, " ".join(f"word{i}" for i in range(3000)) + " " + "x" * 1001)]
    got = {r["doc_id"]: r for r in Q.judged(Q.ledger(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    assert got[1]["n_unspaced"] == 800 + 9 * 300 and got[1]["n_endless"] == 0 and got[1]["failed"] & 16 == 0
    assert [got[d]["n_endless"] for d in (2, 3, 4, 6)] == [1200, 0, 1002, 1001]
    assert [bool(got[d]["failed"] & 256) for d in range(1, 7)] == [False, True, False, True, False, False]
    assert got[5]["failed"] & 16 and got[6]["kept"]


def test_edge_rows(spark):
    docs = edge.documents(spark, clash=("n_words", "failed", "_measures"))
    rows = {(r["doc_id"], r["n_words"]): r for r in Q.judged(Q.ledger(docs)).collect()}
    assert len(Q.ledger(docs).collect()) == docs.count()
    assert rows[(4, 0)]["base_failed"] and not rows[(4, 0)]["kept"]
    assert rows[(10, 3000)]["base_failed"] and rows[(1, 60)]["kept"]
    assert Q.judged(Q.ledger(edge.empty(spark))).count() == 0
    good = Q.keep_good(docs)
    assert good.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in good.collect()) == sorted(
        str(r["doc_id"]) for r in Q.judged(Q.ledger(docs)).filter("kept").collect())


def test_policies_only_grow_and_ablation_counts(spark):
    assert Q.policy_mask(1) & Q.policy_mask(2) == Q.policy_mask(1)
    ledger = Q.ledger(edge.documents(spark))
    masks = [r["failed"] & Q.policy_mask() for r in ledger.collect()]
    for row in Q.ablation(ledger).collect():
        bit = 1 << [r.name for r in Q.RULES].index(row["rule"])
        assert row["failing"] == sum(m & bit != 0 for m in masks)
        assert row["only"] == sum(m == bit for m in masks)


def test_toxic_words_of_every_language_are_learned(spark):
    """Recall and false rejects on held-out documents of each language."""
    docs, labels = (spark.read.parquet(f"{DATA}/sf0.1/{name}.parquet") for name in ("documents", "labels"))
    taught = labels.filter("doc_id % 5 <> 0")
    lexicon = Q.learned_lexicon(docs, taught)
    held_out = docs.join(labels.filter("doc_id % 5 = 0"), "doc_id")
    rows = Q.ledger(held_out, lexicon).join(held_out.select("doc_id", "lang", "toxic"), "doc_id").collect()
    bit = Q.policy_mask(4) & ~Q.policy_mask(3)
    for lang in ("de", "en", "es", "fr"):
        hit = [r["failed"] & bit != 0 for r in rows if r["lang"] == lang and r["toxic"] == 1]
        wrong = [r["failed"] & bit != 0 for r in rows if r["lang"] == lang and r["toxic"] == 0]
        assert sum(hit) >= 0.75 * len(hit) and len(hit) > 2, lang
        assert sum(wrong) <= 0.01 * len(wrong) and len(wrong) > 50, lang


def test_bounded_teaching(spark, monkeypatch):
    docs, labels = (spark.read.parquet(f"{DATA}/sf0.01/{name}.parquet") for name in ("documents", "labels"))
    monkeypatch.setattr(Q, "TAUGHT", 150)
    some = Q.learned_lexicon(docs, labels)
    assert some == Q.learned_lexicon(docs.repartition(7), labels.repartition(3))
    monkeypatch.undo()
    every = Q.learned_lexicon(docs, labels)
    assert sum(map(len, some.values())) < sum(map(len, every.values()))


def test_query_rejects_toxic_documents_of_every_language(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/sf0.1/{name}.parquet") for name in ("documents", "labels"))
    rows = (QUERIES["op8_quality_rules"](spark, f"{DATA}/sf0.1").select("doc_id", "kept", "base_failed")
            .join(docs.select("doc_id", "lang"), "doc_id").join(labels, "doc_id").collect())
    for lang in ("de", "en", "es", "fr"):
        toxic = [r["kept"] for r in rows if r["lang"] == lang and r["toxic"] == 1]
        good = [r["kept"] for r in rows if r["lang"] == lang and r["toxic"] == 0 and r["quality"] == 1]
        assert sum(toxic) <= 0.12 * len(toxic) and sum(good) >= 0.97 * len(good), lang


def test_length_does_not_dilute_toxic_words(spark):
    words = frozenset(("b\u00f6s", "fies"))
    assert Q.toxic_words("b\u00f6s " + "gut " * 9000 + "Fies! " + "gut " * 9000 + "\u00abB\u00d6S\u00bb", words) == (3, 0)
    assert Q.toxic_words("gut " * 9000 + "fies gut b\u00f6s", words) == (2, 1)
    assert Q.toxic_words("fies " + "gut " * 49 + "b\u00f6s", words) == (2, 0)
    assert Q.toxic_words(None, words) == Q.toxic_words("fies", frozenset()) == (0, 0)
    tail = " ".join(f"w{i}" for i in range(9000))
    rows = [(1, f"fies b\u00f6s {tail}", "de"), (2, f"fies b\u00f6s {tail}", "en"), (3, f"fies b\u00f6s {tail}", None), (4, tail, "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert sorted(r["doc_id"] for r in Q.keep_good(docs, 4, {"de": words}).collect()) == [2, 4]
    assert Q.keep_good(docs, 4).count() == 4


def test_edge_labels(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    some = spark.createDataFrame([(None, 0, 1), (1, 0, None), (4, 0, 1), (999, 0, 1)], none.schema)
    for labels in (none, some):
        assert Q.learned_lexicon(edge.documents(spark, clash=("_lang", "_word", "toxic")), labels) == {}
