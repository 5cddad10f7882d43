"""Packing against exact optima, ids against the library, places against plain checks."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from oddsline.llm import packing as P
from oddsline.llm.queries import QUERIES
from tests.conftest import DATA
from tests.llm import edge

WORDS = public_tokenizers.path("word_bpe_49k.json")


def optimum(lengths, capacity):
    """Least number of sequences, by trying every place for every piece."""
    lengths, best = sorted(lengths, reverse=True), len(lengths)

    def place(i, filled):
        nonlocal best
        if len(filled) >= best:
            return
        if i == len(lengths):
            best = len(filled)
            return
        for k in {f: k for k, f in enumerate(filled)}.values():
            if filled[k] + lengths[i] <= capacity:
                place(i + 1, [f + lengths[i] * (j == k) for j, f in enumerate(filled)])
        place(i + 1, [*filled, lengths[i]])

    place(0, [])
    return best


def sequences_of(packing, lengths, capacity):
    placed = Counter()
    for n, pattern in packing:
        assert n > 0 and sum(x * k for x, k in pattern) <= capacity
        for x, k in pattern:
            placed[x] += n * k
    assert placed == Counter(lengths)
    return sum(n for n, _ in packing)


def bound_of(lengths, capacity):
    table = np.zeros(capacity + 1, np.int64)
    for x in lengths:
        table[x] += 1
    return P.lower_bound(table)


def test_small_packings_are_optimal():
    rnd, better = random.Random(3), 0
    for _ in range(800):
        capacity = rnd.choice([10, 20, 37])
        lengths = [rnd.randrange(1, capacity + 1) if rnd.random() < 0.5 else
                   rnd.randrange(capacity // 4, capacity // 2 + 2) for _ in range(rnd.randrange(1, 11))]
        least = optimum(lengths, capacity)
        assert bound_of(lengths, capacity) <= least
        assert sequences_of(P.completed(Counter(lengths), capacity), lengths, capacity) == least, lengths
        better += sequences_of(P.best_fit(Counter(lengths), capacity), lengths, capacity) > least
    assert better  # the search does what best fit can't


@pytest.mark.parametrize("low,high,number", [(2, 900, 3000), (300, 800, 400), (700, 1300, 3000), (1, 2048, 20000)])
def test_large_packings(low, high, number):
    rnd = random.Random(number)
    lengths = [rnd.randrange(low, high + 1) for _ in range(number)]
    got = sequences_of(P.completed(Counter(lengths), 2048), lengths, 2048)
    assert got <= sequences_of(P.best_fit(Counter(lengths), 2048), lengths, 2048)
    plan = P.slots(P.completed(Counter(lengths), 2048))
    assert len(plan) <= 64 * 3 * 2048
    if (low, high) != (700, 1300):
        assert got <= bound_of(lengths, 2048) * 1.01 + 1


def test_fillings_are_undominated_and_complete():
    rnd = random.Random(5)
    for _ in range(300):
        counts = Counter(rnd.randrange(1, 13) for _ in range(rnd.randrange(1, 8)))
        room = rnd.randrange(1, 20)
        listed = list(P.fillings(counts, sorted(counts), room, room, 10_000))
        sums = {sum(x * n for x, n in f) for f in listed}
        every = {0}
        for x in counts.elements():
            every |= {s + x for s in every}
        # The fullest filling is always among those that are listed, and comes first.
        assert max(s for s in every if s <= room) == max(sums, default=0)
        assert listed == sorted(listed, key=lambda f: room - sum(x * n for x, n in f))


TEXTS = ["", " ", "Hello, World's  test\n\tI'll we've 12345", "é é áb ́x", "İstanbul ΣΑΣ ﬁ Å",
         "a\x1cb\x85c\xa0d e　f", "<|startoftext|> x <|endoftext|>y", "<|STARTOFTEXT|> z", "漢字かな\U0001f600 ok",
         "x" * 3000, "\0 nul", "don't 's 'll ' '' it's", "한국어 각 가"]


def test_ids_against_the_library():
    own, model = P.Tokens(WORDS), Tokenizer.from_file(WORDS)
    assert own.by_word
    rnd = random.Random(2)
    parts = ["a", "the", " ", "\n", "\x0b", "é", "é", "́", "'s", "'", "12", "漢", "İ", "Σ", "\xa0", "\x85", "‍",
             "!!", "가", "ᆨ", "<|", "|>", "<|endoftext|>", "ﬁ"]
    texts = TEXTS + ["".join(rnd.choice(parts) for _ in range(rnd.randrange(12))) for _ in range(3000)]
    for text in texts:
        assert own.ids(text) == own.packed(model.encode(text, add_special_tokens=False).ids), repr(text)


def test_forgetting_and_other_tokenizers(monkeypatch):
    monkeypatch.setattr(P, "REMEMBERED", 20)
    own = P.Tokens(WORDS)
    for text in ["one two three", "four five six seven eight nine", "one ten"] * 3:
        assert own.ids(text) == own.packed(own.model.encode(text, add_special_tokens=False).ids)
    other = P.Tokens(public_tokenizers.path("byte_bpe_50k.json"))
    assert not other.by_word
    assert other.ids(" a  b") == other.packed(other.model.encode(" a  b", add_special_tokens=False).ids)


def test_edge_rows(spark):
    docs = edge.documents(spark, clash=("ids", "length", "_text", "sequence_id"))
    model = Tokenizer.from_file(WORDS)
    pieces = P.pieces(docs, WORDS, 64)
    placed = P.packed(pieces.withColumn("sequence_id", F.lit("clash")), 64)
    rows = placed.collect()
    want = Counter()
    for d, t, *_ in edge.document_rows():
        ids = model.encode(t or "", add_special_tokens=False).ids + [0]
        for k, at in enumerate(range(0, len(ids), 64)):
            want[d, k, at, len(ids[at:at + 64]), np.array(ids[at:at + 64], "<u4").tobytes()] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], bytes(r["ids"])) for r in rows) == want
    gapless(rows, 64)
    whole = {r["sequence_id"]: bytes(r["ids"]) for r in P.sequences(placed).collect()}
    for r in rows:
        assert whole[r["sequence_id"]][4 * r["offset"]:4 * (r["offset"] + r["length"])] == bytes(r["ids"])
    assert P.packed(P.pieces(edge.empty(spark), WORDS)).count() == 0
    with pytest.raises(ValueError):
        P.packed(pieces, 32)


def gapless(rows, capacity):
    held = defaultdict(list)
    for r in rows:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in held.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return held


def test_query(spark):
    rows = QUERIES["op11_best_fit_packing"](spark, f"{DATA}/sf0.01").collect()
    held = gapless(rows, 2048)
    lengths = [r["length"] for r in rows]
    assert len(held) <= bound_of(lengths, 2048) + 1
    model = Tokenizer.from_file(WORDS)
    docs = spark.read.parquet(f"{DATA}/sf0.01/documents.parquet").select("doc_id", "text").limit(200).collect()
    got = {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in rows}
    for d, t in docs:
        ids = model.encode(t or "", add_special_tokens=False).ids + [0]
        for k, at in enumerate(range(0, len(ids), 2048)):
            piece = np.array(ids[at:at + 2048], "<u4")
            assert got[d, k] == (at, len(piece), zlib.crc32(piece.tobytes()))
        assert (d, k + 1) not in got
