"""Counts against the tokenizer on whole texts."""

import random

import public_tokenizers
import pytest

from oddsline.llm import token_counts as T
from tests.llm import edge

MODEL = public_tokenizers.path("piece_bpe_32k.model")
PARTS = ["a", "the", " ", "  ", "\n", "\t", "é", "▁", "<s>", "</s>", "<0x0A>", "漢", "\U0001f600", "\0", "\r\n", "ing",
         "er.", "!!!", " \n ", "ß", "99", "\xa0", "<unk>", "ﬁ", "​", "$$$", "zq" * 40]


def test_against_whole_texts():
    counting = T.counting(MODEL)
    assert counting.split and len(counting.known) > 30000
    rnd = random.Random(6)
    for _ in range(6000):
        text = "".join(rnd.choice(PARTS) for _ in range(rnd.randrange(16)))
        assert counting.count(text) == len(counting.model.encode(text)), repr(text)


def test_without_proof_whole_texts_are_encoded(monkeypatch):
    monkeypatch.setattr(T.Counting, "splits_at_words", lambda self: False)
    counting = T.Counting(MODEL)
    assert counting.count("the  cat\n") == len(counting.model.encode("the  cat\n"))


def test_edge_rows(spark):
    docs = edge.documents(spark, clash=("n_tokens", "n_bytes"))
    counting = T.counting(MODEL)
    got = edge.rows_of(T.token_counts(docs, MODEL))
    want = []
    for d, t, *_ in edge.document_rows():
        n = len(counting.model.encode(t)) if t else 0
        want.append((d, len((t or "").encode()), n, n > 4096))
    assert got == sorted(want, key=lambda r: tuple((x is not None, str(x)) for x in r))
    assert any(r[3] for r in got)
    assert T.token_counts(edge.empty(spark), MODEL).count() == 0


@pytest.mark.parametrize("limit", [0, 10])
def test_limit(spark, limit):
    rows = T.token_counts(edge.documents(spark), MODEL, limit).collect()
    assert all(r["over_limit"] == (r["n_tokens"] > limit) for r in rows)
