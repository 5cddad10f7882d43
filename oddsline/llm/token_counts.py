"""Token counts with a whole-token shortcut.

A merge-based tokenizer never joins characters whose neighbourhood occurs in no piece of
its vocabulary. From the vocabulary it is proved, once per worker and without any text,
(1) that no piece holds a word-start mark after another character, so texts fall into
pre-tokens at word starts, (2) which characters stand alone, such as the line break, and
(3) which vocabulary strings, encoded alone, are one token. Pre-tokens that are such
strings are counted directly; only the rest of a text is merged, in one call. Where the proof of (1) fails, whole texts are encoded.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from oddsline.llm.common import row_batches

#: Fixed value: the mark for a space in sentencepiece vocabularies.
MARK = "▁"


class Counting:
    """Counts the tokens of texts by one sentencepiece model."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        special = lambda i: self.model.is_control(i) or self.model.is_byte(i) or self.model.is_unknown(i)
        self.pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size()) if not special(i)]
        self.split = self.splits_at_words()
        self.line_break = len(self.model.encode("\n\n")) - len(self.model.encode("\n"))
        self.known = self.whole_tokens() if self.split else frozenset()

    def splits_at_words(self) -> bool:
        """Proof of (1) and that line breaks stand alone, spaces are kept and nothing is rewritten."""
        inner = any(MARK in piece.lstrip(MARK) for piece in self.pieces)
        breaks = any("\n" in piece and len(piece) > 1 for piece in self.pieces)
        probes = ("", " ", "a", " a  b ", "A\n\nb", "ﬁ 　x", "é")
        same = all(self.model.decode(self.model.encode(p)) == p for p in probes[2:])
        spaced = [len(self.model.encode(p)) for p in probes[:2]] == [0, len(self.model.encode(" "))]
        return not inner and not breaks and same and spaced

    def whole_tokens(self) -> frozenset[str]:
        """Proof of (3): the vocabulary strings that are one token when they stand alone."""
        strings = [p for p in self.pieces if p.strip(MARK) and p != "\n"]
        return frozenset(p for p in strings if self.merged([p]) == 1)

    def merged(self, pretokens: list[str]) -> int:
        """The tokens of pre-tokens that stand apart, by one call of the model.

        Marks separate them; a line break is put before one without a mark and after one of
        marks only. These, the first line break and the mark that the model adds to every
        text are no tokens of theirs.
        """
        if not pretokens:
            return 0
        bare = [p for p in pretokens if p[0] != MARK]
        blank = [p for p in pretokens if p[-1] == MARK]
        if blank or bare:
            pretokens = [p for p in pretokens if p[0] == MARK and p[-1] != MARK]
        text = "\n" + "\n".join(blank + [""] * bool(blank)) + "".join(pretokens) + "".join("\n" + p for p in bare)
        added = 2 + self.line_break * (len(blank) + len(bare))
        return len(self.model.encode(text.replace(MARK, " "))) - added

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if not self.split:
            return len(self.model.encode(text))
        pretokens = PRETOKEN.findall(MARK + text.replace(" ", MARK))
        known = self.known
        rest = [p for p in pretokens if p not in known]
        return text.count("\n") * self.line_break + len(pretokens) - len(rest) + self.merged(rest)


PRETOKEN = re.compile(rf"{MARK}*[^{MARK}\n]+|{MARK}+")


@lru_cache(maxsize=2)
def counting(path: str) -> Counting:
    return Counting(path)


def token_counts(docs: DataFrame, model: str, limit: int = 4096) -> DataFrame:
    """Per row: doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    Whole texts, without begin, end or added special tokens; strings of special tokens
    are ordinary text. A null or empty text has no bytes and no tokens. ``model`` is the
    path of a sentencepiece model on every worker. Repeated rows get a row each; extra
    columns are ignored; an empty table gives an empty result.
    """
    row_batches(docs.sparkSession)

    @F.pandas_udf("long")
    def tokens(texts: pd.Series) -> pd.Series:
        count = counting(model).count
        return pd.Series(np.array([count(t) for t in texts], np.int64))
    n = tokens(F.col("text"))
    rows = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
                       n.alias("n_tokens"))
    return rows.withColumn("over_limit", F.col("n_tokens") > limit)
