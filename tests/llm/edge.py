"""Rows that every operator has to take: nulls, empty and long texts, ties, copies, clashing names."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def document_rows(seed: int = 1) -> list[tuple]:
    rnd = random.Random(seed)
    words = [w + rnd.choice(["", ".", ","]) for w in "the and of to in was for on are as with his they at be".split()]
    text = lambda n: " ".join(rnd.choice(words) + str(rnd.randrange(9)) for _ in range(n))
    base = text(60)
    rows = [(1, base, "en", "a", 1), (2, base, "en", "a", 1), (2, base, "en", "a", 1), (3, base + " more", "en", "b", 1),
            (4, None, None, None, None), (5, "", "en", "", 0), (6, " \n\t ", None, "b", 3), (7, "one", "de", "a", 3),
            (8, "One", "de", "a", 3), (None, base, "en", "a", 1), (9, text(4000), "en", "c", 1),
            (10, "word " * 3000, "fr", "c", 1), (11, "éß漢 \U0001f600 x", "fr", None, 1),
            (12, "x" * 5000, "es", "b", 1), (13, "1234 !!", "en", "c", 1), (14, text(25), "es", "a", 1)]
    return rows + [(20 + i, text(rnd.randrange(5, 90)), rnd.choice(["en", "de"]), rnd.choice("abcd"), 1) for i in range(20)]


def documents(spark, rows=None, clash: tuple[str, ...] = ()):
    """The edge rows as a table; ``clash`` adds columns of these names."""
    df = spark.createDataFrame(document_rows() if rows is None else rows, DOCUMENTS).repartition(3)
    return df.withColumns({c: F.lit("clash") for c in clash}) if clash else df


def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)


def rows_of(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is not None, str(x)) for x in r))
