"""Language identification by multinomial logistic regression on TF-IDF character n-grams.

Document frequencies cover all labelled rows. The classifier is fitted on a bounded sample
of them by follow-the-regularised-leader with elastic-net penalties, which leaves most
weights at zero, and its scores are calibrated by a temperature on rows kept aside.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from oddsline.llm.common import row_batches, unit

BUCKETS_LOG2, ORDERS = 15, (1, 2, 3)
BUCKETS = 1 << BUCKETS_LOG2
#: Bound of the rows that the classifier is fitted on, all languages together.
FITTED_ROWS = 4000
EPOCHS, ALPHA, BETA, L1, L2 = 4, 0.5, 1.0, 0.02, 0.02
UNKNOWN = "und"

_NOT_LETTERS = re.compile(r"[\W\d_]+")
_MULTIPLIERS = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B), np.uint32(0xC2B2AE35))


def term_counts(text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
    """Hashed character n-grams of a whole text and their counts; None without any letter.

    Letters are lower-cased, everything else is one space; n-grams see word ends.
    """
    cleaned = _NOT_LETTERS.sub(" ", text.lower()).strip() if text else ""
    if not any(map(str.isalpha, cleaned[:64])) and not any(map(str.isalpha, cleaned)):
        return None
    points = np.frombuffer(f" {cleaned} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    counts = np.zeros(BUCKETS, np.int64)
    gram = np.zeros(len(points), np.uint32)
    for order in ORDERS:
        size = len(points) - order + 1
        if size <= 0:
            break
        gram = (gram[:size] * np.uint32(31)) ^ (points[order - 1:] * _MULTIPLIERS[order - 1])
        mixed = (gram ^ (gram >> np.uint32(15))) * np.uint32(0x2C1B3C6D) + np.uint32(order)
        counts += np.bincount((mixed * np.uint32(0x297A2D39)) >> np.uint32(32 - BUCKETS_LOG2), minlength=BUCKETS)
    terms = np.flatnonzero(counts)
    return terms, counts[terms]


@dataclass
class Model:
    """Languages, inverse document frequencies, weights (buckets by languages) and temperature."""
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float

    def features(self, terms: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return tfidf(terms, counts, self.idf)

    def predict(self, text: str | None) -> tuple[str, float]:
        found = term_counts(text) if self.languages else None
        if found is None:
            return UNKNOWN, 0.0
        logits = self.features(*found) @ self.weights[found[0]] + self.bias
        p = softmax(logits / self.temperature)
        best = int(np.argmax(p))
        return self.languages[best], float(min(1.0, p[best]))


def tfidf(terms: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = (1 + np.log(counts)) * idf[terms]
    length = np.sqrt((x * x).sum())
    return x / length if length else x


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max())
    return e / e.sum()


def follow_leader(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int, epochs: int = EPOCHS):
    """Weights and bias after proximal follow-the-regularised-leader passes over the rows.

    The last row of the tables is the bias, which is not penalised.
    """
    z = np.zeros((BUCKETS + 1, classes))
    n = np.zeros((BUCKETS + 1, classes))

    def weights(at):
        zs, ns = z[at], n[at]
        shrunk = np.where(np.abs(zs) <= L1, 0.0, zs - np.sign(zs) * L1)
        return -shrunk / ((BETA + np.sqrt(ns)) / ALPHA + L2)

    def bias():
        return -z[-1] / ((BETA + np.sqrt(n[-1])) / ALPHA)

    for _ in range(epochs):
        for terms, x, label in rows:
            w, b = weights(terms), bias()
            error = softmax(x @ w + b)
            error[label] -= 1
            for at, old, g in ((terms, w, np.outer(x, error)), (-1, b, error)):
                grown = np.sqrt(n[at] + g * g)
                z[at] += g - (grown - np.sqrt(n[at])) / ALPHA * old
                n[at] += g * g
    return weights(np.arange(BUCKETS)), bias()


def calibrated(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least negative log-likelihood, by golden-section search."""
    if not len(labels):
        return 1.0

    def loss(log_t):
        scaled = logits / np.exp(log_t)
        top = scaled.max(1)
        return float((np.log(np.exp(scaled - top[:, None]).sum(1)) + top - scaled[np.arange(len(labels)), labels]).mean())

    low, high, ratio = -3.0, 3.0, (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def held_out(doc_id: Column) -> Column:
    """Every third document by checksum of its id; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def labelled(docs: DataFrame) -> DataFrame:
    return (docs.select("doc_id", "text", "lang")
            .filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))))


def document_frequencies(rows: DataFrame) -> np.ndarray:
    """In how many rows each bucket occurs (all rows); the last element counts the rows.

    Every task adds up its own rows, so at most a fixed number of buckets is collected."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS + 1, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                found = term_counts(text)
                if found is not None:
                    total[found[0]] += 1
                    total[-1] += 1
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["bucket", "n"])

    out = np.zeros(BUCKETS + 1)
    for bucket, n in (rows.select("text").mapInArrow(count, "bucket long, n long")
                      .groupBy("bucket").agg(F.sum("n").alias("n")).collect()):
        out[bucket] = n
    return out


def fit(docs: DataFrame) -> Model:
    """The model from the labelled rows of ``docs`` that are not held out.

    The sample takes every language to about the same number of rows, chosen by a hash of
    the id, FITTED_ROWS at most in all; every fifth of them only sets the temperature.
    """
    row_batches(docs.sparkSession)
    rows = labelled(docs)
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Model([], np.zeros(BUCKETS), np.zeros((BUCKETS, 0)), np.zeros(0), 1.0)
    languages = sorted(sizes)
    frequencies = document_frequencies(rows)
    idf = np.log((1 + frequencies[-1]) / (1 + frequencies[:-1])) + 1
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items()
                           for x in (lang, min(1.0, FITTED_ROWS / len(sizes) / n))])
    place = unit(F.xxhash64("doc_id"))
    sample = rows.filter(place < share[F.col("lang")]).select(F.xxhash64("doc_id").alias("h"), "lang", "text")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for h, lang, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                found = term_counts(text)
                if found is not None:
                    out.append((h, lang, found[0].astype(np.int32), tfidf(*found, idf).astype(np.float32)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.string()),
                 pa.array([r[2] for r in out], pa.list_(pa.int32())),
                 pa.array([r[3] for r in out], pa.list_(pa.float32()))], names=["h", "lang", "terms", "x"])

    def train(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = [r for f in frames for r in f.itertuples(index=False)]
        rows.sort(key=lambda r: (r.h, r.lang))
        number = {lang: i for i, lang in enumerate(languages)}
        made = [(np.asarray(r.terms, np.int64), np.asarray(r.x, float), number[r.lang]) for r in rows]
        aside = [r for i, r in enumerate(made) if i % 5 == 4]
        w, b = follow_leader([r for i, r in enumerate(made) if i % 5 != 4], len(languages))
        logits = np.array([x @ w[terms] + b for terms, x, _ in aside]).reshape(len(aside), len(languages))
        t = calibrated(logits, np.array([label for _, _, label in aside], int))
        yield pd.DataFrame({"class": np.arange(len(languages)), "bias": b, "temperature": t,
                            "weights": [w[:, k].astype(np.float32).tobytes() for k in range(len(languages))]})

    one = sample.mapInArrow(features, "h long, lang string, terms array<int>, x array<float>").repartition(1)
    fitted = sorted(one.mapInPandas(train, "class int, bias double, temperature double, weights binary").collect())
    weights = np.stack([np.frombuffer(r["weights"], np.float32) for r in fitted], 1)
    return Model(languages, idf, weights.astype(float), np.array([r["bias"] for r in fitted]), fitted[0]["temperature"])


def identified(docs: DataFrame, model: Model) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score (0 to 1).

    Only the text is used. A null text or one without any letter is ``und`` with score 0,
    and so is every text if no row was labelled. Repeated rows get a row each; extra
    columns are ignored; an empty table gives an empty result.
    """
    row_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a fixed number of buckets per language

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([shared.value.predict(t) for t in texts], columns=["lang_pred", "score"])
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), predict("text").alias("_p"))
    return rows.select("doc_id", "held_out", "_p.lang_pred", "_p.score")
