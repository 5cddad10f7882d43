"""Periodic runs of words by the branching-tandem test on an enhanced suffix array.

The suffixes of many documents are sorted at once; words of different documents never
compare equal, so nothing crosses a document. For each interval of suffixes with a common
prefix of d words, every suffix i outside the interval's largest child looks up whether
suffix i + d or i - d lies in the interval as well: then d words stand twice in a row, and
the word that follows breaks the period. Such squares end their run. They are rotated to
the left as far as the period lasts, and squares of one stretch are merged under the
smallest period. Intervals come from a scan of the prefix lengths; no tree is built.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from oddsline.llm.common import WORD, row_batches

#: Words whose suffixes are sorted together; a longer document is sorted alone.
BLOCK_WORDS = 100_000
RUN = "array<struct<start:long,length:long,period:long>>"


def suffix_array(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of all suffixes and each suffix's rank, by prefix doubling.

    Only suffixes that still tie are sorted again. The codes hold a unique one at the end
    of each document, so all suffixes differ.
    """
    n = len(codes)
    order = np.argsort(codes, kind="stable")
    starts = np.flatnonzero(np.r_[True, np.diff(codes[order]) != 0])
    rank = np.empty(n, np.int64)
    rank[order] = np.repeat(starts, np.diff(np.r_[starts, n]))
    width = 1
    tied = order[np.repeat(np.diff(np.r_[starts, n]) > 1, np.diff(np.r_[starts, n]))]
    while len(tied):
        first, second = rank[tied], rank[tied + width]
        by = np.lexsort((second, first))
        tied, first, second = tied[by], first[by], second[by]
        new_group = np.r_[True, np.diff(first) != 0]
        head = np.flatnonzero(new_group | np.r_[True, np.diff(second) != 0])
        place = first + np.arange(len(tied)) - np.repeat(
            np.flatnonzero(new_group), np.diff(np.r_[np.flatnonzero(new_group), len(tied)]))
        sizes = np.diff(np.r_[head, len(tied)])
        order[place] = tied
        rank[tied] = np.repeat(place[head], sizes)
        tied = tied[np.repeat(sizes > 1, sizes)]
        width *= 2
    return order, rank


def common_prefixes(codes: list[int], order: list[int], rank: list[int]) -> list[int]:
    """At each place of the order, the words in common with the suffix before."""
    out = [0] * len(codes)
    same = 0
    for i, r in enumerate(rank):
        if r:
            j = order[r - 1]
            while codes[i + same] == codes[j + same]:
                same += 1
            out[r] = same
            if same:
                same -= 1
        else:
            same = 0
    return out


def small_children(prefixes: list[int]) -> list[tuple[int, int, int, int, int]]:
    """(first, last, depth, from, to): intervals, each with the children but its largest.

    ``first`` to ``last`` are places of the suffixes that share ``depth`` words; the
    children, and single suffixes beside them, lie between the places that hold the depth.
    """
    out = []
    open_ = [(0, 0, [0])]  # depth, first place, starts of children

    def close(depth, first, starts, last):
        ends = starts[1:] + [last + 1]
        largest = max(range(len(starts)), key=lambda c: ends[c] - starts[c])
        if largest:
            out.append((first, last, depth, first, starts[largest] - 1))
        if largest + 1 < len(starts):
            out.append((first, last, depth, ends[largest], last))

    for place in range(1, len(prefixes) + 1):
        depth = prefixes[place] if place < len(prefixes) else 0
        child = place - 1
        while open_[-1][0] > depth:
            closed = open_.pop()
            close(*closed, place - 1)
            child = closed[1]
        if open_[-1][0] < depth:
            open_.append((depth, child, [child, place]))
        elif depth:
            open_[-1][2].append(place)
    return out


def squares(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, period) of every square that the next word breaks."""
    order, rank = suffix_array(codes)
    listed = small_children(common_prefixes(codes.tolist(), order.tolist(), rank.tolist()))
    if not listed:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    first, last, depth, begin, end = np.array(listed, np.int64).T
    sizes = end - begin + 1
    which = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + begin[which]
    first, last, depth = first[which], last[which], depth[which]
    suffix = order[place]
    found = []
    for other, start in ((suffix + depth, suffix), (suffix - depth, suffix - depth)):
        inside = (other >= 0) & (other < len(codes))
        at = rank[np.where(inside, other, 0)]
        hit = inside & (at >= first) & (at <= last)
        start, period = start[hit], depth[hit]
        # Two suffixes of one child share more than the depth: no break.
        found.append(np.stack([start, period])[:, codes[start + period] != codes[start + 2 * period]])
    both = np.unique(np.concatenate(found, axis=1), axis=1)
    return both[0], both[1]


def rotated(codes: np.ndarray, start: int, period: int) -> int:
    """Where the period of a square begins: the start moved left while words repeat."""
    step = 16
    while start:
        low = max(0, start - step)
        differ = np.flatnonzero(codes[low:start] != codes[low + period:start + period])
        if len(differ):
            return low + int(differ[-1]) + 1
        start, step = low, step * 4
    return start


def maximal_runs(codes: np.ndarray, least: int, repeats: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of ``least`` words and ``repeats`` periods at least."""
    starts, periods = squares(codes)
    out, ending = [], {}
    for i in np.lexsort((periods, starts + 2 * periods)):
        start, period = int(starts[i]), int(periods[i])
        end = start + 2 * period
        known = ending.setdefault(end, [])
        if any(period % q == 0 and first <= start for first, q in known):
            continue  # the same stretch under a smaller period
        first = rotated(codes, start, period)
        known.append((first, period))
        if end - first >= max(least, repeats * period):
            out.append((first, end - first, period))
    return sorted(out, key=lambda r: (r[0], r[2]))


def coded(texts: list[list[bytes]]) -> np.ndarray:
    """All words as numbers that differ between documents, each document with an end of its own."""
    numbers: dict[bytes, int] = {}
    parts = [np.array([numbers.setdefault(w, len(numbers)) for w in words] + [-1], np.int64) for words in texts]
    codes = np.concatenate(parts)
    document = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    return document * (len(numbers) + 1) + codes + 1


def block_runs(texts: list[list[bytes]], least: int, repeats: int) -> list[list[tuple[int, int, int]]]:
    """The runs of each of several documents."""
    begins = np.cumsum([0] + [len(words) + 1 for words in texts])
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for start, length, period in maximal_runs(coded(texts), least, repeats):
        of = int(np.searchsorted(begins, start, "right")) - 1
        out[of].append((start - int(begins[of]), length, period))
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The text with a single period left of every run."""
    if not runs:
        return b" ".join(words)
    inside = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        inside[start + period] += 1
        inside[start + length] -= 1
    dropped = np.cumsum(inside) > 0
    return b" ".join(w for w, d in zip(words, dropped) if not d)


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[list[bytes]]]]:
    """Slices of the batches with their words, about ``BLOCK_WORDS`` or one document each."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index("_text"))
        texts, begin, held = [], 0, 0
        for row in range(len(batch)):
            words = (column[row].as_py() or b"").split()  # of bytes: splits at ASCII white space only
            if texts and held + len(words) > BLOCK_WORDS:
                yield batch.slice(begin, len(texts)), texts
                texts, begin, held = [], row, 0
            texts.append(words)
            held += len(words)
        if texts:
            yield batch.slice(begin, len(texts)), texts


def periodic_runs(docs: DataFrame, least: int = 6, repeats: int = 4) -> DataFrame:
    """Per row: doc_id, ``runs`` (array of start, length, period) and the ``collapsed`` text.

    A run is a maximal stretch of words with a smallest period that it holds ``repeats``
    times, of ``least`` words or more; runs are sorted by start, then period. The
    collapsed text keeps one period of each run, words joined by one space. A null or
    empty text has no runs and an empty collapsed text. Repeated rows and rows with a
    null or shared doc_id are judged one by one; extra columns are ignored; an empty
    table gives an empty result. Runs never cross documents.
    """
    if repeats < 2:
        raise ValueError("a run holds its period twice at least")
    row_batches(docs.sparkSession)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in blocks(batches):
            runs = block_runs(texts, least, repeats)
            kept = [collapsed(words, own).decode() for words, own in zip(texts, runs)]
            listed = [[dict(zip(("start", "length", "period"), r)) for r in own] for own in runs]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(listed, kind), pa.array(kept, pa.string())], ["doc_id", "runs", "collapsed"])

    rows = docs.select("doc_id", F.col("text").cast("binary").alias("_text"))
    doc_id = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(judged, f"doc_id {doc_id}, runs {RUN}, collapsed string")


def summarised(runs: DataFrame) -> DataFrame:
    """Per row of ``periodic_runs``: number, longest run and digests of runs and text.

    The longest run is the one with the smallest start, then period, among equally long
    ones; without a run its four columns are null.
    """
    longest = F.array_min(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("short"), r["start"].alias("start"), r["period"].alias("period"))))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    lines = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    return (runs.withColumn("_longest", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("_longest.start").alias("start"),
        (-F.col("_longest.short")).alias("length"), F.col("_longest.period").alias("period"),
        F.floor(1000 * -F.col("_longest.short") / F.col("_longest.period")).alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256")))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text; a tenth of the texts, by crc32 of the id, get a periodic ending.

    From a word ``a`` on, a period of ``p`` words repeats to the end; ``a`` and ``p``
    follow from the checksum. Texts without words and rows without id stay as they are.
    """
    checksum = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))

    def ending(given: Column) -> Column:
        n, g = F.size(given).cast("long"), F.floor(checksum / 10)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        at = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p)
        return F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n - 1),
                                        lambda i: F.get(given, at(i).cast("int"))), " ")

    # The words are bound once: written into the function, they would be split anew for each word.
    planted = F.get(F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, ending(w))), 0)
    return docs.select("doc_id", F.when(checksum % 10 == 0, F.coalesce(planted, F.col("text")))
                       .otherwise(F.col("text")).alias("text"))
