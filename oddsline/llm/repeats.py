"""Removal of repeated byte strings across documents.

Every window of 100 bytes is represented by an anchor, the 32-byte string with the
smallest hash in it. Neighbouring windows share their anchor, so a document is a short
list of runs (anchor, first and last window), and equal windows have equal anchors at
equal offsets. Runs with equal bytes are settled by their hash alone. Where an anchor
stands in different surroundings, its runs are candidates: only parts of them may repeat.
The candidates' texts are indexed by Burrows-Wheeler transforms (see
:mod:`oddsline.llm.bwt`), whose merged order tells which windows repeat.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from oddsline.llm import bwt
from oddsline.llm.common import row_batches, written

LENGTH, ANCHOR = 100, 32
#: Bytes handled at once; longer documents go in overlapping pieces.
PIECE = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_LOW = np.uint64((1 << 24) - 1)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def power(n: int, base: int = _BASE) -> np.uint64:
    return np.uint64(pow(base, n, 1 << 64))


def rolled(data: np.ndarray, length: int, base: int = _BASE) -> dict[int, np.ndarray]:
    """Polynomial hashes of all strings of ``length`` bytes, and of the powers of two up to it."""
    hashes = {1: (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0x8CB92BA72F3D8DD7)}
    size = 1
    while size * 2 <= length:
        h = hashes[size]
        hashes[size * 2] = h[:-size] * power(size, base) + h[size:]
        size *= 2
    whole, done = hashes[size], size
    while done < length:
        size //= 2
        if length - done >= size:
            part = hashes[size][done:]
            n = min(len(part), len(whole))
            whole = whole[:n] * power(size, base) + part[:n]
            done += size
    hashes[length] = whole
    return hashes


def runs(raw: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(anchor hash, surroundings hash, first window, last window) of the runs of a text."""
    for at in range(0, max(1, len(raw) - LENGTH + 1), PIECE):
        data = np.frombuffer(raw, np.uint8)[at:at + PIECE + LENGTH - 1]
        if len(data) < LENGTH:
            continue
        hashes = rolled(data, LENGTH)
        anchors = mix(hashes[ANCHOR])
        place = np.arange(len(anchors), dtype=np.uint64)
        least = (anchors & ~_LOW) | place
        span, width = LENGTH - ANCHOR + 1, 1
        while width * 2 <= span:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < span:
            least = np.minimum(least[:len(least) - (span - width)], least[span - width:])
        chosen = (least & _LOW).astype(np.int64)
        edges = np.flatnonzero(chosen[1:] != chosen[:-1])
        first = np.concatenate(([0], edges + 1))
        last = np.concatenate((edges, [len(chosen) - 1]))
        windows = hashes[LENGTH]
        around = mix(mix(windows[first]) + windows[last] * np.uint64(3) + (last - first).astype(np.uint64))
        yield anchors[chosen[first]], around, first + at, last + at


#: A run: ``place`` is 128 * first window + windows after it. A settled range, whose windows
#: all repeat, has no ``around``; there ``place`` is its first window and ``anchor`` its last.
#: ``version`` is a hash of the text: a doc_id may have several, and equal rows are one.
RUN_DDL = "anchor long, around long, doc_id long, version long, place long"
FOUND_DDL = "doc_id long, version long, first long, last long, anchor long, others long"


def record(names: str, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns],
                                      names=[part.split()[0] for part in names.split(", ")])


def packed(raw: DataFrame) -> DataFrame:
    """Texts compressed before they are shuffled: (doc_id, packed, version) of (doc_id, raw, version)."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pressed = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            texts = [pressed(x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary()), batch.column(2)],
                                             names=["doc_id", "packed", "version"])
    return raw.mapInArrow(pack, "doc_id long, packed binary, version long")


def unpacked(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def in_chunks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[list[tuple]]:
    """(doc_id, raw, ...) rows in lists of about ``size`` bytes."""
    held, held_bytes = [], 0
    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns))):
            held.append(row)
            held_bytes += len(row[1])
            if held_bytes >= size:
                yield held
                held, held_bytes = [], 0
    if held:
        yield held


def earliest(keys: list[np.ndarray], order: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorts by keys, then order: (sorting, whether a row is the first of its keys)."""
    sorting = np.lexsort([*reversed(order), *reversed(keys)])
    new = np.ones(len(sorting), bool)
    if len(sorting):
        new[1:] = False
        for key in keys:
            k = key[sorting]
            new[1:] |= k[1:] != k[:-1]
    return sorting, new


def ranges(docs: np.ndarray, versions: np.ndarray, firsts: np.ndarray, lasts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Adjoining ranges of windows of a document as one."""
    sorting = np.lexsort((firsts, versions, docs))
    docs, versions, firsts, lasts = docs[sorting], versions[sorting], firsts[sorting], lasts[sorting]
    new = np.ones(len(docs), bool)
    new[1:] = (docs[1:] != docs[:-1]) | (versions[1:] != versions[:-1]) | (firsts[1:] != lasts[:-1] + 1)
    ends = np.append(new[1:], True)
    return docs[new], versions[new], firsts[new], lasts[ends]


def document_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of all documents. Of equal runs in a portion only the earliest is compared
    further, so copies in a portion cost no shuffle; the others are settled."""
    for rows in in_chunks(batches, 8 << 20):
        parts = [[], [], [], [], [], []]
        for (doc, version), raw in {(doc, version): raw for doc, raw, version in rows}.items():
            for found in runs(raw):
                n = len(found[2])
                for part, values in zip(parts, (*found[:2], np.full(n, doc), np.full(n, version), *found[2:])):
                    part.append(values)
        if not parts[0]:
            continue
        anchor, around, doc, version, first, last = (np.concatenate(p) for p in parts)
        sorting, new = earliest([anchor, around], [doc, version, first])
        kept, dropped = sorting[new], sorting[~new]
        yield record(RUN_DDL, anchor[kept].view(np.int64), around[kept].view(np.int64), doc[kept],
                     version[kept], first[kept] * 128 + last[kept] - first[kept])
        if len(dropped):
            doc, version, first, last = ranges(doc[dropped], version[dropped], first[dropped], last[dropped])
            yield record(RUN_DDL, last, pa.nulls(len(doc), pa.int64()), doc, version, first)


def settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over runs sorted by anchor, surroundings, document and place: settled ranges, and as
    candidates (with ``anchor`` and the number of ``others``) the first runs of all
    surroundings where an anchor has several. Runs of an anchor's only surroundings end here.
    The same run of equal rows counts once."""
    held: list[np.ndarray] = []  # rows of (anchor, around, doc_id, version, place)

    def flush(rows: np.ndarray):
        if not len(rows):
            return
        rows = rows[np.concatenate(([True], (rows[1:] != rows[:-1]).any(1)))]
        anchor, around, doc, version, place = rows.T
        new_anchor = np.concatenate(([True], anchor[1:] != anchor[:-1]))
        new = new_anchor | np.concatenate(([True], around[1:] != around[:-1]))
        group = np.cumsum(new_anchor) - 1
        others = np.bincount(group, new).astype(np.int64)[group] - 1
        first = place >> 7
        last = first + (place & 127)
        none = lambda n: pa.nulls(n, pa.int64())
        again = np.flatnonzero(~new)
        if len(again):
            made = ranges(doc[again], version[again], first[again], last[again])
            yield record(FOUND_DDL, *made, none(len(made[0])), none(len(made[0])))
        open_ = np.flatnonzero(new & (others > 0))
        if len(open_):
            yield record(FOUND_DDL, doc[open_], version[open_], first[open_], last[open_], anchor[open_], others[open_])

    for batch in batches:
        done = batch.filter(batch.column(1).is_null())
        if done.num_rows:
            nulls = pa.nulls(done.num_rows, pa.int64())
            yield record(FOUND_DDL, done.column(2), done.column(3), done.column(4), done.column(0), nulls, nulls)
        batch = batch.filter(batch.column(1).is_valid())
        if not batch.num_rows:
            continue
        rows = np.stack([batch.column(i).to_numpy() for i in range(5)], 1)
        cut = int(np.searchsorted(rows[:, 0], rows[-1, 0], "left"))
        if cut or (held and held[0][0, 0] != rows[0, 0]):
            yield from flush(np.concatenate([*held, rows[:cut]]))
            held = [rows[cut:]]
        else:
            held.append(rows)
    if held:
        yield from flush(np.concatenate(held))


CONTEXT_DDL = "anchor long, doc_id long, version long, first long, context binary, others long"


def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the candidate runs."""
    for batch in batches:
        for doc, data, version, runs_ in zip(*(batch.column(i).to_pylist() for i in range(4))):
            raw = unpacked(data)
            rows = [(r["anchor"], doc, version, r["first"], raw[r["first"]:r["last"] + LENGTH], r["others"]) for r in runs_]
            yield record(CONTEXT_DDL, *[pa.array([r[i] for r in rows], t) for i, t in enumerate(
                (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64()))])


#: Bytes of contexts that are indexed together (more only for one anchor), and of a shard.
BLOCK, SHARD = 256 << 10, 128 << 10
#: Anchors with more surroundings than this are compared window by window, which needs no
#: task to hold them together.
WIDE = 16384
REPEATED_DDL = "doc_id long, version long, first long, last long"


def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated windows of contexts sorted by anchor, document and place, by merged
    transforms of blocks of whole anchors; all but the earliest of each are returned. The
    context of equal rows counts once."""
    held: list[tuple] = []
    size, anchor = 0, None

    def flush():
        place, group = bwt.repeats([r[4] for r in held], LENGTH, SHARD)
        if not len(place):
            return
        offsets = np.cumsum([0, *(len(r[4]) + 1 for r in held)])
        at = np.searchsorted(offsets, place, "right") - 1
        doc = np.array([r[1] for r in held], np.int64)[at]
        version = np.array([r[2] for r in held], np.int64)[at]
        start = np.array([r[3] for r in held], np.int64)[at] + place - offsets[at]
        sorting, new = earliest([group], [doc, version, start])
        later = sorting[~new]
        yield record(REPEATED_DDL, *ranges(doc[later], version[later], start[later], start[later]))

    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(5))):
            if held and row[:4] == held[-1][:4]:
                continue
            if row[0] != anchor and size >= BLOCK:
                yield from flush()
                held, size = [], 0
            anchor = row[0]
            held.append(row)
            size += len(row[4])
    if held:
        yield from flush()


WINDOW_DDL = "w1 long, w2 long, doc_id long, version long, first long"


def window_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows of contexts by two hashes of their bytes."""
    for batch in batches:
        for _, doc, version, first, context in zip(*(batch.column(i).to_pylist() for i in range(5))):
            data = np.frombuffer(context, np.uint8)
            hashes = [mix(rolled(data, LENGTH, base)[LENGTH]).view(np.int64) for base in (_BASE, 0xC2B2AE3D27D4EB4F)]
            n = len(hashes[0])
            yield record(WINDOW_DDL, *hashes, np.full(n, doc), np.full(n, version), np.arange(first, first + n))


def same_text() -> Column:
    return (F.col("doc_id") == F.col("_id")) & (F.col("version") == F.col("_version"))


def repeated(docs: DataFrame, wide: int = WIDE) -> DataFrame:
    """(doc_id, version, first, last): windows that also start earlier, as ranges of starts."""
    raw = docs.filter("doc_id IS NOT NULL AND octet_length(text) >= 100").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("raw"),
        F.xxhash64(F.col("text").cast("binary")).alias("version"))
    # Settled ranges are spread by document: copies of one text end at the same window.
    key = F.when(F.col("around").isNull(), F.xxhash64("doc_id", "place")).otherwise(F.col("anchor"))
    dealt = (raw.mapInArrow(document_runs, RUN_DDL).repartition(key)
             .sortWithinPartitions(F.col("around").isNotNull(), "anchor", "around", "doc_id", "version", "place"))
    found = written(dealt.mapInArrow(settled, FOUND_DDL), "runs")
    asked = (found.filter("anchor IS NOT NULL").groupBy(F.col("doc_id").alias("_id"), F.col("version").alias("_version"))
             .agg(F.collect_list(F.struct("anchor", "first", "last", "others")).alias("_runs")))
    # Candidates grow with the corpus, so the plan is the one that holds at any size.
    texts = packed(raw).join(asked.hint("merge"), same_text()).select("doc_id", "packed", "version", "_runs")
    surrounded = written(texts.mapInArrow(contexts, CONTEXT_DDL), "contexts")
    narrow = (surrounded.filter(F.col("others") < wide).drop("others").repartition("anchor")
              .sortWithinPartitions("anchor", "doc_id", "version", "first").mapInArrow(indexed, REPEATED_DDL))
    windows = written(surrounded.filter(F.col("others") >= wide).drop("others").mapInArrow(
        window_hashes, WINDOW_DDL), "windows")
    place = F.struct("doc_id", "version", "first")
    least = windows.groupBy("w1", "w2").agg(F.min(place).alias("_first"), F.count("*").alias("_n")).filter("_n > 1")
    later = windows.join(least, ["w1", "w2"]).filter(place > F.col("_first"))
    return (found.filter("anchor IS NULL").select("doc_id", "version", "first", "last").union(narrow)
            .union(later.select("doc_id", "version", "first", F.col("first").alias("last"))))


RESULT_DDL = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def removed_spans(size: int, firsts, lasts) -> list[tuple[int, int]]:
    """Maximal removed byte ranges of a text from ranges of repeated windows."""
    spans: list[list[int]] = []
    for first, last in sorted(zip(firsts, lasts)):
        end = min(last + LENGTH, size)
        if spans and first <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], end)
        elif first < end:
            spans.append([first, end])
    return [(a, b) for a, b in spans]


def cut_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for doc, data, firsts, lasts in zip(*(batch.column(i).to_pylist() for i in range(4))):
            raw = unpacked(data)
            spans = removed_spans(len(raw), firsts or (), lasts or ())
            digest, at = hashlib.sha256(), 0
            for a, b in spans:
                digest.update(raw[at:a])
                at = b
            digest.update(raw[at:])
            out.append((doc, len(raw), sum(b - a for a, b in spans), len(spans), digest.hexdigest()))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)],
                                         names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def without_repeats(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Removed is each byte covered by a 100-byte string that also starts earlier: in a
    document with a smaller doc_id, or earlier in the same one. Strings are judged on the
    input, and matches never cross documents. A null text is empty. A null doc_id has no
    place in the order: nothing is removed there or on its account. Equal rows are the same
    document, and each gets its result; different texts of one doc_id are documents of
    their own, in the order of their hashes. Extra columns are ignored.
    """
    row_batches(docs.sparkSession)
    marks = (repeated(docs).groupBy(F.col("doc_id").alias("_id"), F.col("version").alias("_version"))
             .agg(F.collect_list("first").alias("firsts"), F.collect_list("last").alias("lasts")))
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = packed(docs.select(F.col("doc_id").cast("long").alias("doc_id"), raw.alias("raw"), F.xxhash64(raw).alias("version")))
    return (rows.join(marks.hint("merge"), same_text(), "left")
            .select("doc_id", "packed", "firsts", "lasts").mapInArrow(cut_rows, RESULT_DDL))
