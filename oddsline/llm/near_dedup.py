"""Near-duplicate documents by a multi-index Hamming join of MinHash signatures.

A signature has 30 symbols of 16 bits, one per MinHash function, and two signatures are
as far apart as symbols differ. They are cut into 6 chunks of 5 symbols. By pigeonhole,
two signatures that differ in at most 11 symbols have a chunk with at most one error, so
entering every chunk with each of its symbols left out brings every such pair together.
A pair of documents with similarity 0.85, further apart than that or not, shares an entry
with probability 1 - 2e-5, one with similarity 0.9 with 1 - 3e-7.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from oddsline.llm.common import row_batches, sent, written
from oddsline.llm.components import components

SHINGLE, SYMBOLS, CHUNK = 5, 30, 5
SIMILAR = 85  # percent
#: Rows and bytes of shingle sets that one block of a cluster holds at most.
BLOCK_ROWS, BLOCK_BYTES = 512, 8 << 20

_SEEDS = np.random.Generator(np.random.PCG64(20240229)).integers(1, 1 << 63, (3, SYMBOLS), np.uint64)
FACTORS, SHIFTS = _SEEDS[0] * np.uint64(2) + np.uint64(1), _SEEDS[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(raw: bytes | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's 5-word shingles.

    With fewer words the whole sequence is the one shingle; null or no words: empty.
    """
    words = (raw or b"").lower().split()  # bytes: only A-Z are lower-cased, six spaces split
    n = len(words)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    width = min(n, SHINGLE)
    if not n:
        return hashed
    folded = np.full(n - width + 1, width, np.uint64)
    for k in range(width):
        folded = mix(folded) + hashed[k:n - width + 1 + k]
    return np.unique(mix(folded))


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of 32 symbols (the last two unused) per set; sets must not be empty."""
    sizes = np.array([len(s) for s in sets])
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1])).astype(np.int64)
    joined = np.concatenate(sets)
    out = np.zeros((len(sets), 32), np.uint16)
    for k in range(SYMBOLS):
        smallest = np.minimum.reduceat(joined * FACTORS[k] + SHIFTS[k], starts)
        out[:, k] = mix(smallest) >> np.uint64(48)
    return out


def hashed_rows(raws: list[bytes | None]) -> Iterator[tuple[int, np.ndarray, bytes]]:
    """Per text: set, signature (8 longs); texts go in portions of about a million shingles."""
    portion: list[np.ndarray] = []

    def flush():
        filled = [s for s in portion if len(s)]
        packed = iter(signatures(filled).view(np.int64) if filled else [])
        for s in portion:
            yield s, next(packed) if len(s) else np.zeros(8, np.int64)
        portion.clear()

    size = 0
    for raw in raws:
        portion.append(shingle_set(raw))
        size += len(portion[-1])
        if size > 1 << 20:
            yield from flush()
            size = 0
    yield from flush()


def set_key(s: np.ndarray) -> tuple[int, int]:
    digest = np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64)
    return int(digest[0]), int(digest[1])


SIGNED = "doc_id long, h long, n long, s1 long, s2 long, " + ", ".join(f"c{i} long" for i in range(8))


def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [part.split()[0] for part in SIGNED.split(", ")]
    for batch in batches:
        if not batch.num_rows:
            continue
        n, keys, packed = [], [], []
        for s, signature in hashed_rows(batch.column("raw").to_pylist()):
            n.append(len(s))
            keys.append(set_key(s))
            packed.append(signature)
        keys, packed = np.array(keys, np.int64), np.array(packed, np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").cast(pa.int64()), batch.column("h"), pa.array(n, pa.int64()), pa.array(keys[:, 0]),
             pa.array(keys[:, 1]), *[pa.array(packed[:, i]) for i in range(8)]], names=names)


def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The index entries of signatures: every chunk with each of its symbols left out."""
    for batch in batches:
        if not batch.num_rows:
            continue
        packed = np.stack([batch.column(f"c{i}").to_numpy(zero_copy_only=False) for i in range(8)], 1)
        symbols = np.ascontiguousarray(packed).view(np.uint16).astype(np.uint64)
        ids = batch.column("id")
        for first in range(0, SYMBOLS, CHUNK):
            for left_out in range(CHUNK):
                key = np.zeros(len(symbols), np.uint64)
                for k in range(CHUNK):
                    if k != left_out:
                        key = (key << np.uint64(16)) | symbols[:, first + k]
                key = mix(key ^ mix(np.full(1, first * CHUNK + left_out + 1, np.uint64))).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(key), ids], names=["key", "id"])


BLOCKED = "cluster long, p int, q int, block int, id long, n long, shingles binary, signature binary"


def block_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingle sets of cluster members, once for every block pair that needs them."""
    names = [part.split()[0] for part in BLOCKED.split(", ")]
    types = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    schema = pa.schema([(c.split()[0], types[c.split()[1]]) for c in BLOCKED.split(", ")])
    for batch in batches:
        rows, size = [], 0
        info = [batch.column(c).to_pylist() for c in ("id", "cluster", "blocks", "block", "s1", "s2")]
        for i, (s, signature) in enumerate(hashed_rows(batch.column("raw").to_pylist())):
            doc, cluster, blocks, block, s1, s2 = (c[i] for c in info)
            if set_key(s) != (s1, s2):
                continue  # another row with the same doc_id
            for other in range(blocks):
                rows.append((cluster, min(block, other), max(block, other), block, doc, len(s),
                             s.tobytes(), signature.tobytes()))
                size += 8 * len(s)
            if size > 16 << 20:
                yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema)
                rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema)


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """100 * intersection >= 85 * union of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    if 100 * len(a) < SIMILAR * len(b):
        return False
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    both = int((b[at] == a).sum())
    return 100 * both >= SIMILAR * (len(a) + len(b) - both)


def link_block(rows: list[tuple]) -> list[tuple[int, int]]:
    """Links between two blocks of a cluster (or inside one), as a spanning forest.

    Rows are (block, id, n, set, signature). Pairs already tied together are skipped; all
    others whose sizes allow a link are compared on their full sets, likely ones first.
    """
    unique = {r[1]: r for r in rows}
    rows = sorted(unique.values(), key=lambda r: (r[2], r[1]))
    within = len({r[0] for r in rows}) == 1
    sides = np.array([r[0] for r in rows])
    sizes = np.array([r[2] for r in rows])
    sets = [np.frombuffer(r[3], np.uint64) for r in rows]
    signs = np.stack([np.frombuffer(r[4], np.uint16) for r in rows])
    root = np.arange(len(rows))
    links = []
    for i in range(len(rows) - 1):
        last = int(np.searchsorted(sizes, sizes[i] * 100 // SIMILAR, "right"))
        js = np.arange(i + 1, last)
        js = js[root[js] != root[i]]
        if not within:
            js = js[sides[js] != sides[i]]
        if not len(js):
            continue
        distance = (signs[js] != signs[i]).sum(1)
        for j in js[np.argsort(distance, kind="stable")]:
            if root[j] != root[i] and similar(sets[i], sets[j]):
                links.append((rows[i][1], rows[j][1]))
                root[root == root[j]] = root[i]
    return links


def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs over rows sorted by block pair; holds one block pair at a time."""
    held, key = [], None

    def flush():
        found = link_block(held) if len(held) > 1 else []
        if found:
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()),
                                              pa.array([y for _, y in found], pa.int64())], names=["a", "b"])

    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
        for cluster, p, q, *row in zip(*columns):
            if (cluster, p, q) != key:
                yield from flush()
                held, key = [], (cluster, p, q)
            held.append(tuple(row))
    yield from flush()


def labelled(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, classes): rows (doc_id, h, n, s1, s2) of ``docs``, and for each set (s1, s2) its
    group: ``node`` is the group's own number, ``component`` its smallest doc_id.

    Nodes of the graph are sets, so rows that share a doc_id but not their set stay apart.
    ``h`` is a hash of the text.
    """
    row_batches(docs.sparkSession)
    raw = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("h"),
                      F.col("text").cast("binary").alias("raw"))
    signed = written(raw.mapInArrow(sign, SIGNED), "signed")
    sets = (signed.filter("n > 0 AND doc_id IS NOT NULL").groupBy("s1", "s2")
            .agg(F.min("doc_id").alias("least"), F.max("n").alias("n"),
                 *[F.max(f"c{i}").alias(f"c{i}") for i in range(8)]))
    # Numbered as they are written, so that the numbers don't change any more.
    classes = written(sets.withColumn("id", F.monotonically_increasing_id()), "classes")
    members = written(blocked(classes, clusters(classes)), "members")
    # Members grow with the corpus, so the plan is the one that holds at any size.
    texts = (raw.join(members.hint("merge"), raw.doc_id == members.least)
             .select("raw", "id", "cluster", "blocks", "block", "s1", "s2"))
    pairs = (texts.mapInArrow(block_rows, BLOCKED).repartition("cluster", "p", "q")
             .sortWithinPartitions("cluster", "p", "q"))
    found = components(pairs.mapInArrow(links, "a long, b long"), "a", "b")
    own = classes.select("id", "s1", "s2", "least").join(found, "id", "left").withColumn(
        "node", F.coalesce("component", "id")).drop("component")
    own = written(own, "nodes")
    # Only groups of several sets need a smallest doc_id other than the set's own.
    several = own.filter("id <> node").select("node").distinct()
    least = own.join(several, "node", "left_semi").groupBy("node").agg(F.min("least").alias("component"))
    return (signed.select("doc_id", "h", "n", "s1", "s2"),
            own.join(least, "node", "left").select("s1", "s2", "node", F.coalesce("component", "least").alias("component")))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept.

    Documents are linked when 100 * intersection >= 85 * union of their shingle sets,
    confirmed on the full sets; ``component_id`` is the smallest doc_id reachable. Equal
    sets are one node of the graph, so copies cost nothing further. A document without
    words is linked with nothing. A null doc_id can't name a group: its component is
    null, and it is kept. Rows sharing a doc_id are the same document if their sets are
    equal, else each is judged by its own set. Extra columns are ignored.
    """
    rows, classes = labelled(docs)
    out = rows.join(classes, ["s1", "s2"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def clusters(classes: DataFrame) -> DataFrame:
    """(id, component) of classes tied by common index entries, not yet confirmed.

    Within an entry all members are tied to the smallest, so a hot entry gives a star and
    no pairs. Every pair that shares an entry is in one cluster.
    """
    keyed = classes.select("id", *[f"c{i}" for i in range(8)]).mapInArrow(entries, "key long, id long")
    shared = keyed.groupBy("key").agg(F.min("id").alias("hub"), F.max("id").alias("_last")).filter("hub < _last")
    stars = keyed.join(shared, "key").filter("id != hub").select("hub", "id")
    return components(stars, "hub", "id")


def blocked(classes: DataFrame, grouped: DataFrame) -> DataFrame:
    """Members of clusters with their block: a cluster is cut so that no task holds more
    than two blocks of bounded rows and bytes, and every two blocks meet in some task."""
    members = classes.select("id", "least", "n", "s1", "s2").join(grouped, "id")
    sizes = members.groupBy("component").agg(F.ceil(F.greatest(
        F.count("*") / F.lit(BLOCK_ROWS), 8 * F.sum("n") / F.lit(BLOCK_BYTES))).cast("int").alias("blocks"))
    return (members.join(sizes, "component")
            .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
            .select("id", "least", F.col("component").alias("cluster"), "blocks", "block", "s1", "s2"))


def keep_first(docs: DataFrame) -> DataFrame:
    """``docs`` with one row per group of near duplicates, columns unchanged.

    The row with the smallest doc_id stays, of one doc_id that with the smallest text hash,
    and one of several rows that are equal in both. A row without words is a group of its
    own, but equal ones are one; rows without doc_id all stay. Only rows with a copy of
    both id and text, and those that meet a long list of dropped ones, are moved.
    """
    rows, classes = labelled(docs)
    keyed = written(rows.filter("doc_id IS NOT NULL").groupBy("doc_id", "h", "s1", "s2", "n")
                    .agg(F.count("*").alias("_copies"))
                    .join(classes.select("s1", "s2", "node"), ["s1", "s2"], "left"), "keyed")
    named = F.struct("doc_id", "h")
    first = keyed.filter("n > 0").groupBy("node").agg(F.min(named).alias("_first"))
    dropped = written(keyed.filter("n > 0").join(first, "node").filter(named != F.col("_first"))
                      .select(F.col("doc_id").alias("_id"), F.col("h").alias("_hash")).distinct(), "dropped")
    copied = written(keyed.filter("_copies > 1").select(F.col("doc_id").alias("_id"), F.col("h").alias("_hash"))
                     .distinct(), "copied")
    text_hash = F.xxhash64(docs["text"])

    def meets(keys: DataFrame):
        return (docs["doc_id"].cast("long") == keys["_id"]) & (text_hash == keys["_hash"])

    dropped_, copied_ = sent(dropped), sent(copied)
    single = docs.join(dropped_, meets(dropped_), "left_anti").join(copied_, meets(copied_), "left_anti")
    if copied.isEmpty():
        return single
    again = docs.join(copied_, meets(copied_), "left_semi").join(dropped_, meets(dropped_), "left_anti")
    every = F.struct(*[f"`{c}`" for c in docs.columns])
    one = (again.groupBy("doc_id", F.xxhash64("text")).agg(F.min_by(every, F.xxhash64(every)).alias("_row"))
           .select("_row.*"))
    return single.unionByName(one)
