"""Best-fit packing of documents into fixed-length sequences by bin completion.

Pieces of one length are alike, so a packing is planned on the number of pieces of each
length: at most ``capacity`` numbers, whatever the corpus. Bin completion takes the
longest length left, lists the undominated fillings of the room beside it, and makes the
one of least waste as often as the numbers allow. The last pieces are searched one
sequence at a time by branch and bound: fillings by rising waste, cut off where the waste
so far, or a lower bound on the sequences of the rest, cannot beat the best packing known.
Best-fit decreasing gives the first one, for the whole and for the rest. The plan is then
dealt out on the executors: pieces are numbered within their length, and a number
says which sequence and place is the piece's.
"""

from __future__ import annotations

import bisect
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from oddsline.llm.common import row_batches, row_hash, running, written

CAPACITY = 2048
#: Pieces that are left to branch and bound, and the steps it and one listing may take.
#: They bound the search, not the input: the best packing known is used then.
SEARCHED, NODES, VISITS = 96, 3000, 400
#: Bytes of words whose ids a worker remembers before it forgets all and starts anew.
REMEMBERED = 4_000_000

Pattern = tuple[tuple[int, int], ...]  # (length, pieces of it), the content of a sequence


class Tokens:
    """Ids of whole texts by a tokenizers file.

    Texts of plain letters, digits and marks are cut into pre-tokens here and merged by
    ``merging``, where that is proved equal. Of other texts the words between ASCII
    white space are taken apart, which always separates tokens where the pre-tokenizer only
    matches runs without white space, and the normalizer treats characters alone or
    composes marks with the character before: each is encoded once, plain ones as above
    and others by the library, and remembered. Other tokenizers, and texts with the string
    of an added token, are left to the library.
    """

    def __init__(self, path: str):
        import json

        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}
        self.held = 0
        config = json.load(open(path, encoding="utf-8"))
        self.added = [t["content"] for t in config.get("added_tokens") or []]
        self.by_word = self.separable(config)
        self.merge, self.ending = merging(config["model"]) if self.by_word else (None, None)

    @staticmethod
    def separable(config: dict) -> bool:
        normalizer, splitter = config.get("normalizer") or {}, config.get("pre_tokenizer") or {}
        local = [n["type"] in ("NFC", "Lowercase") or n == {
            "type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "} for n in normalizer.get("normalizers", [])]
        lower = any(n["type"] == "Lowercase" for n in normalizer.get("normalizers", []))
        parts = splitter.get("pretokenizers", [])
        split = [p["type"] == "Split" and p["behavior"] == "Removed" and p["invert"]
                 and SPACELESS == p["pattern"].get("Regex") for p in parts[:1]]
        rest = [p["type"] == "ByteLevel" and not p["add_prefix_space"] and not p["use_regex"] for p in parts[1:]]
        return (normalizer.get("type") == splitter.get("type") == "Sequence" and all(local) and lower
                and split == rest == [True] and not config.get("post_processor"))

    @staticmethod
    def packed(ids: list[int]) -> bytes:
        return np.array(ids, "<u4").tobytes()

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids of a text."""
        if not self.by_word or any(t in text for t in self.added):
            return self.packed(self.model.encode(text, add_special_tokens=False).ids)
        if self.merge and PLAIN(text):
            return self.merge(END.join([*PRETOKENS(text.lower()), ""])).tobytes()
        words = text.encode().split()  # of bytes: splits at ASCII white space only
        if self.held > REMEMBERED:
            self.known.clear()
            self.held = 0
        known = self.known
        new = set(words).difference(known)
        if new:
            self.held += sum(map(len, new))
            self.learn(new)
        return b"".join(map(known.__getitem__, words))

    def learn(self, words: set[bytes]) -> None:
        plain, parts, counts, other = [], [], [], []
        for word in words:
            text = word.decode()
            if self.merge and PLAIN(text):
                own = PRETOKENS(text.lower())
                plain.append(word)
                parts += own
                counts.append(len(own))
            else:
                other.append(word)
        if plain:
            ids = self.merge(END.join([*parts, ""]))
            last = (np.flatnonzero(self.ending[ids]) + 1)[np.cumsum(counts) - 1] * 4
            data, first = ids.tobytes(), 0
            for word, end in zip(plain, last.tolist()):
                self.known[word] = data[first:end]
                first = end
        if other:
            found = self.model.encode_batch([w.decode() for w in other], add_special_tokens=False)
            self.known.update((w, self.packed(e.ids)) for w, e in zip(other, found))


#: Fixed value: the expression by which the tokenizer cuts texts; no alternative matches white space.
SPACELESS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Latin letters whose lower case is one letter, whatever stands beside them.
_LETTERS = "\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0132-\u0148\u014a-\u017e"
PLAIN = re.compile(f"[\\t-\\r -~{_LETTERS}]+").fullmatch
PRETOKENS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[a-z{_LETTERS}]+|[0-9]|[^\\t-\\r a-z0-9{_LETTERS}]+").findall
#: Ends a pre-token in ``merging``; words that hold it are not plain.
END = "\0"


def byte_characters() -> dict[str, int]:
    """The character by which byte-level vocabularies write each byte: printable Latin-1
    characters stand for themselves, the others follow from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def merging(model: dict):
    """A function from pre-tokens, each followed by END, to ids, and which ids end one; or nothing.

    The library merges a pair of neighbours if there is a rule for it; the fast one merges
    any pair whose text is in the vocabulary, both by rising rank. They agree if every
    string left in the vocabulary is one token when encoded alone: as long as two
    neighbours x, y cover a string, the merges inside it came in the same order as
    if it stood alone, so x, y is its last step and has the rule. Strings that alone
    are not one token are never made by the library and are taken out.
    """
    import tiktoken
    from tokenizers import Tokenizer, models

    vocabulary, suffix = model["vocab"], model.get("end_of_word_suffix")
    rules = [tuple(r.split(" ")) if isinstance(r, str) else tuple(r) for r in model["merges"]]
    made = [vocabulary[x + y] for x, y in rules]
    others = set(vocabulary.values()) - set(made)
    special = [i for i in others if i > min(made)]
    if (model["type"] != "BPE" or not suffix or model.get("dropout") or model.get("continuing_subword_prefix")
            or model.get("byte_fallback") or model.get("ignore_merges") or made != sorted(set(made))):
        return None, None
    number = byte_characters()
    whole = Tokenizer(models.BPE(vocabulary, rules, end_of_word_suffix=suffix))
    inner = Tokenizer(models.BPE(vocabulary, rules))
    ranks: dict[bytes, int] = {}
    names = [t for t, i in vocabulary.items() if i not in special]
    for ends, by in ((True, whole), (False, inner)):
        own = [t for t in names if t.endswith(suffix) == ends]
        bodies = [t[:-len(suffix)] if ends else t for t in own]
        for token, body, alone in zip(own, bodies, by.encode_batch(bodies)):
            raw = bytes(number[c] for c in body)
            if alone.ids == [vocabulary[token]] and (END.encode() not in raw or raw == END.encode() and not ends):
                ranks[raw + END.encode() * ends] = vocabulary[token]
    single = [ranks.get(bytes([b]), -1) for b in range(256)]
    closed = [ranks.get(bytes([b, 0]), -1) for b in range(1, 256)]
    if -1 in single + closed or max(single + closed) > min(made):
        return None, None  # some byte has no token, or merges could come before the end of a word
    ending = np.zeros(max(vocabulary.values()) + 1, bool)
    ending[[i for raw, i in ranks.items() if len(raw) > 1 and raw.endswith(END.encode())]] = True
    fast = tiktoken.Encoding("words", pat_str=r"[^\x00]+\x00", mergeable_ranks=ranks, special_tokens={})
    return fast.encode_to_numpy, ending


@lru_cache(maxsize=2)
def tokens(path: str) -> Tokens:
    return Tokens(path)


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = 0) -> DataFrame:
    """Per piece: doc_id, piece (from 0), start, length, ids (little-endian unsigned 32-bit).

    A document is the ids of its whole text, without special tokens, then the id ``end``.
    Only documents longer than ``capacity`` are cut, into pieces of ``capacity``; the last
    one may be shorter. A null or empty text has the end only. Repeated rows and null or
    shared ids give pieces of their own; extra columns are ignored. ``tokenizer`` is the
    path of a tokenizers file on every worker.
    """
    row_batches(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokens(tokenizer)
        last = own.packed([end])
        for batch in batches:
            at, number, ids, held = [], [], [], 0

            def given():
                length = [len(i) // 4 for i in ids]
                return pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(at, pa.int64())), pa.array(number, pa.int32()),
                     pa.array([n * capacity for n in number], pa.int64()), pa.array(length, pa.int64()),
                     pa.array(ids, pa.binary())], ["doc_id", "piece", "start", "length", "ids"])

            for row, text in enumerate(batch.column(1)):
                whole = own.ids(text.as_py() or "") + last
                for k, begin in enumerate(range(0, len(whole), 4 * capacity)):
                    at.append(row)
                    number.append(k)
                    ids.append(whole[begin:begin + 4 * capacity])
                held += len(whole)
                if held > 8_000_000:
                    yield given()
                    at, number, ids, held = [], [], [], 0
            if at:
                yield given()

    rows = docs.select("doc_id", F.col("text").cast("string").alias("_text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(cut, f"doc_id {kind}, piece int, start long, length long, ids binary")


def lower_bound(counts: np.ndarray) -> int:
    """Sequences that any packing needs, by the long pieces that can't share one.

    ``counts`` holds the number of pieces of each length, from 0 to the capacity.
    """
    capacity = len(counts) - 1
    number, total = np.cumsum(counts), np.cumsum(counts * np.arange(capacity + 1))
    half = capacity // 2
    k = np.arange(half + 1)
    alone = number[-1] - number[capacity - k]
    halves, halves_total = number[capacity - k] - number[half], total[capacity - k] - total[half]
    small = total[half] - np.where(k > 0, total[np.maximum(k - 1, 0)], 0)
    room = halves * capacity - halves_total
    return int((alone + halves + np.maximum(0, -((room - small) // capacity))).max())


def best_fit(counts: Counter, capacity: int) -> list[tuple[int, Pattern]]:
    """Best-fit decreasing on numbers of pieces: (sequences, what each of them holds)."""
    rooms: list[int] = []  # ascending; sequences of each room
    held: dict[int, list[tuple[int, Pattern]]] = {}

    def put(room: int, sequences: int, pattern: Pattern) -> None:
        if sequences:
            if room not in held:
                bisect.insort(rooms, room)
            held.setdefault(room, []).append((sequences, pattern))

    def take(at: int) -> tuple[int, Pattern]:
        room = rooms[at]
        out = held[room].pop()
        if not held[room]:
            del held[room], rooms[at]
        return out

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect.bisect_left(rooms, length)
            room = rooms[at] if at < len(rooms) else capacity
            sequences, pattern = take(at) if at < len(rooms) else (left, ())
            fit = room // length
            full = min(sequences, left // fit)
            put(room - fit * length, full, (*pattern, (length, fit)))
            left -= full * fit
            sequences -= full
            if sequences and left:
                put(room - left * length, 1, (*pattern, (length, left)))
                left, sequences = 0, sequences - 1
            if pattern:
                put(room, sequences, pattern)
    return [entry for entries in held.values() for entry in entries]


def fillings(counts: Counter, present: list[int], room: int, most_waste: int, visits: int = VISITS) -> Iterator[Pattern]:
    """Undominated fillings of a room, by rising waste, then by falling lengths.

    ``present`` are the lengths of ``counts`` that are left, ascending. A length that
    fills the room exactly dominates all else. A filling is dominated if a piece outside
    it can take the place of pieces in it, with as much or more of the room filled.
    """
    found: list[tuple[int, tuple[int, ...]]] = []
    used: Counter = Counter()
    budget = visits

    def walk(left: int, longest: int, chosen: tuple[int, ...]) -> None:
        nonlocal budget
        at = bisect.bisect_right(present, left) - 1
        while at >= 0 and used[present[at]] >= counts[present[at]]:
            at -= 1
        if at < 0:
            if left <= most_waste:
                found.append((left, chosen))
            return
        if present[at] == left > longest:
            return  # dominated by that piece
        at = min(at, bisect.bisect_right(present, longest) - 1)
        while at >= 0 and budget > 0:
            length = present[at]
            if used[length] < counts[length]:
                budget -= 1
                used[length] += 1
                walk(left - length, length, (*chosen, length))
                used[length] -= 1
                if length == left:
                    return
            at -= 1

    walk(room, room, ())
    spare = sum(1 << x for x in present)
    for waste, chosen in sorted(found, key=lambda f: (f[0], [-x for x in f[1]])):
        if not dominated(chosen, waste, counts, spare):
            yield tuple(Counter(chosen).items())


def dominated(chosen: tuple[int, ...], waste: int, counts: Counter, spare: int) -> bool:
    """Whether one more piece could stand for some of the chosen ones and waste no more.

    Sets of lengths are bits of an integer; ``spare`` has those of all pieces.
    """
    for x, n in Counter(chosen).items():
        if n >= counts[x]:
            spare &= ~(1 << x)
    sums, several = 1, 0  # sums of any pieces, and of two or more
    for x in chosen:
        several |= (sums & ~1) << x
        sums |= sums << x
    sums &= ~1
    longer, span = sums << 1 if waste else 0, 1  # lengths above a sum by ``waste`` at most
    while span < waste:
        step = min(span, waste - span)
        longer |= longer << step
        span += step
    return bool(spare & (longer | several))


def searched(counts: Counter, capacity: int) -> list[tuple[int, Pattern]]:
    """The best packing of a few pieces that branch and bound finds within its steps."""
    best = best_fit(counts, capacity)
    total = sum(length * n for length, n in counts.items())
    table = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        table[length] = n
    least = lower_bound(table)
    nodes = NODES
    left = Counter(counts)

    def number(packing):
        return sum(n for n, _ in packing)

    def branch(done: list[Pattern], waste: int) -> None:
        nonlocal best, nodes
        present = sorted(x for x in left if left[x])
        if not present:
            if len(done) < number(best):
                best = [(1, pattern) for pattern in done]
            return
        nodes -= 1
        if nodes < 0 or number(best) == least or len(done) + lower_bound(table) >= number(best):
            return
        allowed = (number(best) - 1) * capacity - total - waste
        longest = present[-1]
        take(longest, 1)
        rest = present if left[longest] else present[:-1]
        for filling in fillings(left, rest, capacity - longest, allowed):
            inside = capacity - longest - sum(x * n for x, n in filling)
            if inside > (number(best) - 1) * capacity - total - waste:
                break  # fillings waste more and more
            for x, n in filling:
                take(x, n)
            merged = Counter({longest: 1}) + Counter(dict(filling))
            branch([*done, tuple(sorted(merged.items(), reverse=True))], waste + inside)
            for x, n in filling:
                take(x, -n)
        take(longest, -1)

    def take(length: int, n: int) -> None:
        left[length] -= n
        table[length] -= n

    branch([], 0)
    return best


def completed(counts: dict[int, int], capacity: int) -> list[tuple[int, Pattern]]:
    """Bin completion on numbers of pieces: (sequences, what each of them holds).

    Each step fills the room beside the longest length left with the filling of least
    waste, as often as the numbers allow; the last ``SEARCHED`` pieces, and what is better
    packed by best fit as a whole, are decided by ``searched`` and ``best_fit``.
    """
    left = Counter({length: n for length, n in counts.items() if n})
    present = sorted(left)
    whole = best_fit(left, capacity)
    out: list[tuple[int, Pattern]] = []
    pieces_left = sum(left.values())
    while pieces_left > SEARCHED:
        longest = present[-1]
        left[longest] -= 1
        listed = fillings(left, present if left[longest] else present[:-1], capacity - longest, capacity)
        pattern = Counter({longest: 1}) + Counter(dict(next(listed, ())))
        left[longest] += 1
        times = min(left[x] // n for x, n in pattern.items())
        spare = pieces_left - SEARCHED  # leaves enough for the search
        times = max(1, min(times, -(-spare // sum(pattern.values()))))
        for x, n in pattern.items():
            left[x] -= times * n
            if not left[x]:
                present.remove(x)
        pieces_left -= times * sum(pattern.values())
        out.append((times, tuple(sorted(pattern.items(), reverse=True))))
    out += searched(+left, capacity)
    return out if sum(n for n, _ in out) <= sum(n for n, _ in whole) else whole


def slots(packing: list[tuple[int, Pattern]]) -> np.ndarray:
    """Rows (length, first number, sequences, first sequence, offset), sorted.

    Of the pieces of a length, numbered from 0, those from the first number on go to
    the sequences one by one, and round again behind each other.
    """
    rows, given, sequence = [], Counter(), 0
    for sequences, pattern in packing:
        offset = 0
        for length, n in pattern:
            rows.append((length, given[length], sequences, sequence, offset))
            given[length] += sequences * n
            offset += length * n
        sequence += sequences
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def packed(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``rows`` of pieces, with sequence_id and offset (place in the sequence, gapless from 0).

    Needs a column ``length`` from 1 to ``capacity``; all other columns are carried along,
    but for own ones of these two names. The driver sees the number of pieces of each
    length only, and sends back a plan of at most three patterns a length. Equal rows
    are told apart arbitrarily, so only their set of places is fixed. An empty table
    gives an empty result.
    """
    kept = [c for c in rows.columns if c not in ("sequence_id", "offset")]
    own = written(rows.select("length", row_hash(*[f"`{c}`" for c in kept]).alias("_h"), F.lit(1).alias("_one"),
                              F.struct(*[f"`{c}`" for c in kept]).alias("_row")), "pieces")
    counts = {r[0]: r[1] for r in own.groupBy("length").count().collect()}  # one row a length
    if any(not 1 <= n <= capacity for n in counts):
        raise ValueError(f"pieces are 1 to {capacity} long")
    plan = slots(completed(counts, capacity))
    places = placing(plan)
    numbered = running(own, "length", "_h", "_one")
    at = places(F.col("length"), F.col("_rank"))
    return (numbered.select("_row", at.alias("_at"))
            .select("_row.*", F.col("_at.sequence_id").alias("sequence_id"), F.col("_at.offset").alias("offset")))


def placing(plan: np.ndarray):
    """A column function: the sequence and offset of the piece of a length with a number."""
    starts = plan[:, 0] << 48 | plan[:, 1]

    @F.pandas_udf("sequence_id long, offset long")
    def places(length: pd.Series, number: pd.Series) -> pd.DataFrame:
        length, number = length.to_numpy(np.int64), number.to_numpy(np.int64)
        _, first, sequences, sequence, offset = plan[np.searchsorted(starts, length << 48 | number, "right") - 1].T
        turn = number - first
        return pd.DataFrame({"sequence_id": sequence + turn % sequences,
                             "offset": offset + turn // sequences * length})

    return places


def sequences(placed: DataFrame) -> DataFrame:
    """Per sequence: sequence_id, n_tokens, and all ids of its pieces in order."""
    part = F.struct("offset", "ids")
    joined = F.aggregate(F.sort_array(F.collect_list(part)), F.lit(b"").cast("binary"),
                         lambda a, p: F.concat(a, p["ids"]))
    return placed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), joined.alias("ids"))
