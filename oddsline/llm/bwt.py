"""Burrows-Wheeler transforms of sets of strings, and their merging.

A transform is the character before each suffix, in suffix order. It is all that a merge
needs: sorting its characters stably gives the first character of every suffix and the
entry of the suffix that follows. Two transforms are merged by refining their interleave:
first all entries are dealt by their first character, those of the first set before those
of the second; then the entries of each still equal group are dealt by the group of the
suffix that follows after the characters compared so far, which doubles these. Suffixes
are never compared or sorted by their text again, and the entries of one set never
change their order. Groups that remain share the wanted prefix. Based on J. Holt and L. McMillan,
"Merging of multi-string BWTs with applications" (2014), which compares one more
character in each round.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

PACKED = 7


@dataclass
class Transform:
    """Characters before the suffixes in suffix order (0: string start, else byte + 1), the
    suffixes' places in the caller's numbering, and the number of strings."""
    before: np.ndarray
    places: np.ndarray
    strings: int


def split_groups(order: np.ndarray, rank: np.ndarray, second: np.ndarray) -> bool:
    """Deals the entries of every group of equal ``rank`` by ``second``, in place.

    ``rank`` of an entry is the slot in ``order`` where its group begins. Entries equal in
    both keep their order. Returns whether any group of two or more remains.
    """
    ranks = rank[order]
    new = np.ones(len(order) + 1, bool)
    new[1:-1] = ranks[1:] != ranks[:-1]
    slots = np.flatnonzero(~(new[:-1] & new[1:]))
    if not len(slots):
        return False
    entries = order[slots]
    key = ranks[slots] * np.int64(len(order) + 1) + second[entries]
    sorting = np.argsort(key, kind="stable")
    entries, key = entries[sorting], key[sorting]
    order[slots] = entries
    parted = np.ones(len(slots), bool)
    parted[1:] = key[1:] != key[:-1]
    rank[entries] = slots[np.maximum.accumulate(np.where(parted, np.arange(len(slots)), 0))]
    return True


def transform(strings: list[bytes], first_place: int = 0) -> Transform:
    """The transform of a shard. Every string ends with a mark of its own, smaller than all
    bytes and ordered as the list; places count bytes and marks from ``first_place``."""
    lengths = np.array([len(s) for s in strings], np.int64)
    ends = np.cumsum(lengths + 1) - 1
    text = np.frombuffer(b"".join(s + b"\0" for s in strings), np.uint8).astype(np.uint16) + np.uint16(1)
    text[ends] = 0
    n = len(text)
    packed = np.zeros(n, np.int64)
    left = np.repeat(ends, lengths + 1) - np.arange(n)  # bytes before the mark
    for k in range(PACKED):
        shifted = np.zeros(n, np.int64)
        shifted[:max(0, n - k)] = text[k:]
        packed = packed * 257 + np.where(left >= k, shifted, 0)
    order = np.argsort(packed, kind="stable")
    marked = left[order] < PACKED  # holds its mark, so it equals no other
    parted = np.ones(n, bool)
    parted[1:] = (packed[order][1:] != packed[order][:-1]) | marked[1:] | marked[:-1]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(parted, np.arange(n), 0))
    width, following = PACKED, np.arange(n)
    while width <= lengths.max(initial=0):
        if not split_groups(order, rank, rank[np.minimum(following + width, n - 1)]):
            break
        width *= 2
    before = np.empty(n, np.uint16)
    before[1:] = text[:-1]
    before[ends - lengths] = 0
    return Transform(before[order], order + first_place, len(strings))


def read(t: Transform) -> tuple[np.ndarray, np.ndarray]:
    """First characters of the suffixes, and the entries of the suffixes after them."""
    following = np.argsort(t.before, kind="stable")
    first = t.before[following]
    following[:t.strings] = np.arange(t.strings)  # nothing follows a mark
    return first, following


def merge(a: Transform, b: Transform, depth: int) -> tuple[Transform, np.ndarray]:
    """The transform of both sets, ordered by the first ``depth`` characters at least, and
    the group of every entry: entries of a group share ``depth`` characters. No group of
    two or more holds a suffix that is shorter. Without a second set this only groups."""
    (first_a, next_a), (first_b, next_b) = read(a), read(b)
    first = np.concatenate((first_a, first_b))
    n, strings = len(first), a.strings + b.strings
    jumps = [np.concatenate((next_a, next_b + len(next_a)))]
    order = np.argsort(first, kind="stable")
    parted = np.ones(n, bool)
    parted[1:] = first[order][1:] != first[order][:-1]
    parted[:strings] = True
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(parted, np.arange(n), 0))
    width = 1
    while width < depth:
        step = min(width, depth - width)
        at = None
        for bit, jump in enumerate(jumps):
            if step >> bit & 1:
                at = jump if at is None else jump[at]
        if not split_groups(order, rank, rank[at]):
            break
        width += step
        jumps.append(jumps[-1][jumps[-1]])
    before = np.concatenate((a.before, b.before))[order]
    return Transform(before, np.concatenate((a.places, b.places))[order], strings), rank[order]


EMPTY = Transform(np.empty(0, np.uint16), np.empty(0, np.int64), 0)


def repeats(strings: list[bytes], length: int, shard_bytes: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, group) of all substrings of ``length`` bytes that occur twice or more.

    The strings are cut into shards in list order, whose transforms are merged two by two.
    Places count bytes and one end mark per string; equal substrings have equal groups.
    """
    shards, held, size, place = [], [], 0, 0
    for s in strings:
        held.append(s)
        size += len(s) + 1
        if size >= shard_bytes:
            shards.append(transform(held, place))
            place += size
            held, size = [], 0
    if held:
        shards.append(transform(held, place))
    if not shards:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    longest = max(map(len, strings)) + 1  # below the root the order must be complete
    while len(shards) > 2:
        pairs = zip(shards[::2], shards[1::2])
        shards = [merge(a, b, longest)[0] for a, b in pairs] + shards[len(shards) // 2 * 2:]
    whole, group = merge(shards[0], shards[1] if len(shards) > 1 else EMPTY, length)
    many = np.bincount(group)[group] > 1
    return whole.places[many], group[many]
