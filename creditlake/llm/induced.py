"""Suffix order and common prefixes of one shard by external induced sorting.

The text of a shard is sorted as in SA-IS. The order of its leftmost S-type
(LMS) suffixes comes from the string of names of their substrings: that string
is sorted by recursion, until it fits into memory, where it is sorted by
doubling. From the LMS suffixes the order of all L-type, then of all S-type
suffixes is induced in one scan each.

A scan works on a priority queue of suffix tuples: the priority is the first
character, and within a character tuples come in the order they were pushed,
which is their rank. A tuple carries the position and the length of the prefix
that it has in common with the tuple before it. The queue keeps a bounded part
in memory; the rest goes to a scratch file of the task, which is unlinked when
it is opened, so that nothing outlives the task and a repeated task makes its
own.

Prefixes are followed to ``depth`` characters: the order is right up to there
and lengths are capped there.
"""

from __future__ import annotations

import tempfile
from collections import defaultdict

import numpy as np

# Tuples of a queue kept in memory, and LMS suffixes that are sorted in memory.
QUEUE_TUPLES = 4_000_000
IN_MEMORY = 4_000_000
# Suffixes whose characters are looked at together; what that takes besides them is bounded.
AT_ONCE = 1 << 15

# By the number of characters inside the bound: all bits of those that follow, of eight.
_BEYOND = np.array([(1 << 8 * (8 - k)) - 1 for k in range(9)], np.uint64)


class TupleQueue:
    """A priority queue of (position, common prefix) by first character, partly on disk."""

    def __init__(self, limit: int = QUEUE_TUPLES):
        self.limit, self.held = limit, 0
        self.buckets: dict[int, list] = defaultdict(list)
        self.file = None

    def push(self, key: int, positions: np.ndarray, common: np.ndarray) -> None:
        self.buckets[key].append((positions, common))
        self.held += len(positions)
        if self.held > self.limit:
            self._spill()

    def pop(self, key: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """All tuples pushed under ``key`` since the last time, in order, as a list of parts."""
        parts = self.buckets.pop(key, [])
        found = []
        for part in parts:
            if isinstance(part[0], np.ndarray):
                self.held -= len(part[0])
                found.append(part)
            else:
                found.append(self._load(*part))
        return found

    def _spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        self.file.seek(0, 2)
        for parts in self.buckets.values():
            for i, part in enumerate(parts):
                if isinstance(part[0], np.ndarray):
                    parts[i] = (self.file.tell(), len(part[0]))
                    self.file.write(part[0].astype(np.int64).tobytes())
                    self.file.write(part[1].astype(np.uint8).tobytes())
        self.held = 0

    def _load(self, at: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        self.file.seek(at)
        positions = np.frombuffer(self.file.read(8 * n), np.int64)
        return positions, np.frombuffer(self.file.read(n), np.uint8)

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


def repeats(text: np.ndarray, depth: int, limit: int = QUEUE_TUPLES, in_memory: int = IN_MEMORY) -> np.ndarray:
    """Whether the suffix at each place shares ``depth`` characters with another one.

    ``text`` holds characters from 1 to 254; ``depth`` is at most 200.
    """
    text = np.append(text, 0).astype(np.uint8)
    found = np.zeros(len(text), bool)
    for positions, common in _sorted(text, depth, limit, in_memory, True):
        found[positions[common >= depth]] = True
        # Who shares with the one before it, that one shares too.
        found[positions[:-1][common[1:] >= depth]] = True
    return found[:-1]


def suffix_array(text: np.ndarray, depth: int, limit: int = QUEUE_TUPLES, in_memory: int = IN_MEMORY):
    """Positions in the order of their suffixes and the common prefix of each with the one before."""
    text = np.append(text, 0).astype(np.uint8)
    parts = list(_sorted(text, depth, limit, in_memory, True))[::-1]
    return np.concatenate([p for p, _ in parts]), np.concatenate([c for _, c in parts])


def _sorted(text: np.ndarray, depth: int, limit: int, in_memory: int, carry: bool):
    """The suffixes of ``text`` (with its end mark, 0), those of the greatest first character first.

    Each part holds the suffixes of one first character in order, with what
    each shares with the one before it.
    """
    n = len(text)
    s_type = _types(text)
    lms = np.flatnonzero(s_type & np.concatenate([[False], ~s_type[:-1]])).astype(_kind(n))
    ordered = _order(text, lms, depth, limit, in_memory)
    common = _common(text, ordered, depth) if carry else np.zeros(len(ordered), np.uint8)
    keys = np.unique(text)
    scan = _Scan(text, s_type, depth, limit, carry)

    seeds = _by_key(text, ordered, common)
    lists = TupleQueue(limit)
    for key in keys.tolist():
        last = -1
        for positions, shared in scan.run(key, rising=True):
            lists.push(key, positions, shared)
            last = positions[-1]
        if key in seeds:
            positions, shared = seeds[key]
            shared = shared.copy()
            shared[0] = 0 if last < 0 else scan.seam(last, positions[0])
            scan.induce(key, positions, shared, rising=True, seeds=True)
    scan.restart()
    for key in keys[::-1].tolist():
        falling = list(scan.run(key, rising=False))
        small = lists.pop(key)
        join = 0
        if small:
            positions = np.concatenate([p for p, _ in small])
            shared = np.concatenate([c for _, c in small])
            if falling:
                join = scan.seam(positions[-1], falling[-1][0][-1])
            # In falling order each carries what it shares with the one above it.
            down = np.concatenate([[join], shared[:0:-1]]).astype(np.uint8)
            scan.induce(key, positions[::-1], down, rising=False, seeds=True)
            shared = shared.copy()
            shared[0] = 0
        elif key == 0:
            # The end mark is the only suffix that nothing induces.
            positions, shared = np.array([n - 1], lms.dtype), np.zeros(1, np.uint8)
        else:
            positions, shared = np.zeros(0, lms.dtype), np.zeros(0, np.uint8)
        if falling:
            high = np.concatenate([p for p, _ in falling])[::-1]
            up = np.concatenate([c for _, c in falling])
            positions = np.concatenate([positions, high])
            shared = np.concatenate([shared, [join], up[:0:-1]]).astype(np.uint8)
        yield positions, shared
    scan.queue.close()
    lists.close()


class _Scan:
    """One induction over the queue, rising for L-type and falling for S-type suffixes."""

    def __init__(self, text, s_type, depth, limit, carry):
        self.text, self.s_type, self.depth, self.limit, self.carry = text, s_type, depth, limit, carry
        self.queue = TupleQueue(limit)
        # The least common prefix seen since the last tuple pushed under each character.
        self.least = np.full(256, depth, np.uint8)
        self.filled = np.zeros(256, bool)

    def restart(self) -> None:
        self.queue.close()
        self.queue = TupleQueue(self.limit)
        self.least[:] = self.depth
        self.filled[:] = False

    def seam(self, low: int, high: int) -> int:
        """What an L-type and an S-type suffix of one character share: the shorter run of it."""
        return min(self._run(low), self._run(high), self.depth)

    def _run(self, at: int) -> int:
        ahead = self.text[at : at + self.depth]
        other = np.flatnonzero(ahead != ahead[0])
        return int(other[0]) if len(other) else len(ahead)

    def run(self, key: int, rising: bool):
        """All tuples of ``key``, also those that inducing them adds."""
        while parts := self.queue.pop(key):
            for positions, shared in parts:
                yield positions, shared
                self.induce(key, positions, shared, rising)

    def induce(self, key, positions, shared, rising, seeds=False) -> None:
        """Push the suffixes one place to the left that are of the scan's type."""
        before = positions - 1
        if len(positions) and positions.min() == 0:
            first = self.text[np.maximum(before, 0)]
            fits = (before >= 0) & (first >= key if rising else first <= key)
        else:
            first = self.text[before]
            fits = first >= key if rising else first <= key
        if seeds:
            fits &= first != key
        kept = np.flatnonzero(fits)
        least = _Least(shared) if self.carry else None
        if len(kept):
            target = first[kept]
            order = np.argsort(target, kind="stable")
            kept, target = kept[order], target[order]
            heads = np.flatnonzero(np.concatenate([[True], target[1:] != target[:-1]]))
            if self.carry:
                since = np.concatenate([[-1], kept[:-1]])
                since[heads] = -1
                values = least.between(since + 1, kept)
                keys = target[heads]
                values[heads] = np.minimum(values[heads], self.least[keys])
                values = np.minimum(values.astype(np.int16) + 1, self.depth).astype(np.uint8)
                values[heads[~self.filled[keys]]] = 0
            else:
                values = np.zeros(len(kept), np.uint8)
            ends = np.append(heads[1:], len(kept))
            moved = before[kept]
            for a, b in zip(heads.tolist(), ends.tolist()):
                self.queue.push(int(target[a]), moved[a:b], values[a:b])
        if self.carry:
            self.least = np.minimum(self.least, shared.min() if len(shared) else self.depth)
            if len(kept):
                last = kept[ends - 1]
                rest = np.full(len(last), self.depth, np.uint8)
                inside = last + 1 < len(shared)
                rest[inside] = least.between(last[inside] + 1, np.full(int(inside.sum()), len(shared) - 1))
                self.least[keys] = rest
                self.filled[keys] = True


class _Least:
    """Least values of intervals, from minima over powers of two."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        width = 1
        while 2 * width <= len(values):
            low = self.levels[-1]
            self.levels.append(np.minimum(low[:-width], low[width:]))
            width *= 2

    def between(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        level = np.frexp(end - begin + 1)[1] - 1
        out = np.empty(len(begin), np.uint8)
        for k in np.flatnonzero(np.bincount(level)):
            at = np.flatnonzero(level == k)
            row = self.levels[k]
            out[at] = np.minimum(row[begin[at]], row[end[at] - (1 << int(k)) + 1])
        return out


def _types(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next one; the end mark is."""
    n = len(text)
    rises = np.append(text[1:] > text[:-1], True)
    # Equal neighbours take the type of the next place where the text changes.
    places = np.arange(n, dtype=_kind(n))
    change = np.where(np.append(text[1:] != text[:-1], True), places, places[-1])
    np.minimum.accumulate(change[::-1], out=change[::-1])
    return rises[change]


def _kind(n: int) -> type:
    """The integers that number ``n`` places."""
    return np.int32 if n < 1 << 31 else np.int64


def _by_key(text, positions, common) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    first = text[positions]
    cuts = np.flatnonzero(np.concatenate([[True], first[1:] != first[:-1]]))
    ends = np.append(cuts[1:], len(positions))
    return {int(first[a]): (positions[a:b], common[a:b]) for a, b in zip(cuts.tolist(), ends.tolist())}


def _eights(text: np.ndarray) -> np.ndarray:
    """The eight characters from each place on as one big-endian number: overlapping views of one copy."""
    padded = np.append(text, np.zeros(8, np.uint8))
    return np.ndarray(len(text), ">u8", padded, strides=(1,))


def _words(eights: np.ndarray, at: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The eight characters from each place on as one number; beyond its bound the greatest character."""
    words = np.empty(len(at), np.uint64)
    for low in range(0, len(at), AT_ONCE):
        begin, bound = at[low : low + AT_ONCE], bounds[low : low + AT_ONCE]
        taken = eights[np.minimum(begin, len(eights) - 1)].astype(np.uint64)
        inside = np.clip(bound - begin, 0, 8)
        words[low : low + AT_ONCE] = taken | _BEYOND[inside]
    return words


def _order(text, lms, depth, limit, in_memory) -> np.ndarray:
    """The LMS places in the order of their suffixes, right to ``depth`` characters."""
    names, distinct = _names(text, lms, depth) if text.dtype == np.uint8 else _names_of_numbers(text, lms)
    if distinct == len(lms):
        order = np.empty(len(lms), lms.dtype)
        order[names] = np.arange(len(lms), dtype=lms.dtype)
        return lms[order]
    if len(lms) <= in_memory:
        return lms[_doubled(names, depth)]
    return lms[_recursive(names, depth, limit, in_memory)]


def _names(text, lms, depth) -> tuple[np.ndarray, int]:
    """Ranks of the LMS substrings; a substring that begins another is the greater one."""
    ends = np.minimum(np.append(lms[1:], len(text) - 1), lms + depth + 8) + 1
    kind = _kind(len(lms))
    rank = np.zeros(len(lms), kind)
    open_, at, eights = np.arange(len(lms), dtype=kind), 0, _eights(text)
    while len(open_):
        words = _words(eights, lms[open_] + at, ends[open_])
        by = np.lexsort((words, rank[open_]))
        items = open_[by]
        group, word = rank[items], words[by]
        del by, words
        new_group = np.concatenate([[True], group[1:] != group[:-1]])
        fresh = new_group | np.concatenate([[True], word[1:] != word[:-1]])
        del word
        # Ranks count places, so that groups split without moving others.
        rank[items] = group + _heads(fresh, kind) - _heads(new_group, kind)
        sizes = np.diff(np.append(np.flatnonzero(fresh), len(items)))
        tied = np.repeat(sizes > 1, sizes)
        at += 8
        open_ = items[tied & (ends[items] - lms[items] > at)]
    used, names = np.unique(rank, return_inverse=True)
    return names, len(used)


def _heads(first: np.ndarray, kind: type) -> np.ndarray:
    """For each place the last one up to it that is a ``first``."""
    places = np.where(first, np.arange(len(first), dtype=kind), kind(0))
    return np.maximum.accumulate(places, out=places)


def _names_of_numbers(text, lms) -> tuple[np.ndarray, int]:
    """The same for a string of numbers, at deeper levels of the recursion."""
    ends = np.append(lms[1:], len(text) - 1) + 1
    top = int(text.max()) + 1
    rank = np.zeros(len(lms), np.int64)
    for at in range(int((ends - lms).max(initial=0))):
        inside = lms + at < ends
        value = np.where(inside, text[np.minimum(lms + at, len(text) - 1)], top)
        pairs = np.stack([rank, value], 1)
        rank = np.unique(pairs, axis=0, return_inverse=True)[1].ravel()
        if rank.max(initial=0) == len(lms) - 1:
            break
    used, names = np.unique(rank, return_inverse=True)
    return names, len(used)


def _doubled(names: np.ndarray, depth: int) -> np.ndarray:
    """The order of a string's suffixes by doubling; those told apart drop out."""
    n, kind = len(names), _kind(len(names) + 1)
    counts = np.bincount(names).astype(kind)
    starts = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(kind)
    rank = starts[names] + kind(1)
    open_ = np.flatnonzero(counts[names] > 1).astype(kind)
    del counts, starts
    width = 1
    # Each name stands for two characters at least.
    while len(open_) and 2 * width < depth + 2:
        after = open_ + width
        second = np.where(after < n, rank[np.minimum(after, n - 1)], kind(0))
        # Both ranks as one number; what is still equal may come in any order.
        order = np.argsort(rank[open_].astype(np.int64) * (n + 1) + second)
        items, low = open_[order], second[order]
        del after, second, order
        high = rank[items]
        new_group = np.concatenate([[True], high[1:] != high[:-1]])
        fresh = new_group | np.concatenate([[True], low[1:] != low[:-1]])
        del low
        rank[items] = high + _heads(fresh, kind) - _heads(new_group, kind)
        sizes = np.diff(np.append(np.flatnonzero(fresh), len(items)))
        open_ = items[np.repeat(sizes > 1, sizes)]
        width *= 2
    return np.argsort(rank, kind="stable")


def _recursive(names: np.ndarray, depth: int, limit: int, in_memory: int) -> np.ndarray:
    """The order of a string of names by another level of induced sorting."""
    text = np.append(names + 1, 0).astype(np.int64)
    order = np.concatenate([p for p, _ in _sorted(text, depth, limit, in_memory, False)][::-1])
    return order[order < len(names)]


def _common(text: np.ndarray, ordered: np.ndarray, depth: int) -> np.ndarray:
    """What each suffix shares with the one before it, at most ``depth``."""
    n = len(ordered)
    shared = np.zeros(n, np.uint8)
    open_ = np.arange(1, n, dtype=_kind(n))
    at, eights = 0, _eights(text)
    while len(open_) and at < depth:
        left = []
        for low in range(0, len(open_), AT_ONCE):
            part = open_[low : low + AT_ONCE]
            a, b = ordered[part - 1] + at, ordered[part] + at
            end = np.full(len(part), len(text))
            differ = _words(eights, a, end) ^ _words(eights, b, end)
            same = differ == 0
            # Leading zero bytes of the difference are equal characters.
            rest = part[~same]
            lead = 7 - (np.frexp(differ[~same].astype(np.longdouble))[1] - 1) // 8
            shared[rest] = np.minimum(at + lead, depth)
            left.append(part[same])
        open_ = np.concatenate(left)
        at += 8
        shared[open_] = min(at, depth)
    return shared
