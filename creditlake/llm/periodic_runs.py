"""Periodic runs of words: stretches that repeat one period several times over.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q``
apart are equal) and at least ``exponent`` periods and ``least`` words long that
cannot be extended to either side. Each document is looked at on its own:

1. Every window of ``least // exponent`` words inside a run occurs twice or more in
   the document, one period apart. So runs lie in stretches of such windows, and
   all other words are left out by comparing hashes of windows (a collision lets
   a word too many through, never one too few).
2. Of each stretch and of its reversal a suffix tree is built, whose common
   ancestors tell in constant time how far two places agree to the right and to
   the left (:mod:`~creditlake.llm.suffix_tree`).
3. Every run has a Lyndon word as its root, under the order of the words or under
   its reverse, that is the longest one from where it begins: it ends at the
   next suffix that is smaller. These words, at most two for each place, are the
   candidates. Extended both ways, they give all runs and their periods.

Missing and empty texts, and texts of white space, have no words and no runs.
Very long texts are looked at whole, in linear time but for sorting; a task
holds the trees of one stretch. Of equal runs there is one; runs are sorted by
start, then period. Rows without ``doc_id`` and repeated rows are answered one by
one. An empty table gives no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditlake.llm.common import map_slices
from creditlake.llm.suffix_tree import SuffixTree

LEAST = 24
EXPONENT = 3

_RUNS = "doc_id bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"


def split(doc_id: int | None, text: str | None) -> list[bytes]:
    """The words of a text: bytes are split at the six ASCII white-space characters only."""
    return (text or "").encode().split()


def periodic_runs(
    docs: DataFrame,
    least: int = LEAST,
    exponent: int = EXPONENT,
    words: Callable[[int | None, str | None], list[bytes]] = split,
) -> DataFrame:
    """``doc_id``, ``runs`` and ``collapsed`` for every row of ``docs`` (``doc_id``, ``text``).

    ``collapsed`` has the words, one space between them, without those that some
    run contains after its first period. Words are numbered from 0 and are what
    ``words`` makes of id and text. ``exponent`` is 3 or more.
    """
    if exponent < 3:
        raise ValueError("runs of fewer than three periods are not looked for")

    def run(columns: dict[str, list]) -> Iterator[dict]:
        for doc, text in zip(columns["doc_id"], columns["text"]):
            kept = words(doc, text)
            found = document_runs(kept, least, exponent)
            if found:
                edges = np.zeros(len(kept) + 1, np.int64)
                for start, length, period in found:
                    edges[start + period] += 1
                    edges[start + length] -= 1
                kept = [w for w, covered in zip(kept, edges.cumsum().tolist()) if not covered]
            runs = [{"start": s, "length": n, "period": q} for s, n, q in found]
            yield {"doc_id": doc, "runs": runs, "collapsed": b" ".join(kept).decode()}

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return map_slices(rows, run, _RUNS)


def document_runs(words: list[bytes], least: int = LEAST, exponent: int = EXPONENT) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of all runs of a document, by start, then period."""
    if len(words) < least:
        return []
    numbers: dict[bytes, int] = {}
    number = numbers.setdefault
    ids = np.array([number(w, len(numbers)) for w in words], np.int64)
    found: list[tuple[int, int, int]] = []
    for begin, end in stretches(ids, max(1, least // exponent), least):
        made = sequence_runs(ids[begin:end], least, exponent)
        found += [(s + begin, n, q) for s, n, q in made]
    return sorted(found, key=lambda r: (r[0], r[2]))


def stretches(ids: np.ndarray, window: int, least: int) -> Iterator[tuple[int, int]]:
    """Where words begin and end that only windows occurring twice or more cover, ``least`` words at least."""
    # Numbers are mixed before they are added up, since they are small and dense.
    mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    size = len(ids) - window + 1
    hashes = np.zeros(size, np.uint64)
    for k in range(window):
        hashes = hashes * np.uint64(0x100000001B3) + mixed[k : k + size]
    ordered = np.sort(hashes)
    repeated = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(repeated):
        return
    place = np.minimum(np.searchsorted(repeated, hashes), len(repeated) - 1)
    edges = np.flatnonzero(np.diff(repeated[place] == hashes, prepend=False, append=False))
    for begin, end in edges.reshape(-1, 2).tolist():
        if end - begin + window - 1 >= least:
            yield begin, end + window - 1


def sequence_runs(ids: np.ndarray, least: int = LEAST, exponent: int = EXPONENT) -> list[tuple[int, int, int]]:
    """All runs of a sequence of numbers, by the suffix trees of it and of its reversal."""
    n = len(ids)
    known, numbers = np.unique(ids, return_inverse=True)
    numbers = numbers + 1
    right = SuffixTree(numbers.tolist(), len(known))
    left = SuffixTree(numbers[::-1].tolist(), len(known))

    starts, ends = [], []
    for rank in (right.rank, right.falling_ranks()):
        following = next_smaller(rank)
        at = np.flatnonzero((following - np.arange(n)) * exponent <= n)
        starts.append(at)
        ends.append(following[at])
    start, end = np.concatenate(starts), np.concatenate(ends)
    period = end - start

    forward, backward = np.zeros(len(start), np.int64), np.zeros(len(start), np.int64)
    inside = np.flatnonzero(end < n)
    forward[inside] = right.agree(start[inside], end[inside])
    inside = np.flatnonzero(start > 0)
    backward[inside] = left.agree(n - start[inside], n - end[inside])
    start, length = start - backward, end + forward - start + backward
    long = np.flatnonzero((length >= least) & (length >= exponent * period))
    made = np.unique(np.stack([start[long], period[long], length[long]], axis=1), axis=0)
    return [(s, n, q) for s, q, n in made.tolist()]


def next_smaller(rank: np.ndarray) -> np.ndarray:
    """For each suffix but the empty one, the next place whose suffix is smaller; the longest Lyndon word ends there."""
    ranks = rank.tolist()
    n = len(ranks) - 1
    following, stack = [n] * n, [n]
    for i in range(n - 1, -1, -1):
        own = ranks[i]
        while ranks[stack[-1]] > own:
            stack.pop()
        following[i] = stack[-1]
        stack.append(i)
    return np.array(following, np.int64)
