"""Best-fit packing by repeated patterns.

Documents become pieces of at most ``capacity`` tokens. How many pieces have
each length is all that the packing looks at, so its size depends on the
capacity and not on the corpus:

1. patterns of two to four pieces that fill a sequence exactly, or nearly
   (a share of ``WASTE`` may stay free), are enumerated from the lengths that occur;
2. non-negative least squares finds how often to repeat each pattern so that
   the histogram of lengths comes out; the counts are rounded to what is left;
3. what remains is packed best fit decreasing, all pieces of one length at a
   time, into the free space of the chosen patterns as well as into new sequences.

The plan with the fewest sequences is taken, of one for each share of waste. Best
fit decreasing alone takes its place only where it needs fewer.

The result is a table of slots: for each length, which ranks go to which
sequences and where. Pieces get their rank among those of their length from
counts per task, and find their slot by that rank.

Missing texts are empty documents (the end id alone). Rows without ``doc_id``
are packed like others. Repeated rows are packed each. An empty table gives no
rows. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from creditlake.llm.common import SLICE
from creditlake.llm.encoding import encoder
from creditlake.llm.window_packing import fit as least_squares
from creditlake.llm.window_packing import rounded
from creditlake.staging import stage

CAPACITY = 2048
# Patterns tried.
PATTERNS_PER_LENGTH = 24
# Shares of a sequence that patterns of the fit may leave free, each tried. Few
# lengths may have none but wasteful ones.
WASTE = (0.0, 1 / 64, 1.0)

_PIECE = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, task int, rank bigint"


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of every document with their task and their rank among its pieces of that length.

    Only documents longer than ``capacity`` are cut; their first piece takes
    the remainder, so that the others are full.
    """
    end = end_id.to_bytes(4, "little")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task = encoder(tokenizer).encode, TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for begin in range(0, batch.num_rows, SLICE):
                made = []
                part = batch.slice(begin, SLICE)
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    ids = encode(text) + end
                    for piece, (a, b) in enumerate(cuts(len(ids) // 4, capacity)):
                        made.append((doc, piece, a, b - a, zlib.crc32(ids[4 * a : 4 * b]), task, int(seen[b - a])))
                        seen[b - a] += 1
                if made:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made), _TYPES)], _NAMES)

    return rows.mapInArrow(run, _PIECE)


_NAMES = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "rank"]
_TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """Where a document of ``n`` tokens is cut: the remainder first, then full pieces."""
    first = n % capacity or capacity
    edges = [0, *range(min(first, n), n + 1, capacity)]
    return list(zip(edges, edges[1:]))


def pack(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """Every piece with the sequence it goes to and its offset there."""
    staged = stage(pieces(docs, tokenizer, end_id, capacity))
    counts = staged.groupBy("length", "task").agg(F.count("*").alias("n"))
    # At most one line for each length up to the capacity.
    histogram = np.zeros(capacity + 1, np.int64)
    for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():
        histogram[row["length"]] = row["n"]
    slots = plan(histogram, capacity)

    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    placed = staged.join(base, ["length", "task"]).withColumn("rank", F.col("rank") + F.col("before"))
    return _placed(placed, slots)


def _placed(ranked: DataFrame, slots: list[tuple[int, int, int, int, int]]) -> DataFrame:
    """Look ranks up in the slots, whose number is bounded by the capacity."""
    table: dict[int, tuple] = {}
    for length in {s[0] for s in slots}:
        rows = sorted(s[1:] for s in slots if s[0] == length)
        table[length] = tuple(np.array(c, np.int64) for c in zip(*rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            sequence, offset = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
            for n in np.unique(length):
                at = np.flatnonzero(length == n)
                first, _, start, place = table[int(n)]
                k = np.searchsorted(first, rank[at], side="right") - 1
                sequence[at] = start[k] + rank[at] - first[k]
                offset[at] = place[k]
            columns = [batch.column(c) for c in _NAMES[:5]] + [pa.array(sequence), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(columns, [*_NAMES[:5], "sequence_id", "offset"])

    schema = (
        "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, "
        "sequence_id bigint, offset bigint"
    )
    return ranked.select(*_NAMES[:5], "rank").mapInArrow(run, schema)


def plan(histogram: np.ndarray, capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Slots ``(length, first rank, ranks, first sequence, offset)`` for all pieces.

    Rank ``first + i`` of a length goes to sequence ``first sequence + i``.
    """
    left = histogram.copy()
    slots: list[tuple[int, int, int, int, int]] = []
    used = np.zeros(capacity + 1, np.int64)
    sequences = 0

    def put(pattern: tuple[int, ...], times: int) -> None:
        nonlocal sequences
        offset = 0
        for length in pattern:
            slots.append((length, int(used[length]), times, sequences, offset))
            used[length] += times
            left[length] -= times
            offset += length
        sequences += times

    if left[capacity]:
        put((capacity,), int(left[capacity]))
    plans = []
    found = patterns(left, capacity)
    least = -(-int((left * np.arange(capacity + 1)).sum()) // capacity)
    for waste in WASTE:
        full = [p for p in found if sum(p) >= capacity * (1 - waste)]
        rest, chosen = left.copy(), []
        for pattern, times in zip(full, fit(full, left, capacity)):
            lengths, each = np.unique(pattern, return_counts=True)
            times = min(int(times), int((rest[lengths] // each).min()))
            if times > 0:
                rest[lengths] -= each * times
                chosen.append((pattern, times))
        plans.append(residual(rest, capacity, chosen))
        if sum(times for _, times in plans[-1]) == least:
            break
    else:
        plans.append(residual(left, capacity))
    for pattern, times in min(plans, key=lambda made: sum(times for _, times in made)):
        put(pattern, times)
    return slots


def patterns(histogram: np.ndarray, capacity: int) -> list[tuple[int, ...]]:
    """Patterns of two to four pieces that fill a sequence, the fullest and most plentiful first.

    For each length: pairs and triples with plentiful partners whose sum is the
    capacity, or the nearest below it.
    """
    lengths = np.flatnonzero(histogram[:capacity])
    if not len(lengths):
        return []
    present = histogram > 0
    # The nearest length that occurs at or below each number.
    nearest = np.maximum.accumulate(np.where(present, np.arange(capacity + 1), 0))
    plentiful = lengths[np.argsort(-histogram[lengths], kind="stable")][:PATTERNS_PER_LENGTH]
    found: set[tuple[int, ...]] = set()
    for a in lengths[::-1]:
        rest = capacity - a
        b = nearest[rest]
        if b:
            found.add(tuple(sorted((int(a), int(b)), reverse=True)))
        for b in plentiful[plentiful < rest]:
            c = nearest[rest - b]
            if c:
                found.add(tuple(sorted((int(a), int(b), int(c)), reverse=True)))
                d = nearest[rest - b - c]
                if d:
                    found.add(tuple(sorted((int(a), int(b), int(c), int(d)), reverse=True)))
    return sorted(found, key=lambda p: (sum(p), p[0]), reverse=True)


def fit(found: list[tuple[int, ...]], histogram: np.ndarray, capacity: int) -> np.ndarray:
    """How often to repeat each pattern: non-negative least squares on the histogram, in whole numbers.

    The fit is that of :mod:`~creditlake.llm.window_packing`; running sums are rounded, so that the many
    small counts of a wide histogram add up to as many sequences as they should.
    """
    rows = np.zeros((len(found), max(map(len, found), default=1)), np.int64)
    for k, pattern in enumerate(found):
        rows[k, : len(pattern)] = pattern
    return rounded(least_squares(rows, histogram)) if found else np.zeros(0, np.int64)


def residual(
    histogram: np.ndarray, capacity: int, chosen: list[tuple[tuple[int, ...], int]] | tuple = ()
) -> list[tuple[tuple[int, ...], int]]:
    """Best fit decreasing over what is left, all pieces of a length at once.

    ``room`` holds, for each amount of free space, the open patterns with that
    space and how many sequences have each; at first those ``chosen`` before,
    which are part of the result.
    """
    room: dict[int, list[list]] = {}
    free = np.zeros(capacity + 1, bool)
    for pattern, times in chosen:
        room.setdefault(capacity - sum(pattern), []).append([pattern, times])
        free[capacity - sum(pattern)] = True
    for length in np.flatnonzero(histogram)[::-1]:
        length, n = int(length), int(histogram[length])
        while n > 0:
            fits = np.flatnonzero(free[length:])
            if len(fits):
                space = length + int(fits[0])
                pattern, times = room[space].pop()
                if not room[space]:
                    free[space] = False
            else:
                space, pattern, times = capacity, (), -(-n // (capacity // length))
            each = min(space // length, n)
            whole = min(times, n // each)
            if whole < times:
                if pattern:
                    room.setdefault(space, []).append([pattern, times - whole])
                    free[space] = True
            grown = pattern + (length,) * each
            room.setdefault(space - length * each, []).append([grown, whole])
            free[space - length * each] = True
            n -= whole * each
    return [(tuple(p), t) for group in room.values() for p, t in group]
