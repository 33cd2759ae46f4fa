"""Packing by length combinations that fill a window, fitted by non-negative least squares.

A document gives up whole windows of ``window`` tokens from its start; what is
left is one piece shorter than a window. How many pieces have each length is
all that the planning looks at, so its size depends on the window and not on
the corpus. A few times over:

1. combinations of two to ``DEPTH`` lengths that fill a window exactly are
   enumerated from the lengths that occur;
2. non-negative least squares finds how often to repeat each combination so that
   the histogram comes out;
3. the counts are rounded to whole numbers, at most to what is left.

The pieces that remain are packed greedily: laid end to end, longest first, and
cut where a window ends. What is too short for the last window goes to windows
of descending powers of two, which need no padding either. So nothing is
padded, and only remaining pieces are cut.

The plan is a table of slots: for each length, which ranks go to which
sequences and where. Pieces get their rank among those of their length from
counts per task. The first ranks of a length are those that remain: they are in
the first tasks, so few ids are read again to cut them.

Missing texts are empty documents (the end id alone). Very long texts are
encoded whole and give one row a window. Rows without ``doc_id`` are packed like
others. Repeated rows are packed each; equal lengths are told apart by their rank
alone. An empty table gives no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from creditlake.llm.common import SLICE
from creditlake.llm.encoding import encoder
from creditlake.staging import stage

WINDOW = 2048
# Lengths of a combination at most, combinations tried for each length and depth,
# steps of the fit, and how often the rest is fitted again.
DEPTH = 4
TRIED = 12
STEPS = 150
ROUNDS = 4

_PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, task int, rank bigint, ids binary"
)
_PLACED = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
_NAMES = [f.split()[0] for f in _PIECES.split(", ")]
_TYPES = [pa.int64()] * 5 + [pa.int32(), pa.int64(), pa.binary()]


def pack(docs: DataFrame, tokenizer: str, end_id: int, window: int = WINDOW) -> DataFrame:
    """Every piece of every document (``doc_id``, ``text``) with its sequence and its offset there.

    ``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``.
    ``end_id`` ends each document. A sequence holds ``window`` tokens or a power of two.
    """
    staged = stage(pieces(docs, tokenizer, end_id, window))
    counts = staged.groupBy("length", "task").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    counts = stage(counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))))
    # At most one line for each length up to the window, here and below.
    histogram = np.zeros(window + 1, np.int64)
    for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():
        histogram[row["length"]] = row["n"]
    made = plan(histogram, window)

    rest = _looked_up(made.rest, "length")
    tasks = np.full(window + 1, -1, np.int64)
    for row in counts.filter(F.col("before") < rest).groupBy("length").agg(F.max("task").alias("task")).collect():
        tasks[row["length"]] = row["task"]
    needed = F.when(F.col("task") <= _looked_up(tasks, "length"), F.col("ids")).alias("ids")
    ranked = staged.select(*_NAMES[:-1], needed).join(counts.select("length", "task", "before"), ["length", "task"])
    ranked = ranked.withColumn("rank", F.col("rank") + F.col("before"))
    return ranked.select(*_NAMES).mapInArrow(_place(made), _PLACED)


def _looked_up(numbers: np.ndarray, column: str):
    """The number at each value of ``column``: one folded array literal, not a join."""
    return F.get(F.split(F.lit(",".join(map(str, numbers.tolist()))), ",").cast("array<bigint>"), F.col(column).cast("int"))


def pieces(docs: DataFrame, tokenizer: str, end_id: int, window: int = WINDOW) -> DataFrame:
    """Whole windows and the remainder of every document, with task, rank among its pieces of that length, and ids.

    Ids (little-endian unsigned 32-bit) are kept of remainders only.
    """
    end = end_id.to_bytes(4, "little")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task = encoder(tokenizer).encode, TaskContext.get().partitionId()
        seen = [0] * (window + 1)
        for batch in batches:
            for begin in range(0, batch.num_rows, SLICE):
                made = []
                part = batch.slice(begin, SLICE)
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    ids = encode(text) + end
                    tokens = len(ids) // 4
                    whole = tokens - tokens % window
                    for a in range(0, whole, window):
                        made.append((doc, a, window, zlib.crc32(ids[4 * a : 4 * (a + window)]), tokens, task, seen[window], None))
                        seen[window] += 1
                    if whole < tokens:
                        left, n = ids[4 * whole :], tokens - whole
                        made.append((doc, whole, n, zlib.crc32(left), tokens, task, seen[n], left))
                        seen[n] += 1
                if made:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made), _TYPES)], _NAMES)

    return rows.mapInArrow(run, _PIECES)


@dataclass
class Plan:
    """Where the pieces of each length go.

    Full windows have the sequences from 0. ``rest`` counts the pieces of each
    length that are laid end to end from place ``begin`` of that length on, in
    sequences from ``first_rest`` on; ``tail`` has the edges of the last, shorter
    windows. All later ranks are in ``slots``: ``(first rank, first sequence, offset)`` by length.
    """

    window: int
    rest: np.ndarray
    begin: np.ndarray
    first_rest: int
    tail: np.ndarray
    slots: dict[int, tuple[np.ndarray, ...]]
    combinations: list[tuple[tuple[int, ...], int]]

    def span(self, place: int) -> tuple[int, int, int]:
        """Number, begin and end of the window that holds ``place`` of the rest."""
        if place < self.tail[0]:
            number = place // self.window
            return number, number * self.window, (number + 1) * self.window
        k = int(np.searchsorted(self.tail, place, side="right")) - 1
        return int(self.tail[0]) // self.window + k, int(self.tail[k]), int(self.tail[k + 1])


def plan(histogram: np.ndarray, window: int) -> Plan:
    """The plan for ``histogram[n]`` pieces of each length up to ``window``."""
    left = histogram.copy()
    left[window] = 0
    chosen: list[tuple[tuple[int, ...], int]] = []
    for round_ in range(ROUNDS):
        found = combinations(left, window, round_)
        if not len(found):
            break
        placed = False
        for row, times in zip(found, rounded(fit(found, left))):
            lengths, each = np.unique(row[row > 0], return_counts=True)
            times = min(int(times), int((left[lengths] // each).min()))
            if times:
                left[lengths] -= each * times
                chosen.append((tuple(int(n) for n in row[row > 0]), times))
                placed = True
        if not placed:
            break

    used, sequences = left.copy(), int(histogram[window])
    slots: dict[int, list[tuple[int, int, int]]] = {}
    for lengths, times in chosen:
        offset = 0
        for n in lengths:
            slots.setdefault(n, []).append((int(used[n]), sequences, offset))
            used[n] += times
            offset += n
        sequences += times

    tokens = left * np.arange(window + 1)
    # Longest first: what is cut from the longest lies beside it.
    begin = tokens[::-1].cumsum()[::-1] - tokens
    total = int(tokens.sum())
    tail = [total - total % window]
    for bit in range(window.bit_length(), -1, -1):
        if total - tail[-1] >= 1 << bit:
            tail.append(tail[-1] + (1 << bit))
    return Plan(
        window, left, begin, sequences, np.array(tail, np.int64),
        {n: tuple(np.array(c, np.int64) for c in zip(*rows)) for n, rows in slots.items()}, chosen,
    )


def combinations(histogram: np.ndarray, window: int, shift: int = 0) -> np.ndarray:
    """Rows of two to ``DEPTH`` lengths, padded with zeros, whose sum is ``window``.

    For each length: its exact partner, and for each further depth ``TRIED``
    choices of the lengths between, spread evenly over the pieces (so frequent
    lengths are taken more often), with the partner that completes the sum if it
    occurs. ``shift`` moves the choices.
    """
    present = histogram > 0
    present[window:] = False
    lengths = np.flatnonzero(present)
    if not len(lengths):
        return np.zeros((0, DEPTH), np.int64)
    ends = histogram[lengths].cumsum()
    found = []
    for depth in range(2, DEPTH + 1):
        tried = TRIED if depth > 2 else 1
        rows = np.zeros((len(lengths), tried, DEPTH), np.int64)
        rows[:, :, 0] = lengths[:, None]
        number = np.arange(len(lengths) * tried).reshape(len(lengths), tried) + 1
        for k in range(1, depth - 1):
            # Multiples of an irrational number, another for each place, lie evenly in [0, 1).
            share = (number * (2 ** (k / (DEPTH + 1))) + shift * 0.37) % 1.0
            rows[:, :, k] = lengths[np.searchsorted(ends, share * ends[-1], side="right")]
        last = window - rows.sum(2)
        fits = (last > 0) & present[np.clip(last, 0, window)]
        rows[:, :, depth - 1] = last
        found.append(rows[fits])
    made = np.unique(-np.sort(-np.concatenate(found), axis=1), axis=0)
    # Long pieces first: they have the fewest partners.
    return made[::-1]


def fit(found: np.ndarray, histogram: np.ndarray) -> np.ndarray:
    """How often to repeat each combination: non-negative least squares on the histogram.

    Each step multiplies every count by the ratio of what its lengths have to what
    they are given. The ratios keep counts at or above zero, and the squared
    difference falls with every step.
    """
    target = histogram.astype(float)
    target[0] = 0.0
    used = found > 0
    counts = np.full(len(found), target.sum() / max(1, used.sum()))

    def gathered(numbers: np.ndarray) -> np.ndarray:
        return (numbers[found] * used).sum(1)

    wanted = gathered(target)
    for _ in range(STEPS):
        given = np.bincount(found[used], (counts[:, None] * used)[used], minlength=len(target))
        counts *= wanted / np.maximum(gathered(given), 1e-300)
    return counts


def rounded(counts: np.ndarray) -> np.ndarray:
    """Whole numbers whose running sums are those of ``counts`` rounded."""
    return np.diff(np.floor(counts.cumsum() + 0.5), prepend=0).astype(np.int64)


def _place(made: Plan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = rank.copy(), np.zeros(len(rank), np.int64)
            whole = length == made.window
            remains = ~whole & (rank < made.rest[length])
            for n in np.unique(length[~whole & ~remains]).tolist():
                at = np.flatnonzero(~remains & (length == n))
                first, begin, place = made.slots[n]
                k = np.searchsorted(first, rank[at], side="right") - 1
                sequence[at] = begin[k] + rank[at] - first[k]
                offset[at] = place[k]
            kept = np.flatnonzero(~remains)
            columns = [batch.column(c).take(pa.array(kept)) for c in _NAMES[:5]]
            columns += [pa.array(sequence[kept]), pa.array(offset[kept])]
            yield pa.RecordBatch.from_arrays(columns, [*_NAMES[:5], "sequence_id", "offset"])

            rest = batch.filter(pa.array(remains))
            for begin in range(0, rest.num_rows, SLICE):
                parts = [part for row in rest.slice(begin, SLICE).to_pylist() for part in _cut(made, row)]
                yield pa.RecordBatch.from_pylist(parts, _SCHEMA)

    return run


_SCHEMA = pa.schema([(c, pa.int64()) for c in [*_NAMES[:5], "sequence_id", "offset"]])


def _cut(made: Plan, row: dict) -> Iterator[dict]:
    """The parts of a remaining piece, one for each window that it touches."""
    place = int(made.begin[row["length"]]) + row["rank"] * row["length"]
    done = 0
    while done < row["length"]:
        number, begin, end = made.span(place + done)
        n = min(row["length"] - done, end - place - done)
        crc = row["ids_crc32"] if n == row["length"] else zlib.crc32(row["ids"][4 * done : 4 * (done + n)])
        yield {
            "doc_id": row["doc_id"], "start": row["start"] + done, "length": n, "ids_crc32": crc,
            "doc_tokens": row["doc_tokens"], "sequence_id": made.first_rest + number, "offset": place + done - begin,
        }
        done += n
