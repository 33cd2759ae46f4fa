"""Hard negatives: rows of another label that score within a window below an anchor's positives.

The table is dealt into shards of even size by row, and the anchors, a stated
set of rows, go to every shard in blocks. A task multiplies block by tile with
:func:`~creditlake.llm.strassen.multiply` and keeps heaps: lists of the best few,
in the order of score, then id. Heaps of the same anchor merge into one of
the same kind, so those of tiles merge within the shard and those of shards in a
tree, ``FAN_IN`` at a time. The first round fills one heap an anchor with its
positives; their scores set the windows, and the second round fills one heap
for each anchor and positive. Both sides are sorted by label within a shard, so
that a round skips products of tiles without a row that it could use. A task
holds one shard, one block and the product of a block and a tile, whatever the
size of the table or of a label.

Components are floored after scaling; scores are exact. A score beyond 64 bits
is set to the nearest 64-bit number.

Rows without id, label or vector, or with a missing or non-finite component,
take no part. Vectors meet only vectors of their own length; empty
vectors score 0. Rows with an anchor's id are never its positives or negatives;
other repeated rows each count. Equal anchor rows are one anchor. A positive
whose window is empty (a score below 0) has no rows. An empty table gives no
rows. Other columns are ignored, whatever their names. Of texts it reads none.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditlake.llm.strassen import multiply
from creditlake.staging import stage

TILE = 4_096
BLOCK = 512
SHARD_BYTES = 64 << 20
FAN_IN = 8
SCALE = 256

# A heap is sorted, and ``under`` is the complement of a score: it rises as the
# score falls, and unlike the negative it exists for every 64-bit number.
_HEAP = "array<struct<under:bigint,vec_id:bigint>>"
_LISTS = f"anchor_no bigint, positive int, node bigint, heap {_HEAP}"


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    label: Column | str = "label",
    positives: int = 5,
    negatives: int = 10,
    window: tuple[int, int] = (30, 90),
    scale: int = SCALE,
    tile: int = TILE,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """The hardest ``negatives`` for each anchor and each of its ``positives`` best rows of the same label.

    ``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``,
    ``negative_score`` of ``vectors`` (``vec_id``, ``embedding``). A negative's
    score is between the two percentages of the positive's in ``window``.
    """
    spark = vectors.sparkSession
    fine = F.forall("vector", lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False)))
    rows = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        (F.col(label) if isinstance(label, str) else label).cast("bigint").alias("label"),
        F.col("embedding").cast("array<double>").alias("vector"),
        is_anchor.alias("asked"),
    )
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & fine)
    rows = stage(rows.withColumn("place", F.monotonically_increasing_id()))
    n, size = rows.agg(F.count("*"), F.max(F.size("vector"))).first()
    least = -(-n * max(size or 0, 1) * 8 // shard_bytes)
    shards = max(1, least, min(spark.sparkContext.defaultParallelism, -(-n // tile)))

    anchors = rows.filter("asked").select("vec_id", "label", "vector").distinct()
    anchors = stage(anchors.withColumn("anchor_no", F.monotonically_increasing_id()))
    none = F.lit(None).cast(_HEAP)
    found = _search(rows, anchors.withColumn("windows", none), shards, _task(positives, None, scale, tile), positives)
    # The windows travel with the anchor: at most ``positives`` numbers a row.
    found = stage(found.select("anchor_no", F.col("heap").alias("windows")))
    asked = anchors.join(found, "anchor_no")
    lists = _search(rows, asked, shards, _task(negatives, window, scale, tile), negatives)

    named = asked.select("anchor_no", F.col("vec_id").alias("anchor_id"), F.posexplode("windows").alias("positive", "p"))
    named = lists.join(named, ["anchor_no", "positive"])
    named = named.select("anchor_id", "p", F.posexplode("heap").alias("at", "best"))
    return named.select(
        "anchor_id",
        F.col("p.vec_id").alias("positive_id"),
        (F.col("at") + 1).cast("int").alias("rank"),
        F.col("best.vec_id").alias("negative_id"),
        F.bitwise_not("p.under").alias("positive_score"),
        F.bitwise_not("best.under").alias("negative_score"),
    )


def _search(rows: DataFrame, anchors: DataFrame, shards: int, task: Callable, keep: int) -> DataFrame:
    """The merged heaps that ``task`` finds: one for each anchor, or for each anchor and positive."""
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(shards - 1).cast("bigint")))
    asked = anchors.select(every.alias("shard"), F.lit(1).alias("kind"), "label", "anchor_no", "vec_id", "vector", "windows")
    # By row, not by value: neither a frequent label nor a frequent vector meets in one shard.
    place = F.pmod(F.col("place") + F.shiftright("place", 33), F.lit(shards).cast("bigint"))
    stored = rows.select(
        place.alias("shard"), F.lit(0).alias("kind"), "label", F.lit(None).cast("bigint").alias("anchor_no"),
        "vec_id", "vector", F.lit(None).cast(_HEAP).alias("windows"),
    )
    dealt = stored.union(asked).repartition(shards, "shard").sortWithinPartitions("shard", "kind", "label")
    lists = stage(dealt.mapInArrow(task, _LISTS))
    while shards > 1:
        shards = -(-shards // FAN_IN)
        lists = stage(_merged(lists.withColumn("node", F.floor(F.col("node") / FAN_IN)), keep))
    return lists


def _merged(lists: DataFrame, keep: int) -> DataFrame:
    joined = F.slice(F.array_sort(F.flatten(F.collect_list("heap"))), 1, keep)
    return lists.groupBy("anchor_no", "positive", "node").agg(joined.alias("heap"))


@dataclass
class _Tile:
    ids: np.ndarray
    labels: np.ndarray
    values: np.ndarray


@dataclass
class _Side:
    """Rows of one vector length that are put together until they make a tile or block."""

    ids: list[int] = field(default_factory=list)
    labels: list[int] = field(default_factory=list)
    vectors: list[np.ndarray] = field(default_factory=list)
    numbers: list[int] = field(default_factory=list)
    windows: list[list[dict]] = field(default_factory=list)

    def tile(self, scale: int) -> _Tile:
        values = np.array(self.vectors, float).reshape(len(self.ids), len(self.vectors[0]))
        return _Tile(np.array(self.ids, np.int64), np.array(self.labels, np.int64), whole(values, scale))


def whole(values: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * x)``: 64-bit integers, or Python integers where these do not hold it."""
    if not values.size or np.abs(values).max() * scale < 2**62:
        return np.floor(values * scale).astype(np.int64)
    exact = np.empty(values.shape, object)
    exact.flat = [int(x) * scale if abs(x) >= 2**53 else math.floor(x * scale) for x in values.ravel().tolist()]
    return exact


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of ``a`` and ``b``, exact within 64 bits and set to the nearest beyond."""
    if a.dtype != object and b.dtype != object:
        largest = [int(m.max(initial=0)) for m in (np.abs(a), np.abs(b))]
        if largest[0] * largest[1] * max(a.shape[1], 1) < 2**63:
            return multiply(a, b.T)
    exact = multiply(a.astype(object), b.T.astype(object))
    low, high = -(2**63), 2**63 - 1
    return np.array([[min(max(int(x), low), high) for x in row] for row in exact], np.int64).reshape(exact.shape)


def heaps(at: np.ndarray, under: np.ndarray, ids: np.ndarray, keep: int) -> tuple[np.ndarray, ...]:
    """The first ``keep`` of each ``at`` by score, then id; the concatenation of two results merges the same way."""
    order = np.lexsort((ids, under, at))
    at, under, ids = at[order], under[order], ids[order]
    first = np.arange(len(at)) - np.searchsorted(at, at, side="left") < keep
    return at[first], under[first], ids[first]


def bounds(score: int, window: tuple[int, int]) -> tuple[int, int]:
    """The least and greatest whole score within the percentages of ``score``."""
    least, most = -(2**63), 2**63 - 1
    return min(max(-(-window[0] * score // 100), least), most), min(max(window[1] * score // 100, least), most)


def _task(keep: int, window: tuple[int, int] | None, scale: int, size_of_tile: int) -> Callable:
    def positives(block: _Side, tile: _Tile, own: _Tile) -> Iterator[tuple[np.ndarray, ...]]:
        rows = np.flatnonzero((own.labels >= tile.labels[0]) & (own.labels <= tile.labels[-1]))
        if not len(rows):
            return
        found = scores(own.values[rows], tile.values)
        fits = (own.labels[rows, None] == tile.labels) & (own.ids[rows, None] != tile.ids)
        yield from _best(rows, found, fits, tile.ids, keep)

    def negatives(block: _Side, tile: _Tile, own: _Tile) -> Iterator[tuple[np.ndarray, ...]]:
        rows = np.flatnonzero((own.labels != tile.labels[0]) | (own.labels != tile.labels[-1]))
        if not len(rows):
            return
        found = scores(own.values[rows], tile.values)
        other = (own.labels[rows, None] != tile.labels) & (own.ids[rows, None] != tile.ids)
        # One line for each positive of each anchor.
        lines = [(k, i, *bounds(~p["under"], window)) for k, r in enumerate(rows) for i, p in enumerate(block.windows[r])]
        for start in range(0, len(lines), BLOCK):
            at, place, low, high = (np.array(c, np.int64) for c in zip(*lines[start : start + BLOCK]))
            seen = found[at]
            fits = (seen >= low[:, None]) & (seen <= high[:, None]) & other[at]
            yield from _best(rows[at] * _PLACES + place, seen, fits, tile.ids, keep)

    offer = positives if window is None else negatives

    def search(shard: dict[int, list[_Tile]], block: _Side, size: int, number: int) -> pa.RecordBatch:
        own, kept = block.tile(scale), [np.zeros(0, np.int64)] * 3
        for tile in shard.get(size, []):
            for more in offer(block, tile, own):
                kept = heaps(*(np.concatenate(c) for c in zip(kept, more)), keep)
        at, under, ids = kept
        starts = np.flatnonzero(np.diff(at, prepend=-1))
        edges = [*starts.tolist(), len(at)]
        lines = at[starts]
        if window is None:
            rows, place = lines, np.full(len(lines), -1)
        else:
            rows, place = np.divmod(lines, _PLACES)
        entries = pa.StructArray.from_arrays([pa.array(under), pa.array(ids)], ["under", "vec_id"])
        columns = [
            pa.array(np.array(block.numbers, np.int64)[rows]), pa.array(place, pa.int32()),
            pa.array(np.full(len(lines), number, np.int64)), pa.ListArray.from_arrays(pa.array(edges, pa.int32()), entries),
        ]
        return pa.RecordBatch.from_arrays(columns, ["anchor_no", "positive", "node", "heap"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, shard, open_, blocks = None, {}, {}, {}

        def close(size: int) -> None:
            shard.setdefault(size, []).append(open_.pop(size).tile(scale))

        for batch in batches:
            numbers, kinds, labels, asked, ids = (batch.column(i).to_pylist() for i in range(5))
            vectors = batch.column(5)
            offsets, values = vectors.offsets.to_numpy(), vectors.values.to_numpy()
            for i, kind in enumerate(kinds):
                if numbers[i] != number:
                    yield from (search(shard, b, s, number) for s, b in blocks.items())
                    number, shard, open_, blocks = numbers[i], {}, {}, {}
                vector = values[offsets[i] : offsets[i + 1]]
                size = len(vector)
                side = (blocks if kind else open_).setdefault(size, _Side())
                side.ids.append(ids[i])
                side.labels.append(labels[i])
                side.vectors.append(vector)
                if not kind:
                    if len(side.ids) == size_of_tile:
                        close(size)
                    continue
                for left in list(open_):
                    close(left)
                side.numbers.append(asked[i])
                side.windows.append(batch.column(6)[i].as_py())
                if len(side.ids) == BLOCK:
                    yield search(shard, blocks.pop(size), size, number)
        yield from (search(shard, b, s, number) for s, b in blocks.items())

    return run


# More than the positives of an anchor: keeps (anchor, positive) in one number.
_PLACES = 1 << 20


def _best(lines: np.ndarray, found: np.ndarray, fits: np.ndarray, ids: np.ndarray, keep: int) -> Iterator[tuple]:
    """The heaps of one product: entries that fit, few of each line by partial selection first."""
    if found.shape[1] > 4 * keep:
        # An entry that does not fit counts as the least number; one that fits and is the least stays by the mask.
        masked = np.where(fits, found, np.iinfo(np.int64).min)
        least = np.partition(masked, -keep, axis=1)[:, -keep]
        fits = fits & (found >= least[:, None])
    at, column = np.nonzero(fits)
    yield heaps(lines[at], ~found[at, column], ids[column], keep)
