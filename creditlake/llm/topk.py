"""Exact top-k search by inner product, in tiles.

The table is dealt into shards of even size. Each task takes one shard after
the other into memory, streams the queries past it in blocks, multiplies block
and tile as matrices, and keeps the best of each query by partial selection.
Lists of tiles are merged within the shard, and those of shards in a tree,
``FAN_IN`` at a time. A task holds one shard, one block and the product of a
block and a tile, whatever the size of the table, and no task meets all lists
of a query at once.

Components are floored after scaling, as whole numbers. Products are exact: in
floating point while their bound is below 2**53, in integers beyond. A score
beyond 64 bits is set to the nearest 64-bit number.

Vectors that are missing or hold a missing or non-finite component, and rows
without id, take no part. Vectors meet only vectors of their own length;
empty vectors score 0. Repeated ids are candidates of their own; a query's own
id is never its candidate. A repeated query id is one query for each different
vector. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from creditlake.staging import stage

TILE = 4_096
BLOCK = 512
SHARD_BYTES = 64 << 20
FAN_IN = 8
SCALE = 1024

_LIST = "query_no bigint, query_id bigint, vec_id bigint, score bigint, node bigint"
_FIELDS = [f.split()[0] for f in _LIST.split(", ")]


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, scale: int = SCALE) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the ``k`` best of ``vectors`` (``vec_id``, ``embedding``).

    Ties go to the smaller ``vec_id``. ``is_query`` chooses the queries by ``vec_id``.
    """
    spark = vectors.sparkSession
    fine = F.forall("vector", lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False)))
    rows = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector")
    )
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & fine)
    rows = stage(rows.withColumn("place", F.monotonically_increasing_id()))
    n, size = rows.agg(F.count("*"), F.max(F.size("vector"))).first()
    least = -(-n * max(size or 0, 1) * 8 // SHARD_BYTES)
    shards = max(1, least, min(spark.sparkContext.defaultParallelism, -(-n // TILE)))

    asked = rows.filter(is_query).select("vec_id", "vector").distinct()
    asked = stage(asked.withColumn("query_no", F.monotonically_increasing_id()))
    # The stated query set meets every shard; the shards are dealt out evenly by row, not by value.
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(shards - 1).cast("bigint")))
    queries = asked.select(every.alias("shard"), F.lit(1).alias("kind"), "query_no", "vec_id", "vector")
    place = F.pmod(F.col("place") + F.shiftright("place", 33), F.lit(shards).cast("bigint"))
    stored = rows.select(
        place.alias("shard"), F.lit(0).alias("kind"), F.lit(None).cast("bigint").alias("query_no"), "vec_id", "vector"
    )
    dealt = stored.union(queries).repartition(shards, "shard").sortWithinPartitions("shard", "kind")
    lists = stage(dealt.mapInArrow(_multiply(k, scale), _LIST))

    while shards > 1:
        shards = -(-shards // FAN_IN)
        above = lists.withColumn("node", F.floor(F.col("node") / FAN_IN))
        lists = stage(_best(above, ["query_no", "node"], k).drop("rank"))
    return _best(lists, ["query_no"], k).select("query_id", "rank", "vec_id", "score")


def _best(lists: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
    return lists.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


class _Shard:
    """The vectors of a shard by their length, each length in tiles."""

    def __init__(self, number: int):
        self.number = number
        self.open: dict[int, list[tuple[int, np.ndarray]]] = {}
        self.tiles: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

    def add(self, vec_id: int, vector: np.ndarray) -> None:
        rows = self.open.setdefault(len(vector), [])
        rows.append((vec_id, vector))
        if len(rows) == TILE:
            self._close(len(vector))

    def finish(self) -> None:
        for size in list(self.open):
            self._close(size)

    def _close(self, size: int) -> None:
        rows = self.open.pop(size)
        ids = np.array([r[0] for r in rows], np.int64)
        self.tiles.setdefault(size, []).append((ids, np.array([r[1] for r in rows], float).reshape(len(rows), size)))

    def search(self, block: list[tuple[int, int, np.ndarray]], k: int) -> Iterator[pa.RecordBatch]:
        for size in sorted({len(q[2]) for q in block}):
            asked = [q for q in block if len(q[2]) == size]
            numbers = np.array([q[0] for q in asked], np.int64)
            own = np.array([q[1] for q in asked], np.int64)
            queries = np.array([q[2] for q in asked], float).reshape(len(asked), size)
            lists = [select(queries, own, ids, vectors, k) for ids, vectors in self.tiles.get(size, [])]
            if not lists:
                continue
            at, ids, scores = best(*(np.concatenate(c) for c in zip(*lists)), k)
            columns = [numbers[at], own[at], ids, scores, np.full(len(at), self.number)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], _FIELDS)


def select(queries, own, ids, vectors, k):
    """The ``k`` best of a tile for each query: positions of queries, ids and scores."""
    bound = np.abs(queries).max(initial=0) * np.abs(vectors).max(initial=0) * queries.shape[1]
    if bound < 2**53:
        scores = queries @ vectors.T
    else:
        whole = [[int(x) for x in row] for row in vectors]
        exact = [[sum(int(a) * b for a, b in zip(q, v)) for v in whole] for q in queries]
        low, high = -(2**63), 2**63 - 1
        scores = np.array([[min(max(x, low), high) for x in row] for row in exact], np.int64).reshape(len(own), len(ids))
    other = own[:, None] != ids[None, :]
    if len(ids) > k + 1:
        # The own vector may be among the best, so one more is looked at.
        least = np.partition(scores, len(ids) - k - 1, axis=1)[:, len(ids) - k - 1]
        other &= scores >= least[:, None]
        # Equal ids beside the query's own may leave too few; then all are kept.
        few = other.sum(1) < k
        if few.any():
            other[few] = own[few][:, None] != ids[None, :]
    at, column = np.nonzero(other)
    return best(at, ids[column], scores[at, column].astype(np.int64), k)


def best(at, ids, scores, k):
    """The first ``k`` of each query in the order of score, then id."""
    # Complement instead of minus: it exists for the least 64-bit number too.
    order = np.lexsort((ids, ~scores, at))
    at, ids, scores = at[order], ids[order], scores[order]
    heads = np.searchsorted(at, at, side="left")
    keep = np.arange(len(at)) - heads < k
    return at[keep], ids[keep], scores[keep]


def _multiply(k: int, scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, block = None, []
        for batch in batches:
            numbers, kinds, asked, ids = (batch.column(i).to_pylist() for i in range(4))
            vectors = batch.column(4)
            offsets = vectors.offsets.to_numpy()
            values = np.floor(vectors.values.to_numpy() * scale)
            for i, (number, kind, query, vec_id) in enumerate(zip(numbers, kinds, asked, ids)):
                vector = values[offsets[i] : offsets[i + 1]]
                if shard is None or shard.number != number:
                    if block:
                        yield from shard.search(block, k)
                    shard, block = _Shard(number), []
                if kind == 0:
                    shard.add(vec_id, vector)
                    continue
                shard.finish()
                block.append((query, vec_id, vector))
                if len(block) == BLOCK:
                    yield from shard.search(block, k)
                    block = []
        if block:
            yield from shard.search(block, k)

    return run
