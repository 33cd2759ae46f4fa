"""Consecutive row numbers, dimensions, and the lookup of their keys.

Numbering does not move a large table through one task: the rows are sorted by
range across the cluster, staged, and every partition's numbers start where those
of the partitions before it end. A table whose rows come from an input of at most the session's
broadcast limit is sorted and numbered by one task while it is stored.

A lookup broadcasts a dimension only if its measured size is under the limit.
A larger one is joined by a shuffle that keeps frequent natural keys apart.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditlake.functions.columns import key_first
from creditlake.operators.sizes import estimated_size, session_limit
from creditlake.staging import stage

# A natural key is frequent if it holds more than this share of all rows, so
# there are at most 1 / HOT_SHARE of them: small enough to broadcast.
HOT_SHARE = 0.001

_PLACE = "__place"
_ROWS = "__rows"
_MATCH = "__match_"
_PLACE_BITS = 33
# Natural keys of more columns than this are looked up by two hashes, which are narrower.
_NARROW = 2


@dataclass(frozen=True)
class Dimension:
    """A stored table whose rows carry consecutive keys from 0.

    ``size`` is what a lookup needs of it, key and natural key, in bytes. ``frequent``
    has the rows that are frequent in the table it was counted from; None where no row can be,
    or where that table was so small that it does not matter.
    """

    frame: DataFrame
    key: str
    columns: tuple[str, ...]
    rows: int
    size: int
    frequent: DataFrame | None = None


# Writes a table and returns it read back.
Store = Callable[[DataFrame], DataFrame]


def create_dimension(
    df: DataFrame, columns: Sequence[str], key: str, store: Store = stage, small: int | None = None
) -> Dimension:
    """The distinct tuples of ``columns`` with a key first.

    The key is the position in the order of ``columns``, NULL first: the same
    rows get the same keys whatever the partitioning. ``store`` says where the
    table goes, by default to the staging folder. An input of at most ``small`` bytes by
    Spark's estimate (by default the session's broadcast limit) is numbered by one task.
    """
    if _is_small(df.select(*columns), small):
        return _numbered_at_once(df.select(*columns).distinct(), key, columns, columns, store)
    counted = df.groupBy(*columns).agg(F.count("*").alias(_ROWS))
    numbered = _number(counted, key, columns, columns, weight=F.col(_ROWS))
    frequent = numbered.frame.filter(F.col(_ROWS) > numbered.weight * HOT_SHARE)
    frame = numbered.frame.select(key, *columns)
    return Dimension(
        frame if store is stage else store(frame),
        key,
        tuple(columns),
        numbered.rows,
        numbered.size,
        frequent.select(key, *columns),
    )


def add_key(
    df: DataFrame,
    key: str,
    order_by: Sequence[str],
    natural_key: Sequence[str] | None = None,
    store: Store = stage,
    small: int | None = None,
) -> Dimension:
    """A key first for every row of ``df``, by position in the order of ``order_by``.

    ``order_by`` must be unique, or the order of equal rows is open. ``store`` and ``small`` are as in
    :func:`create_dimension`.
    """
    columns = tuple(natural_key or order_by)
    if _is_small(df, small):
        return _numbered_at_once(df, key, order_by, columns, store)
    numbered = _number(df, key, order_by, columns)
    frame = key_first(numbered.frame, [key])
    frame = frame if store is stage else store(frame)
    return Dimension(frame, key, columns, numbered.rows, numbered.size)


def _is_small(df: DataFrame, small: int | None) -> bool:
    return estimated_size(df) <= (session_limit(df) if small is None else small)


def _numbered_at_once(
    df: DataFrame, key: str, order_by: Sequence[str], columns: Sequence[str], store: Store
) -> Dimension:
    """``df`` sorted and numbered by the one task that writes it; its totals come with the write."""
    ordered = df.coalesce(1).sortWithinPartitions(*[F.asc_nulls_first(c) for c in order_by])
    numbered = ordered.select(F.monotonically_increasing_id().alias(key), *df.columns)
    totals = Observation()
    size = F.coalesce(F.sum(_row_size(df.select(*columns))), F.lit(0)).alias("size")
    frame = store(numbered.observe(totals, F.count("*").alias("rows"), size))
    found = totals.get
    return Dimension(frame, key, tuple(columns), found["rows"], found["size"])


def attach_key(
    df: DataFrame,
    dimension: Dimension,
    null_safe: bool = True,
    broadcast_limit: int | None = None,
    counted: bool = False,
) -> DataFrame:
    """``df`` with the dimension's key as a last column, NULL where none matches.

    With ``null_safe`` a missing value matches a missing value; without, it
    matches nothing. ``broadcast_limit`` in bytes defaults to the session's
    ``spark.sql.autoBroadcastJoinThreshold``. Frequent keys are searched for in
    ``df``; ``counted`` says that the dimension was counted from the same rows, so
    that its own are known, or that it has unique keys and so does ``df``. A shuffle carries two
    hashes in place of a natural key of more than two columns.
    """
    columns, key = dimension.columns, dimension.key
    limit = session_limit(df) if broadcast_limit is None else broadcast_limit
    if dimension.size <= limit:
        return _lookup(df, F.broadcast(dimension.frame), columns, key, null_safe)

    frequent = dimension.frequent if counted else _frequent_tuples(df, dimension)
    by_hash = len(columns) > _NARROW and _same_types(df, dimension)
    if frequent is None and not by_hash:
        return _lookup(df, dimension.frame, columns, key, null_safe)
    pair = [f"{_MATCH}h1", f"{_MATCH}h2"]
    missing = reduce(Column.__or__, [F.col(c).isNull() for c in columns])
    marked = df.withColumns({n: F.when(F.lit(null_safe) | ~missing, h) for n, h in zip(pair, _hashes(columns, pair))})
    if frequent is None:
        return marked.join(_hashed(dimension, pair), pair, "left").select(*df.columns, key)
    # Frequent tuples travel as two hashes and a key, so they have a bound in
    # bytes too, however long the values are.
    hot = f"{_MATCH}hot"
    hashed = frequent.select(F.col(key).alias(hot), *_hashes(columns, pair))
    idle = F.col(hot).isNotNull()
    marked = marked.join(F.broadcast(hashed), pair, "left")
    # Rows that are answered already, or that can match nothing, are spread over
    # all tasks by the task they come from instead of by their key: equal rows of
    # different tasks part, and a repeated task sends them the same way.
    if not null_safe:
        idle = idle | missing
    spread = f"{_MATCH}spread"
    apart = F.when(idle, F.xxhash64(F.spark_partition_id() + 1)).otherwise(F.lit(0))
    marked = marked.withColumn(spread, apart)
    # Zero in every row, but not a literal: the planner would not shuffle by one.
    zero = F.col(key).bitwiseAND(F.lit(0).cast("bigint"))
    if by_hash:
        # Rows that can match nothing have no hashes.
        found = F.when(F.col(hot).isNotNull(), F.col(hot)).otherwise(F.col(key)).alias(key)
        cold = _hashed(dimension, pair).withColumn(spread, zero)
        return marked.join(cold, [*pair, spread], "left").select(*df.columns, found)
    joined = _lookup(marked.drop(*pair), dimension.frame.withColumn(spread, zero), [*columns, spread], key, null_safe)
    found = F.when(idle, F.col(hot)).otherwise(F.col(key)).alias(key)
    return joined.select(*df.columns, found)


def _hashed(dimension: Dimension, pair: Sequence[str]) -> DataFrame:
    """The keys of a dimension by two hashes of the natural key."""
    return dimension.frame.select(dimension.key, *_hashes(dimension.columns, pair))


def attach_keys(
    df: DataFrame,
    dimensions: Sequence[Dimension],
    null_safe: bool = True,
    broadcast_limit: int | None = None,
    counted: bool = False,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """``df`` with the keys of several dimensions as last columns, in their order.

    The same as one :func:`attach_key` after the other, which would shuffle the
    rows once for each dimension over the broadcast limit. Here those are looked up
    together: every row gives two hashes for each of them, all these are joined in one
    shuffle, the keys found come together by row, and the rows themselves are
    shuffled once, to meet them. Frequent keys of all of them are searched for in
    one pass over ``df``. The rows are staged, so that a repeated task numbers them
    alike. ``keep`` names the columns of ``df`` in the result, if not all are needed.
    """
    kept = [*(df.columns if keep is None else keep)]
    limit = session_limit(df) if broadcast_limit is None else broadcast_limit
    large = [d for d in dimensions if d.size > limit]
    # A small table is shuffled sooner than staged.
    if len(large) < 2 or estimated_size(df) <= limit or not all(_same_types(df, d) for d in large):
        large = []
    # The others first, so that their natural keys need not travel.
    others = [d for d in dimensions if d not in large]
    for i, d in enumerate(others):
        needed = {*kept}.union(*(e.columns for e in [*others[i:], *large]), (e.key for e in others[:i]))
        df = attach_key(df.select(*[c for c in df.columns if c in needed]), d, null_safe, limit, counted)
    if large:
        df = _together(df, large, null_safe, counted, [*kept, *(d.key for d in others)])
    return df.select(*kept, *(d.key for d in dimensions))


def _same_types(df: DataFrame, dimension: Dimension) -> bool:
    """Whether equal natural keys have equal hashes on both sides."""
    own, other = dict(df.dtypes), dict(dimension.frame.dtypes)
    return all(own[c] == other[c] for c in dimension.columns)


def _together(
    df: DataFrame, dimensions: Sequence[Dimension], null_safe: bool, counted: bool, kept: Sequence[str]
) -> DataFrame:
    """``kept`` and the keys of ``dimensions``, all looked up in one shuffle of hashes."""
    needed = {*kept}.union(*(d.columns for d in dimensions))
    narrow = df.select(*[c for c in df.columns if c in needed])
    rows = stage(narrow.withColumn(_PLACE, F.monotonically_increasing_id()))
    number, pair, key = f"{_MATCH}number", [f"{_MATCH}h1", f"{_MATCH}h2"], f"{_MATCH}key"

    def hashed(columns: Sequence[str], i: int) -> list[Column]:
        return [F.lit(i).alias(number), *_hashes(columns, pair)]

    asked = []
    for i, d in enumerate(dimensions):
        missing = reduce(Column.__or__, [F.col(c).isNull() for c in d.columns])
        asked.append(F.when(F.lit(null_safe) | ~missing, F.struct(*hashed(d.columns, i))))
    each = rows.select(_PLACE, F.explode(F.array(*asked)).alias("asked")).filter("asked IS NOT NULL")
    each = each.select(_PLACE, "asked.*")

    def keys(frames: Sequence[DataFrame], name: str) -> DataFrame:
        sides = [f.select(*hashed(d.columns, i), F.col(d.key).alias(name)) for i, (d, f) in enumerate(zip(dimensions, frames))]
        return reduce(DataFrame.union, sides)

    # As in a single lookup: frequent tuples are answered by a broadcast of bounded
    # size, and their rows are spread instead of meeting in one task.
    hot, spread = f"{_MATCH}hot", f"{_MATCH}spread"
    frequent = _frequent_of_all(rows, dimensions, counted)
    marked = each.join(F.broadcast(keys(frequent, hot)), [number, *pair], "left")
    apart = F.when(F.col(hot).isNotNull(), F.xxhash64(F.spark_partition_id() + 1)).otherwise(F.lit(0))
    marked = marked.withColumn(spread, apart)
    cold = keys([d.frame for d in dimensions], key)
    cold = cold.withColumn(spread, F.col(key).bitwiseAND(F.lit(0).cast("bigint")))
    found = marked.join(cold, [number, *pair, spread], "left")
    found = found.select(_PLACE, number, F.coalesce(hot, key).alias(key))
    wide = found.groupBy(_PLACE).agg(
        *[F.max(F.when(F.col(number) == i, F.col(key))).alias(d.key) for i, d in enumerate(dimensions)]
    )
    return rows.join(wide, _PLACE, "left").select(*kept, *(d.key for d in dimensions))


class _Numbered(NamedTuple):
    frame: DataFrame
    rows: int
    size: int
    weight: int


def _number(
    df: DataFrame,
    key: str,
    order_by: Sequence[str],
    columns: Sequence[str],
    weight: Column | None = None,
) -> _Numbered:
    """``df`` with its 0-based position as ``key``, and its totals.

    The totals are the row count, the bytes of key and ``columns``, and the sum
    of ``weight``.
    """
    ordered = df.orderBy(*[F.asc_nulls_first(c) for c in order_by])
    staged = stage(ordered.withColumn(_PLACE, F.monotonically_increasing_id()))
    part = F.shiftright(_PLACE, _PLACE_BITS)
    within = F.col(_PLACE).bitwiseAND((1 << _PLACE_BITS) - 1)

    # One line per partition of the sort, never per row.
    parts = (
        staged.groupBy(part.cast("int").alias("part"))
        .agg(
            F.count("*").alias("rows"),
            F.sum(_row_size(staged.select(*columns))).alias("size"),
            F.sum(F.lit(1) if weight is None else weight).alias("weight"),
        )
        .collect()
    )
    counts = {p["part"]: p["rows"] for p in parts}
    starts, total = [], 0
    for i in range(max(counts, default=-1) + 1):
        starts.append(total)
        total += counts.get(i, 0)
    # The starts travel as one folded array literal, so that the size estimate
    # of the staged table stays exact and no join is needed.
    start = F.split(F.lit(",".join(map(str, starts or [0]))), ",").cast("array<bigint>")
    position = F.get(start, part.cast("int")) + within
    return _Numbered(
        staged.select(*df.columns, position.alias(key)),
        total,
        sum(p["size"] for p in parts),
        sum(p["weight"] for p in parts),
    )


def _hashes(columns: Sequence[str], names: Sequence[str]) -> list[Column]:
    """Two hashes of a tuple; missing values count with their place."""
    parts = [p for c in columns for p in (F.col(c).isNull(), F.col(c))]
    return [F.xxhash64(F.lit(i), *parts).alias(n) for i, n in enumerate(names)]


def _row_size(df: DataFrame) -> Column:
    """Bytes of a row in memory: eight per field, and texts and bytes themselves.

    A nested or wide value has no bound that is cheap to measure: it counts as
    too large for any broadcast.
    """
    fixed = F.lit(8 * (len(df.columns) + 1)).cast("bigint")
    wide = T.DecimalType, T.StringType, T.BinaryType
    plain = T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType
    if any(not isinstance(f.dataType, (*plain, *wide)) for f in df.schema.fields):
        return F.lit(1 << 40).cast("bigint")
    fixed = fixed + 16 * sum(isinstance(f.dataType, T.DecimalType) for f in df.schema.fields)
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    return reduce(
        Column.__add__, [F.coalesce(F.octet_length(c), F.lit(0)) for c in texts], fixed
    )


def _lookup(
    df: DataFrame, side: DataFrame, columns: Sequence[str], key: str, null_safe: bool
) -> DataFrame:
    renamed = side.select(key, *[F.col(c).alias(_MATCH + c) for c in columns])
    pairs = [
        F.col(c).eqNullSafe(F.col(_MATCH + c)) if null_safe else F.col(c) == F.col(_MATCH + c)
        for c in columns
    ]
    joined = df.join(renamed, reduce(Column.__and__, pairs), "left")
    return joined.select(*df.columns, key)


def _frequent_tuples(df: DataFrame, dimension: Dimension) -> DataFrame:
    """The dimension's rows for natural keys that are frequent in ``df``.

    The frequent-item count is one pass with a bounded buffer; it may name a
    few keys too many, which is harmless, but never misses a frequent one.
    """
    columns = dimension.columns
    hashed = df.select(F.xxhash64(*columns).alias("h"))
    items = hashed.freqItems(["h"], HOT_SHARE).select(F.explode("h_freqItems").alias("h"))
    frame = dimension.frame.select(dimension.key, *columns)
    return frame.join(F.broadcast(items), F.xxhash64(*columns) == F.col("h"), "left_semi")


def _frequent_of_all(
    df: DataFrame, dimensions: Sequence[Dimension], counted: bool
) -> list[DataFrame]:
    """The rows of each dimension that are frequent in ``df``; one pass over ``df`` finds those not known."""
    frames = [d.frame.select(d.key, *d.columns) for d in dimensions]
    if counted:
        return [f.limit(0) if d.frequent is None else d.frequent for d, f in zip(dimensions, frames)]
    names = [f"h{i}" for i in range(len(dimensions))]
    hashed = df.select(*[F.xxhash64(*d.columns).alias(n) for d, n in zip(dimensions, names)])
    # At most 1 / HOT_SHARE numbers for each dimension.
    items = hashed.freqItems(names, HOT_SHARE).first()
    found = []
    for d, frame, name in zip(dimensions, frames, names):
        hot = df.sparkSession.createDataFrame([(h,) for h in items[f"{name}_freqItems"]], "h bigint")
        found.append(frame.join(F.broadcast(hot), F.xxhash64(*d.columns) == F.col("h"), "left_semi"))
    return found
