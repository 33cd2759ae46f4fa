"""Duplicates, missing values and outliers of one table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, GroupedData, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditlake.functions.columns import columns_like, null_above
from creditlake.functions.scalars import is_missing
from creditlake.operators.sizes import (
    PARTITION_BYTES,
    estimated_size,
    has_wide_condition,
    input_size,
    is_stored,
    session_limit,
    spread,
)
from creditlake.settings import DAY_LIMIT
from creditlake.staging import stage

_ROW = "__row"
_COPIES = "__copies"
_WORD = "__word"
_BITS = "__bits"
_HASH = "__hash"

# Repeated keys are marked in so many words of 64 bits: at most 10 MB in memory,
# and with a million repeated keys one other key in 17 is taken for one.
_WORDS = 1 << 18
# Whole rows are counted by a hash below this number, which travels in five bytes; equal
# hashes of different rows cost a comparison.
_HASHES = 1 << 40


def dedup(
    df: DataFrame,
    keys: Sequence[str] | None = None,
    order_by: Sequence[str] | None = None,
    small: int | None = None,
) -> DataFrame:
    """One row per distinct row, or per key.

    Of several rows with the same key the smallest one by ``order_by`` and then
    by the other columns (NULL first) survives, so the result does not depend
    on the input order. Only rows whose key may be repeated are compared and
    moved, if ``df`` is a stored table also without keys; see :func:`_one_per_key` and
    :func:`_one_per_row`. A table of at most ``small`` bytes by Spark's
    estimate (by default the session's broadcast limit) is compared as a whole
    instead, since planning more would take longer.
    """
    if keys:
        return _one_per_key(df, keys, order_by, small).drop(_COPIES)
    if _is_marked_by_row(df, small):
        return _one_per_row(df).drop(_COPIES)
    return spread(df, df.columns).dropDuplicates()


def duplicate_count(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """One row ``duplicates``: rows beyond the first of each row or key."""
    copies = df.groupBy(*(keys or df.columns)).agg(F.count("*").alias(_COPIES))
    return copies.agg(_surplus().alias("duplicates"))


def missing_counts(df: DataFrame) -> DataFrame:
    """``(column, missing)`` for every column, counted in one pass."""
    return _tall(df, {f.name: F.count_if(is_missing(f)) for f in df.schema.fields}, "missing")


def outlier_counts(
    df: DataFrame, columns: Sequence[str] | None = None, limit: float = DAY_LIMIT
) -> DataFrame:
    """``(column, outliers)``: values over ``limit`` in the day columns."""
    chosen = columns_like(df, "days") if columns is None else columns
    return _tall(df, {c: F.count_if(F.col(c) > limit) for c in chosen}, "outliers")


def outlier_count(
    df: DataFrame, columns: Sequence[str] | None = None, limit: float = DAY_LIMIT
) -> DataFrame:
    """One row ``outliers``: values over ``limit`` in all day columns together."""
    chosen = columns_like(df, "days") if columns is None else columns
    total = F.lit(0).cast("bigint")
    for c in chosen:
        total = total + F.count_if(F.col(c) > limit)
    return df.agg(total.alias("outliers"))


def quality_check(
    df: DataFrame,
    name: str,
    keys: Sequence[str] | None = None,
    limit: float = DAY_LIMIT,
    order_by: Sequence[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The cleaned table and its report; nothing runs until one of them is used."""
    clean = quality_clean(df, keys, limit, order_by=order_by)
    return clean, quality_report(df, name, keys, limit, order_by)


def quality_clean(
    df: DataFrame,
    keys: Sequence[str] | None = None,
    limit: float = DAY_LIMIT,
    audit: Observation | None = None,
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """``df`` without duplicates and with day values over ``limit`` set to NULL.

    Of several rows of a key the first by ``order_by`` stays, as in :func:`dedup`. With ``audit`` the counts of the report are taken along when the result is
    written, at no pass of their own; :func:`audit_report` then reads them. The
    result must be written without another shuffle in between, because only the
    tasks of a job's last stage are sure to be counted once.
    """
    days = columns_like(df, "days")
    if audit is None:
        return null_above(dedup(df, keys, order_by), days, limit)
    counts = [c.alias(":".join(name)) for name, c in _counts(df, limit).items()]
    kept = _kept(df, keys, order_by).observe(audit, *counts)
    return null_above(kept.drop(_COPIES), days, limit)


def quality_report(
    df: DataFrame,
    name: str,
    keys: Sequence[str] | None = None,
    limit: float = DAY_LIMIT,
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """``(table, check, column, value)``: what cleaning ``df`` finds.

    Counts duplicates in the input, then missing values and outliers among the
    rows that are kept, before outliers are removed. All counts come from one
    pass with one shuffle.
    """
    counts = _counts(df, limit)
    wide = _kept(df, keys, order_by).agg(*[c.alias(f"c{i}") for i, c in enumerate(counts.values())])
    lines = [
        F.struct(
            F.lit(name).alias("table"),
            F.lit(check).alias("check"),
            F.lit(column or None).cast("string").alias("column"),
            F.col(f"c{i}").alias("value"),
        )
        for i, (check, column) in enumerate(counts)
    ]
    return wide.select(F.inline(F.array(*lines)))


def audit_report(spark: SparkSession, audits: Mapping[str, Observation]) -> DataFrame:
    """The report of tables that were cleaned with an audit and written."""
    lines = []
    for table, audit in audits.items():
        for name, value in audit.get.items():
            check, column = name.split(":", 1)
            lines.append((table, check, column or None, value))
    return spark.createDataFrame(lines, "table string, check string, column string, value bigint")


def _counts(df: DataFrame, limit: float) -> dict[tuple[str, str], Column]:
    """The counts of a report by check and column, over kept rows with their copies."""
    counts = {("duplicates", ""): _surplus()}
    counts |= {("missing", f.name): F.count_if(is_missing(f)) for f in df.schema.fields}
    days = columns_like(df, "days")
    return counts | {("outliers", c): F.count_if(F.col(c) > limit) for c in days}


def _kept(
    df: DataFrame, keys: Sequence[str] | None, order_by: Sequence[str] | None = None
) -> DataFrame:
    """The rows that cleaning keeps, each with its number of copies."""
    if keys:
        return _one_per_key(df, keys, order_by)
    if _is_marked_by_row(df):
        return _one_per_row(df)
    return spread(df, df.columns).groupBy(*df.columns).agg(F.count("*").alias(_COPIES))


def _is_marked_by_row(df: DataFrame, small: int | None = None) -> bool:
    """Whether to look for repeated rows before rows are moved.

    That reads ``df`` twice, so it must be a stored table, with values whose hashes are
    equal if they are; a row of two columns is hardly wider than its hash.
    """
    if len(df.columns) <= 2 or not all(_has_hash(f.dataType) for f in df.schema.fields):
        return False
    return is_stored(df) and estimated_size(df) > (session_limit(df) if small is None else small)


def _has_hash(kind: T.DataType) -> bool:
    plain = T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BinaryType
    return isinstance(kind, plain) or kind.simpleString() == "string"


def _one_per_row(df: DataFrame) -> DataFrame:
    """The distinct rows, each with its number of copies.

    Like :func:`_one_per_key`, with a hash of the whole row in place of the key: only the hashes
    are shuffled, and the rows whose mark is set. These meet in partitions that grow in
    number with the input, see :func:`creditlake.operators.sizes.spread`.
    """
    parts = -(-input_size(df) // PARTITION_BYTES)
    # A comparison takes the two zeros for one and returns the positive one.
    floating = [f for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    df = df.withColumns({f.name: F.col(f.name) + F.lit(0).cast(f.dataType) for f in floating})
    row = F.pmod(F.xxhash64(*df.columns), F.lit(_HASHES))
    alone, shared = _parted(df, df.select(row.alias(_HASH)).groupBy(_HASH), _place(F.col(_HASH)), _place(row))
    met = shared.repartition(parts, *df.columns)
    return alone.union(met.groupBy(*df.columns).agg(F.count("*").alias(_COPIES)))


def _one_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] | None = None,
    small: int | None = None,
) -> DataFrame:
    """The smallest row of each key, with its number of copies.

    The keys alone are counted by hash first. Repeated ones are marked in a table
    of bits by their hash, whose size is bounded whatever the number of keys, so
    every task can have it. Rows whose bit is not set have a key of their own:
    they pass as they are, without a sort or a shuffle. The others go through a
    minimum, which is right for all of them, and is combined before its shuffle: a
    key with very many copies sends one row per task. Two keys on one bit cost a
    little of that work, never a row.
    """
    if estimated_size(df) <= (session_limit(df) if small is None else small):
        return _unpack(df, keys, _smallest(df, keys, order_by), _COPIES)
    df = _settled(df)
    place = _place(F.xxhash64(*keys))
    alone, shared = _parted(df, df.groupBy(*keys), place, place)
    return alone.union(_unpack(df, keys, _smallest(shared, keys, order_by), _COPIES))


def _place(hashed: Column) -> Column:
    """The bit of a hash in the table of marks."""
    return F.pmod(hashed, F.lit(64 * _WORDS).cast("bigint"))


def _parted(
    df: DataFrame, grouped: GroupedData, mark: Column, place: Column
) -> tuple[DataFrame, DataFrame]:
    """The rows of ``df`` that stand alone in their group, with one copy each, and those that may share it.

    ``mark`` is the place of a group, ``place`` that of a row; they agree.
    """
    counted = grouped.agg(F.count("*").alias(_COPIES)).filter(F.col(_COPIES) > 1)
    marks = counted.groupBy(F.shiftright(mark, 6).alias(_WORD)).agg(F.bit_or(_bit(mark)).alias(_BITS))
    marked = df.withColumn(_WORD, F.shiftright(place, 6)).join(F.broadcast(marks), _WORD, "left")
    shared = F.coalesce(F.col(_BITS).bitwiseAND(_bit(place)) != 0, F.lit(False))
    alone = marked.filter(~shared).select(*df.columns, F.lit(1).cast("bigint").alias(_COPIES))
    return alone, marked.filter(shared).select(*df.columns)


def _bit(place: Column) -> Column:
    within = place.bitwiseAND(F.lit(63).cast("bigint")).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), within)


def _settled(df: DataFrame) -> DataFrame:
    """``df``, staged if reading it again could give other rows, or if a wide condition is below.

    Filters and joins above a wide condition can keep the optimizer busy for hours.
    """
    again = df._jdf.queryExecution().analyzed().deterministic() and not has_wide_condition(df)
    return df if again else stage(df)


def _smallest(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None
) -> DataFrame:
    first = [c for c in order_by or () if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in first]
    return df.groupBy(*keys).agg(
        F.min(F.struct(*first, *rest)).alias(_ROW) if first or rest else F.lit(None).alias(_ROW),
        F.count("*").alias(_COPIES),
    )


def _unpack(df: DataFrame, keys: Sequence[str], packed: DataFrame, *more: str) -> DataFrame:
    fields = [F.col(c) if c in keys else F.col(f"{_ROW}.`{c}`").alias(c) for c in df.columns]
    return packed.select(*fields, *more)


def _surplus() -> Column:
    return F.coalesce(F.sum(F.col(_COPIES) - 1), F.lit(0).cast("bigint"))


def _tall(df: DataFrame, counts: dict[str, Column], value: str) -> DataFrame:
    wide = df.agg(*[count.alias(f"c{i}") for i, count in enumerate(counts.values())])
    lines = [
        F.struct(F.lit(name).alias("column"), F.col(f"c{i}").alias(value))
        for i, name in enumerate(counts)
    ]
    return wide.select(F.inline(F.array(*lines)))
