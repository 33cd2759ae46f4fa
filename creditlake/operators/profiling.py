"""Profiles of a table: frequencies, statistics, distributions."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditlake.functions.scalars import is_missing
from creditlake.staging import scope, stage

QUARTILES = (0.25, 0.5, 0.75)
WHISKER = 1.5


def filter_count(df: DataFrame, condition: Column) -> DataFrame:
    """One row ``rows``: how many rows meet the condition."""
    return df.filter(condition).agg(F.count("*").alias("rows"))


def top_n(df: DataFrame, order_by: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows by ``order_by`` (NULL first)."""
    return df.orderBy(*[F.asc_nulls_first(c) for c in order_by]).limit(n)


def profile(df: DataFrame) -> DataFrame:
    """``(position, column, type, non_null)`` for every column, in one pass."""
    fields = df.schema.fields
    wide = df.agg(*[F.count_if(~is_missing(f)).alias(f"c{i}") for i, f in enumerate(fields)])
    lines = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.col(f"c{i}").alias("non_null"),
        )
        for i, f in enumerate(fields)
    ]
    return wide.select(F.inline(F.array(*lines)))


def value_counts(df: DataFrame, columns: str | Sequence[str]) -> DataFrame:
    """How often each value or tuple occurs, most frequent first; NULL is left out."""
    names = [columns] if isinstance(columns, str) else list(columns)
    counted = df.dropna(subset=names).groupBy(*names).agg(F.count("*").alias("rows"))
    return counted.orderBy(F.desc("rows"), *names)


def value_shares(df: DataFrame, column: str) -> DataFrame:
    """:func:`value_counts` with the share of each value in percent."""
    counted = value_counts(df, column)
    # The total adds up the counts, so the table is read once.
    total = counted.agg(F.sum("rows")).scalar()
    return counted.withColumn("percent", 100 * F.col("rows") / total)


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson's coefficient ``(a, b, correlation)`` of every pair, in one pass.

    A row counts for a pair if it has both values.
    """
    values = {c: F.nanvl(F.col(c).cast("double"), F.lit(None)) for c in columns}
    halves = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    wide = df.agg(*[F.corr(values[a], values[b]).alias(f"c{i}") for i, (a, b) in enumerate(halves)])
    place = {pair: f"c{i}" for i, pair in enumerate(halves)}
    lines = [
        F.struct(
            F.lit(a).alias("a"),
            F.lit(b).alias("b"),
            F.col(place.get((a, b)) or place[(b, a)]).alias("correlation"),
        )
        for a, b in product(columns, columns)
    ]
    return wide.select(F.inline(F.array(*lines)))


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """``(bin, low, high, rows)`` for ``bins`` equal widths; the maximum is in the last.

    The input is read once: its values are staged, and range and counts come
    from there. Both are looked up when the histogram is made, as a line a bin.
    """
    with scope(df.sparkSession):
        values = stage(_present(df, column))
        low, high = values.agg(F.min("v"), F.max("v")).first()
        if low is None:
            raise ValueError(f"no values in {column}")
        # With a single value the width is 0 and everything is in the first bin.
        width = (high - low) / bins
        place = F.floor((F.col("v") - low) / width) if width else F.lit(0)
        place = F.least(place, F.lit(bins - 1)).cast("int").alias("bin")
        lines = values.groupBy(place).agg(F.count("*").alias("rows")).collect()
    counted = df.sparkSession.createDataFrame([tuple(r) for r in lines], "bin int, rows bigint")
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(F.broadcast(counted), "bin", "left").select(
        "bin",
        (F.lit(low) + F.col("bin") * width).alias("low"),
        (F.lit(low) + (F.col("bin") + 1) * width).alias("high"),
        F.coalesce("rows", F.lit(0)).alias("rows"),
    )


def quantiles(
    df: DataFrame, columns: Sequence[str], shares: Sequence[float] = QUARTILES
) -> DataFrame:
    """Exact quantiles, linear between neighbours: ``(column, values, q0, q1, ...)``.

    ``values`` counts the present values. Built-in exact percentiles keep every
    distinct value of a column in one task. Here the value frequencies are
    sorted by range across the cluster and staged; only the partitions that
    hold a wanted rank are looked at again. The result is looked up when it is
    asked for, as one line a column, and the staged values go at once.
    """
    with scope(df.sparkSession):
        found = _quantiles(df, columns, shares)
        lines = [tuple(r) for r in found.collect()]
    return df.sparkSession.createDataFrame(lines, found.schema)


def _quantiles(df: DataFrame, columns: Sequence[str], shares: Sequence[float]) -> DataFrame:
    long = df.select(*[F.col(c).cast("double") for c in columns]).unpivot(
        [], list(columns), "column", "v"
    )
    counted = (
        long.filter("v IS NOT NULL AND NOT isnan(v)")
        .groupBy("column", "v")
        .agg(F.count("*").alias("n"))
    )
    part = F.shiftright(F.monotonically_increasing_id(), 33)
    staged = stage(counted.orderBy("column", "v").withColumn("part", part))

    # One line per column and partition of the sort.
    by_part = Window.partitionBy("column").orderBy("part")
    parts = staged.groupBy("column", "part").agg(F.sum("n").alias("here"))
    parts = parts.select(
        "column",
        "part",
        "here",
        (F.sum("here").over(by_part) - F.col("here")).alias("before"),
        F.sum("here").over(Window.partitionBy("column")).alias("values"),
    )

    def rank(share: float) -> Column:
        return F.lit(float(share)) * (F.col("values") - 1)

    wanted = [f(rank(s)).cast("bigint") for s in shares for f in (F.floor, F.ceil)]
    first, after = F.col("before"), F.col("before") + F.col("here")
    holds = F.exists(F.array(*wanted), lambda r: (r >= first) & (r < after))
    within = Window.partitionBy("column", "part").orderBy("v")
    running = (
        staged.join(F.broadcast(parts.filter(holds)), ["column", "part"])
        .withColumn("end", F.col("before") + F.sum("n").over(within))
        .withColumn("start", F.col("end") - F.col("n"))
    )

    def at(r: Column) -> Column:
        return F.max(F.when((r >= F.col("start")) & (r < F.col("end")), F.col("v")))

    picked = running.groupBy("column", "values").agg(
        *[at(r).alias(f"r{i}") for i, r in enumerate(wanted)]
    )
    outcome = []
    for i, s in enumerate(shares):
        below, above = F.col(f"r{2 * i}"), F.col(f"r{2 * i + 1}")
        fraction = rank(s) - F.floor(rank(s))
        outcome.append((below + (above - below) * fraction).alias(f"q{i}"))
    return picked.select("column", "values", *outcome)


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, deviation, extremes and quartiles of each column."""
    values = {c: F.nanvl(F.col(c).cast("double"), F.lit(None)) for c in columns}
    measures = (F.count, F.avg, F.stddev, F.min, F.max)
    names = ("count", "mean", "std", "min", "max")
    wide = df.agg(
        *[m(v).alias(f"{n}_{i}") for i, v in enumerate(values.values()) for m, n in zip(measures, names)]
    )
    lines = [
        F.struct(F.lit(c).alias("column"), *[F.col(f"{n}_{i}").alias(n) for n in names])
        for i, c in enumerate(columns)
    ]
    ranks = quantiles(df, columns).toDF("column", "values", "q25", "q50", "q75")
    # Both sides have one row per column.
    stats = wide.select(F.inline(F.array(*lines)))
    return stats.join(F.broadcast(ranks.drop("values")), "column", "left").select(
        "column", "count", "mean", "std", "min", "q25", "q50", "q75", "max"
    )


def box_stats(df: DataFrame, column: str) -> DataFrame:
    """Quartiles, whiskers and outlier count of one column, one row.

    The whiskers end at the outermost values within 1.5 interquartile ranges
    of the box. The quartiles are looked up when the result is made, as one row.
    """
    box = quantiles(df, [column]).first()
    if box is None:
        raise ValueError(f"no values in {column}")
    low, middle, high = box["q0"], box["q1"], box["q2"]
    reach = WHISKER * (high - low)
    value = F.col("v")
    inside = (value >= low - reach) & (value <= high + reach)
    return _present(df, column).agg(
        F.lit(column).alias("column"),
        F.lit(low).alias("q25"),
        F.lit(middle).alias("q50"),
        F.lit(high).alias("q75"),
        F.min(F.when(inside, value)).alias("whisker_low"),
        F.max(F.when(inside, value)).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"),
    )


def _present(df: DataFrame, column: str) -> DataFrame:
    values = df.select(F.col(column).cast("double").alias("v"))
    return values.filter(F.col("v").isNotNull() & ~F.isnan("v"))
