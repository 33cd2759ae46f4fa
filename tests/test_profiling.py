import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from creditlake.operators import profiling as P


def test_quantiles_equal_those_of_the_sorted_values(spark):
    values = [3.5, -1.0, 3.5, 12.0, 7.25, math.nan, None, 0.0]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "a double, b int")
    got = {r["column"]: r for r in P.quantiles(df, ["a", "b"], [0, 0.1, 0.5, 0.9, 1]).collect()}
    known = [v for v in values if v is not None and not math.isnan(v)]
    assert got["a"]["values"] == 6
    for i, share in enumerate([0, 0.1, 0.5, 0.9, 1]):
        assert got["a"][f"q{i}"] == pytest.approx(np.quantile(known, share))
        assert got["b"][f"q{i}"] == pytest.approx(np.quantile(range(8), share))


def test_quantiles_over_many_partitions_with_a_frequent_value(spark):
    df = spark.range(60000).select(
        F.when(F.col("id") % 3 == 0, 1000.0).otherwise(F.col("id").cast("double")).alias("x")
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = P.quantiles(df.repartition(9), ["x"], [0.01, 0.25, 0.5, 0.99]).first()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    known = [1000.0 if i % 3 == 0 else float(i) for i in range(60000)]
    for i, share in enumerate([0.01, 0.25, 0.5, 0.99]):
        assert got[f"q{i}"] == pytest.approx(np.quantile(known, share))


def test_histogram_keeps_empty_bins_and_the_maximum(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (10.0,), (None,), (math.nan,)], "x double")
    got = sorted(map(tuple, P.histogram(df, "x", 5).collect()))
    assert [r[3] for r in got] == [2, 0, 0, 0, 1]
    assert got[-1][1:3] == (8.0, 10.0)


def test_histogram_of_one_value(spark):
    df = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    assert [r["rows"] for r in P.histogram(df, "x", 3).orderBy("bin").collect()] == [2, 0, 0]


def test_box_stats(spark):
    values = [1.0, 2.0, 3.0, 4.0, 100.0]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert tuple(P.box_stats(df, "x").first()) == ("x", 2.0, 3.0, 4.0, 1.0, 4.0, 1)


def test_correlation_skips_missing_pairs(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0), (2.0, 4.0), (3.0, 6.0), (math.nan, 1.0), (5.0, None)], "a double, b double"
    )
    got = {(r["a"], r["b"]): r["correlation"] for r in P.correlations(df, ["a", "b"]).collect()}
    assert got[("a", "b")] == pytest.approx(1.0)
    assert got[("a", "b")] == got[("b", "a")]


def test_frequencies_leave_out_null(spark):
    df = spark.createDataFrame([("x",), ("x",), ("y",), (None,)], "a string")
    assert [tuple(r) for r in P.value_counts(df, "a").collect()] == [("x", 2), ("y", 1)]
    shares = {r["a"]: r["percent"] for r in P.value_shares(df, "a").collect()}
    assert shares == {"x": pytest.approx(200 / 3), "y": pytest.approx(100 / 3)}


def test_describe_ignores_missing(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (math.nan,), (None,)], "x double")
    row = P.describe(df, ["x"]).first()
    assert (row["count"], row["mean"], row["min"], row["q50"], row["max"]) == (2, 1.5, 1.0, 1.5, 2.0)
