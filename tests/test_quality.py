import math

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from creditlake.operators import quality as Q
from creditlake.operators import sizes


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def sample(spark):
    return spark.createDataFrame(
        [(1, 40000.0, "a"), (1, 40000.0, "a"), (2, math.nan, None), (2, 5.0, "b"), (3, None, "c")],
        "id int, days double, name string",
    )


def test_dedup_of_rows(spark):
    assert Q.dedup(sample(spark)).count() == 4


def test_dedup_by_key_keeps_the_smallest_whole_row(spark):
    df = spark.createDataFrame(
        [(1, 5, "a"), (1, None, "z"), (1, 5, None), (2, 1, "q")], "id int, n int, s string"
    )
    for parts in (1, 4):
        kept = Q.dedup(df.repartition(parts), ["id"])
        assert kept.columns == df.columns
        assert rows(kept) == [(1, None, "z"), (2, 1, "q")]
    assert rows(Q.dedup(df, ["id"], order_by=["s"])) == [(1, 5, None), (2, 1, "q")]
    assert Q.dedup(df.select("id"), ["id"]).count() == 2


def test_dedup_survives_a_key_with_most_of_the_rows(spark):
    df = spark.range(30000).selectExpr("CASE WHEN id % 3 = 0 THEN -1 ELSE id END AS k", "id AS v")
    kept = Q.dedup(df, ["k"])
    assert kept.count() == 20001
    assert kept.filter("k = -1").first()["v"] == 0


@pytest.mark.parametrize("words", [1, 1 << 18])
def test_both_ways_keep_the_same_rows(spark, monkeypatch, words):
    # With one word of 64 bits nearly all keys share a bit with a repeated one.
    monkeypatch.setattr(Q, "_WORDS", words)
    df = spark.range(6000).selectExpr(
        "IF(id % 5 = 0, NULL, CAST(id % 2500 AS INT)) AS a", "IF(id % 7 = 0, NULL, CAST(id % 3 AS DOUBLE) - 1) * 0.0 AS b",
        "CAST(id * 37 % 101 AS INT) AS c", "IF(id % 11 = 0, 'NaN', CAST(id AS STRING)) AS s",
    )
    for order in (None, ["s"], ["c", "s"]):
        one, two = (Q.dedup(df, ["a", "b"], order, small=small) for small in (1 << 40, -1))
        assert one.dtypes == two.dtypes
        assert rows(one) == rows(two)
    assert Q.dedup(df.limit(0), ["a"], small=-1).count() == 0


def test_rows_with_a_key_of_their_own_are_neither_sorted_nor_moved(spark):
    df = spark.range(1000).selectExpr("id AS k", "id % 7 AS v", "CAST(id AS STRING) AS s")
    plan = Q.dedup(df, ["k"], small=-1)._jdf.queryExecution().sparkPlan()
    assert plan.nodeName() == "Union"
    alone = plan.children().apply(0).toString()
    # Only the marks, which are broadcast, come from an aggregate.
    assert "SortAggregate" not in alone and "Sort " not in alone
    assert plan.children().apply(1).toString().count("SortAggregate") == 2


def test_a_frame_that_changes_when_read_again_is_settled_first(spark):
    df = spark.range(2000).selectExpr("CAST(rand() * 500 AS INT) AS k", "uuid() AS s")
    kept = Q.dedup(df, ["k"], small=-1)
    assert kept.count() == kept.select("k").distinct().count()


def test_duplicate_count(spark):
    df = sample(spark)
    assert Q.duplicate_count(df).first()["duplicates"] == 1
    assert Q.duplicate_count(df, ["id"]).first()["duplicates"] == 2
    assert Q.duplicate_count(df.limit(0)).first()["duplicates"] == 0


def test_missing_and_outliers(spark):
    df = sample(spark)
    assert rows(Q.missing_counts(df)) == [("days", 2), ("id", 0), ("name", 1)]
    # NaN is over every limit.
    assert rows(Q.outlier_counts(df)) == [("days", 3)]
    assert Q.outlier_count(df).first()["outliers"] == 3


EXPECTED = [
    ("t", "duplicates", None, 1),
    ("t", "missing", "days", 2),
    ("t", "missing", "id", 0),
    ("t", "missing", "name", 1),
    ("t", "outliers", "days", 2),
]


def test_report_counts_missing_before_outliers_are_removed(spark):
    clean, report = Q.quality_check(sample(spark), "t")
    assert rows(report) == sorted(EXPECTED, key=str)
    assert clean.filter("days IS NOT NULL").count() == 1


def test_audit_taken_along_equals_the_report(spark, tmp_path):
    df = sample(spark)
    for i, keys in enumerate((None, ["id"])):
        audit = Observation()
        Q.quality_clean(df, keys, audit=audit).write.parquet(f"{tmp_path}/{i}")
        taken = Q.audit_report(spark, {"t": audit})
        assert rows(taken) == rows(Q.quality_report(df, "t", keys))
        plain = Q.quality_clean(df, keys)
        assert rows(spark.read.parquet(f"{tmp_path}/{i}")) == rows(plain)


def test_a_condition_on_many_columns_does_not_stop_the_planner(spark):
    """Spark would keep the condition once for each of 2^40 choices of renamed columns."""
    names = [f"c{i}" for i in range(40)]
    df = spark.range(100).selectExpr("id % 20 AS C0", *[f"id + {i} AS C{i}" for i in range(1, 40)])
    df = df.union(df.filter(F.pmod(F.xxhash64(*df.columns), F.lit(3)) >= 0)).toDF(*names)
    kept = Q.dedup(df, ["c0"], small=-1)
    assert sorted(r["c0"] for r in kept.collect()) == list(range(20))
    assert sorted(r["c39"] for r in kept.collect()) == list(range(39, 59))


def test_whole_rows_are_compared_in_more_partitions_if_the_input_is_larger(spark, tmp_path):
    """Not in more rows a partition; and hashed so that the copies of a row still meet."""
    spark.range(2_000_000).selectExpr("xxhash64(id % 1500000) AS a", "xxhash64(-(id % 1500000)) AS b").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    parts = -(-sizes.input_size(df) // sizes.PARTITION_BYTES)
    assert sizes.input_size(df) > sizes.session_limit(df) and parts > 4
    kept = Q.dedup(df)
    assert kept.rdd.getNumPartitions() == parts and kept.count() == 1_500_000
    assert sizes.input_size(df.union(df)) == 2 * sizes.input_size(df)
