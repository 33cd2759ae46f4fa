import math

import pytest
from pyspark.sql import functions as F

from creditlake.operators.dimensions import add_key, attach_key, attach_keys, create_dimension


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def skewed(spark):
    """A third of the rows shares one natural key and is one row copied."""
    hot = spark.range(10000).selectExpr("CAST(NULL AS STRING) AS a", "7 AS b", "0 AS v")
    rest = spark.range(20000).selectExpr("CAST(id % 5000 AS STRING) AS a", "CAST(id % 3 AS INT) AS b", "CAST(id AS INT) AS v")
    return hot.union(rest)


BOTH_WAYS = pytest.mark.parametrize("small", [None, -1])


@BOTH_WAYS
def test_keys_are_consecutive_and_follow_the_natural_order(spark, small):
    df = spark.createDataFrame([("b", 2), (None, 1), ("a", 3), ("b", 1), ("b", 2)], "s string, n int")
    dimension = create_dimension(df, ["s", "n"], "id", small=small)
    assert dimension.frame.columns == ["id", "s", "n"]
    assert rows(dimension.frame) == [(0, None, 1), (1, "a", 3), (2, "b", 1), (3, "b", 2)]
    assert dimension.rows == 4
    assert dimension.size == create_dimension(df, ["s", "n"], "id").size


def test_keys_do_not_depend_on_the_partitioning(spark):
    df = skewed(spark)
    wanted = rows(create_dimension(df, ["a", "b"], "id", small=1 << 40).frame)
    for parts, setting in ((1, "1"), (7, "3"), (16, "40")):
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", setting)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            got = rows(create_dimension(df.repartition(parts), ["a", "b"], "id", small=-1).frame)
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
            spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        assert sorted(r[0] for r in got) == list(range(len(got)))
        assert got == wanted


@BOTH_WAYS
def test_empty_dimension(spark, small):
    df = spark.createDataFrame([], "a string, v int")
    dimension = create_dimension(df, ["a"], "id", small=small)
    assert dimension.rows == 0
    assert attach_key(df, dimension).columns == ["a", "v", "id"]
    assert attach_key(df, dimension, broadcast_limit=-1).count() == 0


def test_a_stored_dimension_is_written_once_and_read_from_there(spark, tmp_path):
    df = skewed(spark)
    for small in (1 << 40, -1):
        written = []

        def store(frame):
            written.append(f"{tmp_path}/{small}")
            frame.write.parquet(written[-1])
            return spark.read.parquet(written[-1])

        dimension = create_dimension(df, ["a", "b"], "id", store, small)
        assert len(written) == 1 and dimension.frame.inputFiles()
        assert all(written[0] in f for f in dimension.frame.inputFiles())
        assert rows(dimension.frame) == rows(create_dimension(df, ["a", "b"], "id").frame)


@BOTH_WAYS
def test_key_on_an_aggregate(spark, small):
    df = spark.createDataFrame([(30, 1.0), (10, 2.0), (20, 3.0)], "sk int, x double")
    assert rows(add_key(df, "id", ["sk"], small=small).frame) == [(0, 10, 2.0), (1, 20, 3.0), (2, 30, 1.0)]


@pytest.mark.parametrize("limit", [None, -1])
@pytest.mark.parametrize("null_safe", [True, False])
def test_lookup_matches_a_plain_join(spark, limit, null_safe):
    df = skewed(spark)
    dimension = create_dimension(df, ["a", "b"], "id")
    got = attach_key(df, dimension, null_safe, broadcast_limit=limit)
    assert got.columns == ["a", "b", "v", "id"]
    assert got.count() == df.count()
    missing = got.filter("id IS NULL").count()
    assert missing == (0 if null_safe else 10000)
    pairs = got.filter("id IS NOT NULL").select("id", "a", "b").distinct()
    known = dimension.frame if null_safe else dimension.frame.filter("a IS NOT NULL")
    assert rows(pairs) == rows(known)


def test_frequent_keys_are_found_and_few(spark):
    dimension = create_dimension(skewed(spark), ["a", "b"], "id", small=-1)
    assert rows(dimension.frequent) == [(0, None, 7)]


def test_lookup_finds_frequent_keys_by_itself(spark):
    """A dimension that was not counted from the table it is looked up for."""
    names = skewed(spark).select("a", "b").distinct()
    dimension = add_key(names, "id", ["a", "b"])
    df = skewed(spark)
    small = attach_key(df, dimension)
    large = attach_key(df, dimension, broadcast_limit=-1)
    assert rows(small.groupBy("id").count()) == rows(large.groupBy("id").count())


@pytest.mark.parametrize("null_safe", [True, False])
@pytest.mark.parametrize("value", ["NULL", "'hot'"])
def test_hot_rows_are_spread(spark, null_safe, value):
    """With broadcasting off, no task of the shuffled lookup gets the hot key whole."""
    hot = spark.range(10000).selectExpr(f"CAST({value} AS STRING) AS a", "CAST(id AS INT) AS v")
    rest = spark.range(20000).selectExpr("CAST(id AS STRING) AS a", "CAST(id AS INT) AS v")
    df = hot.union(rest)
    dimension = create_dimension(df, ["a"], "id")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
    }
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        got = attach_key(df, dimension, null_safe)
        sizes = [
            r["n"] for r in got.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()
        ]
    finally:
        for k in settings:
            spark.conf.unset(k)
    assert sum(sizes) == 30000
    assert max(sizes) < 2 * 30000 / 8


def test_nan_matches_nan(spark):
    df = spark.createDataFrame([(math.nan, 1), (1.5, 2), (None, 3)], "x double, v int")
    dimension = create_dimension(df, ["x"], "id")
    for limit in (None, -1):
        assert attach_key(df, dimension, broadcast_limit=limit).filter("id IS NULL").count() == 0


def largest_share(spark, joined):
    """The most rows in one task of the result, and all of them."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        counts = [r["n"] for r in joined.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    return max(counts), sum(counts)


def test_equal_hot_rows_part(spark):
    df = skewed(spark).repartition(64, F.rand(3)).select("a", "b")
    dimension = create_dimension(df, ["a", "b"], "id")
    most, total = largest_share(spark, attach_key(df, dimension, broadcast_limit=-1))
    assert total == 30000 and most < 8500


def test_hot_keys_of_the_table_that_is_looked_up(spark):
    names = spark.range(20000).selectExpr("id AS a")
    dimension = create_dimension(names, ["a"], "id")
    fact = spark.range(40000).selectExpr("IF(id % 2 = 0, 7, id % 20000) AS a").repartition(64, F.rand(3))
    joined = attach_key(fact, dimension, broadcast_limit=-1)
    assert joined.filter("id <> a").count() == 0
    most, total = largest_share(spark, joined)
    assert total == 40000 and most < 11000


def test_a_lookup_reads_only_what_is_asked_for(spark, tmp_path):
    spark.range(100).selectExpr("id AS a", "id AS unused", "id AS other").write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    joined = attach_key(df, create_dimension(df, ["a"], "key"), broadcast_limit=-1).select("a", "key")
    assert "unused" not in joined._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("kind", ["BINARY", "ARRAY<BIGINT>"])
def test_large_values_are_not_broadcast(spark, kind):
    value = {"BINARY": "CAST(repeat(CAST(id AS STRING), 50000) AS BINARY)", "ARRAY<BIGINT>": "array_repeat(id, 20000)"}[kind]
    dimension = create_dimension(spark.range(200).selectExpr(f"{value} AS v"), ["v"], "key")
    assert dimension.size > 10 << 20


def several(spark):
    """Rows with a hot tuple, missing values and repeated rows, and three dimensions."""
    df = spark.range(12000).selectExpr(
        "IF(id % 3 = 0, NULL, CAST(id % 700 AS INT)) AS a", "CAST(IF(id % 2 = 0, 7, id % 50) AS DOUBLE) AS b",
        "IF(id % 4 = 0, 'hot', CAST(id % 90 AS STRING)) AS c", "id % 5 AS v",
    )
    natural = {"i": ["a", "b"], "j": ["c"], "k": ["b", "c"]}
    return df, [create_dimension(df, columns, key, small=-1) for key, columns in natural.items()]


@pytest.mark.parametrize("counted", [True, False])
@pytest.mark.parametrize("null_safe", [True, False])
@pytest.mark.parametrize("limit", [None, -1, 3000])
def test_several_lookups_equal_one_after_the_other(spark, counted, null_safe, limit):
    df, dimensions = several(spark)
    expected = df
    for d in dimensions:
        expected = attach_key(expected, d, null_safe)
    got = attach_keys(df, dimensions, null_safe, limit, counted)
    assert got.columns == expected.columns
    assert rows(got) == rows(expected)
    narrow = attach_keys(df, dimensions, null_safe, limit, counted, keep=["v"])
    assert rows(narrow) == rows(expected.select("v", "i", "j", "k"))
    assert attach_keys(df.limit(0), dimensions, null_safe, limit, counted).count() == 0


def test_several_lookups_shuffle_the_rows_once(spark):
    df, dimensions = several(spark)
    df = df.withColumn("measure", F.col("v") + 1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = attach_keys(df, dimensions, counted=True)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = plan.splitlines()
    moved = [i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line]
    # The measure is below one exchange only.
    assert sum(any("measure" in below for below in lines[i + 1 : i + 5]) for i in moved) == 1


def test_several_lookups_of_other_types_go_one_by_one(spark):
    df, dimensions = several(spark)
    wide = df.withColumn("b", F.col("b").cast("int"))
    got = attach_keys(wide, dimensions, broadcast_limit=-1)
    assert got.filter("i IS NULL OR k IS NULL").count() == 0


def test_the_hot_tuple_of_several_lookups_is_spread(spark):
    df, dimensions = several(spark)
    joined = attach_keys(df.repartition(64, F.rand(3)), dimensions, broadcast_limit=-1, counted=True)
    most, total = largest_share(spark, joined)
    assert total == 12000 and most < 4000
