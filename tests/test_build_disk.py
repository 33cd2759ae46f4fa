"""What a build leaves on disk while it goes on, and how few rows its cleaning moves."""

import glob
import os
import time

import pytest
from pyspark.sql import functions as F

from checks.queries import _built
from creditlake import Layer, staging
from creditlake.operators import quality as Q
from creditlake.operators.dimensions import add_key, attach_key, create_dimension
from creditlake.plans.pipeline import build_marts, build_silver


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture
def stored(spark, tmp_path):
    """Rows with missing values, both zeros and NaN, some of them up to three times."""
    df = spark.range(6000).selectExpr(
        "IF(id % 5 = 0, NULL, CAST(id % 2500 AS INT)) AS a", "IF(id % 2500 % 7 = 0, NULL, IF(id % 3 = 0, 0.0D, -0.0D)) AS b",
        "IF(id % 2500 % 4 = 0, CAST('NaN' AS DOUBLE), CAST(id % 2500 AS DOUBLE)) AS c", "IF(id % 2500 % 11 = 0, NULL, 'x') AS s",
    )
    df.write.parquet(f"{tmp_path}/stored")
    return spark.read.parquet(f"{tmp_path}/stored")


@pytest.mark.parametrize("words", [1, 1 << 18])
def test_marked_rows_are_the_same_as_compared_ones(stored, monkeypatch, words):
    # With one word of 64 bits nearly all rows share a bit with a repeated one.
    monkeypatch.setattr(Q, "_WORDS", words)
    one, two = (Q.dedup(stored, small=small) for small in (1 << 40, -1))
    assert one.dtypes == two.dtypes and one.count() < 6000
    assert rows(one) == rows(two)
    counted = stored.groupBy(*stored.columns).agg(F.count("*").alias("__copies"))
    assert rows(Q._one_per_row(stored)) == rows(counted)
    assert Q._one_per_row(stored.filter("a < 0")).count() == 0


def test_rows_of_their_own_are_not_moved(stored):
    plan = Q.dedup(stored, small=-1)._jdf.queryExecution().sparkPlan()
    assert plan.nodeName() == "Union"
    assert "Exchange REPARTITION" not in plan.children().apply(0).toString()


def test_other_rows_are_compared_as_before(spark, stored, tmp_path):
    """Rows that are computed, or that have no hash, are not read twice."""
    joined = stored.join(spark.range(9), F.col("a") == F.col("id"))
    mapped = stored.withColumn("m", F.create_map(F.lit("k"), F.col("a")))
    random = stored.withColumn("r", F.rand())
    assert not any(Q._is_marked_by_row(df, -1) for df in (joined, mapped, random, stored.select("a", "b")))
    assert Q._is_marked_by_row(stored.toDF("x", "y", "z", "w"), -1) and not Q._is_marked_by_row(stored)


def shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = disk.getAllFiles()
    return sum(files.apply(i).getName().startswith("shuffle") for i in range(files.size()))


def test_layers_leave_no_shuffle_files(spark, tmp_path):
    bronze, silver, gold = (Layer(spark, path=f"{tmp_path}/{n}") for n in ("bronze", "silver", "gold"))
    status = spark.range(500).selectExpr("id % 90 AS SK_ID_BUREAU", "CAST(-(id % 12) AS INT) AS MONTHS_BALANCE", "'C' AS STATUS")
    bronze.write(status, "bureau_balance")
    paid = spark.range(500).selectExpr(
        "id AS sk_id_prev", "id % 90 AS sk_id_curr", "1.0D AS days_entry_payment", "2.0D AS days_instalment",
        "3.0D AS amt_payment", "4.0D AS amt_instalment",
    )
    silver.write(paid, "installments_payments")
    before, setting = shuffle_files(spark), spark.conf.get(staging._RELEASE)
    build_silver(bronze, silver, tables=["bureau_balance"])
    build_marts(silver, gold, tables=["mart_payment_behavior"])
    for _ in range(100):
        if shuffle_files(spark) <= before:
            break
        time.sleep(0.1)
    assert shuffle_files(spark) <= before and spark.conf.get(staging._RELEASE) == setting
    assert silver.read("bureau_balance").count() == 500 - sum(i - 180 >= 0 for i in range(500))
    assert gold.read("mart_payment_behavior").count() == 90


def test_the_csv_files_of_a_build_go_when_they_are_loaded(spark, sf_dir):
    layers = _built(spark, sf_dir)
    assert layers["gold"].read("mart_master").count() > 0
    folder = staging.staging_folder(spark)
    assert not glob.glob(f"{folder}/**/*.csv*", recursive=True)
    assert all(os.path.isdir(layers[n].path) for n in ("bronze", "silver", "gold"))


@pytest.mark.parametrize("null_safe", [True, False])
@pytest.mark.parametrize("counted", [True, False])
def test_a_wide_natural_key_does_not_travel(stored, null_safe, counted):
    """Rows and dimension meet by two hashes, with the same keys as a broadcast finds."""
    columns = ["a", "b", "c"]
    df = stored.withColumn("v", F.xxhash64("s"))
    d = create_dimension(df, columns, "k", small=-1)
    found, plain = (attach_key(df, d, null_safe, limit, counted).select("v", "k") for limit in (-1, 1 << 40))
    assert rows(found) == rows(plain) and found.count() == 6000
    assert not null_safe or found.filter("k IS NULL").isEmpty()
    plan = found._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() != "Join":
        plan = plan.children().apply(0)
    sides = [plan.children().apply(i).output().mkString(",") for i in (0, 1)]
    assert all("h1" in side and not any(f"{c}#" in side.split(",") or f",{c}#" in side for c in columns) for side in sides)


@pytest.mark.parametrize("null_safe", [True, False])
def test_unique_wide_keys_and_other_types(spark, stored, null_safe):
    once = Q.dedup(stored)
    d = add_key(once.withColumn("n", F.xxhash64(*once.columns)), "k", ["n"], ["a", "c", "s"], small=-1)
    assert d.frequent is None
    for df in (stored, stored.withColumn("a", F.col("a").cast("bigint"))):
        found, plain = (attach_key(df, d, null_safe, limit, True) for limit in (-1, 1 << 40))
        assert rows(found) == rows(plain)
