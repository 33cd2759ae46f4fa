import os
import time

import pytest

from creditlake import Layer, staging
from creditlake.jobs import together
from creditlake.operators.dimensions import create_dimension
from creditlake.operators import profiling as P
from creditlake.operators.profiling import box_stats
from creditlake.plans.pipeline import build_gold


def staged(spark):
    return sorted(os.listdir(staging.staging_folder(spark)))


def test_staged_tables_are_in_the_checkpoint_folder_and_read_back(spark):
    df = spark.range(10).selectExpr("id", "CAST(id AS STRING) AS s")
    kept = staging.stage(df)
    assert kept.dtypes == df.dtypes
    assert kept.exceptAll(df).isEmpty()
    folder = staging.staging_folder(spark)
    assert folder.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert all(folder in f for f in kept.inputFiles())


def test_a_scope_takes_only_its_own_tables_with_it(spark):
    before = staging.stage(spark.range(3))
    with staging.scope(spark) as folder:
        inside = together([lambda: staging.stage(spark.range(4)), lambda: staging.stage(spark.range(5))], 2)
        assert all(folder in f for df in inside for f in df.inputFiles())
        assert [df.count() for df in inside] == [4, 5]
    assert not os.path.exists(folder)
    assert before.count() == 3


def test_a_failed_scope_leaves_nothing(spark):
    before = staged(spark)
    with pytest.raises(ZeroDivisionError), staging.scope(spark):
        staging.stage(spark.range(3))
        raise ZeroDivisionError
    assert staged(spark) == before


def test_a_dimension_outlives_a_build_and_a_failed_build_leaves_nothing(spark, tmp_path):
    dimension = create_dimension(spark.range(5), ["id"], "key")
    before = staged(spark)
    empty = Layer(spark, path=f"{tmp_path}/silver")
    with pytest.raises(Exception):
        build_gold(empty, Layer(spark, path=f"{tmp_path}/gold"))
    assert staged(spark) == before
    assert dimension.frame.count() == 5


def test_box_stats_leaves_nothing(spark):
    before = staged(spark)
    assert box_stats(spark.range(9).selectExpr("CAST(id AS DOUBLE) AS v"), "v").first()["q50"] == 4
    assert staged(spark) == before


def test_profiles_leave_nothing_however_often_they_are_asked_for(spark):
    df = spark.range(200).selectExpr("CAST(id % 90 AS DOUBLE) AS v", "CAST(id AS DOUBLE) AS w")
    before = staged(spark)
    made = [P.describe(df, ["v", "w"]) for _ in range(20)] + [P.quantiles(df, ["v"]), P.histogram(df, "w", 4)]
    assert staged(spark) == before
    # The frames are whole though nothing is staged any more.
    assert [f.count() for f in made] == [2] * 20 + [1, 4]


def shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    # One listing: files come and go meanwhile.
    files = disk.getAllFiles()
    return sum(files.apply(i).getName().startswith("shuffle") for i in range(files.size()))


def test_a_scope_leaves_no_shuffle_files_and_no_setting(spark):
    setting = spark.conf.get(staging._RELEASE)

    def waited(most):
        for _ in range(100):
            if shuffle_files(spark) <= most:
                return True
            time.sleep(0.1)
        return False

    before = shuffle_files(spark)
    held = spark.range(1000).selectExpr("id % 90 AS k").groupBy("k").count()
    with staging.scope(spark), staging.scope(spark):
        jobs = [lambda i=i: staging.stage(spark.range(1000).selectExpr(f"id % {i + 7} AS k").groupBy("k").count()).count() for i in range(6)]
        assert together(jobs, 3) == [i + 7 for i in range(6)]
        # A frame may be run again after its shuffle files went.
        assert [held.count(), held.count(), len(held.collect()), len(held.collect())] == [90] * 4
        assert spark.conf.get(staging._RELEASE) == "true"
    assert spark.conf.get(staging._RELEASE) == setting
    assert waited(before)


def test_without_a_folder_staging_is_an_error():
    class Context:
        master = "local[2]"

        def getCheckpointDir(self):
            return None

    class Session:
        conf = type("Conf", (), {"get": staticmethod(lambda key, default: default)})
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        staging.staging_folder(Session())


def test_the_first_failure_stops_what_has_not_started():
    ran = []

    def fail():
        raise ValueError("first")

    with pytest.raises(ValueError, match="first"):
        together([fail, *[lambda k=k: ran.append(k) for k in range(50)]], 1)
    assert len(ran) < 50
