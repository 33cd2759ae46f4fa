from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import types as T

from creditlake import Layer
from creditlake.sources.csv import list_csv, load_all, load_csv, source_type


def write(folder, name, text):
    (folder / name).write_text(text)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


RAGGED = "a,b,c\n1,2,3\n4,5\n6,7,8,9\n"


def test_ragged_rows(spark, tmp_path):
    write(tmp_path, "t.csv", RAGGED)
    schema = T.StructType([T.StructField(c, T.IntegerType()) for c in "abc"])
    for given in (None, schema):
        assert rows(load_csv(spark, f"{tmp_path}/t.csv", given)) == [(1, 2, 3), (4, 5, None), (6, 7, 8)]


def test_known_columns_have_fixed_types_and_others_are_inferred(spark, tmp_path):
    write(tmp_path, "b.csv", "SK_ID_BUREAU,STATUS,AMT_CREDIT_SUM,extra\n1,0,5,x\n2,C,,y\n")
    df = load_csv(spark, f"{tmp_path}/b.csv")
    assert df.dtypes == [
        ("SK_ID_BUREAU", "bigint"), ("STATUS", "string"), ("AMT_CREDIT_SUM", "double"), ("extra", "string"),
    ]
    assert rows(df) == [(1, "0", 5.0, "x"), (2, "C", None, "y")]


def test_type_rules():
    assert source_type("DAYS_BIRTH") == "int"
    assert source_type("DAYS_REGISTRATION") == "double"
    assert source_type("CREDIT_DAY_OVERDUE") == "int"
    assert source_type("HOUSETYPE_MODE") == "string"
    assert source_type("FLOORSMAX_MODE") == "double"
    assert source_type("something") is None


def test_a_folder_of_files_with_one_header(spark, tmp_path):
    (tmp_path / "t.csv").mkdir()
    write(tmp_path / "t.csv", "p1.csv", "sk_id_curr,target\n1,0\n")
    write(tmp_path / "t.csv", "p2.csv", "sk_id_curr,target\n2,1\n")
    assert rows(load_csv(spark, f"{tmp_path}/t.csv")) == [(1, 0), (2, 1)]


def test_failing_files_are_reported_and_do_not_stop_the_rest(spark, tmp_path):
    write(tmp_path, "good.csv", "sk_id_curr,target\n1,0\n2,1\n")
    write(tmp_path, "bad.csv", "sk_id_curr,target\n1,zero\n")
    bronze = Layer(spark, path=f"{tmp_path}/bronze")
    report = {
        r["table"]: r
        for r in load_all(spark, str(tmp_path), bronze, ["gone.csv", "bad.csv", "good.csv"]).collect()
    }
    assert report["good"]["status"] == "loaded" and report["good"]["rows"] == 2
    assert report["bad"]["status"] == "failed" and "zero" in report["bad"]["error"]
    assert report["gone"]["status"] == "failed" and report["gone"]["rows"] is None
    assert bronze.read("good").count() == 2


def test_listing(spark, tmp_path):
    write(tmp_path, "b.csv", "x\n1\n")
    write(tmp_path, "a.csv", "x\n1\n")
    write(tmp_path, "c.txt", "x")
    assert list_csv(spark, str(tmp_path)) == ["a.csv", "b.csv"]
    bronze = Layer(spark, path=f"{tmp_path}/bronze")
    assert load_all(spark, str(tmp_path), bronze).count() == 2


def test_folder_layer_round_trip_replaces(spark, tmp_path):
    layer = Layer(spark, path=f"{tmp_path}/gold")
    layer.publish({"a": spark.range(5), "b": spark.range(2)})
    layer.write(spark.range(3), "a")
    assert layer.read("a").count() == 3
    assert layer.read("b").count() == 2


def test_database_layer_round_trip_and_buckets(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS gold_test")
    layer = Layer(spark, database="gold_test")
    layer.write(spark.range(5), "a")
    layer.write(spark.range(4), "a")
    assert layer.read("a").count() == 4
    layer.write(spark.range(100), "left_side", bucket_by="id", buckets=4)
    layer.write(spark.range(50), "right_side", bucket_by="id", buckets=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = layer.read("left_side").join(layer.read("right_side"), "id")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
        assert joined.count() == 50
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_layer_is_a_path_or_a_database(spark):
    with pytest.raises(ValueError):
        Layer(spark)


def test_two_files_for_one_table_are_an_error_before_loading(spark, tmp_path):
    write(tmp_path, "sales.2023.csv", "x\n1\n")
    write(tmp_path, "sales.2024.csv", "x\n2\n")
    bronze = Layer(spark, path=f"{tmp_path}/bronze")
    assert {r["table"] for r in load_all(spark, str(tmp_path), bronze).collect()} == {"sales.2023", "sales.2024"}
    assert rows(bronze.read("sales.2023")) == [(1,)] and rows(bronze.read("sales.2024")) == [(2,)]
    other = Layer(spark, path=f"{tmp_path}/other")
    with pytest.raises(ValueError, match="A.csv, a.csv"):
        load_all(spark, str(tmp_path), other, ["a.csv", "A.csv"])
    assert not (tmp_path / "other").exists()


def failing(spark):
    return spark.range(0, 4, 1, 1).selectExpr("CAST(IF(id = 3, raise_error('late'), id) AS BIGINT) AS id")


def test_a_failed_write_leaves_the_old_table(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS replaced_test")
    for layer in (Layer(spark, path=f"{tmp_path}/layer"), Layer(spark, database="replaced_test")):
        layer.write(spark.range(2), "t")
        with pytest.raises(Exception, match="late"):
            layer.write(failing(spark), "t")
        assert rows(layer.read("t")) == [(0,), (1,)]
        layer.write(layer.read("t").selectExpr("id + 5 AS id"), "t")
        assert rows(layer.read("t")) == [(5,), (6,)]
    # The current version and the one before it; nothing of the failed one.
    assert [p.name for p in (tmp_path / "layer").iterdir()] == ["t"]
    assert len(list((tmp_path / "layer" / "t").glob("data-*"))) == 2
    names = [t.name for t in spark.catalog.listTables("replaced_test")]
    assert sorted(names) == ["t", "t__v000001", "t__v000002"]


@pytest.fixture
def layers(spark, tmp_path):
    name = f"versions_{tmp_path.name}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")
    yield [Layer(spark, path=f"{tmp_path}/layer"), Layer(spark, database=name)]
    spark.sql(f"DROP DATABASE {name} CASCADE")


def versions(layer):
    if layer.path:
        return len(list(Path(layer.path, "t").glob("data-*")))
    return len(layer._versions("t"))


def test_a_switch_that_fails_leaves_the_old_table_and_the_next_write_clears_up(spark, layers, monkeypatch):
    def killed(*_):
        raise KeyboardInterrupt

    for layer in layers:
        layer.write(spark.range(2), "t")
        with monkeypatch.context() as patch:
            patch.setattr(Layer, "_mark", killed)
            patch.setattr(Layer, "_view", killed)
            for _ in range(2):
                with pytest.raises(KeyboardInterrupt):
                    layer.write(spark.range(9), "t")
        assert rows(layer.read("t")) == [(0,), (1,)]
        assert versions(layer) == 3
        layer.write(spark.range(3), "t")
        assert layer.read("t").count() == 3
        # The two that never became current are gone, the one before is kept.
        assert versions(layer) == 2


def test_a_first_write_that_fails_leaves_no_table(spark, layers):
    for layer in layers:
        with pytest.raises(Exception, match="late"):
            layer.write(failing(spark), "t")
        with pytest.raises(Exception):
            layer.read("t").count()
        layer.write(spark.range(1), "t")
        assert layer.read("t").count() == 1


def test_readers_that_have_begun_can_finish(spark, layers):
    for layer in layers:
        layer.write(spark.range(2), "t")
        begun = layer.read("t")
        layer.write(spark.range(7), "t")
        assert begun.count() == 2 and layer.read("t").count() == 7
        for n in range(3):
            layer.write(spark.range(n), "t")
        assert layer.read("t").count() == 2 and versions(layer) == 2


@pytest.mark.parametrize("keep", [0, 2])
def test_number_of_kept_versions(spark, layers, keep):
    for layer in layers:
        layer = replace(layer, keep=keep)
        for n in range(4):
            layer.write(spark.range(n), "t")
        assert layer.read("t").count() == 3 and versions(layer) == keep + 1


def test_plain_tables_from_elsewhere_are_read_and_replaced(spark, layers, monkeypatch):
    folder, database = layers
    spark.range(4).write.parquet(f"{folder.path}/t")
    spark.range(4).write.saveAsTable(f"{database.database}.t")
    for layer in layers:
        assert layer.read("t").count() == 4
    with monkeypatch.context() as patch:
        patch.setattr(Layer, "_view", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            database.write(spark.range(9), "t")
    assert database.read("t").count() == 4
    for layer in layers:
        for n in (5, 6, 7):
            layer.write(spark.range(n), "t")
            assert layer.read("t").count() == n
        assert versions(layer) == 2
    assert not list(Path(folder.path, "t").glob("*.parquet"))


def test_location_is_where_others_read(spark, layers):
    folder, database = layers
    for layer in layers:
        layer.write(spark.range(3), "t")
    assert spark.read.parquet(folder.location("t")).count() == 3
    assert spark.table(database.location("t")).count() == 3


def test_publish_with_buckets(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS buckets_test")
    layer = Layer(spark, database="buckets_test")
    layer.publish({"a": spark.range(10), "b": spark.range(3)}, {"a": ("id", 4)})
    assert "Num Buckets" in {r["col_name"] for r in spark.sql(f"DESCRIBE EXTENDED {layer.location('a')}").collect()}


def test_every_public_text_column_has_a_rule():
    for column in ("OCCUPATION_TYPE", "ORGANIZATION_TYPE", "NAME_EDUCATION_TYPE", "WEEKDAY_APPR_PROCESS_START", "CODE_GENDER"):
        assert source_type(column) == "string"
