"""The layer jobs: contracts, decisions, and the whole warehouse from CSV files."""

import pytest
from pyspark.sql import functions as F

from checks import views
from creditlake import Layer, build_layers
from creditlake.operators.behavior import behavior
from creditlake.plans import gold, marts, silver, stars
from creditlake.settings import LEGACY_SEVERITY

NATURAL = {
    "fact_application": stars.APPLICATION,
    "fact_bureau": stars.BUREAU,
    "fact_credit_card_balance": stars.CREDIT_CARD_BALANCE,
    "fact_installments_payments": stars.INSTALLMENTS,
    "fact_previous_applications": stars.PREVIOUS_APPLICATION,
    "fact_pos_cash_balance": stars.POS_CASH_BALANCE,
}
SILVER_OF = {
    "fact_application": "application",
    "fact_bureau": "bureau",
    "fact_credit_card_balance": "credit_card_balance",
    "fact_installments_payments": "installments_payments",
    "fact_previous_applications": "previous_application",
    "fact_pos_cash_balance": "pos_cash_balance",
}


@pytest.fixture(scope="module")
def warehouse(spark, sf_dir, tmp_path_factory):
    folder = tmp_path_factory.mktemp("warehouse")
    for name in views.SOURCES:
        views.source(spark, sf_dir, name).write.csv(f"{folder}/csv/{name}.csv", header=True)
    layers = [Layer(spark, path=f"{folder}/{n}") for n in ("bronze", "silver", "gold")]
    report = build_layers(spark, f"{folder}/csv", *layers)
    assert {r["status"] for r in report.collect()} == {"loaded"}
    return dict(zip(("bronze", "silver", "gold"), layers))


def test_bronze_equals_the_source(spark, sf_dir, warehouse):
    for name in views.SOURCES:
        expected = views.source(spark, sf_dir, name)
        stored = warehouse["bronze"].read(name)
        assert stored.dtypes == expected.dtypes
        assert stored.exceptAll(expected).isEmpty()
        assert stored.count() == expected.count()


def test_facts_have_one_row_per_silver_row_and_every_key_resolves(warehouse):
    for fact, star in NATURAL.items():
        table = warehouse["gold"].read(fact)
        assert table.columns == list(star.columns)
        assert table.count() == warehouse["silver"].read(SILVER_OF[fact]).count()
        for name, (key, _) in star.dimensions.items():
            dimension = warehouse["gold"].read(name)
            keys = dimension.agg(F.min(key), F.max(key), F.count_distinct(key), F.count("*")).first()
            assert keys[0] == 0 and keys[1] + 1 == keys[2] == keys[3]
            if key in table.columns:
                assert table.filter(F.col(key).isNull()).isEmpty()
                assert table.join(dimension, key, "left_anti").isEmpty()


def test_dimension_rows_belong_to_their_fact_rows(warehouse):
    """The key of a fact row leads back to the natural key of its silver row."""
    source = warehouse["silver"].read("credit_card_balance")
    fact = warehouse["gold"].read("fact_credit_card_balance")
    status = warehouse["gold"].read("dim_cc_status")
    date = warehouse["gold"].read("dim_cc_date")
    back = fact.join(status, "cc_status_id").join(date, "cc_date_id").select(*source.columns)
    assert back.exceptAll(source).isEmpty() and source.exceptAll(back).isEmpty()


def test_gold_has_all_tables(spark, warehouse):
    names = {d for star in NATURAL.values() for d in star.dimensions} | set(NATURAL)
    names |= {"dim_app_target", "dim_bureau_balance", "dim_bureau_behavior"}
    names |= {"mart_bureau_summary", "mart_previous_app_summary", "mart_payment_behavior", "mart_master"}
    assert len(names) == 33
    for name in names:
        assert not warehouse["gold"].read(name).isEmpty()


def test_severity_histogram_adds_up(warehouse):
    table = warehouse["gold"].read("dim_bureau_behavior")
    levels = sum(F.col(f"dpd_{i}") for i in range(6))
    assert table.filter(levels != F.col("history_length")).isEmpty()


def test_quality_report_is_stored(warehouse):
    report = warehouse["silver"].read("quality_report")
    assert report.select("table").distinct().count() == 7
    found = report.filter("check = 'duplicates' AND table = 'application'").first()["value"]
    train, test = (warehouse["bronze"].read(f"application_{n}") for n in ("train", "test"))
    assert found == train.count() + test.count() - warehouse["silver"].read("application").count()


def test_no_later_layer_after_a_failed_load(spark, tmp_path):
    layers = [Layer(spark, path=f"{tmp_path}/{n}") for n in ("bronze", "silver", "gold")]
    with pytest.raises(RuntimeError, match="bureau"):
        build_layers(spark, f"{tmp_path}/none", *layers, files=["bureau.csv"])


def test_missing_columns_are_an_error_unless_skipped(spark):
    df = spark.createDataFrame([(1, 2, 3)], "sk_id_prev int, sk_id_curr int, months_balance int")
    df = df.withColumn("name_contract_status", F.lit("Active"))
    with pytest.raises(Exception, match="year_month_balance"):
        gold.gold_pos_cash_balance(df)
    tables = gold.gold_pos_cash_balance(df, skip_missing=True)
    assert tables["fact_pos_cash_balance"].columns == ["sk_id_prev", "sk_id_curr", "pos_status_id", "pos_date_id"]


def history(spark):
    rows = [
        (1, 0, "DPD 1-30 days"), (1, -3, "DPD 61-90 days"), (1, -4, "DPD > 120 days"), (1, -5, "Closed"),
        (2, -9, "No DPD"), (3, -1, None),
    ]
    return spark.createDataFrame(rows, "sk_id_bureau int, months_balance int, status string")


def test_behaviour(spark):
    got = {r["sk_id_bureau"]: r for r in behavior(history(spark)).collect()}
    one = got[1].asDict()
    assert (one["max_dpd"], one["avg_dpd"], one["delinquency_ratio"]) == (5, 2.25, 0.75)
    assert (one["severe_delinquency_ratio"], one["recent_max_dpd"], one["recent_avg_dpd"]) == (0.5, 3, 2.0)
    assert (one["history_length"], one["history_min"], one["history_max"]) == (4, -5, 0)
    assert [one[f"dpd_{i}"] for i in range(6)] == [1, 1, 0, 1, 0, 1]
    assert got[2]["recent_max_dpd"] is None and got[2]["max_dpd"] == 0
    assert got[3]["max_dpd"] is None and got[3]["delinquency_ratio"] == 0


def test_legacy_severity_has_no_first_level(spark):
    got = behavior(history(spark), severity=LEGACY_SEVERITY).filter("sk_id_bureau = 1").first()
    assert got["dpd_1"] == 0
    assert got["avg_dpd"] == pytest.approx(8 / 3)
    assert got["delinquency_ratio"] == 0.5


def test_a_credit_without_history_has_no_behaviour_key(spark):
    names = set(stars.BUREAU.columns) - {"status_id", "bureau_date_id", "bb_id", "sk_id_bureau"}
    natural = {c for _, cols in stars.BUREAU.dimensions.values() for c in cols}
    bureau = spark.createDataFrame([(1,), (7,)], "sk_id_bureau int")
    bureau = bureau.withColumns({c: F.lit(None).cast("double") for c in names | natural})
    fact = gold.gold_bureau(bureau, history(spark))["fact_bureau"]
    assert {r["sk_id_bureau"]: r["bb_id"] for r in fact.collect()} == {1: 0, 7: None}


def test_target_comes_from_before_the_dedup_and_is_unique(spark, sf_dir):
    train = views.source(spark, sf_dir, "application_train")
    tables = silver.silver_application(
        train.union(train), views.source(spark, sf_dir, "application_test")
    )
    assert tables["application_target"].count() == train.count()
    assert "target" not in tables["application"].columns


def master_inputs(spark):
    application = spark.createDataFrame([(1,), (2,), (3,)], "sk_id_curr int")
    target = spark.createDataFrame([(1, 1), (2, 0), (2, 0)], "sk_id_curr int, target int")
    bureau = spark.createDataFrame([(1, 4)], "sk_id_curr int, bureau_total_loans int")
    previous = spark.createDataFrame([(9, 4)], "sk_id_curr int, prev_total_apps int")
    payments = spark.createDataFrame([(1, None)], "sk_id_curr int, pay_total_paid_amt double")
    return application, target, bureau, previous, payments


def test_master_keeps_labelled_customers_without_history(spark):
    got = {r["sk_id_curr"]: r for r in marts.mart_master(*master_inputs(spark)).collect()}
    assert set(got) == {1, 2}
    assert got[1]["risk_label"] == "Default (Risk)" and got[2]["risk_label"] == "Good (No Risk)"
    assert (got[1]["bureau_total_loans"], got[2]["bureau_total_loans"]) == (4, 0)
    assert (got[1]["prev_total_apps"], got[1]["pay_total_paid_amt"]) == (0, 0.0)


def test_master_can_keep_everyone(spark):
    got = marts.mart_master(*master_inputs(spark), labelled_only=False)
    assert got.count() == 3
    assert got.filter("sk_id_curr = 3").first()["risk_label"] == "Good (No Risk)"


def test_master_needs_no_shuffle_beyond_one_per_input(spark):
    bureau = spark.range(100).selectExpr("id % 9 AS sk_id_curr", "id AS sk_id_bureau", "'Active' AS credit_active",
                                         "1.0D AS amt_credit_sum", "1.0D AS amt_credit_sum_debt", "0.0D AS amt_credit_sum_overdue")
    application = spark.range(9).selectExpr("id AS sk_id_curr")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = application.join(marts.bureau_summary(bureau), "sk_id_curr", "left")
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2
