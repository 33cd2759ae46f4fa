"""The registered queries: every operator and job on the loan sources.

Each takes ``(spark, sf_dir)`` and reads the given tables whole. Sums and means
of floating values depend on the order of addition in the last digits, so the
queries round those before they are compared.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from functools import partial, reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from checks.views import CHANGED, SOURCES, given, repeated, source
from creditlake import Layer, build_layers
from creditlake.functions import columns as C
from creditlake.functions import scalars as S
from creditlake.operators import profiling as P
from creditlake.operators import quality as Q
from creditlake.operators.behavior import behavior
from creditlake.operators.dimensions import attach_key, attach_keys, create_dimension
from creditlake.plans import gold, marts, silver, stars
from creditlake.sources.csv import load_all
from creditlake.settings import INSURED_LABELS, LEGACY_SEVERITY, SEVERITY, STATUS_LABELS
from creditlake.staging import scope, stage, staging_folder

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__.rstrip("_")] = function
    return function


# Sources and silver tables


def _train(spark: SparkSession, sf: str) -> DataFrame:
    return C.lower_columns(source(spark, sf, "application_train"))


def _test(spark: SparkSession, sf: str) -> DataFrame:
    return C.lower_columns(source(spark, sf, "application_test"))


def _everyone(spark: SparkSession, sf: str) -> DataFrame:
    return C.union_by_name(_train(spark, sf).drop("target"), _test(spark, sf))


def _raw(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return C.lower_columns(source(spark, sf, name))


def _application(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return silver.silver_application(
        source(spark, sf, "application_train"), source(spark, sf, "application_test")
    )


_SILVER: dict[str, Callable[[DataFrame], dict[str, DataFrame]]] = {
    "bureau": silver.silver_bureau,
    "bureau_balance": silver.silver_bureau_balance,
    "credit_card_balance": silver.silver_credit_card_balance,
    "POS_CASH_balance": silver.silver_pos_cash_balance,
    "installments_payments": silver.silver_installments,
    "previous_application": silver.silver_previous_application,
}


def _silver(spark: SparkSession, sf: str, name: str) -> DataFrame:
    (table,) = _SILVER[name](source(spark, sf, name)).values()
    return table


def _rounded(df: DataFrame, columns: Sequence[str], places: int = 4) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in columns})


# Projection and schema


@query
def lower_columns(spark, sf):
    train, test = (source(spark, sf, f"application_{n}") for n in ("train", "test"))
    return C.lower_columns(train.drop("TARGET").unionByName(test))


@query
def project_fact(spark, sf):
    return _everyone(spark, sf).select("sk_id_curr", "amt_credit", "amt_annuity", "ext_source_1")


@query
def split_target(spark, sf):
    target, features = C.split_target(_train(spark, sf), "sk_id_curr", "target")
    width = F.lit(len(features.columns)).alias("feature_columns")
    return target.select("sk_id_curr", "target", width)


@query
def split_features(spark, sf):
    return C.split_target(_train(spark, sf), "sk_id_curr", "target")[1]


@query
def union_by_name(spark, sf):
    return _everyone(spark, sf)


@query
def union_missing_label(spark, sf):
    both = C.union_by_name(_train(spark, sf), _test(spark, sf), allow_missing=True)
    return both.select("sk_id_curr", "target", "code_gender")


@query
def key_first(spark, sf):
    return C.key_first(_raw(spark, sf, "bureau"), ["sk_id_bureau", "credit_type"])


@query
def columns_with_prefix(spark, sf):
    df = _everyone(spark, sf)
    return df.select("sk_id_curr", *C.columns_with_prefix(df, "flag_document", "amt_req_"))


@query
def cast_int(spark, sf):
    df = _everyone(spark, sf).select("sk_id_curr", "cnt_fam_members", "own_car_age", "ext_source_1")
    df = C.cast_columns(df, ["cnt_fam_members"], "int")
    return C.cast_columns(df, C.columns_of_type(df), "bigint")


@query
def round_floats(spark, sf):
    df = _everyone(spark, sf)
    return C.round_floats(df.select("sk_id_curr", *C.columns_of_type(df)))


# Conditions


@query
def null_outliers(spark, sf):
    df = _everyone(spark, sf)
    days = C.columns_like(df, "days")
    return C.null_above(df.select("sk_id_curr", *days), days, 36500)


@query
def null_outliers_one_column(spark, sf):
    df = _everyone(spark, sf).select("sk_id_curr", "days_employed")
    return C.null_above(df, ["days_employed"], 40000).withColumn("days_none", S.null_of("int"))


@query
def sign_fix(spark, sf):
    fixed = S.negate_positive("days_credit_update").alias("days_credit_update")
    return _raw(spark, sf, "bureau").select("sk_id_bureau", fixed)


@query
def flags(spark, sf):
    df = _raw(spark, sf, "bureau")
    return df.select(
        "sk_id_bureau",
        S.flag(F.col("credit_active") == "Active").alias("is_active"),
        S.flag(F.col("amt_credit_sum_overdue") > 0).alias("is_overdue"),
        S.flag(F.col("days_enddate_fact") < -1000).alias("is_long_closed"),
        S.label_if(F.col("amt_credit_sum_debt") > 500, "high", "low").alias("debt_label"),
    )


@query
def one_hot(spark, sf):
    df = _raw(spark, sf, "bureau_balance").withColumn(
        "severity", F.col("status").try_cast("int")
    )
    return S.one_hot(df, "severity", range(6), "dpd_")


@query
def filter_count(spark, sf):
    app, bureau = _everyone(spark, sf), _raw(spark, sf, "bureau")
    balance, ccb = _raw(spark, sf, "bureau_balance"), _raw(spark, sf, "credit_card_balance")
    payments = _raw(spark, sf, "installments_payments")
    cases = {
        "income over 200000": P.filter_count(app, F.col("amt_income_total") > 200000),
        "employed before": P.filter_count(app, F.col("days_employed") < 0),
        "employed today": P.filter_count(app, F.col("days_employed") == 0),
        "old credit": P.filter_count(bureau, F.col("days_credit") < -1000),
        "updated in the future": P.filter_count(bureau, F.col("days_credit_update") > 0),
        "no delay": P.filter_count(balance, F.col("status") == "0"),
        "future month": P.filter_count(ccb, F.col("months_balance") > 0),
        "nothing due": P.filter_count(payments, F.col("amt_instalment") == 0),
    }
    named = [df.select(F.lit(name).alias("filter"), "rows") for name, df in cases.items()]
    return reduce(DataFrame.unionByName, named)


# Scalars


@query
def safe_ratio(spark, sf):
    df = _everyone(spark, sf)
    ratios = {name: S.safe_ratio(a, b) for name, (a, b) in silver.APPLICATION_RATIOS.items()}
    return df.withColumns(ratios).select("sk_id_curr", *ratios)


@query
def ratio_or_zero(spark, sf):
    share = S.ratio_or_zero("amt_credit_sum_debt", "amt_credit_sum").alias("debt_ratio")
    return _raw(spark, sf, "bureau").select("sk_id_bureau", share)


@query
def age_years(spark, sf):
    return _everyone(spark, sf).select("sk_id_curr", S.age_years("days_birth").alias("age"))


@query
def offset_dates(spark, sf):
    df = C.null_above(_everyone(spark, sf), ["days_employed"], 36500)
    dates = [S.offset_to_date(days).alias(name) for name, days in silver.APPLICATION_DATES.items()]
    other = F.to_date(F.lit("2024-02-29"))
    return df.select(
        "sk_id_curr",
        *dates,
        S.offset_to_date("days_birth", other).alias("from_leap_day"),
        S.offset_to_date("days_birth", other, "dd.MM.yyyy").alias("other_pattern"),
    )


@query
def offset_dates_today(spark, sf):
    """Dates counted from the day of the run."""
    return _everyone(spark, sf).select(
        "sk_id_curr",
        S.offset_to_date("days_birth", None).alias("date_birth"),
        S.offset_date("days_registration", None).cast("string").alias("date_registration"),
        S.offset_to_date("days_id_publish", None, "yyyy/MM").alias("month_id_publish"),
        S.month_offset("cnt_children", None).alias("months_ahead"),
    )


@query
def offset_months(spark, sf):
    df = _raw(spark, sf, "credit_card_balance")
    return df.groupBy(
        "months_balance", S.month_offset("months_balance").alias("year_month_balance")
    ).agg(F.count("*").alias("rows"))


@query
def shift_months(spark, sf):
    df = given(spark, sf, "orders")
    moved = S.shift_months(F.to_date("o_orderdate"), -6).alias("half_year_before")
    return df.select("o_orderkey", moved)


@query
def bureau_dates(spark, sf):
    df = silver.silver_bureau(source(spark, sf, "bureau"), dates=True)["bureau"]
    return df.select("sk_id_bureau", *[F.col(c).cast("string").alias(c) for c in silver.BUREAU_DATES])


@query
def payment_features(spark, sf):
    df = _raw(spark, sf, "installments_payments")
    return df.select(
        "sk_id_prev",
        S.rate("amt_payment", "amt_instalment").alias("ratio_payment_installment"),
        F.round(F.col("amt_instalment") - F.col("amt_payment"), 4).alias("payment_delay"),
        (F.col("days_entry_payment") - F.col("days_instalment")).alias("days_late"),
    )


@query
def map_codes(spark, sf):
    df = _raw(spark, sf, "bureau_balance")
    return df.groupBy("status", S.map_values("status", STATUS_LABELS).alias("label")).agg(
        F.count("*").alias("rows")
    )


@query
def map_insured(spark, sf):
    df = _raw(spark, sf, "previous_application")
    number = F.col("nflag_insured_on_approval").try_cast("int")
    return df.select("sk_id_prev", S.map_values(number, INSURED_LABELS).alias("insured"))


@query
def map_severity(spark, sf):
    label = S.map_values("status", STATUS_LABELS)
    df = _raw(spark, sf, "bureau_balance").withColumn("label", label)
    return df.groupBy(
        "label",
        S.map_values("label", SEVERITY).alias("severity"),
        S.map_values("label", LEGACY_SEVERITY).alias("legacy_severity"),
    ).agg(F.count("*").alias("rows"))


@query
def fill_zero(spark, sf):
    df = _raw(spark, sf, "bureau").select("sk_id_bureau", "credit_type", "amt_annuity", "amt_credit_sum_debt")
    return C.fill_zero(df)


@query
def fill_zero_prefix(spark, sf):
    df = _raw(spark, sf, "bureau").select("sk_id_bureau", "days_enddate_fact", "amt_annuity")
    return C.fill_zero(df, ["amt_"])


# Quality


@query
def dedup_rows(spark, sf):
    return Q.dedup(_raw(spark, sf, "bureau_balance"))


@query
def dedup_key(spark, sf):
    return Q.dedup(_everyone(spark, sf), ["sk_id_curr"])


@query
def dedup_key_large(spark, sf):
    """As ``dedup_key``, the way that tables over the broadcast limit take."""
    return Q.dedup(_everyone(spark, sf), ["sk_id_curr"], small=-1)


@query
def dedup_order_large(spark, sf):
    df = _raw(spark, sf, "bureau_balance")
    return Q.dedup(df, ["sk_id_bureau"], order_by=["months_balance"], small=-1)


@query
def dedup_order(spark, sf):
    df = _raw(spark, sf, "bureau_balance")
    return Q.dedup(df, ["sk_id_bureau"], order_by=["months_balance"])


@query
def duplicate_count(spark, sf):
    df = _raw(spark, sf, "bureau_balance")
    rows = Q.duplicate_count(df).select(F.lit("row").alias("scope"), "duplicates")
    keys = Q.duplicate_count(df, ["sk_id_bureau", "months_balance"])
    return rows.unionByName(keys.select(F.lit("key").alias("scope"), "duplicates"))


@query
def null_audit(spark, sf):
    return Q.missing_counts(_everyone(spark, sf))


@query
def outlier_count(spark, sf):
    return Q.outlier_count(_everyone(spark, sf))


@query
def outlier_counts(spark, sf):
    return Q.outlier_counts(_raw(spark, sf, "previous_application"))


@query
def quality_report(spark, sf):
    _, application = Q.quality_check(_everyone(spark, sf), "application", ["sk_id_curr"])
    _, balance = Q.quality_check(_raw(spark, sf, "bureau_balance"), "bureau_balance")
    _, bureau = Q.quality_check(_raw(spark, sf, "bureau"), "bureau")
    return application.unionByName(balance).unionByName(bureau)


@query
def quality_clean(spark, sf):
    return Q.quality_check(_everyone(spark, sf), "application", ["sk_id_curr"])[0]


@query
def quality_audit(spark, sf):
    """The same counts, observed while the cleaned tables are written."""
    audits = {"application": Observation(), "bureau_balance": Observation(), "bureau": Observation()}
    everyone = _everyone(spark, sf)
    stage(Q.quality_clean(everyone, ["sk_id_curr"], audit=audits["application"]))
    for name in ("bureau_balance", "bureau"):
        stage(Q.quality_clean(_raw(spark, sf, name), audit=audits[name]))
    return Q.audit_report(spark, audits)


# Profiling


@query
def profile(spark, sf):
    return P.profile(_everyone(spark, sf))


@query
def top_n(spark, sf):
    return P.top_n(_raw(spark, sf, "bureau"), ["days_credit_enddate", "sk_id_bureau"], 20)


@query
def value_counts(spark, sf):
    return P.value_counts(_everyone(spark, sf), "name_type_suite")


@query
def value_counts_group(spark, sf):
    return P.value_counts(_everyone(spark, sf), ["housetype_mode", "code_gender", "cnt_children"])


@query
def value_shares(spark, sf):
    return _rounded(P.value_shares(_everyone(spark, sf), "emergencystate_mode"), ["percent"])


@query
def describe(spark, sf):
    columns = ["days_employed", "amt_annuity", "own_car_age", "ext_source_3"]
    stats = P.describe(_everyone(spark, sf), columns)
    return _rounded(stats, ["mean", "std", "q25", "q50", "q75"])


@query
def describe_lineitem(spark, sf):
    stats = P.describe(given(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_partkey"])
    return _rounded(stats, ["mean", "std", "q25", "q50", "q75"])


@query
def box_stats(spark, sf):
    boxed = P.box_stats(_everyone(spark, sf), "amt_goods_price")
    return _rounded(boxed, ["q25", "q50", "q75"])


@query
def correlations(spark, sf):
    ratios = {name: S.safe_ratio(a, b) for name, (a, b) in silver.APPLICATION_RATIOS.items()}
    df = _everyone(spark, sf).withColumns(ratios)
    return _rounded(P.correlations(df, list(ratios)), ["correlation"], 6)


@query
def histogram(spark, sf):
    binned = P.histogram(_everyone(spark, sf), "days_employed", 50)
    return _rounded(binned, ["low", "high"])


@query
def histogram_lineitem(spark, sf):
    binned = P.histogram(given(spark, sf, "lineitem"), "l_extendedprice", 20)
    return _rounded(binned, ["low", "high"])


# Behaviour


def _balance(spark, sf):
    return _silver(spark, sf, "bureau_balance")


@query
def behavior_(spark, sf):
    return behavior(_balance(spark, sf)).select(
        "sk_id_bureau", "max_dpd", "avg_dpd", "delinquency_ratio", "severe_delinquency_ratio",
        "history_length", "history_min", "history_max",
    )


@query
def behavior_recent(spark, sf):
    return behavior(_balance(spark, sf)).select("sk_id_bureau", "recent_max_dpd", "recent_avg_dpd")


@query
def behavior_buckets(spark, sf):
    df = behavior(_balance(spark, sf))
    return df.select("sk_id_bureau", *C.columns_with_prefix(df, "dpd_"))


@query
def behavior_legacy(spark, sf):
    return behavior(_balance(spark, sf), severity=LEGACY_SEVERITY)


@query
def dim_contract_large(spark, sf):
    """Numbered across the cluster, as dimensions of tables over the broadcast limit are."""
    key, columns = stars.APPLICATION.dimensions["dim_contract"]
    return create_dimension(_application(spark, sf)["application"], columns, key, small=-1).frame


# Key lookup


@query
def attach_key_(spark, sf):
    df = _silver(spark, sf, "POS_CASH_balance")
    months = create_dimension(df, ["months_balance"], "month_id")
    keyed = attach_key(df, months, null_safe=False)
    return keyed.groupBy("months_balance", "month_id").agg(F.count("*").alias("rows"))


@query
def attach_key_multi(spark, sf):
    df = _everyone(spark, sf)
    natural = ["name_contract_type", "name_type_suite"]
    return attach_key(df, create_dimension(df, natural, "contract_id"), null_safe=False).select(
        "sk_id_curr", *natural, "contract_id"
    )


@query
def attach_key_null(spark, sf):
    df = _silver(spark, sf, "credit_card_balance")
    status = create_dimension(df, ["name_contract_status"], "cc_status_id")
    keyed = attach_key(df, status)
    return keyed.groupBy("name_contract_status", "cc_status_id").agg(F.count("*").alias("rows"))


@query
def attach_key_shuffled(spark, sf):
    """The lookup in a dimension that is too large to broadcast."""
    df = _silver(spark, sf, "bureau")
    natural = ["credit_active", "days_credit_enddate"]
    dimension = create_dimension(df, natural, "pair_id", small=-1)
    keyed = attach_key(df, dimension, broadcast_limit=0)
    return keyed.select("sk_id_bureau", *natural, "pair_id")


@query
def attach_key_shuffled_equal(spark, sf):
    """The same without matching missing values."""
    df = _silver(spark, sf, "bureau")
    natural = ["credit_active", "days_credit_enddate"]
    dimension = create_dimension(df, natural, "pair_id", small=-1)
    keyed = attach_key(df, dimension, null_safe=False, broadcast_limit=0)
    return keyed.select("sk_id_bureau", *natural, "pair_id")


@query
def attach_key_hot_equal_rows(spark, sf):
    """Narrow rows, most of them equal to many others, in a dimension too large to broadcast."""
    df = _raw(spark, sf, "bureau_balance").select("status", "months_balance")
    dimension = create_dimension(df, ["status", "months_balance"], "pair_id", small=-1)
    return attach_key(df, dimension, broadcast_limit=-1)


@query
def attach_keys_together(spark, sf):
    """Three dimensions that are too large to broadcast, looked up in one shuffle."""
    df = _silver(spark, sf, "bureau")
    dimensions = [
        create_dimension(df, natural, key, small=-1)
        for key, natural in (
            ("pair_id", ["credit_active", "days_credit_enddate"]),
            ("type_id", ["credit_type"]),
            ("debt_id", ["amt_credit_sum_debt", "credit_currency", "cnt_credit_prolong"]),
        )
    ]
    keyed = attach_keys(df, dimensions, broadcast_limit=-1, counted=True, keep=["sk_id_bureau", "days_credit"])
    equal = attach_keys(df, dimensions, null_safe=False, broadcast_limit=-1, keep=["sk_id_bureau"])
    renamed = equal.toDF("sk_id_bureau", *(f"{d.key}_equal" for d in dimensions))
    return keyed.join(renamed, "sk_id_bureau")


@query
def attach_keys_other_tables(spark, sf):
    """Two dimensions counted from other tables; frequent keys are searched for in one pass."""
    customers = given(spark, sf, "customer").selectExpr("c_custkey % 40 AS code", "c_custkey AS customer")
    parts = given(spark, sf, "part").selectExpr("p_size AS size", "p_partkey % 7 AS rest")
    dimensions = [create_dimension(customers, ["code"], "code_id"), create_dimension(parts, ["size", "rest"], "part_id")]
    lines = given(spark, sf, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "IF(l_linenumber < 4, 7, l_orderkey % 60) AS code",
        "CAST(l_linenumber * 9 AS INT) AS size", "l_orderkey % 9 AS rest",
    )
    return attach_keys(lines, dimensions, broadcast_limit=-1)


@query
def attach_key_other_table(spark, sf):
    """The lookup in a dimension whose keys are rare where it was counted and frequent in the fact."""
    customers = given(spark, sf, "customer").selectExpr("c_custkey % 40 AS code", "c_custkey AS customer")
    dimension = create_dimension(customers, ["code"], "code_id")
    lines = given(spark, sf, "lineitem").selectExpr("l_orderkey", "l_linenumber", "IF(l_linenumber < 4, 7, l_orderkey % 60) AS code")
    return attach_key(lines, dimension, broadcast_limit=-1)


@query
def load_report(spark, sf):
    """What loading a folder reports: three given tables as files, and one with a value that does not fit."""
    folder = f"{staging_folder(spark)}/files-{uuid.uuid4().hex}"
    tables = {name: given(spark, sf, name) for name in ("region", "nation", "supplier")}
    tables["broken"] = tables["nation"].selectExpr("n_nationkey AS sk_id_curr", "n_name AS target")
    jvm = spark.sparkContext._jvm.org.apache.hadoop.fs
    at = jvm.Path(folder)
    files = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for name, table in tables.items():
        table.coalesce(1).write.csv(f"{folder}/parts/{name}", header=True)
        (part,) = files.globStatus(jvm.Path(f"{folder}/parts/{name}/part-*"))
        files.mkdirs(jvm.Path(f"{folder}/in"))
        files.rename(part.getPath(), jvm.Path(f"{folder}/in/{name}.csv"))
    report = load_all(spark, f"{folder}/in", Layer(spark, path=f"{folder}/bronze"))
    return report.select("table", "status", "rows")


# Silver jobs


@query
def silver_application(spark, sf):
    return _application(spark, sf)["application"]


@query
def silver_application_target(spark, sf):
    return _application(spark, sf)["application_target"]


for _name in _SILVER:
    QUERIES[f"silver_{_name.lower()}"] = partial(
        lambda spark, sf, name: _silver(spark, sf, name), name=_name
    )


def _silver_repeated(spark, sf, name):
    """The silver table of a source with repeated rows: the same as without."""
    (table,) = _SILVER[name](repeated(spark, sf, name)).values()
    return table


for _name in _SILVER:
    QUERIES[f"silver_{_name.lower()}_repeated"] = partial(_silver_repeated, name=_name)


@query
def silver_application_repeated(spark, sf):
    train, test = (repeated(spark, sf, f"application_{n}") for n in ("train", "test"))
    return silver.silver_application(train, test)["application"]


def _changed(spark, sf, **options):
    train = source(spark, sf, "application_train")
    again = source(spark, sf, "application_test", CHANGED)
    return silver.silver_application(train, again, **options)["application"]


@query
def silver_application_changed(spark, sf):
    """Some customers applied twice, with other data: the smaller row stays."""
    return _changed(spark, sf)


@query
def silver_application_ordered(spark, sf):
    """As before, but the application with the lowest income stays."""
    return _changed(spark, sf, order_by=["amt_income_total"])


# Gold jobs


# A job that makes several tables starts from stored silver, as in the warehouse.


def _stored(df: DataFrame, only: Sequence[str] | None) -> DataFrame:
    single = only is not None and len(only) == 1 and not only[0].startswith("fact_")
    return df if single else stage(df)


def _application_gold(spark, sf, only=None, **options):
    tables = _application(spark, sf)
    application = _stored(tables["application"], only)
    return gold.gold_application(
        application, tables["application_target"], only=only, **options
    )


def _bureau_gold(spark, sf, only=None, **options):
    bureau = _stored(_silver(spark, sf, "bureau"), only)
    return gold.gold_bureau(bureau, _balance(spark, sf), only=only, **options)


def _one_source_gold(job, name):
    def run(spark, sf, only=None, **options):
        return job(_stored(_silver(spark, sf, name), only), only=only, **options)

    return run


_GOLD = {
    "gold_application": (_application_gold, stars.APPLICATION),
    "gold_bureau": (_bureau_gold, stars.BUREAU),
    "gold_credit_card_balance": (
        _one_source_gold(gold.gold_credit_card_balance, "credit_card_balance"),
        stars.CREDIT_CARD_BALANCE,
    ),
    "gold_installments": (
        _one_source_gold(gold.gold_installments, "installments_payments"),
        stars.INSTALLMENTS,
    ),
    "gold_previous_applications": (
        _one_source_gold(gold.gold_previous_applications, "previous_application"),
        stars.PREVIOUS_APPLICATION,
    ),
    "gold_pos_cash_balance": (
        _one_source_gold(gold.gold_pos_cash_balance, "POS_CASH_balance"),
        stars.POS_CASH_BALANCE,
    ),
}


def _gold_table(spark, sf, job, table, **options):
    return job(spark, sf, only=[table], **options)[table]


for _job, _star in _GOLD.values():
    for _table in [*_star.dimensions, _star.fact]:
        QUERIES[_table] = partial(_gold_table, job=_job, table=_table)

for _table in ("dim_app_target",):
    QUERIES[_table] = partial(_gold_table, job=_application_gold, table=_table)

for _table, _name in {"dim_bureau_balance": "dim_bureau_balance", "dim_bureau_behavior": "dim_behavior"}.items():
    QUERIES[_name] = partial(_gold_table, job=_bureau_gold, table=_table)


@query
def fact_application_all_keys(spark, sf):
    return _gold_table(spark, sf, _application_gold, "fact_application", all_keys=True)


@query
def fact_application_equal(spark, sf):
    """The fact when missing values do not match each other."""
    return _gold_table(spark, sf, _application_gold, "fact_application", null_safe=False)


def _row_counts(spark, sf, job):
    tables = job(spark, sf)
    counts = [
        df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


for _name, (_job, _) in _GOLD.items():
    QUERIES[_name] = partial(_row_counts, job=_job)


# Marts

_BUREAU_SUMS = ["bureau_total_credit_amt", "bureau_avg_debt_ratio"]
_PREVIOUS_SUMS = ["prev_total_applied_amt", "prev_avg_down_payment"]
_PAYMENT_SUMS = ["pay_avg_days_late", "pay_total_required_amt"]


def _marts(spark, sf):
    return (
        marts.bureau_summary(_silver(spark, sf, "bureau")),
        marts.previous_summary(_silver(spark, sf, "previous_application")),
        marts.payment_summary(_silver(spark, sf, "installments_payments")),
    )


@query
def mart_bureau(spark, sf):
    return _rounded(marts.bureau_summary(_silver(spark, sf, "bureau")), _BUREAU_SUMS)


@query
def mart_previous(spark, sf):
    return _rounded(
        marts.previous_summary(_silver(spark, sf, "previous_application")), _PREVIOUS_SUMS
    )


@query
def mart_payment(spark, sf):
    return _rounded(
        marts.payment_summary(_silver(spark, sf, "installments_payments")), _PAYMENT_SUMS
    )


def _master(spark, sf, **options):
    tables = _application(spark, sf)
    wide = marts.mart_master(
        tables["application"], tables["application_target"], *_marts(spark, sf), **options
    )
    return _rounded(wide, _BUREAU_SUMS + _PREVIOUS_SUMS + _PAYMENT_SUMS)


@query
def mart_master(spark, sf):
    return _master(spark, sf)


_builds: dict[tuple[str, str], dict[str, Layer]] = {}


def _write_csv(df, path):
    """All rows of ``df`` as CSV files, packed fast; of bounded size each, since a packed file is read by one task."""
    packed = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": 250_000}
    df.write.options(header=True, **packed).csv(path)


def _built(spark, sf):
    """The layers of a whole build, from CSV files; one for each application and folder."""
    key = spark.sparkContext.applicationId, sf
    if key not in _builds:
        folder = f"{staging_folder(spark)}/build-{uuid.uuid4().hex}"
        layers = {n: Layer(spark, path=f"{folder}/{n}") for n in ("bronze", "silver", "gold")}
        # The CSV files are needed until they are loaded, and go with their scope.
        with scope(spark) as landing:
            for name in SOURCES:
                _write_csv(source(spark, sf, name), f"{landing}/csv/{name}.csv")
            build_layers(spark, f"{landing}/csv", *layers.values(), layers=("bronze",))
        build_layers(spark, f"{folder}/csv", *layers.values(), layers=("silver", "gold", "marts"))
        _builds[key] = layers
    return _builds[key]


@query
def pipeline_mart_master(spark, sf):
    """The wide table at the end of the whole build, from CSV files through all layers."""
    wide = _built(spark, sf)["gold"].read("mart_master")
    return _rounded(wide, _BUREAU_SUMS + _PREVIOUS_SUMS + _PAYMENT_SUMS)


@query
def pipeline_fact_bureau(spark, sf):
    """A fact of the whole build."""
    return _built(spark, sf)["gold"].read("fact_bureau")


@query
def pipeline_quality_report(spark, sf):
    """What cleaning found in the whole build, as the silver layer stores it."""
    return _built(spark, sf)["silver"].read("quality_report")


@query
def mart_master_everyone(spark, sf):
    return _master(spark, sf, labelled_only=False)
