import datetime
import math

from pyspark.sql import functions as F

from creditlake.functions import columns as C
from creditlake.functions import scalars as S
from creditlake.settings import INSURED_LABELS, LEGACY_SEVERITY, SEVERITY, STATUS_LABELS


def values(df):
    return [tuple(r) for r in df.collect()]


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_lower_columns_and_key_first(spark):
    df = C.lower_columns(spark.createDataFrame([(1, 2, 3)], ["A", "bC", "d"]))
    assert df.columns == ["a", "bc", "d"]
    assert C.key_first(df, ["d", "a"]).columns == ["d", "a", "bc"]


def test_column_groups(spark):
    df = spark.createDataFrame([(1.0, 1, "x")], "days_x double, amt_days int, flag_y string")
    assert C.columns_of_type(df) == ["days_x"]
    assert C.columns_like(df, "days") == ["days_x", "amt_days"]
    assert C.columns_with_prefix(df, "flag_", "amt_") == ["amt_days", "flag_y"]


def test_cast_truncates_and_drops_nan(spark):
    df = spark.createDataFrame([(2.9,), (-2.9,), (math.nan,), (None,)], "a double")
    assert values(C.cast_columns(df, ["a"], "int")) == [(2,), (-2,), (None,), (None,)]


def test_round_is_half_up(spark):
    df = spark.createDataFrame([(2.00005, 1), (-0.00005, 2), (None, 3)], "a double, b int")
    assert values(C.round_floats(df)) == [(2.0001, 1), (-0.0001, 2), (None, 3)]


def test_outliers_become_null_also_nan(spark):
    df = spark.createDataFrame([(36500.0,), (36501.0,), (math.nan,), (None,)], "days double")
    cleaned = C.null_above(df, ["days"], 36500)
    assert values(cleaned) == [(36500.0,), (None,), (None,), (None,)]
    assert cleaned.schema == df.schema


def test_union_by_name_is_strict_unless_allowed(spark):
    one_side = spark.createDataFrame([(1, 2)], "a int, b int")
    other = spark.createDataFrame([(3,)], "a int")
    both = C.union_by_name(one_side, other, allow_missing=True)
    assert sorted(values(both)) == [(1, 2), (3, None)]


def test_fill_zero_leaves_text(spark):
    df = spark.createDataFrame([(None, None, None)], "pay_a int, b double, pay_c string")
    assert values(C.fill_zero(df)) == [(0, 0.0, None)]
    assert values(C.fill_zero(df, ["pay_"])) == [(0, None, None)]


def test_missing_counts_nan_only_in_floats(spark):
    df = spark.createDataFrame([(math.nan, None), (None, 1), (1.0, 2)], "a double, b int")
    flags = df.select(*[S.is_missing(f) for f in df.schema.fields])
    assert values(flags) == [(True, True), (True, False), (False, False)]


def test_flags_treat_null_as_zero(spark):
    df = spark.createDataFrame([(1,), (-1,), (None,)], "a int")
    assert values(df.select(S.flag(F.col("a") > 0))) == [(1,), (0,), (0,)]
    assert values(df.select(S.label_if(F.col("a") > 0, "y", "n"))) == [("y",), ("n",), ("n",)]
    assert values(S.one_hot(df, "a", [1, 2], "a_")) == [(1, 1, 0), (-1, 0, 0), (None, 0, 0)]
    assert values(df.select(S.negate_positive("a"))) == [(-1,), (-1,), (None,)]


def test_ratios(spark):
    df = spark.createDataFrame(
        [(1.0, 4.0), (1.0, 0.0), (1.0, None), (None, 2.0), (1.0, -2.0)], "a double, b double"
    )
    assert values(df.select(S.safe_ratio("a", "b"))) == [(0.25,), (None,), (None,), (None,), (-0.5,)]
    assert values(df.select(S.ratio_or_zero("a", "b"))) == [(0.25,), (0.0,), (0.0,), (None,), (0.0,)]
    assert one(spark, S.rate(F.lit(2), F.lit(3))) == 0.6667


def test_age_truncates(spark):
    assert one(spark, S.age_years(F.lit(-(25 * 365 + 364)))) == 25


def test_dates(spark):
    assert one(spark, S.offset_to_date(F.lit(-1.0))) == "2025-09-30"
    assert one(spark, S.offset_to_date(F.lit(math.nan))) is None
    assert one(spark, S.offset_date(F.lit(-30))) == datetime.date(2025, 9, 1)
    assert one(spark, S.offset_date(F.lit(0), None)) == one(spark, F.current_date())
    anchor = datetime.date(2024, 2, 29)
    assert one(spark, S.offset_to_date(F.lit(1), anchor, "dd/MM/yyyy")) == "01/03/2024"


def test_a_month_is_thirty_days_or_a_calendar_month(spark):
    assert one(spark, S.month_offset(F.lit(-3))) == "2025-07"
    assert one(spark, S.month_offset(F.lit(-96))) == "2017-11"
    start = F.lit(datetime.date(2025, 10, 1))
    assert one(spark, S.shift_months(start, -96)) == "2017-10"


def test_lookups(spark):
    df = spark.createDataFrame([("1",), ("C",), ("?",), (None,)], "s string")
    labelled = df.select(S.map_values("s", STATUS_LABELS).alias("s"))
    assert values(labelled) == [("DPD 1-30 days",), ("Closed",), (None,), (None,)]
    assert values(labelled.select(S.map_values("s", SEVERITY)))[:2] == [(1,), (0,)]
    assert values(labelled.select(S.map_values("s", LEGACY_SEVERITY)))[:2] == [(None,), (0,)]
    assert one(spark, S.map_values(F.lit(1), INSURED_LABELS)) == "Insured"
    assert one(spark, S.null_of("int")) is None
