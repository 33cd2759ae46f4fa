"""The loan sources, derived from the given tables.

Each source is a list of ``(column, type, expression)`` over one of the given
tables. The text made from it is valid in Spark SQL and in DuckDB, so a query
and its oracle start from the same rows. Expressions use only arithmetic, CASE
and the types' casts; they put in missing values, zero denominators, sentinels,
outliers and repeated rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditlake.operators.sizes import PARTITION_BYTES, input_size, session_limit

Columns = list[tuple[str, str, str]]


def _pick(expression: str, *values: str) -> str:
    cases = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values[:-1]))
    return f"CASE {expression} {cases} ELSE '{values[-1]}' END"


WEEKDAYS = ("MONDAY", "TUESDAY", "WEDNESDAY", "THURSDAY", "FRIDAY", "SATURDAY", "SUNDAY")

# Customers, and suppliers as new customers without any history.
APPLICANTS = """
SELECT c_custkey AS id, c_nationkey AS nation, c_acctbal AS balance, c_mktsegment AS segment
FROM customer
UNION ALL
SELECT 1000000000 + s_suppkey, s_nationkey, s_acctbal, 'SUPPLIER' FROM supplier
"""

APPLICATION: Columns = [
    ("SK_ID_CURR", "BIGINT", "id"),
    ("NAME_CONTRACT_TYPE", "STRING", "CASE WHEN id % 10 = 0 THEN 'Revolving loans' ELSE 'Cash loans' END"),
    ("NAME_TYPE_SUITE", "STRING", "CASE WHEN id % 23 = 0 THEN NULL WHEN id % 3 = 0 THEN 'Family' ELSE 'Unaccompanied' END"),
    ("CODE_GENDER", "STRING", _pick("id % 2", "F", "M")),
    ("NAME_FAMILY_STATUS", "STRING", _pick("id % 5", "Married", "Single", "Widow", "Separated", "Civil marriage")),
    ("NAME_EDUCATION_TYPE", "STRING", _pick("id % 3", "Secondary", "Higher", "Incomplete")),
    ("NAME_INCOME_TYPE", "STRING", _pick("id % 4", "Working", "Pensioner", "State servant", "Associate")),
    ("ORGANIZATION_TYPE", "STRING", _pick("id % 6", "XNA", "School", "Trade", "Bank", "Police", "Other")),
    ("NAME_HOUSING_TYPE", "STRING", "segment"),
    ("WEEKDAY_APPR_PROCESS_START", "STRING", _pick("id % 7", *WEEKDAYS)),
    ("HOUR_APPR_PROCESS_START", "INT", "id % 24"),
    ("FLAG_OWN_CAR", "STRING", "CASE WHEN id % 3 = 0 THEN 'Y' ELSE 'N' END"),
    ("FLAG_OWN_REALTY", "STRING", "CASE WHEN id % 4 = 0 THEN 'N' ELSE 'Y' END"),
    ("OWN_CAR_AGE", "DOUBLE", "CASE WHEN id % 3 = 0 THEN id % 20 ELSE NULL END"),
    ("CNT_CHILDREN", "INT", "id % 4"),
    ("CNT_FAM_MEMBERS", "DOUBLE", "CASE WHEN id % 97 = 0 THEN NULL ELSE id % 5 + 1 END"),
    ("AMT_INCOME_TOTAL", "DOUBLE", "CASE WHEN id % 50 = 0 THEN 0 ELSE 25000 + (id * 7919) % 200000 END"),
    ("AMT_CREDIT", "DOUBLE", "CASE WHEN id % 47 = 0 THEN 0 ELSE 45000 + (id * 104729) % 900000 END"),
    ("AMT_ANNUITY", "DOUBLE", "CASE WHEN id % 43 = 0 THEN NULL WHEN id % 41 = 0 THEN 0 ELSE 1500 + (id * 31) % 60000 END"),
    ("AMT_GOODS_PRICE", "DOUBLE", "CASE WHEN id % 89 = 0 THEN NULL ELSE 40000 + (id * 91) % 800000 END"),
    ("EXT_SOURCE_1", "DOUBLE", "balance"),
    ("EXT_SOURCE_2", "DOUBLE", "CAST((id * 613) % 997 AS DOUBLE) / 1024"),
    ("EXT_SOURCE_3", "DOUBLE", "CASE WHEN id % 5 = 0 THEN NULL ELSE CAST((id * 389) % 991 AS DOUBLE) / 1024 END"),
    ("REGION_POPULATION_RELATIVE", "DOUBLE", "CAST(nation AS DOUBLE) / 1000"),
    ("REGION_RATING_CLIENT", "INT", "nation % 3 + 1"),
    ("REGION_RATING_CLIENT_W_CITY", "INT", "nation % 3 + 1"),
    ("REG_REGION_NOT_LIVE_REGION", "INT", "CASE WHEN id % 61 = 0 THEN 1 ELSE 0 END"),
    ("REG_REGION_NOT_WORK_REGION", "INT", "CASE WHEN id % 19 = 0 THEN 1 ELSE 0 END"),
    ("LIVE_REGION_NOT_WORK_REGION", "INT", "CASE WHEN id % 29 = 0 THEN 1 ELSE 0 END"),
    ("REG_CITY_NOT_LIVE_CITY", "INT", "CASE WHEN id % 13 = 0 THEN 1 ELSE 0 END"),
    ("REG_CITY_NOT_WORK_CITY", "INT", "CASE WHEN id % 8 = 0 THEN 1 ELSE 0 END"),
    ("LIVE_CITY_NOT_WORK_CITY", "INT", "CASE WHEN id % 9 = 0 THEN 1 ELSE 0 END"),
    ("FLAG_DOCUMENT_2", "INT", "0"),
    ("FLAG_DOCUMENT_3", "INT", "CASE WHEN id % 7 = 0 THEN 1 ELSE 0 END"),
    ("FLAG_DOCUMENT_6", "INT", "CASE WHEN id % 11 = 0 THEN 1 ELSE 0 END"),
    ("FLAG_MOBIL", "INT", "1"),
    ("FLAG_EMP_PHONE", "INT", "CASE WHEN id % 6 = 0 THEN 0 ELSE 1 END"),
    ("FLAG_WORK_PHONE", "INT", "CASE WHEN id % 5 = 0 THEN 1 ELSE 0 END"),
    ("FLAG_CONT_MOBILE", "INT", "CASE WHEN id % 211 = 0 THEN 0 ELSE 1 END"),
    ("FLAG_PHONE", "INT", "CASE WHEN id % 4 = 0 THEN 1 ELSE 0 END"),
    ("FLAG_EMAIL", "INT", "CASE WHEN id % 17 = 0 THEN 1 ELSE 0 END"),
    ("OBS_30_CNT_SOCIAL_CIRCLE", "DOUBLE", "CASE WHEN id % 71 = 0 THEN NULL ELSE id % 8 END"),
    ("DEF_30_CNT_SOCIAL_CIRCLE", "DOUBLE", "CASE WHEN id % 71 = 0 THEN NULL ELSE id % 3 END"),
    ("OBS_60_CNT_SOCIAL_CIRCLE", "DOUBLE", "CASE WHEN id % 71 = 0 THEN NULL ELSE id % 7 END"),
    ("DEF_60_CNT_SOCIAL_CIRCLE", "DOUBLE", "CASE WHEN id % 71 = 0 THEN NULL ELSE id % 2 END"),
    ("AMT_REQ_CREDIT_BUREAU_HOUR", "DOUBLE", "CASE WHEN id % 8 = 0 THEN NULL ELSE 0 END"),
    ("AMT_REQ_CREDIT_BUREAU_DAY", "DOUBLE", "CASE WHEN id % 8 = 0 THEN NULL ELSE id % 2 END"),
    ("AMT_REQ_CREDIT_BUREAU_WEEK", "DOUBLE", "CASE WHEN id % 8 = 0 THEN NULL ELSE id % 3 END"),
    ("AMT_REQ_CREDIT_BUREAU_MON", "DOUBLE", "CASE WHEN id % 8 = 0 THEN NULL ELSE id % 5 END"),
    ("AMT_REQ_CREDIT_BUREAU_QRT", "DOUBLE", "CASE WHEN id % 8 = 0 THEN NULL ELSE id % 4 END"),
    ("AMT_REQ_CREDIT_BUREAU_YEAR", "DOUBLE", "CASE WHEN id % 8 = 0 THEN NULL ELSE id % 9 END"),
    ("DAYS_BIRTH", "INT", "-(7000 + (id * 37) % 18000)"),
    ("DAYS_EMPLOYED", "INT", "CASE WHEN id % 6 = 0 THEN 365243 ELSE -((id * 13) % 9000) END"),
    ("DAYS_REGISTRATION", "DOUBLE", "-((id * 17) % 20000)"),
    ("DAYS_ID_PUBLISH", "INT", "-((id * 19) % 6000)"),
    ("DAYS_LAST_PHONE_CHANGE", "DOUBLE", "CASE WHEN id % 101 = 0 THEN NULL ELSE -((id * 23) % 4000) END"),
    ("HOUSETYPE_MODE", "STRING", "CASE WHEN id % 2 = 0 THEN NULL WHEN id % 3 = 0 THEN 'terraced house' ELSE 'block of flats' END"),
    ("EMERGENCYSTATE_MODE", "STRING", "CASE WHEN id % 2 = 0 THEN NULL WHEN id % 35 = 0 THEN 'Yes' ELSE 'No' END"),
]
TARGET = ("TARGET", "INT", "CASE WHEN id % 12 = 0 THEN 1 ELSE 0 END")

BUREAU: Columns = [
    ("SK_ID_CURR", "BIGINT", "o_custkey"),
    ("SK_ID_BUREAU", "BIGINT", "o_orderkey"),
    ("CREDIT_ACTIVE", "STRING", "CASE o_orderstatus WHEN 'F' THEN 'Closed' WHEN 'O' THEN 'Active' ELSE 'Bad debt' END"),
    ("CREDIT_CURRENCY", "STRING", "CASE WHEN o_orderkey % 29 = 0 THEN 'currency 2' ELSE 'currency 1' END"),
    ("CREDIT_TYPE", "STRING", "o_orderpriority"),
    ("DAYS_CREDIT", "INT", "-(o_orderkey % 2900)"),
    ("CREDIT_DAY_OVERDUE", "INT", "CASE WHEN o_orderkey % 31 = 0 THEN o_orderkey % 90 ELSE 0 END"),
    ("DAYS_CREDIT_ENDDATE", "DOUBLE", "CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 211 = 0 THEN 40000 ELSE o_orderkey % 3000 - 1500 END"),
    ("DAYS_ENDDATE_FACT", "DOUBLE", "CASE WHEN o_orderstatus = 'O' THEN NULL ELSE -(o_orderkey % 1700) END"),
    ("AMT_CREDIT_MAX_OVERDUE", "DOUBLE", "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderkey % 800 END"),
    ("CNT_CREDIT_PROLONG", "INT", "CASE WHEN o_orderkey % 37 = 0 THEN 1 ELSE 0 END"),
    ("AMT_CREDIT_SUM", "DOUBLE", "CASE WHEN o_orderkey % 20 = 0 THEN 0 ELSE o_totalprice END"),
    ("AMT_CREDIT_SUM_DEBT", "DOUBLE", "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderkey % 900 END"),
    ("AMT_CREDIT_SUM_LIMIT", "DOUBLE", "CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderkey % 600 END"),
    ("AMT_CREDIT_SUM_OVERDUE", "DOUBLE", "CASE WHEN o_orderkey % 9 = 0 THEN o_orderkey % 100 ELSE 0 END"),
    ("DAYS_CREDIT_UPDATE", "INT", "o_orderkey % 40 - 35"),
    ("AMT_ANNUITY", "DOUBLE", "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderkey % 700 END"),
]

BUREAU_BALANCE: Columns = [
    ("SK_ID_BUREAU", "BIGINT", "l_orderkey"),
    ("MONTHS_BALANCE", "INT", "-((l_partkey + l_linenumber) % 12)"),
    ("STATUS", "STRING", _pick("(l_suppkey + l_linenumber) % 8", "C", "X", "0", "1", "2", "3", "4", "5")),
]

PREVIOUS_APPLICATION: Columns = [
    ("SK_ID_PREV", "BIGINT", "o_orderkey"),
    ("SK_ID_CURR", "BIGINT", "o_custkey"),
    ("NAME_CONTRACT_TYPE", "STRING", "CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE 'Consumer loans' END"),
    ("AMT_ANNUITY", "DOUBLE", "CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_orderkey % 6000 END"),
    ("AMT_APPLICATION", "DOUBLE", "o_totalprice"),
    ("AMT_CREDIT", "DOUBLE", "o_orderkey % 100000"),
    ("AMT_DOWN_PAYMENT", "DOUBLE", "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderkey % 5000 END"),
    ("AMT_GOODS_PRICE", "DOUBLE", "CASE WHEN o_orderkey % 14 = 0 THEN NULL ELSE o_totalprice END"),
    ("WEEKDAY_APPR_PROCESS_START", "STRING", _pick("o_orderkey % 7", *WEEKDAYS)),
    ("HOUR_APPR_PROCESS_START", "INT", "o_orderkey % 24"),
    ("FLAG_LAST_APPL_PER_CONTRACT", "STRING", "CASE WHEN o_orderkey % 199 = 0 THEN 'N' ELSE 'Y' END"),
    ("NFLAG_LAST_APPL_IN_DAY", "INT", "CASE WHEN o_orderkey % 257 = 0 THEN 0 ELSE 1 END"),
    ("RATE_DOWN_PAYMENT", "DOUBLE", "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(o_orderkey % 64 AS DOUBLE) / 128 END"),
    ("RATE_INTEREST_PRIMARY", "DOUBLE", "CASE WHEN o_orderkey % 53 = 0 THEN CAST(o_orderkey % 32 AS DOUBLE) / 64 ELSE NULL END"),
    ("RATE_INTEREST_PRIVILEGED", "DOUBLE", "CASE WHEN o_orderkey % 53 = 0 THEN CAST(o_orderkey % 16 AS DOUBLE) / 32 ELSE NULL END"),
    ("NAME_CASH_LOAN_PURPOSE", "STRING", _pick("o_orderkey % 4", "XAP", "XNA", "Repairs", "Other")),
    ("NAME_CONTRACT_STATUS", "STRING", "CASE o_orderstatus WHEN 'F' THEN 'Approved' WHEN 'O' THEN 'Refused' ELSE 'Canceled' END"),
    ("DAYS_DECISION", "INT", "-(1 + o_orderkey % 2900)"),
    ("NAME_PAYMENT_TYPE", "STRING", _pick("o_orderkey % 3", "Cash through the bank", "XNA", "Non-cash")),
    ("CODE_REJECT_REASON", "STRING", "CASE WHEN o_orderstatus = 'O' THEN 'HC' ELSE 'XAP' END"),
    ("NAME_TYPE_SUITE", "STRING", "CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE 'Family' END"),
    ("NAME_CLIENT_TYPE", "STRING", _pick("o_orderkey % 3", "Repeater", "New", "Refreshed")),
    ("NAME_GOODS_CATEGORY", "STRING", _pick("o_orderkey % 5", "Mobile", "XNA", "Computers", "Furniture", "Other")),
    ("NAME_PORTFOLIO", "STRING", _pick("o_orderkey % 4", "POS", "Cash", "Cards", "XNA")),
    ("NAME_PRODUCT_TYPE", "STRING", "o_orderpriority"),
    ("CHANNEL_TYPE", "STRING", _pick("o_orderkey % 3", "Stone", "Country-wide", "Contact center")),
    ("SELLERPLACE_AREA", "INT", "o_orderkey % 4000 - 1"),
    ("NAME_SELLER_INDUSTRY", "STRING", _pick("o_orderkey % 3", "Connectivity", "XNA", "Consumer electronics")),
    ("CNT_PAYMENT", "DOUBLE", "CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_orderkey % 60 END"),
    ("NAME_YIELD_GROUP", "STRING", _pick("o_orderkey % 4", "high", "middle", "low_normal", "XNA")),
    ("PRODUCT_COMBINATION", "STRING", "CASE WHEN o_orderkey % 83 = 0 THEN NULL ELSE 'POS household' END"),
    ("DAYS_FIRST_DRAWING", "DOUBLE", "CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 11 = 0 THEN -(o_orderkey % 2700) ELSE 365243 END"),
    ("DAYS_FIRST_DUE", "DOUBLE", "CASE WHEN o_orderkey % 8 = 0 THEN 365243 WHEN o_orderkey % 9 = 0 THEN NULL ELSE -(o_orderkey % 2800) END"),
    ("DAYS_LAST_DUE_1ST_VERSION", "DOUBLE", "CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_orderkey % 2800 - 1400 END"),
    ("DAYS_LAST_DUE", "DOUBLE", "CASE WHEN o_orderkey % 4 = 0 THEN 365243 ELSE -(o_orderkey % 2600) END"),
    ("DAYS_TERMINATION", "DOUBLE", "CASE WHEN o_orderkey % 4 = 0 THEN 365243 ELSE -(o_orderkey % 2500) END"),
    ("NFLAG_INSURED_ON_APPROVAL", "DOUBLE", "CASE WHEN o_orderkey % 4 = 0 THEN NULL WHEN o_orderkey % 4 = 1 THEN 1 ELSE 0 END"),
]

INSTALLMENTS_PAYMENTS: Columns = [
    ("SK_ID_PREV", "BIGINT", "l_orderkey"),
    ("SK_ID_CURR", "BIGINT", "o_custkey"),
    ("NUM_INSTALMENT_VERSION", "DOUBLE", "l_linenumber"),
    ("NUM_INSTALMENT_NUMBER", "INT", "CAST(l_quantity AS BIGINT)"),
    ("DAYS_INSTALMENT", "DOUBLE", "-(l_partkey % 2000)"),
    ("DAYS_ENTRY_PAYMENT", "DOUBLE", "CASE WHEN l_partkey % 31 = 0 THEN NULL ELSE l_suppkey % 15 - 10 - l_partkey % 2000 END"),
    ("AMT_INSTALMENT", "DOUBLE", "CASE WHEN l_partkey % 53 = 0 THEN 0 ELSE l_extendedprice END"),
    ("AMT_PAYMENT", "DOUBLE", "CASE WHEN l_partkey % 31 = 0 THEN NULL ELSE l_suppkey * 100 END"),
]

_SNAPSHOT: Columns = [
    ("SK_ID_PREV", "BIGINT", "event_id % 500"),
    ("SK_ID_CURR", "BIGINT", "user_id"),
    ("MONTHS_BALANCE", "INT", "-(event_id % 96)"),
]
_SNAPSHOT_STATUS: Columns = [
    ("NAME_CONTRACT_STATUS", "STRING", "CASE WHEN event_id % 19 = 0 THEN NULL ELSE event_type END"),
    ("SK_DPD", "INT", "event_id % 40"),
    ("SK_DPD_DEF", "INT", "event_id % 4"),
]

CREDIT_CARD_BALANCE: Columns = [
    *_SNAPSHOT,
    ("AMT_BALANCE", "DOUBLE", "value"),
    ("AMT_CREDIT_LIMIT_ACTUAL", "BIGINT", "event_id % 40 * 5000"),
    ("AMT_DRAWINGS_ATM_CURRENT", "DOUBLE", "CASE WHEN event_id % 5 = 0 THEN NULL ELSE event_id % 300 END"),
    ("AMT_DRAWINGS_CURRENT", "DOUBLE", "event_id % 400"),
    ("AMT_DRAWINGS_OTHER_CURRENT", "DOUBLE", "CASE WHEN event_id % 5 = 0 THEN NULL ELSE event_id % 50 END"),
    ("AMT_DRAWINGS_POS_CURRENT", "DOUBLE", "CASE WHEN event_id % 5 = 0 THEN NULL ELSE event_id % 100 END"),
    ("AMT_INST_MIN_REGULARITY", "DOUBLE", "CASE WHEN event_id % 13 = 0 THEN NULL ELSE event_id % 700 END"),
    ("AMT_PAYMENT_CURRENT", "DOUBLE", "CASE WHEN event_id % 6 = 0 THEN NULL ELSE event_id % 800 END"),
    ("AMT_PAYMENT_TOTAL_CURRENT", "DOUBLE", "event_id % 900"),
    ("AMT_RECEIVABLE_PRINCIPAL", "DOUBLE", "value"),
    ("AMT_RECIVABLE", "DOUBLE", "value"),
    ("AMT_TOTAL_RECEIVABLE", "DOUBLE", "value"),
    ("CNT_DRAWINGS_ATM_CURRENT", "DOUBLE", "CASE WHEN event_id % 5 = 0 THEN NULL ELSE event_id % 6 END"),
    ("CNT_DRAWINGS_CURRENT", "INT", "event_id % 9"),
    ("CNT_DRAWINGS_OTHER_CURRENT", "DOUBLE", "CASE WHEN event_id % 5 = 0 THEN NULL ELSE event_id % 2 END"),
    ("CNT_DRAWINGS_POS_CURRENT", "DOUBLE", "CASE WHEN event_id % 5 = 0 THEN NULL ELSE event_id % 3 END"),
    ("CNT_INSTALMENT_MATURE_CUM", "DOUBLE", "CASE WHEN event_id % 13 = 0 THEN NULL ELSE event_id % 120 END"),
    *_SNAPSHOT_STATUS,
]

POS_CASH_BALANCE: Columns = [
    *_SNAPSHOT,
    ("CNT_INSTALMENT", "DOUBLE", "event_id % 24"),
    ("CNT_INSTALMENT_FUTURE", "DOUBLE", "event_id % 12"),
    *_SNAPSHOT_STATUS,
]


def _select(columns: Columns, origin: str) -> str:
    lines = ",\n  ".join(f"CAST({e} AS {t}) AS {name}" for name, t, e in columns)
    return f"SELECT {lines}\nFROM {origin}"


_APPLICANTS = f"({APPLICANTS}) AS applicants"
# Some labelled customers applied again, with the same data and without label.
_TRAIN = "nation < 20"
_TEST = "nation >= 20 OR segment = 'BUILDING'"

SOURCES: dict[str, str] = {
    "application_train": _select([APPLICATION[0], TARGET, *APPLICATION[1:]], f"{_APPLICANTS}\nWHERE {_TRAIN}"),
    "application_test": _select(APPLICATION, f"{_APPLICANTS}\nWHERE {_TEST}"),
    "bureau": _select(BUREAU, "orders"),
    "bureau_balance": _select(BUREAU_BALANCE, "lineitem"),
    "previous_application": _select(PREVIOUS_APPLICATION, "orders"),
    "installments_payments": _select(
        INSTALLMENTS_PAYMENTS, "lineitem JOIN orders ON l_orderkey = o_orderkey"
    ),
    "credit_card_balance": _select(CREDIT_CARD_BALANCE, "events"),
    "POS_CASH_balance": _select(POS_CASH_BALANCE, "events"),
}

# Second applications whose data differ from the first: which one stays can be seen.
_CHANGED = {
    "NAME_EDUCATION_TYPE": _pick("(id + 1) % 3", "Secondary", "Higher", "Incomplete"),
    "AMT_INCOME_TOTAL": "CASE WHEN id % 50 = 1 THEN NULL ELSE 20000 + (id * 6007) % 210000 END",
    "DAYS_REGISTRATION": "-((id * 29) % 20000)",
}
CHANGED = _select([(n, t, _CHANGED.get(n, e)) for n, t, e in APPLICATION], f"{_APPLICANTS}\nWHERE {_TEST}")

_GIVEN = {
    "application_train": ("customer", "supplier"),
    "application_test": ("customer", "supplier"),
    "bureau": ("orders",),
    "bureau_balance": ("lineitem",),
    "previous_application": ("orders",),
    "installments_payments": ("lineitem", "orders"),
    "credit_card_balance": ("events",),
    "POS_CASH_balance": ("events",),
}


def given(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def source(spark: SparkSession, sf_dir: str, name: str, text: str | None = None) -> DataFrame:
    """A loan source over the given tables, whole; ``text`` replaces its own.

    Large tables that are joined meet in partitions that a task can sort, however large they are.
    """
    tables = {t: given(spark, sf_dir, t) for t in _GIVEN[name]}
    if name == "installments_payments":
        tables = _met(tables, {"lineitem": "l_orderkey", "orders": "o_orderkey"})
    text = (text or SOURCES[name]).replace("{", "{{").replace("}", "}}")
    for table in tables:
        text = text.replace(f"FROM {table}", f"FROM {{{table}}}").replace(
            f"JOIN {table} ", f"JOIN {{{table}}} "
        )
    return spark.sql(text, **tables)


def _met(tables: dict[str, DataFrame], keys: dict[str, str]) -> dict[str, DataFrame]:
    """``tables`` hashed by ``keys`` into one number of partitions, if none is small enough to broadcast."""
    sizes = [input_size(df) for df in tables.values()]
    if min(sizes) <= session_limit(tables[next(iter(keys))]):
        return tables
    parts = -(-sum(sizes) // PARTITION_BYTES)
    return {t: df.repartition(parts, keys[t]) for t, df in tables.items()}


def repeated(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A loan source in which about every third row stands twice."""
    once = source(spark, sf_dir, name)
    return once.union(once.filter(F.pmod(F.xxhash64(*once.columns), F.lit(3)) == 0))
