"""The same queries as SQL for DuckDB, written independently of the library, but for
the column lists of the stars, which ``tests/test_stars.py`` holds against literal ones.

Common table expressions build the sources, the silver tables and the marts;
``_sql`` puts those that a query needs in front of it.
"""

from __future__ import annotations

import re

from checks import views
from creditlake.plans import stars

ANCHOR = "DATE '2025-10-01'"

LABELS = (
    "CASE {0} WHEN 'C' THEN 'Closed' WHEN 'X' THEN 'Unknown' WHEN '0' THEN 'No DPD' "
    "WHEN '1' THEN 'DPD 1-30 days' WHEN '2' THEN 'DPD 31-60 days' WHEN '3' THEN 'DPD 61-90 days' "
    "WHEN '4' THEN 'DPD 91-120 days' WHEN '5' THEN 'DPD > 120 days' END"
)
LEVELS = (
    "CASE {0} WHEN 'Closed' THEN 0 WHEN 'Unknown' THEN 0 WHEN 'No DPD' THEN 0 "
    "WHEN 'DPD 1-30 days' THEN 1 WHEN 'DPD 31-60 days' THEN 2 WHEN 'DPD 61-90 days' THEN 3 "
    "WHEN 'DPD 91-120 days' THEN 4 WHEN 'DPD > 120 days' THEN 5 END"
)
LEGACY_LEVELS = (
    "CASE {0} WHEN 'Closed' THEN 0 WHEN 'Unknown' THEN 0 WHEN 'No DPD' THEN 0 WHEN '1' THEN 1 "
    "WHEN 'DPD 31-60 days' THEN 2 WHEN 'DPD 61-90 days' THEN 3 "
    "WHEN 'DPD 91-120 days' THEN 4 WHEN 'DPD > 120 days' THEN 5 END"
)


def _names(columns: views.Columns) -> list[str]:
    return [name.lower() for name, _, _ in columns]


def _types(columns: views.Columns) -> dict[str, str]:
    return {name.lower(): type_name for name, type_name, _ in columns}


APPLICATION = _names(views.APPLICATION)
BUREAU = _names(views.BUREAU)
PREVIOUS = _names(views.PREVIOUS_APPLICATION)
INSTALLMENTS = _names(views.INSTALLMENTS_PAYMENTS)
CARDS = _names(views.CREDIT_CARD_BALANCE)
POS = _names(views.POS_CASH_BALANCE)
DOCUMENTS = [c for c in APPLICATION if c.startswith("flag_document")]


def _lower(columns: list[str]) -> str:
    return ", ".join(f"{c.upper()} AS {c}" for c in columns)


def _no_outlier(column: str) -> str:
    return f"CASE WHEN {column} > 36500 THEN NULL ELSE {column} END"


def _clean(columns: views.Columns, rounded: bool = True, but: tuple[str, ...] = ()) -> str:
    """The select list after outlier removal and rounding, without ``but``."""
    lines = []
    for column, type_name in _types(columns).items():
        value = _no_outlier(column) if "days" in column else column
        if rounded and type_name == "DOUBLE":
            value = f"round({value}, 4)"
        if column not in but:
            lines.append(f"{value} AS {column}")
    return ",\n  ".join(lines)


def _day(column: str, pattern: str = "%Y-%m-%d", anchor: str = ANCHOR) -> str:
    return f"strftime({anchor} + CAST(trunc({column}) AS INTEGER), '{pattern}')"


def _month(column: str) -> str:
    return f"strftime({ANCHOR} + {column} * 30, '%Y-%m')"


def _ratio(a: str, b: str) -> str:
    return f"{a} / NULLIF({b}, 0)"


CTES: dict[str, str] = {f"raw_{name.lower()}": text for name, text in views.SOURCES.items()}

CTES["everyone"] = f"""
SELECT {_lower(APPLICATION)} FROM raw_application_train
UNION ALL SELECT {_lower(APPLICATION)} FROM raw_application_test"""

CTES["one_each"] = f"""
SELECT * FROM everyone QUALIFY row_number() OVER (
  PARTITION BY sk_id_curr ORDER BY {", ".join(f"{c} NULLS FIRST" for c in APPLICATION[1:])}) = 1"""

CTES["clean_application"] = f"""
SELECT {_clean(views.APPLICATION, but=("cnt_fam_members",))},
  CAST(trunc(cnt_fam_members) AS INTEGER) AS cnt_fam_members
FROM one_each"""

CTES["application"] = f"""
SELECT {", ".join(APPLICATION)},
  CAST(trunc(abs(days_birth) / 365.0) AS INTEGER) AS age,
  {_day("days_birth")} AS date_birth,
  {_day("days_employed")} AS date_employed,
  {_day("days_registration")} AS date_registration,
  {_day("days_last_phone_change")} AS date_last_phone_change,
  {_day("days_id_publish")} AS date_id_publish,
  {_ratio("amt_annuity", "amt_credit")} AS annuity_to_credit_ratio,
  {_ratio("amt_credit", "amt_income_total")} AS credit_to_income_ratio,
  {_ratio("amt_annuity", "amt_income_total")} AS annuity_to_income_ratio,
  {_ratio("amt_credit", "amt_annuity")} AS credit_term
FROM clean_application"""

CTES["application_target"] = """
SELECT SK_ID_CURR AS sk_id_curr, min(TARGET) AS target FROM raw_application_train GROUP BY 1"""

CTES["clean_bureau"] = f"""
SELECT {_clean(views.BUREAU)} FROM (SELECT DISTINCT * FROM raw_bureau) AS d"""

CTES["bureau"] = f"""
SELECT * EXCLUDE (days_credit_update),
  CASE WHEN days_credit_update > 0 THEN -days_credit_update ELSE days_credit_update END
    AS days_credit_update,
  {_ratio("amt_annuity", "amt_credit_sum")} AS annuity_to_credit_ratio
FROM clean_bureau"""

CTES["bureau_balance"] = f"""
SELECT SK_ID_BUREAU AS sk_id_bureau, MONTHS_BALANCE AS months_balance,
  {LABELS.format("STATUS")} AS status, {_month("MONTHS_BALANCE")} AS year_month_balance
FROM (SELECT DISTINCT * FROM raw_bureau_balance) AS d"""

CTES["credit_card_balance"] = f"""
SELECT {_clean(views.CREDIT_CARD_BALANCE)}, {_month("months_balance")} AS year_month_balance
FROM (SELECT DISTINCT * FROM raw_credit_card_balance) AS d"""

CTES["pos_cash_balance"] = f"""
SELECT {_clean(views.POS_CASH_BALANCE)}, {_month("months_balance")} AS year_month_balance
FROM (SELECT DISTINCT * FROM raw_pos_cash_balance) AS d"""

CTES["clean_installments"] = f"""
SELECT {_clean(views.INSTALLMENTS_PAYMENTS, rounded=False)}
FROM (SELECT DISTINCT * FROM raw_installments_payments) AS d"""

CTES["installments_payments"] = f"""
SELECT *, {_day("days_instalment")} AS date_installment,
  {_day("days_entry_payment")} AS date_entry_payment,
  round({_ratio("amt_payment", "amt_instalment")}, 4) AS ratio_payment_installment,
  amt_instalment - amt_payment AS payment_delay
FROM clean_installments"""

CTES["clean_previous"] = f"""
SELECT {_clean(views.PREVIOUS_APPLICATION, rounded=False)}
FROM (SELECT DISTINCT * FROM raw_previous_application) AS d"""

CTES["previous_application"] = f"""
SELECT * EXCLUDE (nflag_insured_on_approval),
  CASE CAST(trunc(nflag_insured_on_approval) AS INTEGER)
    WHEN 0 THEN 'Not Insured' WHEN 1 THEN 'Insured' END AS nflag_insured_on_approval,
  {_day("days_decision")} AS date_decision, {_day("days_first_due")} AS date_first_due,
  {_day("days_last_due_1st_version")} AS date_last_due_1st_version,
  {_day("days_last_due")} AS date_last_due, {_day("days_termination")} AS date_termination
FROM clean_previous"""


def _behavior(levels: str) -> str:
    levelled = f"SELECT *, {levels.format('status')} AS level FROM bureau_balance"
    buckets = ",\n  ".join(f"count(*) FILTER (level = {i}) AS dpd_{i}" for i in range(6))
    return f"""
SELECT sk_id_bureau, max(level) AS max_dpd, avg(level) AS avg_dpd,
  avg(CASE WHEN level > 0 THEN 1 ELSE 0 END) AS delinquency_ratio,
  avg(CASE WHEN level >= 3 THEN 1 ELSE 0 END) AS severe_delinquency_ratio,
  count(months_balance) AS history_length, min(months_balance) AS history_min,
  max(months_balance) AS history_max,
  max(level) FILTER (months_balance >= -3) AS recent_max_dpd,
  avg(level) FILTER (months_balance >= -3) AS recent_avg_dpd,
  {buckets}
FROM ({levelled}) AS l GROUP BY sk_id_bureau"""


CTES["behavior"] = _behavior(LEVELS)
CTES["behavior_legacy"] = _behavior(LEGACY_LEVELS)

CTES["dim_bureau_behavior"] = """
SELECT row_number() OVER (ORDER BY sk_id_bureau NULLS FIRST) - 1 AS bb_id, * FROM behavior"""

CTES["mart_bureau"] = """
SELECT sk_id_curr, count(sk_id_bureau) AS bureau_total_loans,
  count(*) FILTER (credit_active = 'Active') AS bureau_active_loans,
  count(*) FILTER (credit_active = 'Bad debt') AS bureau_bad_debts,
  count(*) FILTER (amt_credit_sum_overdue > 0) AS bureau_loans_with_overdue,
  coalesce(round(sum(amt_credit_sum), 4), 0) AS bureau_total_credit_amt,
  coalesce(sum(amt_credit_sum_debt), 0) AS bureau_total_debt_amt,
  coalesce(sum(amt_credit_sum_overdue), 0) AS bureau_total_overdue_amt,
  coalesce(round(avg(CASE WHEN amt_credit_sum > 0 THEN amt_credit_sum_debt / amt_credit_sum ELSE 0 END), 4), 0)
    AS bureau_avg_debt_ratio
FROM bureau GROUP BY sk_id_curr"""

CTES["mart_previous"] = """
SELECT sk_id_curr, count(sk_id_prev) AS prev_total_apps,
  count(*) FILTER (name_contract_status = 'Approved') AS prev_approved_apps,
  count(*) FILTER (name_contract_status = 'Refused') AS prev_refused_apps,
  coalesce(round(sum(amt_application), 4), 0) AS prev_total_applied_amt,
  coalesce(sum(amt_credit), 0) AS prev_total_granted_credit,
  coalesce(round(avg(amt_down_payment), 4), 0) AS prev_avg_down_payment,
  coalesce(round(count(*) FILTER (name_contract_status = 'Refused') / NULLIF(count(sk_id_prev), 0), 4), 0)
    AS prev_refusal_rate
FROM previous_application GROUP BY sk_id_curr"""

CTES["mart_payment"] = """
SELECT sk_id_curr, count(sk_id_prev) AS pay_total_installments,
  count(*) FILTER (days_entry_payment - days_instalment > 0) AS pay_late_installments,
  count(*) FILTER (amt_payment < amt_instalment) AS pay_underpaid_installments,
  coalesce(max(days_entry_payment - days_instalment), 0) AS pay_max_days_late,
  coalesce(round(avg(days_entry_payment - days_instalment), 4), 0) AS pay_avg_days_late,
  coalesce(round(sum(amt_instalment), 4), 0) AS pay_total_required_amt,
  coalesce(sum(amt_payment), 0) AS pay_total_paid_amt,
  coalesce(round(count(*) FILTER (days_entry_payment - days_instalment > 0) / NULLIF(count(sk_id_prev), 0), 4), 0)
    AS pay_late_rate
FROM installments_payments GROUP BY sk_id_curr"""

SUMMARIES = {
    "mart_bureau": [
        "bureau_total_loans", "bureau_active_loans", "bureau_bad_debts", "bureau_loans_with_overdue",
        "bureau_total_credit_amt", "bureau_total_debt_amt", "bureau_total_overdue_amt",
        "bureau_avg_debt_ratio",
    ],
    "mart_previous": [
        "prev_total_apps", "prev_approved_apps", "prev_refused_apps", "prev_total_applied_amt",
        "prev_total_granted_credit", "prev_avg_down_payment", "prev_refusal_rate",
    ],
    "mart_payment": [
        "pay_total_installments", "pay_late_installments", "pay_underpaid_installments",
        "pay_max_days_late", "pay_avg_days_late", "pay_total_required_amt", "pay_total_paid_amt",
        "pay_late_rate",
    ],
}


def _sql(body: str) -> str:
    """``body`` behind the expressions it needs, in the order they need each other."""
    needed: list[str] = []

    def visit(text: str, self_name: str = "") -> None:
        for name in CTES:
            used = re.search(rf"\b(FROM|JOIN)\s+{name}\b", text)
            if used and name != self_name and name not in needed:
                visit(CTES[name], name)
                needed.append(name)

    visit(body)
    if not needed:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in needed) + "\n" + body


ORACLE: dict[str, str] = {}


def oracle(name: str, body: str) -> None:
    ORACLE[name] = _sql(body)


# Projection and schema

oracle("lower_columns", "SELECT * FROM everyone")
oracle("project_fact", "SELECT sk_id_curr, amt_credit, amt_annuity, ext_source_1 FROM everyone")
oracle(
    "split_target",
    f"SELECT SK_ID_CURR AS sk_id_curr, TARGET AS target, {len(APPLICATION)} AS feature_columns "
    "FROM raw_application_train",
)
oracle("split_features", f"SELECT {_lower(APPLICATION)} FROM raw_application_train")
oracle("union_by_name", "SELECT * FROM everyone")
oracle(
    "union_missing_label",
    "SELECT SK_ID_CURR AS sk_id_curr, TARGET AS target, CODE_GENDER AS code_gender FROM raw_application_train "
    "UNION ALL SELECT SK_ID_CURR, NULL, CODE_GENDER FROM raw_application_test",
)
oracle("key_first", f"SELECT {_lower(BUREAU)} FROM raw_bureau")
oracle(
    "columns_with_prefix",
    "SELECT sk_id_curr, flag_document_2, flag_document_3, flag_document_6, amt_req_credit_bureau_hour, "
    "amt_req_credit_bureau_day, amt_req_credit_bureau_week, amt_req_credit_bureau_mon, "
    "amt_req_credit_bureau_qrt, amt_req_credit_bureau_year FROM everyone",
)
oracle(
    "cast_int",
    "SELECT sk_id_curr, CAST(trunc(cnt_fam_members) AS INTEGER) AS cnt_fam_members, "
    "CAST(trunc(own_car_age) AS BIGINT) AS own_car_age, CAST(trunc(ext_source_1) AS BIGINT) AS ext_source_1 "
    "FROM everyone",
)
_doubles = [c for c, t in _types(views.APPLICATION).items() if t == "DOUBLE"]
oracle(
    "round_floats",
    f"SELECT sk_id_curr, {', '.join(f'round({c}, 4) AS {c}' for c in _doubles)} FROM everyone",
)

# Conditions

_days = [c for c in APPLICATION if "days" in c]
oracle(
    "null_outliers",
    f"SELECT sk_id_curr, {', '.join(f'{_no_outlier(c)} AS {c}' for c in _days)} FROM everyone",
)
oracle(
    "null_outliers_one_column",
    "SELECT sk_id_curr, CASE WHEN days_employed > 40000 THEN NULL ELSE days_employed END AS days_employed, "
    "CAST(NULL AS INTEGER) AS days_none FROM everyone",
)
oracle(
    "sign_fix",
    "SELECT SK_ID_BUREAU AS sk_id_bureau, CASE WHEN DAYS_CREDIT_UPDATE > 0 THEN -DAYS_CREDIT_UPDATE "
    "ELSE DAYS_CREDIT_UPDATE END AS days_credit_update FROM raw_bureau",
)
oracle(
    "flags",
    "SELECT SK_ID_BUREAU AS sk_id_bureau, CASE WHEN CREDIT_ACTIVE = 'Active' THEN 1 ELSE 0 END AS is_active, "
    "CASE WHEN AMT_CREDIT_SUM_OVERDUE > 0 THEN 1 ELSE 0 END AS is_overdue, "
    "CASE WHEN DAYS_ENDDATE_FACT < -1000 THEN 1 ELSE 0 END AS is_long_closed, "
    "CASE WHEN AMT_CREDIT_SUM_DEBT > 500 THEN 'high' ELSE 'low' END AS debt_label FROM raw_bureau",
)
oracle(
    "one_hot",
    "SELECT SK_ID_BUREAU AS sk_id_bureau, MONTHS_BALANCE AS months_balance, STATUS AS status, "
    "TRY_CAST(STATUS AS INTEGER) AS severity, "
    + ", ".join(f"CASE WHEN STATUS = '{i}' THEN 1 ELSE 0 END AS dpd_{i}" for i in range(6))
    + " FROM raw_bureau_balance",
)
_filters = {
    "income over 200000": "everyone WHERE amt_income_total > 200000",
    "employed before": "everyone WHERE days_employed < 0",
    "employed today": "everyone WHERE days_employed = 0",
    "old credit": "raw_bureau WHERE DAYS_CREDIT < -1000",
    "updated in the future": "raw_bureau WHERE DAYS_CREDIT_UPDATE > 0",
    "no delay": "raw_bureau_balance WHERE STATUS = '0'",
    "future month": "raw_credit_card_balance WHERE MONTHS_BALANCE > 0",
    "nothing due": "raw_installments_payments WHERE AMT_INSTALMENT = 0",
}
oracle(
    "filter_count",
    "\nUNION ALL ".join(
        f"SELECT '{name}' AS filter, count(*) AS rows FROM {test}" for name, test in _filters.items()
    ),
)

# Scalars

_ratios = {
    "annuity_to_credit_ratio": ("amt_annuity", "amt_credit"),
    "credit_to_income_ratio": ("amt_credit", "amt_income_total"),
    "annuity_to_income_ratio": ("amt_annuity", "amt_income_total"),
    "credit_term": ("amt_credit", "amt_annuity"),
}
oracle(
    "safe_ratio",
    f"SELECT sk_id_curr, {', '.join(f'{_ratio(a, b)} AS {n}' for n, (a, b) in _ratios.items())} FROM everyone",
)
oracle(
    "ratio_or_zero",
    "SELECT SK_ID_BUREAU AS sk_id_bureau, CASE WHEN AMT_CREDIT_SUM > 0 THEN AMT_CREDIT_SUM_DEBT / AMT_CREDIT_SUM "
    "ELSE 0 END AS debt_ratio FROM raw_bureau",
)
oracle("age_years", "SELECT sk_id_curr, CAST(trunc(abs(days_birth) / 365.0) AS INTEGER) AS age FROM everyone")
_leap = "DATE '2024-02-29'"
oracle(
    "offset_dates",
    f"SELECT sk_id_curr, {_day('days_birth')} AS date_birth, "
    f"{_day(_no_outlier('days_employed'))} AS date_employed, "
    f"{_day('days_registration')} AS date_registration, "
    f"{_day('days_last_phone_change')} AS date_last_phone_change, "
    f"{_day('days_id_publish')} AS date_id_publish, "
    f"{_day('days_birth', anchor=_leap)} AS from_leap_day, "
    f"{_day('days_birth', '%d.%m.%Y', _leap)} AS other_pattern FROM everyone",
)
oracle(
    "offset_dates_today",
    f"SELECT sk_id_curr, {_day('days_birth', anchor='current_date')} AS date_birth, "
    f"{_day('days_registration', anchor='current_date')} AS date_registration, "
    f"{_day('days_id_publish', '%Y/%m', 'current_date')} AS month_id_publish, "
    f"{_day('cnt_children * 30', '%Y-%m', 'current_date')} AS months_ahead FROM everyone",
)
oracle(
    "offset_months",
    f"SELECT MONTHS_BALANCE AS months_balance, {_month('MONTHS_BALANCE')} AS year_month_balance, "
    "count(*) AS rows FROM raw_credit_card_balance GROUP BY 1, 2",
)
oracle(
    "shift_months",
    "SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE) - INTERVAL 6 MONTH, '%Y-%m') AS half_year_before FROM orders",
)
oracle(
    "bureau_dates",
    f"SELECT sk_id_bureau, {_day('days_credit')} AS date_last_credit, "
    f"{_day('days_credit_enddate')} AS date_credit_end, {_day('days_credit_update')} AS date_credit_update FROM bureau",
)
oracle(
    "payment_features",
    "SELECT SK_ID_PREV AS sk_id_prev, round(AMT_PAYMENT / NULLIF(AMT_INSTALMENT, 0), 4) AS ratio_payment_installment, "
    "round(AMT_INSTALMENT - AMT_PAYMENT, 4) AS payment_delay, DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT AS days_late "
    "FROM raw_installments_payments",
)
oracle(
    "map_codes",
    f"SELECT STATUS AS status, {LABELS.format('STATUS')} AS label, count(*) AS rows FROM raw_bureau_balance GROUP BY 1, 2",
)
oracle(
    "map_insured",
    "SELECT SK_ID_PREV AS sk_id_prev, CASE NFLAG_INSURED_ON_APPROVAL WHEN 0 THEN 'Not Insured' WHEN 1 THEN 'Insured' END "
    "AS insured FROM raw_previous_application",
)
oracle(
    "map_severity",
    f"SELECT label, {LEVELS.format('label')} AS severity, {LEGACY_LEVELS.format('label')} AS legacy_severity, "
    f"count(*) AS rows FROM (SELECT {LABELS.format('STATUS')} AS label FROM raw_bureau_balance) AS l GROUP BY 1, 2, 3",
)
oracle(
    "fill_zero",
    "SELECT SK_ID_BUREAU AS sk_id_bureau, CREDIT_TYPE AS credit_type, coalesce(AMT_ANNUITY, 0) AS amt_annuity, "
    "coalesce(AMT_CREDIT_SUM_DEBT, 0) AS amt_credit_sum_debt FROM raw_bureau",
)
oracle(
    "fill_zero_prefix",
    "SELECT SK_ID_BUREAU AS sk_id_bureau, DAYS_ENDDATE_FACT AS days_enddate_fact, "
    "coalesce(AMT_ANNUITY, 0) AS amt_annuity FROM raw_bureau",
)

# Quality

_balance_columns = "SK_ID_BUREAU AS sk_id_bureau, MONTHS_BALANCE AS months_balance, STATUS AS status"
oracle("dedup_rows", f"SELECT DISTINCT {_balance_columns} FROM raw_bureau_balance")
for _name in ("dedup_key", "dedup_key_large"):
    oracle(_name, "SELECT * FROM one_each")
for _name in ("dedup_order", "dedup_order_large"):
    oracle(
        _name,
        f"SELECT {_balance_columns} FROM raw_bureau_balance QUALIFY row_number() OVER "
        "(PARTITION BY SK_ID_BUREAU ORDER BY MONTHS_BALANCE NULLS FIRST, STATUS NULLS FIRST) = 1",
    )
oracle(
    "duplicate_count",
    "SELECT 'row' AS scope, (SELECT count(*) FROM raw_bureau_balance) - "
    "(SELECT count(*) FROM (SELECT DISTINCT * FROM raw_bureau_balance) AS d) AS duplicates UNION ALL "
    "SELECT 'key', (SELECT count(*) FROM raw_bureau_balance) - "
    "(SELECT count(*) FROM (SELECT DISTINCT SK_ID_BUREAU, MONTHS_BALANCE FROM raw_bureau_balance) AS d)",
)


def _per_column(columns: list[str], value: str, test: str, origin: str) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} {test}) AS {value} FROM {origin}" for c in columns
    )


oracle("null_audit", _per_column(APPLICATION, "missing", "IS NULL", "everyone"))
oracle(
    "outlier_count",
    f"SELECT CAST({' + '.join(f'count(*) FILTER ({c} > 36500)' for c in _days)} AS BIGINT) AS outliers FROM everyone",
)
oracle(
    "outlier_counts",
    _per_column([c for c in PREVIOUS if "days" in c], "outliers", "> 36500", "raw_previous_application"),
)


def _report(name: str, columns: list[str], origin: str, kept: str, duplicates: str) -> str:
    lines = [f"SELECT '{name}' AS \"table\", 'duplicates' AS \"check\", CAST(NULL AS VARCHAR) AS \"column\", ({duplicates}) AS value"]
    for c in columns:
        lines.append(f"SELECT '{name}', 'missing', '{c}', count(*) FILTER ({c} IS NULL) FROM {kept}")
    for c in columns:
        if "days" in c:
            lines.append(f"SELECT '{name}', 'outliers', '{c}', count(*) FILTER ({c} > 36500) FROM {kept}")
    return "\nUNION ALL ".join(lines)


def _copies(origin: str, what: str) -> str:
    return f"(SELECT count(*) FROM {origin}) - (SELECT count(*) FROM (SELECT DISTINCT {what} FROM {origin}) AS d)"


_reports = "\nUNION ALL ".join(
    [
        _report("application", APPLICATION, "everyone", "one_each", f"SELECT {_copies('everyone', 'sk_id_curr')}"),
        _report(
            "bureau_balance", ["sk_id_bureau", "months_balance", "status"], "raw_bureau_balance",
            "(SELECT DISTINCT * FROM raw_bureau_balance) AS k", f"SELECT {_copies('raw_bureau_balance', '*')}",
        ),
        _report(
            "bureau", BUREAU, "raw_bureau",
            "(SELECT DISTINCT * FROM raw_bureau) AS k", f"SELECT {_copies('raw_bureau', '*')}",
        ),
    ]
)
oracle("quality_report", _reports)
oracle("quality_audit", _reports)
oracle(
    "quality_clean",
    f"SELECT {', '.join(f'{_no_outlier(c)} AS {c}' if 'days' in c else c for c in APPLICATION)} FROM one_each",
)

# Profiling

_spark_types = {"BIGINT": "bigint", "INT": "int", "DOUBLE": "double", "STRING": "string"}
oracle(
    "profile",
    "\nUNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS \"column\", '{_spark_types[t]}' AS type, count({c}) AS non_null FROM everyone"
        for i, (c, t) in enumerate(_types(views.APPLICATION).items())
    ),
)
oracle(
    "top_n",
    f"SELECT {_lower(BUREAU)} FROM raw_bureau ORDER BY DAYS_CREDIT_ENDDATE NULLS FIRST, SK_ID_BUREAU LIMIT 20",
)
oracle(
    "value_counts",
    "SELECT name_type_suite, count(*) AS rows FROM everyone WHERE name_type_suite IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1",
)
oracle(
    "value_counts_group",
    "SELECT housetype_mode, code_gender, cnt_children, count(*) AS rows FROM everyone "
    "WHERE housetype_mode IS NOT NULL AND code_gender IS NOT NULL AND cnt_children IS NOT NULL "
    "GROUP BY 1, 2, 3 ORDER BY 4 DESC, 1, 2, 3",
)
oracle(
    "value_shares",
    "SELECT emergencystate_mode, count(*) AS rows, round(100 * count(*) / (SELECT count(emergencystate_mode) FROM everyone), 4) "
    "AS percent FROM everyone WHERE emergencystate_mode IS NOT NULL GROUP BY 1",
)


def _describe(columns: list[str], origin: str) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, "
        f"CAST(min({c}) AS DOUBLE) AS min, round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 4) AS q25, "
        f"round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 4) AS q50, "
        f"round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 4) AS q75, CAST(max({c}) AS DOUBLE) AS max FROM {origin}"
        for c in columns
    )


oracle("describe", _describe(["days_employed", "amt_annuity", "own_car_age", "ext_source_3"], "everyone"))
oracle("describe_lineitem", _describe(["l_quantity", "l_extendedprice", "l_partkey"], "lineitem"))
oracle(
    "box_stats",
    """SELECT 'amt_goods_price' AS "column", round(q25, 4) AS q25, round(q50, 4) AS q50, round(q75, 4) AS q75,
  min(amt_goods_price) FILTER (amt_goods_price >= q25 - 1.5 * (q75 - q25)) AS whisker_low,
  max(amt_goods_price) FILTER (amt_goods_price <= q75 + 1.5 * (q75 - q25)) AS whisker_high,
  count(*) FILTER (amt_goods_price < q25 - 1.5 * (q75 - q25) OR amt_goods_price > q75 + 1.5 * (q75 - q25)) AS outliers
FROM everyone, (SELECT quantile_cont(amt_goods_price, 0.25) AS q25, quantile_cont(amt_goods_price, 0.5) AS q50,
  quantile_cont(amt_goods_price, 0.75) AS q75 FROM everyone) AS q
GROUP BY ALL""",
)
CTES["rated"] = (
    f"SELECT {', '.join(f'{_ratio(a, b)} AS {n}' for n, (a, b) in _ratios.items())} FROM everyone"
)
oracle(
    "correlations",
    "\nUNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS correlation FROM rated"
        for a in _ratios
        for b in _ratios
    ),
)


def _histogram(column: str, bins: int, origin: str) -> str:
    return f"""
SELECT CAST(b AS INTEGER) AS bin, round(low + b * width, 4) AS low, round(low + (b + 1) * width, 4) AS high,
  (SELECT count(*) FROM {origin} WHERE least(floor(({column} - low) / width), {bins - 1}) = b) AS rows
FROM range({bins}) AS r(b),
  (SELECT min({column}) AS low, (max({column}) - min({column})) / {float(bins)} AS width FROM {origin}) AS w"""


oracle("histogram", _histogram("days_employed", 50, "everyone"))
oracle("histogram_lineitem", _histogram("l_extendedprice", 20, "lineitem"))

# Behaviour

oracle(
    "behavior",
    "SELECT sk_id_bureau, max_dpd, avg_dpd, delinquency_ratio, severe_delinquency_ratio, history_length, "
    "history_min, history_max FROM behavior",
)
oracle("behavior_recent", "SELECT sk_id_bureau, recent_max_dpd, recent_avg_dpd FROM behavior")
oracle("behavior_buckets", "SELECT sk_id_bureau, dpd_0, dpd_1, dpd_2, dpd_3, dpd_4, dpd_5 FROM behavior")
oracle("behavior_legacy", "SELECT * FROM behavior_legacy")

# Key lookup


def _dimension(origin: str, columns: list[str], key: str) -> str:
    order = ", ".join(f"{c} NULLS FIRST" for c in columns)
    return (
        f"SELECT row_number() OVER (ORDER BY {order}) - 1 AS {key}, {', '.join(columns)} "
        f"FROM (SELECT DISTINCT {', '.join(columns)} FROM {origin}) AS d"
    )


def _matches(columns: list[str], null_safe: bool, side: str) -> str:
    sign = "IS NOT DISTINCT FROM" if null_safe else "="
    return " AND ".join(f"t.{c} {sign} {side}.{c}" for c in columns)


def _keyed(origin: str, show: list[str], columns: list[str], key: str, null_safe: bool) -> str:
    shown = ", ".join(f"t.{c}" for c in show)
    return (
        f"SELECT {shown}, k.{key} FROM {origin} AS t "
        f"LEFT JOIN ({_dimension(origin, columns, key)}) AS k ON {_matches(columns, null_safe, 'k')}"
    )


def _counted(inner: str, columns: list[str]) -> str:
    return f"SELECT {', '.join(columns)}, count(*) AS rows FROM ({inner}) AS q GROUP BY ALL"


oracle(
    "attach_key",
    _counted(
        _keyed("pos_cash_balance", ["months_balance"], ["months_balance"], "month_id", False),
        ["months_balance", "month_id"],
    ),
)
_contract = ["name_contract_type", "name_type_suite"]
oracle("attach_key_multi", _keyed("everyone", ["sk_id_curr", *_contract], _contract, "contract_id", False))
oracle(
    "attach_key_null",
    _counted(
        _keyed("credit_card_balance", ["name_contract_status"], ["name_contract_status"], "cc_status_id", True),
        ["name_contract_status", "cc_status_id"],
    ),
)
_pair = ["credit_active", "days_credit_enddate"]
oracle("attach_key_shuffled", _keyed("bureau", ["sk_id_bureau", *_pair], _pair, "pair_id", True))
oracle("attach_key_shuffled_equal", _keyed("bureau", ["sk_id_bureau", *_pair], _pair, "pair_id", False))

ORACLE["attach_key_other_table"] = (
    "WITH d AS (SELECT code, row_number() OVER (ORDER BY code) - 1 AS code_id "
    "FROM (SELECT DISTINCT c_custkey % 40 AS code FROM customer)), "
    "f AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber < 4 THEN 7 ELSE l_orderkey % 60 END AS code FROM lineitem) "
    "SELECT l_orderkey, l_linenumber, f.code, code_id FROM f LEFT JOIN d ON f.code = d.code"
)
_three = {"pair_id": _pair, "type_id": ["credit_type"], "debt_id": ["amt_credit_sum_debt", "credit_currency", "cnt_credit_prolong"]}


def _three_keys() -> str:
    joins, found = [], ["f.sk_id_bureau", "f.days_credit"]
    for key, natural in _three.items():
        numbered = ", ".join(natural), ", ".join(f"{c} NULLS FIRST" for c in natural)
        side = (
            f"(SELECT {numbered[0]}, row_number() OVER (ORDER BY {numbered[1]}) - 1 AS {key} "
            f"FROM (SELECT DISTINCT {numbered[0]} FROM bureau) AS d)"
        )
        joins.append(f"LEFT JOIN {side} AS {key}_s ON " + " AND ".join(f"f.{c} IS NOT DISTINCT FROM {key}_s.{c}" for c in natural))
        none = " OR ".join(f"f.{c} IS NULL" for c in natural)
        found += [f"{key}_s.{key}", f"CASE WHEN {none} THEN NULL ELSE {key}_s.{key} END AS {key}_equal"]
    return f"SELECT {', '.join(found)} FROM bureau AS f {' '.join(joins)}"


oracle("attach_keys_together", _three_keys())
ORACLE["attach_keys_other_tables"] = (
    "WITH c AS (SELECT code, row_number() OVER (ORDER BY code) - 1 AS code_id "
    "FROM (SELECT DISTINCT c_custkey % 40 AS code FROM customer)), "
    "p AS (SELECT size, rest, row_number() OVER (ORDER BY size, rest) - 1 AS part_id "
    "FROM (SELECT DISTINCT p_size AS size, p_partkey % 7 AS rest FROM part)), "
    "f AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber < 4 THEN 7 ELSE l_orderkey % 60 END AS code, "
    "CAST(l_linenumber * 9 AS INTEGER) AS size, l_orderkey % 9 AS rest FROM lineitem) "
    "SELECT f.*, code_id, part_id FROM f LEFT JOIN c ON f.code = c.code LEFT JOIN p ON f.size = p.size AND f.rest = p.rest"
)
_hot = ["status", "months_balance"]
oracle(
    "attach_key_hot_equal_rows",
    _keyed("(SELECT STATUS AS status, MONTHS_BALANCE AS months_balance FROM raw_bureau_balance)", _hot, _hot, "pair_id", True),
)
ORACLE["load_report"] = " UNION ALL ".join(
    [f"SELECT '{t}' AS \"table\", 'loaded' AS status, count(*) AS rows FROM {t}" for t in ("region", "nation", "supplier")]
    + ["SELECT 'broken', 'failed', NULL"]
)

# Silver jobs

for _table in ("application", "bureau", "bureau_balance", "credit_card_balance", "pos_cash_balance",
               "installments_payments", "previous_application"):
    oracle(f"silver_{_table}", f"SELECT * FROM {_table}")
    # Repeated rows change nothing.
    oracle(f"silver_{_table}_repeated", f"SELECT * FROM {_table}")
oracle("silver_application_target", "SELECT * FROM application_target")
ORACLE["silver_application_changed"] = ORACLE["silver_application"].replace(views.SOURCES["application_test"], views.CHANGED)
ORACLE["silver_application_ordered"] = ORACLE["silver_application_changed"].replace(
    "PARTITION BY sk_id_curr ORDER BY ", "PARTITION BY sk_id_curr ORDER BY amt_income_total NULLS FIRST, "
)

# Gold jobs

STARS = {
    "gold_application": ("application", stars.APPLICATION, ["application_target"]),
    "gold_bureau": ("bureau", stars.BUREAU, ["bureau_balance", "dim_bureau_behavior"]),
    "gold_credit_card_balance": ("credit_card_balance", stars.CREDIT_CARD_BALANCE, []),
    "gold_installments": ("installments_payments", stars.INSTALLMENTS, []),
    "gold_previous_applications": ("previous_application", stars.PREVIOUS_APPLICATION, []),
    "gold_pos_cash_balance": ("pos_cash_balance", stars.POS_CASH_BALANCE, []),
}


def _natural(columns: tuple[str, ...] | str) -> list[str]:
    return DOCUMENTS if isinstance(columns, str) else list(columns)


def _fact(table: str, star: stars.Star, more: tuple[str, ...] = (), null_safe: bool = True) -> str:
    shown, joins = [], []
    keys = {key: _natural(columns) for key, columns in star.dimensions.values()}
    for column in [*star.columns, *more]:
        if column in keys:
            shown.append(f"k_{column}.{column}")
            joins.append(
                f"LEFT JOIN ({_dimension(table, keys[column], column)}) AS k_{column} "
                f"ON {_matches(keys[column], null_safe, f'k_{column}')}"
            )
        elif column == "bb_id":
            shown.append("b.bb_id")
            joins.append("LEFT JOIN dim_bureau_behavior AS b ON t.sk_id_bureau IS NOT DISTINCT FROM b.sk_id_bureau")
        else:
            shown.append(f"t.{column}")
    return f"SELECT {', '.join(shown)} FROM {table} AS t\n" + "\n".join(joins)


for _job, (_table, _star, _more) in STARS.items():
    _counts = []
    for _name, (_key, _columns) in _star.dimensions.items():
        oracle(_name, _dimension(_table, _natural(_columns), _key))
        _columns = ", ".join(_natural(_columns))
        _counts.append((_name, f"(SELECT DISTINCT {_columns} FROM {_table}) AS d"))
    oracle(_star.fact, _fact(_table, _star))
    _counts.append((_star.fact, _table))
    for _extra in _more:
        _stored = {"application_target": "dim_app_target", "bureau_balance": "dim_bureau_balance"}
        _counts.append((_stored.get(_extra, _extra), _extra))
    oracle(
        _job,
        "\nUNION ALL ".join(f"SELECT '{n}' AS \"table\", count(*) AS rows FROM {o}" for n, o in _counts),
    )
ORACLE["dim_contract_large"] = ORACLE["dim_contract"]
oracle("dim_app_target", "SELECT * FROM application_target")
oracle("dim_bureau_balance", "SELECT * FROM bureau_balance")
oracle("dim_behavior", "SELECT * FROM dim_bureau_behavior")
oracle(
    "fact_application_all_keys",
    _fact("application", stars.APPLICATION, more=("info_id", "doc_id", "contact_id")),
)
oracle("fact_application_equal", _fact("application", stars.APPLICATION, null_safe=False))

# Marts

for _mart in SUMMARIES:
    oracle(_mart, f"SELECT * FROM {_mart}")


def _master(join: str) -> str:
    summaries = ",\n  ".join(
        f"coalesce({mart}.{c}, 0) AS {c}" for mart, columns in SUMMARIES.items() for c in columns
    )
    joins = "\n".join(f"LEFT JOIN {m} ON a.sk_id_curr = {m}.sk_id_curr" for m in SUMMARIES)
    return f"""
SELECT a.*, g.target,
  {summaries},
  CASE WHEN g.target = 1 THEN 'Default (Risk)' ELSE 'Good (No Risk)' END AS risk_label
FROM application AS a {join} JOIN application_target AS g ON a.sk_id_curr = g.sk_id_curr
{joins}"""


oracle("mart_master", _master("INNER"))
oracle("pipeline_mart_master", _master("INNER"))
ORACLE["pipeline_fact_bureau"] = ORACLE["fact_bureau"]
_whole_rows = {
    "bureau": BUREAU, "bureau_balance": _names(views.BUREAU_BALANCE), "credit_card_balance": CARDS,
    "pos_cash_balance": POS, "installments_payments": INSTALLMENTS, "previous_application": PREVIOUS,
}
oracle(
    "pipeline_quality_report",
    "\nUNION ALL ".join(
        [_report("application", APPLICATION, "everyone", "one_each", f"SELECT {_copies('everyone', 'sk_id_curr')}")]
        + [
            _report(n, columns, f"raw_{n}", f"(SELECT DISTINCT * FROM raw_{n}) AS k", f"SELECT {_copies(f'raw_{n}', '*')}")
            for n, columns in _whole_rows.items()
        ]
    ),
)
oracle("mart_master_everyone", _master("LEFT"))
