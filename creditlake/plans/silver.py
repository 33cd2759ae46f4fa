"""Silver jobs: each takes bronze tables and returns the cleaned tables by name.

With ``audits`` given, every checked table puts an observation into it, which
holds the counts of its quality report once the table is written.
"""

from __future__ import annotations

import datetime
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation

from creditlake.functions.columns import (
    cast_columns,
    lower_columns,
    round_floats,
    split_target,
    union_by_name,
)
from creditlake.functions.scalars import (
    age_years,
    map_values,
    month_offset,
    negate_positive,
    offset_date,
    offset_to_date,
    rate,
    safe_ratio,
)
from creditlake.operators.quality import dedup, quality_clean
from creditlake.settings import ANCHOR_DATE, INSURED_LABELS, STATUS_LABELS

Tables = dict[str, DataFrame]
Audits = dict[str, Observation] | None

# Date column <- day offset.
APPLICATION_DATES = {
    "date_birth": "days_birth",
    "date_employed": "days_employed",
    "date_registration": "days_registration",
    "date_last_phone_change": "days_last_phone_change",
    "date_id_publish": "days_id_publish",
}
INSTALLMENT_DATES = {
    "date_installment": "days_instalment",
    "date_entry_payment": "days_entry_payment",
}
PREVIOUS_DATES = {
    "date_decision": "days_decision",
    "date_first_due": "days_first_due",
    "date_last_due_1st_version": "days_last_due_1st_version",
    "date_last_due": "days_last_due",
    "date_termination": "days_termination",
}
BUREAU_DATES = {
    "date_last_credit": "days_credit",
    "date_credit_end": "days_credit_enddate",
    "date_credit_update": "days_credit_update",
}

# Ratio column <- numerator and denominator.
APPLICATION_RATIOS = {
    "annuity_to_credit_ratio": ("amt_annuity", "amt_credit"),
    "credit_to_income_ratio": ("amt_credit", "amt_income_total"),
    "annuity_to_income_ratio": ("amt_annuity", "amt_income_total"),
    "credit_term": ("amt_credit", "amt_annuity"),
}


def silver_application(
    train: DataFrame,
    test: DataFrame,
    anchor: datetime.date | Column | None = ANCHOR_DATE,
    audits: Audits = None,
    order_by: Sequence[str] | None = None,
) -> Tables:
    """All applications, one per customer, and the label of the labelled ones.

    Of several applications of a customer the first by ``order_by`` stays, then by all columns.
    """
    target, features = split_target(lower_columns(train), "sk_id_curr", "target")
    everyone = union_by_name(features, lower_columns(test))
    clean = _checked(everyone, "application", audits, ["sk_id_curr"], order_by)
    typed = cast_columns(round_floats(clean), ["cnt_fam_members"], "int")
    dated = typed.withColumns(
        {"age": age_years("days_birth")} | _date_columns(APPLICATION_DATES, anchor)
    )
    ratios = {name: safe_ratio(a, b) for name, (a, b) in APPLICATION_RATIOS.items()}
    return {
        "application": dated.withColumns(ratios),
        "application_target": dedup(target, ["sk_id_curr"]),
    }


def silver_bureau(
    df: DataFrame,
    dates: bool = False,
    anchor: datetime.date | Column | None = ANCHOR_DATE,
    audits: Audits = None,
) -> Tables:
    """Credits at other lenders; with ``dates`` three offsets also as dates."""
    clean = round_floats(_checked(lower_columns(df), "bureau", audits))
    more = {
        "days_credit_update": negate_positive("days_credit_update"),
        "annuity_to_credit_ratio": safe_ratio("amt_annuity", "amt_credit_sum"),
    }
    signed = clean.withColumns(more)
    if dates:
        signed = signed.withColumns(
            {name: offset_date(days, anchor) for name, days in BUREAU_DATES.items()}
        )
    return {"bureau": signed}


def silver_bureau_balance(
    df: DataFrame,
    anchor: datetime.date | Column | None = ANCHOR_DATE,
    labels: Mapping[str, str] = STATUS_LABELS,
    audits: Audits = None,
) -> Tables:
    """Monthly status of credits at other lenders, with labels for the codes."""
    clean = _checked(lower_columns(df), "bureau_balance", audits)
    labelled = clean.withColumn("status", map_values("status", labels))
    return {"bureau_balance": _with_month(labelled, anchor)}


def silver_credit_card_balance(
    df: DataFrame,
    anchor: datetime.date | Column | None = ANCHOR_DATE,
    audits: Audits = None,
) -> Tables:
    """Monthly credit-card snapshots."""
    clean = round_floats(_checked(lower_columns(df), "credit_card_balance", audits))
    return {"credit_card_balance": _with_month(clean, anchor)}


def silver_pos_cash_balance(
    df: DataFrame,
    anchor: datetime.date | Column | None = ANCHOR_DATE,
    audits: Audits = None,
) -> Tables:
    """Monthly snapshots of point-of-sale and cash loans."""
    clean = round_floats(_checked(lower_columns(df), "pos_cash_balance", audits))
    return {"pos_cash_balance": _with_month(clean, anchor)}


def silver_installments(
    df: DataFrame,
    anchor: datetime.date | Column | None = ANCHOR_DATE,
    audits: Audits = None,
) -> Tables:
    """Payments of instalments, with the paid share and the amount still open."""
    clean = _checked(lower_columns(df), "installments_payments", audits)
    features = _date_columns(INSTALLMENT_DATES, anchor)
    features["ratio_payment_installment"] = rate("amt_payment", "amt_instalment")
    features["payment_delay"] = clean["amt_instalment"] - clean["amt_payment"]
    return {"installments_payments": clean.withColumns(features)}


def silver_previous_application(
    df: DataFrame,
    anchor: datetime.date | Column | None = ANCHOR_DATE,
    labels: Mapping[int, str] = INSURED_LABELS,
    audits: Audits = None,
) -> Tables:
    """Earlier applications, with dates and the insurance label."""
    clean = _checked(lower_columns(df), "previous_application", audits)
    insured = clean["nflag_insured_on_approval"].try_cast("int")
    features = _date_columns(PREVIOUS_DATES, anchor)
    features["nflag_insured_on_approval"] = map_values(insured, labels)
    return {"previous_application": clean.withColumns(features)}


def _checked(
    df: DataFrame,
    name: str,
    audits: Audits,
    keys: Sequence[str] | None = None,
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    audit = None
    if audits is not None:
        audit = audits[name] = Observation(name)
    return quality_clean(df, keys, audit=audit, order_by=order_by)


def _date_columns(
    offsets: Mapping[str, str], anchor: datetime.date | Column | None
) -> dict[str, Column]:
    return {name: offset_to_date(days, anchor) for name, days in offsets.items()}


def _with_month(df: DataFrame, anchor: datetime.date | Column | None) -> DataFrame:
    return df.withColumn("year_month_balance", month_offset("months_balance", anchor))
