"""Summary tables per customer, and the wide table for dashboards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditlake.functions.columns import fill_zero
from creditlake.functions.scalars import label_if, rate, ratio_or_zero
from creditlake.operators.quality import dedup
from creditlake.settings import NO_RISK_LABEL, RISK_LABEL

CUSTOMER = "sk_id_curr"


def bureau_summary(bureau: DataFrame) -> DataFrame:
    """Credits at other lenders per customer."""
    state = F.col("credit_active")
    return _per_customer(
        bureau,
        bureau_total_loans=F.count("sk_id_bureau"),
        bureau_active_loans=F.count_if(state == "Active"),
        bureau_bad_debts=F.count_if(state == "Bad debt"),
        bureau_loans_with_overdue=F.count_if(F.col("amt_credit_sum_overdue") > 0),
        bureau_total_credit_amt=F.sum("amt_credit_sum"),
        bureau_total_debt_amt=F.sum("amt_credit_sum_debt"),
        bureau_total_overdue_amt=F.sum("amt_credit_sum_overdue"),
        bureau_avg_debt_ratio=F.avg(ratio_or_zero("amt_credit_sum_debt", "amt_credit_sum")),
    )


def previous_summary(previous: DataFrame) -> DataFrame:
    """Earlier applications per customer."""
    state = F.col("name_contract_status")
    counted = _per_customer(
        previous,
        prev_total_apps=F.count("sk_id_prev"),
        prev_approved_apps=F.count_if(state == "Approved"),
        prev_refused_apps=F.count_if(state == "Refused"),
        prev_total_applied_amt=F.sum("amt_application"),
        prev_total_granted_credit=F.sum("amt_credit"),
        prev_avg_down_payment=F.avg("amt_down_payment"),
    )
    refused = rate("prev_refused_apps", "prev_total_apps")
    return counted.withColumn("prev_refusal_rate", F.coalesce(refused, F.lit(0)))


def payment_summary(payments: DataFrame) -> DataFrame:
    """Punctuality and completeness of instalment payments per customer."""
    late = F.col("days_entry_payment") - F.col("days_instalment")
    counted = _per_customer(
        payments,
        pay_total_installments=F.count("sk_id_prev"),
        pay_late_installments=F.count_if(late > 0),
        pay_underpaid_installments=F.count_if(F.col("amt_payment") < F.col("amt_instalment")),
        pay_max_days_late=F.max(late),
        pay_avg_days_late=F.avg(late),
        pay_total_required_amt=F.sum("amt_instalment"),
        pay_total_paid_amt=F.sum("amt_payment"),
    )
    tardy = rate("pay_late_installments", "pay_total_installments")
    return counted.withColumn("pay_late_rate", F.coalesce(tardy, F.lit(0)))


def mart_master(
    application: DataFrame,
    target: DataFrame,
    bureau: DataFrame,
    previous: DataFrame,
    payments: DataFrame,
    labelled_only: bool = True,
) -> DataFrame:
    """Applications with their label and the three summaries, one row per customer.

    Every side has one row per customer, so no key can be frequent, and all
    joins share one partitioning by customer. With ``labelled_only=False``
    applications without label stay in.
    """
    labels = dedup(target, [CUSTOMER])
    wide = application.join(labels, CUSTOMER, "inner" if labelled_only else "left")
    for summary in (bureau, previous, payments):
        wide = wide.join(summary, CUSTOMER, "left")
    risk = label_if(F.col("target") == 1, RISK_LABEL, NO_RISK_LABEL)
    return fill_zero(wide, ("bureau_", "prev_", "pay_")).withColumn("risk_label", risk)


def _per_customer(df: DataFrame, **measures: Column) -> DataFrame:
    # The key is left as it is: a filled key would hide that the rows are
    # already partitioned by customer.
    return df.groupBy(CUSTOMER).agg(
        *[F.coalesce(m, F.lit(0)).alias(n) for n, m in measures.items()]
    )
