"""Monthly delinquency behaviour per credit."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditlake.functions.scalars import flag, map_values
from creditlake.settings import RECENT_FROM_MONTH, SEVERE_FROM, SEVERITY, SEVERITY_LEVELS


def behavior(
    df: DataFrame,
    key: str = "sk_id_bureau",
    month: str = "months_balance",
    status: str = "status",
    severity: Mapping[str, int] = SEVERITY,
    recent_from: int = RECENT_FROM_MONTH,
) -> DataFrame:
    """One row per credit: overall, recent and per-level severity.

    One aggregate with conditional terms covers the whole history, the months
    from ``recent_from`` on, and the histogram of severities, so the monthly
    table is read and shuffled once, after combining in each task.
    """
    # The label is looked up once per row, below the aggregate.
    levelled = df.select(key, month, map_values(status, severity).alias("level"))
    level = F.col("level")
    recent = F.when(F.col(month) >= recent_from, level)
    measures: dict[str, Column] = {
        "max_dpd": F.max(level),
        "avg_dpd": F.avg(level),
        "delinquency_ratio": F.avg(flag(level > 0)),
        "severe_delinquency_ratio": F.avg(flag(level >= SEVERE_FROM)),
        "history_length": F.count(month),
        "history_min": F.min(month),
        "history_max": F.max(month),
        "recent_max_dpd": F.max(recent),
        "recent_avg_dpd": F.avg(recent),
    }
    measures |= {f"dpd_{i}": F.count_if(level == i) for i in range(SEVERITY_LEVELS)}
    return levelled.groupBy(key).agg(*[m.alias(name) for name, m in measures.items()])
