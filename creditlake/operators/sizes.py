"""What Spark knows or is told about sizes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

# Bytes of the stored input that one partition of a table's rows gets. Stored columns
# are compressed, so the rows are several times larger where they are compared.
PARTITION_BYTES = 4 << 20
# Columns in one condition from which on Spark's optimizer is slow with what comes above:
# it keeps each condition once for every choice of columns that are renamed since.
WIDE = 12


def session_limit(df: DataFrame) -> int:
    """The session's ``spark.sql.autoBroadcastJoinThreshold`` in bytes."""
    return df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def estimated_size(df: DataFrame) -> int:
    """Spark's estimate of the bytes of ``df``; very large where nothing is known."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def input_size(df: DataFrame) -> int:
    """Bytes of the stored tables and given rows that ``df`` reads; a table read twice counts twice."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size()))


def spread(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` in partitions by ``columns`` that grow in number with its input, and not in size.

    A shuffle that Spark plans has the session's number of partitions, and adaptive
    execution merges them to a size in compressed bytes. Under the broadcast limit, and
    where the size is unknown, that is left as it is.
    """
    size = input_size(df)
    if size <= session_limit(df) or size >= 1 << 60:
        return df
    return df.repartition(-(-size // PARTITION_BYTES), *columns)


def is_stored(df: DataFrame) -> bool:
    """Whether ``df`` is one stored table with columns chosen, renamed or computed from its own row."""
    plan = df._jdf.queryExecution().analyzed()
    if not plan.deterministic():
        return False
    while plan.children().size() == 1 and plan.nodeName() in ("Project", "SubqueryAlias", "View"):
        plan = plan.children().apply(0)
    return plan.nodeName().startswith(("LogicalRelation", "HiveTableRelation", "RelationV2"))


def has_wide_condition(df: DataFrame) -> bool:
    """Whether rows were filtered or joined by more than ``WIDE`` columns at once."""
    open_ = [df._jdf.queryExecution().analyzed()]
    while open_:
        plan = open_.pop()
        if plan.nodeName() in ("Filter", "Join") and plan.references().size() > WIDE:
            return True
        children = plan.children()
        open_ += [children.apply(i) for i in range(children.size())]
    return False
