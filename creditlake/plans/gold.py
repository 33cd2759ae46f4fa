"""Gold jobs: silver tables to star schemas.

Each job returns ``{table: DataFrame}``. Dimensions are built and written when
the job is called, because a key needs the row counts of the partitions before
it: to where ``store`` puts the table of that name, else to the staging folder.
The fact then looks its keys up in the written tables, so keys agree between
all tables. The natural keys of one star are disjoint groups of columns: the
pruned scans of all its dimensions together read each column once.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping, Sequence

from pyspark.sql import DataFrame

from creditlake.functions.columns import columns_with_prefix, lower_columns
from creditlake.jobs import AT_ONCE, together
from creditlake.operators.behavior import behavior
from creditlake.operators.dimensions import Dimension, Store, add_key, attach_keys, create_dimension
from creditlake.plans import stars
from creditlake.plans.stars import Star
from creditlake.settings import SEVERITY
from creditlake.staging import stage

Tables = dict[str, DataFrame]
# Writes a table under its name and returns it read back.
NamedStore = Callable[[str, DataFrame], DataFrame]


def gold_application(
    application: DataFrame,
    target: DataFrame,
    all_keys: bool = False,
    only: Collection[str] | None = None,
    null_safe: bool = True,
    skip_missing: bool = False,
    at_once: int = AT_ONCE,
    store: NamedStore | None = None,
) -> Tables:
    """Nine dimensions, the fact, and the label table.

    The fact leaves out the keys of customer info, documents and contact;
    ``all_keys`` adds them.
    """
    tables = build_star(
        application, stars.APPLICATION, all_keys=all_keys, only=only,
        null_safe=null_safe, skip_missing=skip_missing, at_once=at_once, store=store,
    )
    return tables | _chosen({"dim_app_target": target}, only)


def gold_bureau(
    bureau: DataFrame,
    balance: DataFrame,
    severity: Mapping[str, int] = SEVERITY,
    only: Collection[str] | None = None,
    null_safe: bool = True,
    skip_missing: bool = False,
    at_once: int = AT_ONCE,
    store: NamedStore | None = None,
) -> Tables:
    """Two dimensions, the monthly table, behaviour per credit, and the fact.

    A credit without monthly history has no ``bb_id``.
    """
    wanted = only is None or {"dim_bureau_behavior", stars.BUREAU.fact} & set(only)
    histories = {}
    if wanted:
        table = "dim_bureau_behavior"
        put = _put(store, table, only)
        histories[table] = add_key(behavior(balance, severity=severity), "bb_id", ["sk_id_bureau"], store=put)
    tables = build_star(
        bureau, stars.BUREAU, more=histories, only=only,
        null_safe=null_safe, skip_missing=skip_missing, at_once=at_once, store=store,
    )
    return _chosen({"dim_bureau_balance": balance}, only) | tables


def gold_credit_card_balance(df: DataFrame, **options) -> Tables:
    """Two dimensions and the fact of credit-card snapshots."""
    return build_star(df, stars.CREDIT_CARD_BALANCE, **options)


def gold_installments(df: DataFrame, **options) -> Tables:
    """Two dimensions and the fact of instalment payments."""
    return build_star(df, stars.INSTALLMENTS, **options)


def gold_previous_applications(df: DataFrame, **options) -> Tables:
    """Three dimensions and the fact of earlier applications."""
    return build_star(df, stars.PREVIOUS_APPLICATION, **options)


def gold_pos_cash_balance(df: DataFrame, **options) -> Tables:
    """Two dimensions and the fact of point-of-sale and cash-loan snapshots."""
    return build_star(lower_columns(df), stars.POS_CASH_BALANCE, **options)


def build_star(
    df: DataFrame,
    star: Star,
    more: Mapping[str, Dimension] | None = None,
    all_keys: bool = False,
    only: Collection[str] | None = None,
    null_safe: bool = True,
    skip_missing: bool = False,
    at_once: int = AT_ONCE,
    store: NamedStore | None = None,
) -> Tables:
    """The tables of one star, dimensions first.

    ``only`` names the tables to build; ``more`` adds ready dimensions, whose key
    no more than one row of ``df`` carries. A column
    that ``df`` lacks is an error, unless ``skip_missing`` leaves it out.
    """
    ready = dict(more or {})
    keys = {table: key for table, (key, _) in star.dimensions.items()}
    keys |= {table: dimension.key for table, dimension in ready.items()}
    with_fact = only is None or star.fact in only
    fact_columns = [*star.columns]
    if all_keys:
        fact_columns += [k for k in keys.values() if k not in fact_columns]

    # Only the dimensions that are asked for, or whose key the fact carries.
    needed = {
        table: (key, _natural_key(df, natural, skip_missing))
        for table, (key, natural) in star.dimensions.items()
        if only is None or table in only or (with_fact and key in fact_columns)
    }
    needed = {table: (key, c) for table, (key, c) in needed.items() if c}
    made = together(
        [
            lambda t=t, c=c, key=key: create_dimension(df, c, key, _put(store, t, only))
            for t, (key, c) in needed.items()
        ],
        at_once,
    )
    ready |= dict(zip(needed, made))

    tables = _chosen({t: ready[t].frame for t in keys if t in ready}, only)
    if with_fact:
        tables[star.fact] = _fact(df, ready, fact_columns, null_safe, skip_missing)
    return tables


def _fact(
    df: DataFrame,
    dimensions: Mapping[str, Dimension],
    columns: Sequence[str],
    null_safe: bool,
    skip_missing: bool,
) -> DataFrame:
    """``columns`` of ``df`` and of the dimensions' keys."""
    used = [d for d in dimensions.values() if d.key in columns]
    keys = {d.key for d in used}
    if skip_missing:
        columns = [c for c in columns if c in df.columns or c in keys]
    measures = [c for c in columns if c not in keys]
    # The dimensions of a star were counted from its own table, and the
    # others have unique keys: no lookup has to search for frequent ones.
    return attach_keys(df, used, null_safe, counted=True, keep=measures).select(*columns)


def _put(store: NamedStore | None, table: str, only: Collection[str] | None) -> Store:
    """Where a dimension goes: a table that was not asked for is staged."""
    if store is None or (only is not None and table not in only):
        return stage
    return lambda df: store(table, df)


def _natural_key(df: DataFrame, natural: tuple[str, ...] | str, skip_missing: bool) -> list[str]:
    if isinstance(natural, str):
        return columns_with_prefix(df, natural.removesuffix("*"))
    return [c for c in natural if not skip_missing or c in df.columns]


def _chosen(tables: Tables, only: Collection[str] | None) -> Tables:
    return {t: df for t, df in tables.items() if only is None or t in only}
