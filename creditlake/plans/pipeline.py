"""The whole warehouse in layer order: bronze, silver, gold, marts."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import DataFrame, SparkSession

from creditlake.jobs import AT_ONCE, together
from creditlake.operators.quality import audit_report
from creditlake.plans import gold, marts, silver
from creditlake.settings import SOURCE_FILES
from creditlake.sources.csv import load_all
from creditlake.sources.layers import Layer
from creditlake.staging import scope, settings_held

LAYERS = ("bronze", "silver", "gold", "marts")


def build_layers(
    spark: SparkSession,
    source: str,
    bronze: Layer,
    silver_layer: Layer,
    gold_layer: Layer,
    layers: Collection[str] = LAYERS,
    files: Sequence[str] = SOURCE_FILES,
    audit: bool = True,
    at_once: int = AT_ONCE,
) -> DataFrame | None:
    """Build the chosen layers in order and return the load report.

    Nothing after bronze runs if a file failed to load. With ``audit`` the
    quality reports are stored as silver table ``quality_report``. The jobs of
    one layer do not depend on each other; up to ``at_once`` are submitted to
    Spark together. What a build stages goes with it, also if it fails, and the shuffle files
    of each of its jobs go with the job.
    """
    report = None
    if "bronze" in layers:
        report = load_all(spark, source, bronze, files, at_once)
        failed = report.filter("status = 'failed'").select("table").collect()
        if failed:
            raise RuntimeError(f"not loaded: {', '.join(r['table'] for r in failed)}")
    if "silver" in layers:
        build_silver(bronze, silver_layer, audit, at_once)
    if "gold" in layers:
        build_gold(silver_layer, gold_layer, at_once)
    if "marts" in layers:
        build_marts(silver_layer, gold_layer, at_once)
    return report


def build_silver(
    bronze: Layer,
    target: Layer,
    audit: bool = True,
    at_once: int = AT_ONCE,
    tables: Collection[str] | None = None,
) -> None:
    """The silver tables from the bronze ones, and the report of what was cleaned.

    ``tables`` names bronze tables whose silver tables to build, instead of all;
    the report then holds these.
    """
    with settings_held(bronze.spark):
        _silver_tables(bronze, target, audit, at_once, tables)


def _silver_tables(
    bronze: Layer, target: Layer, audit: bool, at_once: int, tables: Collection[str] | None
) -> None:
    read = bronze.read
    audits: silver.Audits = {} if audit else None
    jobs = {
        ("application_train", "application_test"): silver.silver_application,
        ("bureau",): silver.silver_bureau,
        ("bureau_balance",): silver.silver_bureau_balance,
        ("credit_card_balance",): silver.silver_credit_card_balance,
        ("POS_CASH_balance",): silver.silver_pos_cash_balance,
        ("installments_payments",): silver.silver_installments,
        ("previous_application",): silver.silver_previous_application,
    }
    built = [
        job(*map(read, names), audits=audits)
        for names, job in jobs.items()
        if tables is None or {*names} & {*tables}
    ]
    together([lambda made=made: target.publish(made) for made in built], at_once)
    if audits:
        target.write(audit_report(bronze.spark, audits), "quality_report")


def build_gold(
    source: Layer, target: Layer, at_once: int = AT_ONCE, tables: Collection[str] | None = None
) -> None:
    """The dimensions and facts from the silver tables.

    ``tables`` names the gold tables to build, instead of all.
    """
    jobs = {
        gold.gold_application: ("application", "application_target"),
        gold.gold_bureau: ("bureau", "bureau_balance"),
        gold.gold_credit_card_balance: ("credit_card_balance",),
        gold.gold_installments: ("installments_payments",),
        gold.gold_previous_applications: ("previous_application",),
        gold.gold_pos_cash_balance: ("pos_cash_balance",),
    }

    def build(job, names: tuple[str, ...]) -> None:
        stored = set()

        def store(table: str, df: DataFrame) -> DataFrame:
            target.write(df, table)
            stored.add(table)
            return target.read(table)

        # What a star stages goes when the star is stored, not with the last of them.
        with scope(source.spark):
            # The stars run side by side, so each makes its dimensions one by one; these are in place then.
            made = job(*map(source.read, names), only=tables, at_once=1, store=store)
            target.publish({t: df for t, df in made.items() if t not in stored})

    together([lambda job=job, n=names: build(job, n) for job, names in jobs.items()], at_once)


def build_marts(
    source: Layer, target: Layer, at_once: int = AT_ONCE, tables: Collection[str] | None = None
) -> None:
    """The three summaries from silver, then the wide table from all of them.

    ``tables`` names the marts to build, instead of all; the wide table reads stored summaries.
    """
    with settings_held(source.spark):
        _mart_tables(source, target, at_once, tables)


def _mart_tables(
    source: Layer, target: Layer, at_once: int, tables: Collection[str] | None
) -> None:
    read = source.read
    summaries = {
        "mart_bureau_summary": lambda: marts.bureau_summary(read("bureau")),
        "mart_previous_app_summary": lambda: marts.previous_summary(read("previous_application")),
        "mart_payment_behavior": lambda: marts.payment_summary(read("installments_payments")),
    }
    together(
        [
            lambda t=t, job=job: target.write(job(), t)
            for t, job in summaries.items()
            if tables is None or t in tables
        ],
        at_once,
    )
    if tables is not None and "mart_master" not in tables:
        return
    master = marts.mart_master(
        read("application"), read("application_target"), *[target.read(t) for t in summaries]
    )
    target.write(master, "mart_master")
