"""What the operators share: table access, text bytes, Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

# Rows of a slice that a Python task turns into objects at a time.
SLICE = 128

# What this process keeps from one task to the next, by kind.
_KEPT: dict[str, tuple] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold(column: str | Column, folds: int = 5) -> Column:
    """crc32 of the id as text, modulo ``folds``; 0 for a missing id."""
    column = F.col(column) if isinstance(column, str) else column
    return F.pmod(F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def in_process(kind: str, name, make: Callable):
    """This process's object of a kind; that of another name, or what is missing, is made anew."""
    if kind not in _KEPT or _KEPT[kind][0] != name:
        _KEPT.pop(kind, None)
        _KEPT[kind] = name, make()
    return _KEPT[kind][1]


def give_back(but: str | None = None) -> None:
    """Drop what is kept of other kinds and return freed memory to the system.

    Spark goes on with the same Python processes, so a step that needs much memory would have it on top of
    what the steps before it have left there.
    """
    for kind in [*_KEPT]:
        if kind != but:
            del _KEPT[kind]
    for pool in (pa.default_memory_pool(), pa.system_memory_pool()):
        pool.release_unused()


def map_slices(
    df: DataFrame, function: Callable[[list[dict]], Iterator[dict]], schema: str, rows: int = SLICE
) -> DataFrame:
    """``function`` over small slices of rows as dictionaries; its rows as a DataFrame.

    A slice bounds the Python objects a task holds; Arrow moves the batches.
    """
    arrow = _arrow_schema(df.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                columns = {n: c.to_pylist() for n, c in zip(part.schema.names, part.columns)}
                made = list(function(columns))
                if made:
                    yield pa.RecordBatch.from_pylist(made, schema=arrow)

    return df.mapInArrow(run, schema)


def _arrow_schema(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))
