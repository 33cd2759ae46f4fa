"""Loading CSV files into the bronze layer."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from fnmatch import fnmatchcase
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditlake.jobs import together
from creditlake.settings import SOURCE_TYPES
from creditlake.sources.layers import Layer

_REPORT = "table string, status string, rows bigint, error string"


def load_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """One CSV file, or a folder of files with the same header.

    Short rows are filled with NULL and surplus values of long rows dropped. A
    value that does not fit its column's type fails the load. Column types come
    from ``schema``, else from the rules for the known sources; only columns
    that no rule covers are inferred, which costs a pass over the file.
    """
    header = spark.read.csv(path, header=True).columns
    known = {f.name.lower(): f.dataType for f in schema.fields} if schema else {}
    types = {c: known.get(c.lower()) or source_type(c) for c in header}
    if not all(types.values()):
        inferred = spark.read.csv(path, header=True, inferSchema=True).schema
        types = {c: types[c] or f.dataType for c, f in zip(header, inferred.fields)}
    text = T.StructType([T.StructField(c, T.StringType()) for c in header])
    rows = spark.read.csv(
        path, schema=text, header=True, mode="PERMISSIVE", enforceSchema=False
    )
    return rows.select(*[F.col(f"`{c}`").cast(types[c]).alias(c) for c in header])


def source_type(column: str) -> str | None:
    """The type that the rules give to a column of a known source."""
    fitting = (t for rule, t in SOURCE_TYPES if fnmatchcase(column.lower(), rule))
    return next(fitting, None)


def list_csv(spark: SparkSession, folder: str) -> list[str]:
    """Names of the CSV files in a folder, sorted. Reads no contents."""
    listing = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(folder)
    return sorted(PurePosixPath(r["path"]).name for r in listing.select("path").collect())


def load_all(
    spark: SparkSession,
    folder: str,
    bronze: Layer,
    files: Sequence[str] | None = None,
    at_once: int = 1,
) -> DataFrame:
    """Load files into bronze tables named after the file; report what happened.

    A table is named after its file without the last extension. Two files for
    one table, also by letter case alone, are an error before anything is
    loaded. A file that fails does not stop the others and leaves the table it
    would have replaced. The report is ``(table, status, rows, error)`` with
    status ``loaded`` or ``failed``.
    """
    names = list_csv(spark, folder) if files is None else files
    tables = {file: PurePosixPath(file).stem for file in names}
    taken = Counter(t.lower() for t in map(tables.get, names))
    if twice := sorted(f for f, t in tables.items() if taken[t.lower()] > 1):
        raise ValueError(f"more than one file for a table: {', '.join(twice)}")

    def load(file: str) -> tuple[str, str, int | None, str | None]:
        table = tables[file]
        try:
            bronze.write(load_csv(spark, f"{folder.rstrip('/')}/{file}"), table)
            return table, "loaded", bronze.read(table).count(), None
        except Exception as error:
            return table, "failed", None, str(error)

    report = together([lambda file=file: load(file) for file in names], at_once)
    return spark.createDataFrame(report, _REPORT)
