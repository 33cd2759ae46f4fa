"""Layers: named places that hold tables.

A table is stored in versions, and one small write makes a new one current:

- In a folder, ``<table>/data-<id>`` holds the rows of a version, and an empty file
  ``<table>/_versions/<number>-<id>`` says that it is complete. The last one counts. Nothing is
  renamed, which an object store would answer with a copy.
- In the catalog, ``<table>__v<number>`` holds the rows, and the table's own name is a view of
  the current one, replaced in one statement.

So readers find the old rows or the new ones, and never nothing. Versions before
the current one stay for ``keep`` more writes, for readers that have begun. What a failed write leaves
is never read, and the next write of that table removes it. One writer at a time
writes a table.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

_MARKS = "_versions"
_DATA = "data-"
_VERSION = "creditlake.version"
# Tables are written once and read often; the smaller files cost no more time to make than Spark's default.
_CODEC = "zstd"


@dataclass(frozen=True)
class Layer:
    """A folder of Parquet tables, or a database of the catalog.

    Give ``path`` for a folder, ``database`` for the catalog. ``keep`` earlier
    versions of each table stay until later writes.
    """

    spark: SparkSession
    path: str | None = None
    database: str | None = None
    keep: int = 1

    def __post_init__(self) -> None:
        if (self.path is None) == (self.database is None):
            raise ValueError("a layer is either a path or a database")

    def read(self, table: str) -> DataFrame:
        """The whole stored table."""
        if self.path is not None:
            return self.spark.read.parquet(self.location(table))
        return self.spark.table(self._named(table))

    def location(self, table: str) -> str:
        """Where the current rows are: a folder of Parquet files, or the name of a table in the catalog.

        A plain folder or table that was not written by a layer is its own location.
        """
        if self.path is not None:
            marks = self._marks(table)
            return self._place(table, _DATA + marks[-1][1]) if marks else self._place(table)
        version = self._version_of(table)
        return self._named(table if version is None else _numbered(table, version))

    def write(
        self,
        df: DataFrame,
        table: str,
        bucket_by: str | None = None,
        buckets: int | None = None,
    ) -> None:
        """Store ``df`` in place of whatever is there.

        The old rows are current until the new ones are complete; a failure at any
        point leaves the one or the other. In a catalog, ``bucket_by`` with ``buckets`` stores the rows hashed and
        sorted by one column, so that later joins on it need no shuffle.
        """
        if self.path is not None:
            name = uuid.uuid4().hex
            try:
                df.write.parquet(self._place(table, _DATA + name), compression=_CODEC)
            except Exception:
                self._delete(table, _DATA + name)
                raise
            self._mark(table, name)
            self._clear_folder(table)
            return
        before = self._version_of(table)
        version = max(self._versions(table), default=0) + 1
        writer = df.write.format("parquet").option("compression", _CODEC)
        if bucket_by:
            writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by)
        try:
            writer.saveAsTable(self._named(_numbered(table, version)))
        except Exception:
            self._drop(_numbered(table, version))
            raise
        self._show(table, version)
        self._clear_database(table, version, before)

    def publish(
        self, tables: Mapping[str, DataFrame], buckets: Mapping[str, tuple[str, int]] | None = None
    ) -> None:
        """Store a set of tables, in their order.

        ``buckets`` gives tables of a catalog their bucketing column and count.
        """
        for table, df in tables.items():
            self.write(df, table, *(buckets or {}).get(table, ()))

    # Folders

    def _marks(self, table: str) -> list[tuple[int, str]]:
        """Number and id of the complete versions, the current one last."""
        files, path = self._file(table, _MARKS)
        if not files.exists(path):
            return []
        names = [s.getPath().getName() for s in files.listStatus(path)]
        return sorted((int(n), i) for n, _, i in (name.partition("-") for name in names) if n.isdigit())

    def _mark(self, table: str, name: str) -> None:
        """Make a version current: one empty file is created, in one step."""
        number = max((n for n, _ in self._marks(table)), default=0) + 1
        files, path = self._file(table, _MARKS, f"{number:012d}-{name}")
        files.create(path, False).close()

    def _clear_folder(self, table: str) -> None:
        """Remove versions that are no longer kept, and what failed writes left."""
        marks = self._marks(table)
        for number, name in marks[: -1 - self.keep]:
            self._delete(table, _MARKS, f"{number:012d}-{name}")
        kept = {_MARKS, *(_DATA + name for _, name in marks[-1 - self.keep :])}
        files, path = self._file(table)
        for status in files.listStatus(path):
            name = status.getPath().getName()
            # Plain files are a table from before the first version.
            if name not in kept and (name.startswith(_DATA) or len(marks) > self.keep):
                self._delete(table, name)

    def _delete(self, *parts: str) -> None:
        files, path = self._file(*parts)
        files.delete(path, True)

    def _file(self, *parts: str) -> tuple:
        context = self.spark.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(self._place(*parts))
        return path.getFileSystem(context._jsc.hadoopConfiguration()), path

    def _place(self, *parts: str) -> str:
        return "/".join([self.path.rstrip("/"), *parts])

    # The catalog

    def _versions(self, table: str) -> list[int]:
        """Numbers of the stored versions, complete or not."""
        names = [r["tableName"] for r in self.spark.sql(f"SHOW TABLES IN `{self.database}`").collect()]
        found = (re.fullmatch(re.escape(table.lower()) + r"__v(\d{6,})", n.lower()) for n in names)
        return sorted(int(m[1]) for m in found if m)

    def _version_of(self, table: str) -> int | None:
        """The version that the table's name shows; None if it is no view of a layer or not there."""
        if not self.spark.catalog.tableExists(self._named(table)):
            return None
        properties = self.spark.sql(f"SHOW TBLPROPERTIES {self._named(table)}").collect()
        return next((int(p["value"]) for p in properties if p["key"] == _VERSION), None)

    def _show(self, table: str, version: int) -> None:
        """Make a version current: the view is replaced in one statement."""
        plain = self._version_of(table) is None and self.spark.catalog.tableExists(self._named(table))
        if plain:
            # A table that no layer wrote steps aside once, as version 0.
            self._rename(table, _numbered(table, 0))
        try:
            self._view(table, version)
        except Exception:
            if plain:
                self._rename(_numbered(table, 0), table)
            raise

    def _view(self, table: str, version: int) -> None:
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self._named(table)} TBLPROPERTIES ('{_VERSION}' = '{version}') "
            f"AS SELECT * FROM {self._named(_numbered(table, version))}"
        )

    def _clear_database(self, table: str, version: int, before: int | None) -> None:
        """Remove versions that are no longer kept, and what failed writes left."""
        shown = [v for v in self._versions(table) if v <= (before or 0)]
        kept = {version, *(shown[-self.keep :] if self.keep else [])}
        for number in self._versions(table):
            if number not in kept:
                self._drop(_numbered(table, number))

    def _rename(self, table: str, other: str) -> None:
        self.spark.sql(f"ALTER TABLE {self._named(table)} RENAME TO {self._named(other)}")

    def _drop(self, table: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self._named(table)}")

    def _named(self, table: str) -> str:
        return f"`{self.database}`.`{table}`"


def _numbered(table: str, version: int) -> str:
    return f"{table}__v{version:06d}"
