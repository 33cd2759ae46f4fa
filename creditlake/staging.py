"""Intermediate tables in the shared checkpoint folder.

A staged table is plain Parquet under the folder that the cluster names in
``spark.checkpoint.dir`` (or that ``SparkContext.setCheckpointDir`` set): it outlives lost executors, is read back column by
column, and cuts the lineage. Tables staged inside a :func:`scope` go when it
ends; all others when the driver does.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
# Rows that a Python task gets at once, unless the session has fewer: texts are much wider than numbers.
_BATCH_ROWS = 1_000

_NAME = f"creditlake-{uuid.uuid4().hex}"
_made: set[str] = set()
_lock = threading.Lock()
_held: dict[str, tuple[str, str, int]] = {}
_scopes: ContextVar[tuple[str, ...]] = ContextVar("scopes", default=())


def staging_folder(spark: SparkSession) -> str:
    """This process's folder below the session's checkpoint directory.

    It is deleted when the driver ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = f"{base.rstrip('/')}/{_NAME}"
    with _lock:
        if folder not in _made:
            files, path = _hadoop(spark, folder)
            files.mkdirs(path)
            files.deleteOnExit(path)
            _made.add(folder)
    return folder


@contextmanager
def scope(spark: SparkSession) -> Iterator[str]:
    """A folder of its own for all tables staged inside, deleted at the end, also after a failure.

    Frames built on these tables end with it. Scopes of other builds and
    tables staged before are not touched. Shuffle files go at the end of each
    query inside: Spark would keep them until the driver has collected its plan,
    which a driver with memory to spare puts off.
    """
    folder = f"{staging_folder(spark)}/scope-{uuid.uuid4().hex}"
    outer = _scopes.set((*_scopes.get(), folder))
    try:
        with settings_held(spark):
            yield folder
    finally:
        _scopes.reset(outer)
        files, path = _hadoop(spark, folder)
        files.delete(path, True)


@contextmanager
def settings_held(spark: SparkSession) -> Iterator[None]:
    """Spark's own settings to delete a query's shuffle files when it ends and to hand over fewer rows at once.

    They hold while any scope of the session is open, or this alone, which needs no folder.
    """
    session = spark._jsparkSession.sessionUUID()
    with _lock:
        release, rows, users = _held.get(session, (spark.conf.get(_RELEASE), spark.conf.get(_BATCH), 0))
        _held[session] = release, rows, users + 1
        spark.conf.set(_RELEASE, "true")
        spark.conf.set(_BATCH, min(int(rows), _BATCH_ROWS) if int(rows) > 0 else _BATCH_ROWS)
    try:
        yield
    finally:
        with _lock:
            release, rows, users = _held.pop(session)
            if users > 1:
                _held[session] = release, rows, users - 1
            else:
                spark.conf.set(_RELEASE, release)
                spark.conf.set(_BATCH, rows)


def stage(df: DataFrame, outlive: bool = False) -> DataFrame:
    """Write ``df`` to the staging folder, or the open scope's, and return it read back.

    With ``outlive`` it belongs to what encloses the open scope.
    """
    spark = df.sparkSession
    scopes = _scopes.get()[:-1] if outlive else _scopes.get()
    path = f"{scopes[-1] if scopes else staging_folder(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path, compression="zstd")
    return spark.read.schema(df.schema).parquet(path)


def _hadoop(spark: SparkSession, folder: str) -> tuple:
    """The file system of ``folder`` and its path there."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(context._jsc.hadoopConfiguration()), path
