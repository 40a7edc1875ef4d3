"""Tables written once and read many times, in the folder the cluster names.

All of an application's tables lie in one folder below ``spark.checkpoint.dir`` (a session that
does not set it, such as a test's, uses its warehouse folder; on a cluster that is an error if the
warehouse is on a machine's own disk).
``staging`` deletes its tables at the end of a with block. Tables behind a DataFrame that is
returned unread have to outlive the call: ``cleanup`` deletes them, at the latest when the
application ends."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager, suppress

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

ROWS_PER_FILE = 500_000
_SETTING = "spark.checkpoint.dir"
_registered: set[str] = set()


def _application_folder(spark: SparkSession) -> str:
    base = spark.conf.get(_SETTING, None)
    if not base:
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        if _is_cluster(spark.sparkContext.master) and warehouse.startswith("file:"):
            raise ValueError(f"{_SETTING} must name a folder that all executors share: {warehouse} is not one")
        base = f"{warehouse}/_scratch"
    return f"{base.rstrip('/')}/salesflow/{spark.sparkContext.applicationId}"


def _is_cluster(master: str) -> bool:
    return not (master == "local" or master.startswith("local["))


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the application's scratch folder."""
    folder = _application_folder(spark)
    if folder not in _registered:
        _registered.add(folder)
        atexit.register(_delete_quietly, spark, folder)
    return f"{folder}/{label}-{uuid.uuid4().hex}"


def delete_path(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _delete_quietly(spark: SparkSession, folder: str) -> None:
    with suppress(Exception):  # the JVM may be gone already
        delete_path(spark, folder)


def cleanup(spark: SparkSession) -> None:
    """Delete all staged tables of this application. DataFrames that read them end with it."""
    delete_path(spark, _application_folder(spark))


def _write_and_read(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _write_compact(df: DataFrame, path: str) -> DataFrame:
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _write_and_read(held.coalesce(-(-held.count() // ROWS_PER_FILE) or 1), path)
    finally:
        held.unpersist()


def stage(df: DataFrame, label: str, *, compact: bool = False) -> DataFrame:
    """Write ``df`` as parquet and read it back: later steps start from the files, neither
    repeating the work before them nor depending on executors that may be lost. The files stay
    until ``cleanup``, as the returned table is read later.

    ``compact`` is for narrow tables that may be small, such as aggregates: they get one file per
    ROWS_PER_FILE rows instead of one per task, of which a shuffle may have thousands."""
    write = _write_compact if compact else _write_and_read
    return write(df, scratch_path(df.sparkSession, label))


@contextmanager
def staging(spark: SparkSession, label: str) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """``stage`` for the length of a with block; the files are deleted at its end."""
    folder = scratch_path(spark, label)
    try:
        yield lambda df, name, compact=False: (_write_compact if compact else _write_and_read)(df, f"{folder}/{name}")
    finally:
        delete_path(spark, folder)
