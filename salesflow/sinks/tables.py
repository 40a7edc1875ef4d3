"""Catalog tables: replaced in one step, or stored so that later joins shuffle nothing."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from salesflow.staging import delete_path

_VERSION = "version-"


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def table_location(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted(name)}").filter("col_name = 'Location'")
    return rows.first()["data_type"]


def _versions(spark: SparkSession, folder: str) -> list[str]:
    """The versions in a table's folder, the oldest first."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [f for f in files.listStatus(path) if f.getPath().getName().startswith(_VERSION)]
    return [f.getPath().toString() for f in sorted(found, key=lambda f: f.getModificationTime())]


def replace_table(
    df: DataFrame, name: str, *, path: str | None = None, format: str = "parquet", keep: int = 1, **options: str
) -> str:
    """Replace the rows of a catalog table, or make it, and return the folder they are in.

    The rows are written to a new folder below ``path`` (by default one beside the managed tables);
    only then does the catalog point the table there, in one step. A reader sees the old rows or the
    new ones, and a write that fails leaves the old ones. The last ``keep`` versions before the new
    one stay, for queries that still read them. ``df`` may read the table itself.

    A table with other columns or in another format is an error, raised before anything is written:
    the catalog could not follow in one step."""
    spark = df.sparkSession
    folder = path or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{name.split('.')[-1]}_versions"
    exists = spark.catalog.tableExists(name)
    if exists:
        described = spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted(name)}")
        provider = described.filter("col_name = 'Provider'").first()["data_type"]
        old = [(f.name, f.dataType.simpleString()) for f in spark.table(name).schema.fields]
        new = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
        if old != new or provider.lower() != format.lower():
            raise ValueError(f"table {name} is {provider} with {old}, not {format} with {new}")
    version = f"{folder}/{_VERSION}{uuid.uuid4().hex}"
    try:
        df.write.format(format).options(**options).save(version)
    except Exception:
        delete_path(spark, version)
        raise
    if exists:
        before = table_location(spark, name)
        spark.sql(f"ALTER TABLE {_quoted(name)} SET LOCATION '{version}'")
        spark.catalog.refreshTable(name)
    else:
        before = None
        spark.catalog.createTable(name, path=version, source=format, schema=df.schema, **options)
    live = version.rsplit("/", 1)[1]
    older = [v for v in _versions(spark, folder) if not v.endswith(live)]
    if before is not None:  # the version just replaced is the newest of them, whatever the clocks say
        last = before.rsplit("/", 1)[1]
        older = [v for v in older if not v.endswith(last)] + [v for v in older if v.endswith(last)]
    for stale in older[: max(len(older) - keep, 0)]:
        delete_path(spark, stale)
    return version


def save_bucketed(df: DataFrame, name: str, keys: list[str], buckets: int, *, path: str | None = None) -> None:
    """Replace a parquet table by ``df`` in ``buckets`` files, dealt by a hash of ``keys`` and sorted by
    them. Tables with the same keys and number of buckets are joined, and grouped by the keys, without a
    shuffle or sort, in every run that reads them: one shuffle when writing instead of one per read.

    A bucket is read by one task, so choose as many as leave a bucket in an executor's memory; a key with
    a large share of all rows is better left to a join that splits it."""
    out = df.repartition(buckets, *keys)  # by the hash that deals rows to buckets: one file per bucket
    writer = out.write.mode("overwrite").format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
    (writer.option("path", path) if path else writer).saveAsTable(name)
