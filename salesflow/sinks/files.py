"""Writers. Every one of them is a single Spark job that writes part files from the executors;
nothing is renamed or gathered on the driver."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesflow.functions import date_key, money_text
from salesflow.sinks.tables import replace_table


def format_numbers(df: DataFrame, pattern: str | None) -> DataFrame:
    """Fractional columns as fixed-point text; Spark would write 1.2E8 for large doubles."""
    if pattern is None:
        return df
    fractional = [f.name for f in df.schema.fields if isinstance(f.dataType, T.FractionalType)]
    return df.withColumns({c: money_text(c, pattern) for c in fractional})


def write_csv(
    df: DataFrame,
    path: str,
    *,
    sep: str = ";",
    header: bool = True,
    sort_by: list[str] | None = None,
    float_format: str | None = "%.2f",
    **options: str,
) -> None:
    """A folder of CSV part files, replaced if it exists. With sort_by the parts, read in the
    order of their names, are globally sorted. Further options (encoding, compression, ...) go to
    Spark's CSV writer."""
    out = df.orderBy(*sort_by) if sort_by else df
    (
        format_numbers(out, float_format)
        .write.mode("overwrite")
        .options(header=header, sep=sep, **options)
        .csv(path)
    )


def write_partitioned_csv(
    df: DataFrame,
    path: str,
    *,
    date: str = "date",
    sort_by: list[str] = (),
    sep: str = ";",
    float_format: str | None = "%.2f",
    max_rows_per_file: int = 1_000_000,
    replace: str = "dates",
    **options: str,
) -> None:
    """One folder ``date_key=YYYYMMDD`` per date, all dates in one job. The rows keep their
    date column. A run replaces the dates it has rows for and leaves those of earlier runs;
    replace="all" leaves nothing but its own. A date gets one sorted file, or, if it has more than max_rows_per_file rows,
    several. ``df`` is read twice, to count and to write, so pass a staged or cached table; its
    order does not matter."""
    if replace not in ("dates", "all"):
        raise ValueError(f"replace must be dates or all, not {replace!r}")
    out = df.withColumn("date_key", date_key(date))
    large = (
        out.groupBy(F.col("date_key").alias("_key"))
        .agg(F.ceil(F.count("*") / max_rows_per_file).alias("_files"))
        .filter("_files > 1")
    )
    # The task number spreads copies of a row too, and is the same when a task runs again. Spark
    # broadcasts ``large`` by its measured size, or splits the large dates in the join.
    file = F.pmod(F.xxhash64("_task", *df.columns), F.col("_files"))
    out = (
        out.withColumn("_task", F.spark_partition_id())
        .join(large, F.col("date_key").eqNullSafe(F.col("_key")), "left")
        .select(*out.columns, F.coalesce(file, F.lit(0)).alias("_file"))
    )
    # As many tasks as a shuffle has, even for few rows: small files cost time, not memory.
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = out.repartition(tasks, "date_key", "_file").sortWithinPartitions("date_key", *sort_by).drop("_file")
    (
        format_numbers(out, float_format)
        .write.mode("overwrite")
        .options(header=True, sep=sep, **options)
        .option("partitionOverwriteMode", "dynamic" if replace == "dates" else "static")
        .partitionBy("date_key")
        .csv(path)
    )


def _driver_is_missing(error: Exception) -> bool:
    text = str(error)
    return "ClassNotFoundException" in text or "No suitable driver" in text


def save_table(
    df: DataFrame,
    name: str,
    *,
    format: str = "parquet",
    path: str | None = None,
    fallback_format: str | None = None,
    fallback_path: str | None = None,
    fallback_options: dict | None = None,
    **options: str,
) -> str:
    """Replace a table and return the format that was written.

    format="jdbc" writes to a database (options: url, driver, numPartitions, ...); any other
    format writes a catalog table, at ``path`` if given, by ``replace_table``. If the JDBC driver is not on the class
    path and fallback_format is given, the same rows are written to fallback_path instead, a CSV
    with fallback_options as ``write_csv`` takes them. Any other failure is raised, so that a
    half-written table is never taken for a success."""
    if format != "jdbc":
        replace_table(df, name, path=path, format=format, **options)
        return format
    try:
        df.write.mode("overwrite").format("jdbc").options(dbtable=name, **options).save()
        return "jdbc"
    except Exception as error:
        if not (fallback_format and fallback_path and _driver_is_missing(error)):
            raise
    if fallback_format == "csv":
        write_csv(df, fallback_path, **(fallback_options or {}))
    else:
        df.write.mode("overwrite").format(fallback_format).options(**(fallback_options or {})).save(fallback_path)
    return fallback_format


def write_lines(df: DataFrame, path: str, column: str = "value") -> None:
    """A folder of text part files, one line per row."""
    df.select(column).write.mode("overwrite").text(path)


def write_json_arrays(df: DataFrame, path: str, *, max_rows_per_file: int = 10_000, **options: str) -> None:
    """A folder of text part files, each of which holds one JSON array over many lines, of at most
    max_rows_per_file rows; such a file is read by one task. Each task joins the rows it has, so nothing
    is shuffled. Further options (compression, ...) go to Spark's text writer."""

    def joined(batches: Iterator) -> Iterator:
        import pandas as pd

        held: list[str] = []
        for batch in batches:
            for value in batch["value"]:
                held.append(value)
                if len(held) == max_rows_per_file:
                    yield pd.DataFrame({"value": ["[ " + ", ".join(held) + " ]"]})
                    held = []
        if held:
            yield pd.DataFrame({"value": ["[ " + ", ".join(held) + " ]"]})

    rows = df.select(F.to_json(F.struct("*"), {"pretty": "true"}).alias("value"))
    arrays = rows.mapInPandas(joined, "value string")
    arrays.write.mode("overwrite").option("maxRecordsPerFile", 1).options(**options).text(path)
