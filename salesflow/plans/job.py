"""The whole job: files in, tables, CSV files, rejects and a run report out."""

from __future__ import annotations

import time
from datetime import UTC, datetime

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesflow.plans import metrics, sales
from salesflow.plans.sales import DAILY_GROUPS, SalesOptions
from salesflow.sinks import save_table, write_csv, write_lines, write_partitioned_csv
from salesflow.sources import clean_refunds, list_files, read_customers, read_orders, read_refunds, split_malformed
from salesflow.staging import staging

_MALFORMED = "_malformed"


def run_sales_job(
    spark: SparkSession,
    customers_path: str,
    refunds_path: str,
    orders_path: str | list[str],
    output_dir: str,
    *,
    options: SalesOptions = SalesOptions(),
    multiline: bool = True,
    infer: bool = False,
    trim: bool = False,
    encoding: str = "UTF-8",
    ignore_missing: bool = False,
    sep: str = ";",
    float_format: str | None = "%.2f",
    jdbc: dict[str, str] | None = None,
) -> DataFrame:
    """Run everything and return the one-row report, which is also written as JSON.

    The order files are parsed once and staged as parquet; the per-order table, orders_clean and the
    daily table are staged after their shuffles, so that neither counters nor sinks compute
    them again, and the daily table is sorted once, for the file that is to be sorted. The customers, read by
    several steps without a shuffle, are persisted.

    Records of the order files that are not whole are counted, and written with their file to
    rejects/malformed_orders.

    Output folders: db/orders_clean and db/daily_city_sales (unless written over JDBC),
    out/daily_summary (by date), out/daily_summary_all, rejects/rejects_items, logs/run_report,
    logs/orders_files. All CSV files, also those in place of a database, have the same format."""
    started, clock = datetime.now(UTC), time.monotonic()
    csv = {"sep": sep, "float_format": float_format}
    text = {"infer": infer, "encoding": encoding}
    raw_refunds = read_refunds(spark, refunds_path, raw=True, **text)
    source = read_orders(
        spark, orders_path, infer=infer, multiline=multiline, ignore_missing=ignore_missing, malformed=_MALFORMED
    )
    order_files = list_files(spark, orders_path, ignore_missing)
    customers = read_customers(spark, customers_path, trim=trim, **text)

    with staging(spark, "job") as stage:
        customers = customers.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            orders, malformed = split_malformed(stage(source, "orders"), _MALFORMED)
            tables = sales.build_daily_sales(customers, clean_refunds(raw_refunds), orders, options)
            tables = tables.on_staged(stage(tables.per_order, "per_order"))
            orders_clean = stage(tables.orders_clean, "orders_clean")
            daily = stage(tables.daily_unsorted, "daily")
            counts = metrics.run_metrics(
                metrics.customer_counts(customers),
                metrics.refund_counts(raw_refunds),
                metrics.order_counts(orders),
                metrics.row_count(orders_clean, "orders_clean_rows"),
                metrics.row_count(daily, "daily_city_sales_rows"),
                metrics.row_count(order_files, "orders_files"),
                metrics.row_count(malformed, metrics.MALFORMED),
            ).first()

            if counts[metrics.MALFORMED]:
                malformed.write.mode("overwrite").json(f"{output_dir}/rejects/malformed_orders")
            if counts["rejected_negative_price_rows"]:
                write_csv(tables.rejects, f"{output_dir}/rejects/rejects_items", sep=sep, float_format=None)
            formats = [
                _save(df, name, f"{output_dir}/db/{name}", jdbc, csv)
                for df, name in ((orders_clean, "orders_clean"), (daily, "daily_city_sales"))
            ]
            write_csv(daily, f"{output_dir}/out/daily_summary_all", sort_by=DAILY_GROUPS, **csv)
            write_partitioned_csv(daily, f"{output_dir}/out/daily_summary", sort_by=DAILY_GROUPS[1:], **csv)
        finally:
            customers.unpersist()

    report = spark.range(0, 1, 1, 1).select(
        F.lit("OK").alias("status"),
        F.lit(started.isoformat()).alias("started_at"),
        F.lit(datetime.now(UTC).isoformat()).alias("finished_at"),
        F.lit(round(time.monotonic() - clock, 3)).alias("duration_sec"),
        F.lit(counts["orders_files"]).cast("long").alias("orders_files"),
        F.lit(orders_path if isinstance(orders_path, str) else ",".join(orders_path)).alias("orders_path"),
        *[F.lit(counts[c]).cast("long").alias(c) for c in [*metrics.COUNTERS, metrics.MALFORMED]],
        F.lit(formats == ["jdbc", "jdbc"]).alias("jdbc_written"),
        F.lit(output_dir).alias("output_dir"),
    )
    report.write.mode("overwrite").json(f"{output_dir}/logs/run_report")
    write_lines(order_files.orderBy("value"), f"{output_dir}/logs/orders_files")
    return report


def _save(df: DataFrame, name: str, path: str, jdbc: dict[str, str] | None, csv: dict) -> str:
    if jdbc:
        fallback = {"fallback_format": "csv", "fallback_path": path, "fallback_options": csv}
        return save_table(df, name, format="jdbc", **fallback, **jdbc)
    write_csv(df, path, **csv)
    return "csv"
