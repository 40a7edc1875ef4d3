"""spark-submit entry point: run the sales job on files.

On a cluster, ``--conf spark.checkpoint.dir=...`` must name a folder that all executors share; the
job's intermediate tables go there and are deleted at its end."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from salesflow.plans import SalesOptions, run_sales_job


def main() -> None:
    parser = argparse.ArgumentParser(prog="salesflow", description=__doc__)
    parser.add_argument("customers", help="customers CSV")
    parser.add_argument("refunds", help="refunds CSV")
    parser.add_argument("orders", help="orders JSON, may hold globs (in/orders_2025-03-*.json) and commas")
    parser.add_argument("output", help="output folder")
    parser.add_argument("--sep", default=";", help="separator of the CSV outputs")
    parser.add_argument("--encoding", default="UTF-8", help="of the CSV inputs")
    parser.add_argument("--json-lines", action="store_true", help="one order per line")
    parser.add_argument("--infer", action="store_true", help="take columns and types from the data")
    parser.add_argument("--trim", action="store_true", help="ignore spaces around is_active")
    parser.add_argument("--ignore-missing", action="store_true", help="of several order paths, skip those without files")
    parser.add_argument("--dedup", choices=["line", "order"], default="line")
    parser.add_argument("--keep-empty", action="store_true", help="keep orders without items")
    parser.add_argument("--dedup-customers", action="store_true", help="one city per customer")
    parser.add_argument("--money", choices=["double", "decimal"], default="double")
    parser.add_argument("--on-bad-date", choices=["null", "error"], default="null")
    parser.add_argument("--float-format", default="%.2f", help="of amounts in CSV outputs; empty: all digits")
    parser.add_argument("--jdbc-url", help="write the tables to this database")
    parser.add_argument("--jdbc-driver", help="driver class; without it on the class path: CSV")
    args = parser.parse_args()

    builder = SparkSession.builder.appName("salesflow")
    spark = builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    jdbc = None
    if args.jdbc_url:
        jdbc = {"url": args.jdbc_url}
        if args.jdbc_driver:
            jdbc["driver"] = args.jdbc_driver
    orders = args.orders.split(",")
    report = run_sales_job(
        spark,
        args.customers,
        args.refunds,
        orders if len(orders) > 1 else orders[0],
        args.output,
        options=SalesOptions(
            dedup=args.dedup,
            keep_empty=args.keep_empty,
            on_bad_date=args.on_bad_date,
            money=args.money,
            dedup_customers=args.dedup_customers,
        ),
        multiline=not args.json_lines,
        infer=args.infer,
        trim=args.trim,
        encoding=args.encoding,
        ignore_missing=args.ignore_missing,
        sep=args.sep,
        float_format=args.float_format or None,
        jdbc=jdbc,
    )
    report.show(vertical=True, truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()
