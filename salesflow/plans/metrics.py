"""Run counters as one row. They are plain aggregates over the tables, one pass per table:
unlike accumulators (Observation), they stay exact when a lost executor's tasks run again."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesflow.functions import is_non_numeric, parse_date, safe_double
from salesflow.operators import explode_items
from salesflow.plans.sales import PAID

# The keys of the run report.
COUNTERS = [
    "customers_rows_raw",
    "dup_customers",
    "refunds_rows",
    "refunds_amount_non_numeric",
    "orders_rows_raw",
    "orders_rows_paid",
    "orders_bad_date",
    "items_qty_non_numeric",
    "items_unit_price_non_numeric",
    "rejected_negative_price_rows",
    "orders_clean_rows",
    "daily_city_sales_rows",
]
MALFORMED = "orders_malformed"  # a further counter of the job


def count_bad_numbers(df: DataFrame, *columns: str, by: list[str] = ()) -> DataFrame:
    """How many values of each text column are not numbers, all columns in one pass."""
    return df.groupBy(*by).agg(
        *[F.count_if(is_non_numeric(c)).alias(f"{c}_non_numeric") for c in columns]
    )


def customer_counts(customers: DataFrame) -> DataFrame:
    per_customer = customers.groupBy("customer_id").agg(F.count("*").alias("listed"))
    return per_customer.agg(
        _total(F.col("listed")).alias("customers_rows_raw"),
        _total(F.col("listed") - 1).alias("dup_customers"),
    )


def refund_counts(raw_refunds: DataFrame) -> DataFrame:
    return raw_refunds.agg(
        F.count("*").alias("refunds_rows"),
        F.count_if(is_non_numeric("amount")).alias("refunds_amount_non_numeric"),
    )


def order_counts(orders: DataFrame) -> DataFrame:
    """Counts over nested orders and their items in one pass. Every order gives at least one row,
    and orders that are not paid exactly one, so orders are counted by their first row."""
    paid = F.col("payment_status") == PAID
    items = orders.select("payment_status", "created_at", F.when(paid, F.col("items")).alias("items"))
    first = F.coalesce("pos", F.lit(0)) == 0
    bad_date = F.col("created_at").isNotNull() & parse_date("created_at").isNull()
    return explode_items(items, keep_empty=True).agg(
        F.count_if(first).alias("orders_rows_raw"),
        F.count_if(first & paid).alias("orders_rows_paid"),
        F.count_if(first & paid & bad_date).alias("orders_bad_date"),
        F.count_if(is_non_numeric("item_qty")).alias("items_qty_non_numeric"),
        F.count_if(is_non_numeric("item_unit_price")).alias("items_unit_price_non_numeric"),
        F.count_if(safe_double("item_unit_price") < 0).alias("rejected_negative_price_rows"),
    )


def row_count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count("*").alias(name))


def run_metrics(*counts: DataFrame) -> DataFrame:
    """One row with the counters of all given one-row tables."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), counts)
    return rows.agg(*[F.max(c).alias(c) for c in rows.columns])


def _total(c: Column) -> Column:
    return F.coalesce(F.sum(c), F.lit(0)).cast("long")
