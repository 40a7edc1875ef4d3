"""The star-schema test tables in the shapes the sales plan reads.

customers: customer with its nation as the city, and every spelling of ``is_active``.
refunds: returned line items, with bad amounts and decimal commas.
order lines: orders joined with line items, flat; some orders arrive twice.
nested orders: one record per line item, with an array of two items, none, or null."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesflow.sources.files import clean_customers, clean_refunds


# declared, so that opening a table starts no job to read file footers
SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    spelling = "element_at(array('false', '1', 'TRUE', 'yes', 'Y', 't', '0', null), cast(c_custkey % 8 + 1 as int))"
    nation = table(spark, sf_dir, "nation")
    customer = table(spark, sf_dir, "customer")
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.col("n_name").alias("city"),
        F.expr(spelling).alias("is_active"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_customers(raw_customers(spark, sf_dir))


def _amount_text():
    text = F.concat(F.lit("-"), F.col("l_extendedprice").cast("string"))
    return (
        F.when(F.col("l_linenumber") == 7, "error")
        .when(F.col("l_linenumber") == 6, F.replace(text, F.lit("."), F.lit(",")))
        .otherwise(text)
    )


def raw_refunds(spark: SparkSession, sf_dir: str, order_id=None) -> DataFrame:
    order_id = F.col("l_orderkey").cast("string") if order_id is None else order_id
    return (
        table(spark, sf_dir, "lineitem")
        .filter("l_returnflag = 'R'")
        .select(
            order_id.alias("order_id"),
            _amount_text().alias("amount"),
            F.date_format("l_shipdate", "yyyy-MM-dd").alias("created_at"),
        )
    )


def refunds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_refunds(raw_refunds(spark, sf_dir))


def created_at(timestamp: str, key: str):
    """Timestamp text, or date text for every fifth key."""
    full = F.date_format(timestamp, "yyyy-MM-dd HH:mm:ss")
    return F.when(F.col(key) % 5 == 0, F.date_format(timestamp, "yyyy-MM-dd")).otherwise(full)


def _order_columns():
    status = F.col("o_orderstatus")
    return {
        "customer_id": F.col("o_custkey").cast("string"),
        "channel": F.when(F.col("o_orderkey") % 2 == 0, "web").otherwise("app"),
        "payment_status": F.when(status == "F", "paid")
        .when(status == "P", "pending")
        .otherwise("failed"),
    }


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the job's columns beside their own."""
    return table(spark, sf_dir, "orders").withColumns(_order_columns())


def order_lines(spark: SparkSession, sf_dir: str, qty: str = "l_quantity") -> DataFrame:
    # every 50th order is delivered twice; made row by row, so orders are read only once
    deliveries = F.when(F.col("o_orderkey") % 50 == 0, F.array(F.lit(1), F.lit(2))).otherwise(
        F.array(F.lit(1))
    )
    orders = table(spark, sf_dir, "orders").withColumn("delivery", F.explode(deliveries))
    lines = table(spark, sf_dir, "lineitem")
    price = F.col("l_extendedprice")
    return orders.join(lines, orders.o_orderkey == lines.l_orderkey).select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        created_at("o_orderdate", "o_orderkey").alias("created_at"),
        *[c.alias(name) for name, c in _order_columns().items()],
        F.col("l_linenumber").alias("pos"),
        F.col(qty).alias("item_qty"),
        F.col("l_partkey").cast("string").alias("item_sku"),
        F.when(F.col("l_discount") == 0, -price).otherwise(price).alias("item_unit_price"),
    )


def shipment_id():
    return F.concat_ws("-", "l_orderkey", "l_linenumber")


def nested_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each line item as an order of its own, ``items`` = the goods and a handling fee. The
    arrays come from single rows, so no group is ever gathered to build them."""
    price = F.col("l_extendedprice")
    price_text = F.when(F.col("l_discount") == 0, -price).otherwise(price).cast("string")
    comma = F.col("l_suppkey") % 3 == 0
    goods = F.struct(
        F.when(F.col("l_partkey") % 40 == 0, "n/a")
        .otherwise(F.col("l_quantity").cast("string"))
        .alias("qty"),
        F.concat(F.lit("P"), "l_partkey").alias("sku"),
        F.when(comma, F.replace(price_text, F.lit("."), F.lit(",")))
        .otherwise(price_text)
        .alias("unit_price"),
    )
    fee = F.struct(
        F.lit("1").alias("qty"),
        F.concat(F.lit("S"), "l_suppkey").alias("sku"),
        F.round(F.col("l_tax") * 100).cast("int").cast("string").alias("unit_price"),
    )
    items = F.when(F.col("l_linenumber") <= 5, F.array(goods, fee)).when(
        F.col("l_linenumber") == 7, F.array().cast("array<struct<qty:string,sku:string,unit_price:string>>")
    )
    columns = _order_columns()
    orders = table(spark, sf_dir, "orders")
    lines = table(spark, sf_dir, "lineitem")
    return orders.join(lines, orders.o_orderkey == lines.l_orderkey).select(
        columns["channel"].alias("channel"),
        created_at("l_shipdate", "l_orderkey").alias("created_at"),
        columns["customer_id"].alias("customer_id"),
        items.alias("items"),
        shipment_id().alias("order_id"),
        columns["payment_status"].alias("payment_status"),
    )


def raw_shipment_refunds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_refunds(spark, sf_dir, shipment_id())
