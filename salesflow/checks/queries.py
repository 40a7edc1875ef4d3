"""One query per operator, over whole tables. Each takes (spark, sf_dir) and returns a
DataFrame; ``checks.oracles`` holds the SQL with the same result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesflow.functions import (
    date_key,
    normalise_bool,
    parse_date,
    safe_double,
)
from salesflow.operators import (
    diff_by_key,
    distinct_estimates,
    distinct_sketches,
    explode_items,
    group_values,
    intersect,
    join_dimension,
    keep_dates,
    keep_first,
    merge_sketches,
    merge_values,
    number_sorted,
    reconcile,
    relative_error,
    split_words,
    top_k,
    word_count,
)
from salesflow.plans import (
    SalesOptions,
    build_daily_sales,
    metrics,
    run_metrics,
    run_sales_job,
    sales,
    sales_from_lines,
)
from salesflow.sinks import (
    replace_table,
    save_bucketed,
    save_table,
    write_csv,
    write_json_arrays,
    write_lines,
    write_partitioned_csv,
)
from salesflow.sources import (
    clean_refunds,
    read_customers,
    read_drifting_csv,
    read_lines,
    read_orders,
    read_refunds,
    split_malformed,
    star,
)
from salesflow.staging import scratch_path, stage

QUERIES = {}

DAILY_SCHEMA = (
    "date string, city string, channel string, orders_count long, unique_customers long, "
    "items_sold long, gross_revenue_eur double, refunds_eur double, net_revenue_eur double"
)

REJECTS_SCHEMA = (
    "channel string, created_at string, customer_id string, order_id string, payment_status string, "
    "item_qty string, item_sku string, item_unit_price string, item_qty_d double, item_unit_price_d double"
)


def query(function):
    """Register under the function's name; a final underscore keeps it apart from an operator."""
    QUERIES[function.__name__.rstrip("_")] = function
    return function


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 2) for c in columns})


def rounded_daily(df: DataFrame) -> DataFrame:
    return rounded(df, "gross_revenue_eur", "refunds_eur", "net_revenue_eur")


def star_sales(spark: SparkSession, sf_dir: str, options: SalesOptions = SalesOptions()):
    return sales_from_lines(
        star.customers(spark, sf_dir),
        star.refunds(spark, sf_dir),
        star.order_lines(spark, sf_dir),
        options,
    )


def nested_sales(spark: SparkSession, sf_dir: str, options: SalesOptions = SalesOptions()):
    return build_daily_sales(
        star.customers(spark, sf_dir),
        clean_refunds(star.raw_shipment_refunds(spark, sf_dir)),
        star.nested_orders(spark, sf_dir),
        options,
    )


# --- the sales plan, whole and in parts -------------------------------------------------


@query
def daily_city_sales(spark, sf_dir):
    return rounded_daily(star_sales(spark, sf_dir).daily_city_sales)


@query
def daily_decimal(spark, sf_dir):
    return star_sales(spark, sf_dir, SalesOptions(money="decimal")).daily_city_sales


@query
def daily_decimal_subcent(spark, sf_dir):
    """Quantities below one give amounts with four decimals: only the daily sums are rounded."""
    lines = star.order_lines(spark, sf_dir, qty="l_discount")
    tables = (star.customers(spark, sf_dir), star.refunds(spark, sf_dir), lines)
    return sales_from_lines(*tables, SalesOptions(money="decimal")).daily_city_sales


@query
def daily_nested(spark, sf_dir):
    return rounded_daily(nested_sales(spark, sf_dir).daily_city_sales)


@query
def daily_dedup_order(spark, sf_dir):
    return rounded_daily(nested_sales(spark, sf_dir, SalesOptions(dedup="order")).daily_city_sales)


@query
def orders_clean(spark, sf_dir):
    return rounded(star_sales(spark, sf_dir).orders_clean, "gross_revenue_eur")


@query
def rejects(spark, sf_dir):
    return nested_sales(spark, sf_dir).rejects


@query
def kept_lines(spark, sf_dir):
    return star_sales(spark, sf_dir).kept


@query
def paid_orders(spark, sf_dir):
    orders = sales.paid_orders(star.orders(spark, sf_dir))
    return orders.select("o_orderkey", "o_custkey", "o_totalprice")


@query
def explode_items_(spark, sf_dir):
    return explode_items(star.nested_orders(spark, sf_dir))


@query
def explode_keep_empty(spark, sf_dir):
    return explode_items(star.nested_orders(spark, sf_dir), keep_empty=True)


@query
def dedup_first(spark, sf_dir):
    lines = star.table(spark, sf_dir, "lineitem").drop("l_tax", "l_linestatus")
    return keep_first(lines, ["l_orderkey"], ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey"])


@query
def per_order(spark, sf_dir):
    kept, _ = sales.split_lines(sales.paid_orders(star.order_lines(spark, sf_dir)))
    return rounded(sales.per_order(kept), "gross_revenue_eur")


@query
def refunds_clean(spark, sf_dir):
    return star.refunds(spark, sf_dir)


@query
def refunds_sum(spark, sf_dir):
    return rounded(sales.refunds_per_order(star.refunds(spark, sf_dir)), "refunds_eur")


@query
def active_orders(spark, sf_dir):
    orders = star.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_custkey").cast("string").alias("customer_id")
    )
    return sales.with_city(orders, sales.active_customers(star.customers(spark, sf_dir)))


@query
def refund_join(spark, sf_dir):
    orders = star.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("order_id"), "o_totalprice"
    )
    return rounded(sales.with_refunds(orders, star.refunds(spark, sf_dir)), "refunds_eur")


# --- cleaners ---------------------------------------------------------------------------


def _dirty_values(spark, sf_dir):
    text = F.col("value").cast("string")
    dirty = (
        F.when(F.col("event_type") == "error", F.concat(text, F.lit(" EUR")))
        .when(F.col("event_type") == "click", F.replace(text, F.lit("."), F.lit(",")))
        .when(F.col("event_type") == "view", F.concat(F.lit(" +"), text))
        .otherwise(text)
    )
    return star.table(spark, sf_dir, "events").select("event_id", "event_type", dirty.alias("value"))


@query
def safe_double_(spark, sf_dir):
    return _dirty_values(spark, sf_dir).select("event_id", safe_double("value").alias("value"))


@query
def bad_counts(spark, sf_dir):
    return metrics.count_bad_numbers(_dirty_values(spark, sf_dir), "value", by=["event_type"])


@query
def bool_norm(spark, sf_dir):
    raw = star.raw_customers(spark, sf_dir)
    return raw.select("customer_id", normalise_bool("is_active").alias("is_active"))


@query
def order_date(spark, sf_dir):
    text = star.created_at("o_orderdate", "o_orderkey")
    return star.table(spark, sf_dir, "orders").select("o_orderkey", parse_date(text).alias("order_date"))


@query
def date_key_(spark, sf_dir):
    text = star.created_at("o_orderdate", "o_orderkey")
    return star.table(spark, sf_dir, "orders").select(
        "o_orderkey", date_key(parse_date(text)).alias("date_key")
    )


# --- joins ------------------------------------------------------------------------------


@query
def left_join(spark, sf_dir):
    lines = star.table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n_lines"))
    orders = star.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return join_dimension(orders, lines, "o_orderkey", "l_orderkey", "left").drop("l_orderkey")


def _open_orders_of_debtors(spark, sf_dir, how):
    """All orders and all customers, matched where the order is open and the customer in debt: the
    key is null in the other rows, so both sides have rows without a match."""
    orders = star.table(spark, sf_dir, "orders").withColumn(
        "debtor", F.when(F.col("o_orderstatus") == "P", F.col("o_custkey"))
    )
    customers = star.table(spark, sf_dir, "customer").withColumn(
        "in_debt", F.when(F.col("c_acctbal") < 0, F.col("c_custkey"))
    )
    return join_dimension(orders, customers, "debtor", "in_debt", how).select(
        "o_orderkey", "o_custkey", "debtor", "c_custkey", "c_name", "c_acctbal"
    )


@query
def join_inner(spark, sf_dir):
    return _open_orders_of_debtors(spark, sf_dir, "inner")


@query
def join_right(spark, sf_dir):
    return _open_orders_of_debtors(spark, sf_dir, "right")


@query
def join_full(spark, sf_dir):
    return _open_orders_of_debtors(spark, sf_dir, "full")


# --- projections, filters, aggregates ---------------------------------------------------


@query
def project(spark, sf_dir):
    return star.table(spark, sf_dir, "orders").drop("o_orderdate", "o_orderpriority")


@query
def with_revenue(spark, sf_dir):
    lines = star.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice"
    )
    return lines.withColumn("revenue", F.round(F.col("l_quantity") * F.col("l_extendedprice"), 2))


@query
def city_revenue(spark, sf_dir):
    orders = star.table(spark, sf_dir, "orders")
    customers = star.table(spark, sf_dir, "customer")
    nations = star.table(spark, sf_dir, "nation")
    # summed per customer first: a customer with very many orders joins as one row
    return (
        orders.groupBy("o_custkey")
        .agg(F.expr("sum(o_totalprice) as revenue"))
        .join(customers, F.col("o_custkey") == customers.c_custkey)
        .groupBy("c_nationkey")
        .agg(F.expr("sum(revenue) as revenue"))
        .join(nations, F.col("c_nationkey") == nations.n_nationkey)
        .select(F.col("n_name").alias("city"), F.expr("round(revenue, 2) as total_revenue"))
        .orderBy(F.col("total_revenue").desc())
    )


@query
def local_sales(spark, sf_dir):
    names = spark.createDataFrame(
        [("F", "paid"), ("P", "pending"), ("O", "failed")], ["status", "payment_status"]
    )
    revenue = star.table(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(
        F.expr("round(sum(o_totalprice), 2) as total_revenue")
    )
    return revenue.join(names, F.col("o_orderstatus") == F.col("status")).select(
        "payment_status", "total_revenue"
    )


@query
def filter_gt(spark, sf_dir):
    lines = star.table(spark, sf_dir, "lineitem")
    return lines.filter(F.col("l_quantity") > 23).select("l_orderkey", "l_linenumber", "l_quantity")


@query
def filter_even(spark, sf_dir):
    return star.table(spark, sf_dir, "lineitem").select("l_partkey").filter(F.col("l_partkey") % 2 == 0)


@query
def map_double(spark, sf_dir):
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    return star.table(spark, sf_dir, "orders").select("o_orderkey", cents.alias("cents")).filter("cents > 9999")


@query
def upper_lines(spark, sf_dir):
    return star.table(spark, sf_dir, "customer").select(F.upper("c_mktsegment").alias("value"))


@query
def flat_map_words(spark, sf_dir):
    return star.table(spark, sf_dir, "part").select("p_partkey", F.explode(F.split("p_name", " ")).alias("word"))


@query
def reduce_by_key(spark, sf_dir):
    events = star.table(spark, sf_dir, "events")
    return rounded(events.groupBy("event_type").agg(F.sum("value").alias("total")), "total")


def _as_text(groups: DataFrame) -> DataFrame:
    values = F.array_join(F.transform("values", lambda v: v.cast("string")), ",")
    return groups.select("key", "chunk", F.size("values").alias("n"), values.alias("values"))


@query
def group_by_key(spark, sf_dir):
    events = star.table(spark, sf_dir, "events")
    return _as_text(group_values(events, F.col("event_type"), F.col("event_id"), 1000))


@query
def group_by_expr(spark, sf_dir):
    orders = star.table(spark, sf_dir, "orders")
    return _as_text(group_values(orders, F.col("o_orderkey") % 2, F.col("o_orderkey"), 1000))


@query
def global_reduce(spark, sf_dir):
    lines = star.table(spark, sf_dir, "lineitem")
    return lines.agg(F.sum("l_quantity").alias("total"), F.count("*").alias("rows"))


@query
def distinct(spark, sf_dir):
    return star.table(spark, sf_dir, "events").select("user_id", "event_type").distinct()


@query
def distinct_counts(spark, sf_dir):
    orders = star.table(spark, sf_dir, "orders")
    return orders.groupBy("o_orderstatus").agg(
        F.count_distinct("o_orderkey").alias("orders"), F.count_distinct("o_custkey").alias("customers")
    )


@query
def distinct_estimate(spark, sf_dir):
    """Estimated beside exact counts: whether each estimate is within five of its standard errors."""
    error = 0.02
    orders = star.table(spark, sf_dir, "orders")

    def near(c):
        exact = F.count_distinct(c)
        return F.abs(F.approx_count_distinct(c, error) - exact) <= 5 * error * exact

    return orders.groupBy("o_orderstatus").agg(
        F.count_distinct("o_custkey").alias("customers"),
        near("o_orderkey").alias("orders_near"),
        near("o_custkey").alias("customers_near"),
    )


@query
def distinct_sketches_(spark, sf_dir):
    """Customers and orders per month and city, estimated from stored daily sketches, beside exact counts:
    whether each estimate is within five standard errors, or half of one."""
    orders = star.table(spark, sf_dir, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), "o_orderkey", "o_custkey"
    )
    customers = star.table(spark, sf_dir, "customer")
    nations = star.table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("city"))
    sold = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    sold = sold.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(*orders.columns, "city")
    names = {"orders": "o_orderkey", "customers": "o_custkey"}
    daily = stage(distinct_sketches(sold, ["date", "city"], names), "sketches")
    month = F.substring("date", 1, 7).alias("month")
    estimated = distinct_estimates(merge_sketches(daily, [month, "city"], list(names)), list(names))
    exact = sold.groupBy(month, "city").agg(*[F.count_distinct(c).alias(f"exact_{n}") for n, c in names.items()])

    def near(name):
        count = F.col(f"exact_{name}")
        return (F.abs(F.col(name) - count) <= 5 * relative_error() * count + 0.5).alias(f"{name}_near")

    return exact.join(estimated, ["month", "city"]).select(
        "month", "city", F.col("exact_customers").alias("customers"), *[near(n) for n in names]
    )


@query
def merge_by_key(spark, sf_dir):
    """The earliest event of each type, by the caller's own merge."""
    event = F.struct("ts", "event_id", "user_id")
    earliest = merge_values(
        star.table(spark, sf_dir, "events"),
        F.col("event_type"),
        event,
        lambda a, b: F.when((a["ts"] < b["ts"]) | ((a["ts"] == b["ts"]) & (a["event_id"] < b["event_id"])), a).otherwise(b),
    )
    return earliest.select(F.col("key").alias("event_type"), "value.event_id", "value.user_id")


@query
def merge_global(spark, sf_dir):
    """All rows merged into one value: exclusive or of the order keys."""
    lines = star.table(spark, sf_dir, "lineitem")
    key = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    return merge_values(lines, F.lit(0), key, lambda a, b: a.bitwiseXOR(b)).select(F.col("value").alias("xor"))


@query
def merge_in_order(spark, sf_dir):
    """Each customer's order states in the order of the dates, joined without repeats in a row: a merge
    that is associative, but not commutative."""
    state = F.col("o_orderstatus")

    def joined(a, b):
        return F.when(F.right(a, F.lit(1)) == F.left(b, F.lit(1)), F.concat(a, F.substring(b, 2, 1 << 30))).otherwise(
            F.concat(a, b)
        )

    orders = star.table(spark, sf_dir, "orders")
    states = merge_values(
        orders, F.col("o_custkey"), state, joined, order_by=[F.col("o_orderdate"), F.col("o_orderkey")], fan_in=4
    )
    return states.select(F.col("key").alias("o_custkey"), F.col("value").alias("states"))


# --- order, sets, words -----------------------------------------------------------------


@query
def sort_values(spark, sf_dir):
    orders = star.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return number_sorted(orders, F.col("o_totalprice").desc(), F.col("o_orderkey").asc())


@query
def sort_ascending(spark, sf_dir):
    customers = star.table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return number_sorted(customers, F.col("c_mktsegment"), F.col("c_custkey"))


@query
def top_words(spark, sf_dir):
    counts = word_count(star.table(spark, sf_dir, "documents"), "text")
    return top_k(counts, 20, F.col("count").desc(), F.col("word"))


@query
def union_all(spark, sf_dir):
    customers = star.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"))
    suppliers = star.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("key"))
    return customers.unionByName(suppliers)


@query
def intersect_(spark, sf_dir):
    buyers = star.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("key"))
    suppliers = star.table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("key"))
    return intersect(buyers, suppliers)


@query
def word_count_df(spark, sf_dir):
    return word_count(star.table(spark, sf_dir, "documents"), "text")


@query
def word_count_rdd(spark, sf_dir):
    return word_count(star.table(spark, sf_dir, "documents"), "text", normalise=False)


@query
def word_pairs(spark, sf_dir):
    """(word, 1) pairs summed by key; the same as a raw word count."""
    words = split_words(star.table(spark, sf_dir, "conversations"), "text", normalise=False)
    return words.select("word", F.lit(1).alias("one")).groupBy("word").agg(F.sum("one").alias("count"))


@query
def reconcile_(spark, sf_dir):
    exact = sales.refunds_per_order(star.refunds(spark, sf_dir))
    altered = exact.withColumn(
        "refunds_eur",
        F.when(F.col("order_id").cast("long") % 100 == 0, F.col("refunds_eur") - 1).otherwise(
            F.col("refunds_eur")
        ),
    )
    return reconcile(exact, altered)


@query
def reconcile_keys(spark, sf_dir):
    """Orders against a copy with totals altered, some by less than the tolerance, other states, missing
    and added rows, and orders that are listed three times, one of them altered."""
    orders = star.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    kind = F.col("o_orderkey") % 50
    total = F.col("o_totalprice")
    three = F.when(kind == 5, F.array(F.lit(0), F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    copy = orders.filter(kind != 3).select(
        F.when(kind == 4, -F.col("o_orderkey")).otherwise(F.col("o_orderkey")).alias("o_orderkey"),
        F.when(kind == 2, "X").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(kind == 0, total + 1).when(kind == 1, total + 0.001).otherwise(total).alias("o_totalprice"),
        F.explode(three).alias("more"),
    )
    copy = copy.withColumn("o_totalprice", F.col("o_totalprice") + F.col("more")).drop("more")
    thrice = orders.withColumn("copy", F.explode(F.when(kind == 5, F.array(*map(F.lit, range(3)))).otherwise(F.array(F.lit(0)))))
    found = diff_by_key(thrice.drop("copy"), copy, ["o_orderkey"], abs_tol=0.01)
    number = F.col("column") == "o_totalprice"
    return found.select(
        "o_orderkey",
        "nth",
        "column",
        *[F.when(number, F.round(F.col(c).cast("double"), 2).cast("decimal(18,2)").cast("string")).otherwise(F.col(c)).alias(c) for c in ("left", "right")],
        F.round("delta", 2).alias("delta"),
    )


# --- files: written from the tables, then read back -------------------------------------


@query
def src_csv(spark, sf_dir):
    path = scratch_path(spark, "customers")
    write_csv(star.raw_customers(spark, sf_dir), path, sep=",")
    return read_customers(spark, path)


@query
def src_csv_infer(spark, sf_dir):
    path = scratch_path(spark, "customers")
    write_csv(star.table(spark, sf_dir, "customer"), path, sep=",")
    return spark.read.csv(path, header=True, inferSchema=True).withColumn(
        "c_custkey", F.col("c_custkey").cast("long")
    )


@query
def src_csv_refunds(spark, sf_dir):
    path = scratch_path(spark, "refunds")
    write_csv(star.raw_refunds(spark, sf_dir), path, sep=",")
    return read_refunds(spark, path)


def _write_order_lines(spark, sf_dir, path):
    """Nested orders, one per line, in compressed files. Such a file is read by one task, so a task
    writes several."""
    star.nested_orders(spark, sf_dir).write.option("maxRecordsPerFile", 100_000).json(path, compression="gzip")


@query
def src_json_nested(spark, sf_dir):
    path = scratch_path(spark, "orders")
    _write_order_lines(spark, sf_dir, path)
    return explode_items(read_orders(spark, f"{path}/*.json.gz", multiline=False))


@query
def src_json_arrays(spark, sf_dir):
    """Compressed files that hold one array over many lines, at most 10,000 orders each: such a file is
    read by one task, so its size is what has to be bounded."""
    path = scratch_path(spark, "orders")
    write_json_arrays(star.nested_orders(spark, sf_dir), path, compression="gzip")
    return explode_items(read_orders(spark, f"{path}/part-*"))


@query
def src_json_numbers(spark, sf_dir):
    """Quantities as numbers, some with an exponent and some above ten million, and as text."""
    path = scratch_path(spark, "orders")
    lines = star.table(spark, sf_dir, "lineitem")
    qty = (
        F.when(F.col("l_linenumber") == 1, F.concat(F.col("l_quantity").cast("int"), F.lit("e2")))
        .when(F.col("l_linenumber") == 2, F.concat(F.col("l_quantity").cast("int"), F.lit("000000")))
        .when(F.col("l_linenumber") == 3, F.concat(F.lit('"'), F.col("l_quantity").cast("int"), F.lit('e2"')))
        .otherwise(F.concat(F.lit('"'), F.replace(F.col("l_quantity").cast("string"), F.lit("."), F.lit(",")), F.lit('"')))
    )
    price = F.format_string("%.2f", "l_extendedprice")
    order = F.concat(
        F.lit('{"order_id":"'), "l_orderkey", F.lit("-"), "l_linenumber", F.lit('","items":[{"qty":'), qty,
        F.lit(',"unit_price":'), price, F.lit("}]}"),
    )
    write_lines(lines.select(order.alias("value")), path)
    items = explode_items(read_orders(spark, path, multiline=False))
    cleaned = sales.clean_lines(items).select("order_id", "item_qty_d", "item_unit_price_d")
    return cleaned.withColumn("bad", F.col("item_qty_d") == 0)


@query
def src_json_bad_counts(spark, sf_dir):
    """What ``src_json_numbers`` reads, counted by the metrics: only exponents in text are bad."""
    path = scratch_path(spark, "orders")
    lines = star.table(spark, sf_dir, "lineitem")
    number = F.concat(F.col("l_quantity").cast("int"), F.lit("E1"))
    qty = F.when(F.col("l_linenumber") == 1, number).otherwise(F.concat(F.lit('"'), number, F.lit('"')))
    order = F.concat(F.lit('{"payment_status":"paid","items":[{"qty":'), qty, F.lit(',"unit_price":1E0}]}'))
    write_lines(lines.select(order.alias("value")), path)
    return metrics.order_counts(read_orders(spark, path, multiline=False)).select(
        "orders_rows_paid", "items_qty_non_numeric", "items_unit_price_non_numeric"
    )


@query
def src_json_malformed(spark, sf_dir):
    """Every seventh order's line breaks off, every eleventh has a text where the items should be: the raw
    records that the reader puts aside, beside how many orders it read."""
    path = scratch_path(spark, "orders")
    whole = F.to_json(F.struct(F.col("o_orderkey").cast("string").alias("order_id"), F.lit("paid").alias("payment_status")))
    broken = F.when(F.col("o_orderkey") % 7 == 0, F.expr("left(line, length(line) - 5)"))
    odd = F.when(F.col("o_orderkey") % 11 == 0, F.replace(F.col("line"), F.lit("}"), F.lit(',"items":"none"}')))
    lines = star.table(spark, sf_dir, "orders").withColumn("line", whole)
    write_lines(lines.select(F.coalesce(broken, odd, "line").alias("value")), path)
    read = stage(read_orders(spark, path, multiline=False, malformed="malformed"), "orders")
    orders, quarantine = split_malformed(read, "malformed")
    paid = sales.paid_orders(orders).agg(F.count("*").alias("paid"))
    records = quarantine.select("record", F.col("file").contains("part-").alias("has_file"))
    return records.join(F.broadcast(paid))  # one row


@query
def src_csv_drift(spark, sf_dir):
    """Orders in three sets of files: one has a further column and text for the customer, one whole
    numbers for the total, no customer, and its columns in another order."""
    path = scratch_path(spark, "orders")
    orders = star.table(spark, sf_dir, "orders")
    total, key = F.col("o_totalprice"), F.col("o_orderkey")
    sets = {
        "F": [key, F.col("o_custkey"), total],
        "O": [F.floor(total).cast("long").alias("o_totalprice"), key],
        "P": [key, F.concat(F.lit("C"), "o_custkey").alias("o_custkey"), total, F.col("o_orderpriority")],
    }
    for status, columns in sets.items():
        write_csv(orders.filter(F.col("o_orderstatus") == status).select(*columns), f"{path}/{status}", sep=",")
    return read_drifting_csv(spark, f"{path}/*")


@query
def src_text(spark, sf_dir):
    path = scratch_path(spark, "lines")
    write_lines(star.table(spark, sf_dir, "documents"), path, "text")
    return read_lines(spark, path)


@query
def sink_csv(spark, sf_dir):
    path = scratch_path(spark, "daily")
    write_csv(star_sales(spark, sf_dir).daily_city_sales, path, sort_by=["date", "city", "channel"])
    return spark.read.schema(DAILY_SCHEMA).option("header", True).csv(path, sep=";")


@query
def sink_csv_order(spark, sf_dir):
    """Where each row stands in the sorted CSV: by the names of the parts, then by line."""
    path = scratch_path(spark, "daily")
    write_csv(star_sales(spark, sf_dir).daily_unsorted, path, sort_by=["date", "city", "channel"])
    back = spark.read.schema(DAILY_SCHEMA).option("header", True).csv(path, sep=";")
    file, block = F.col("_metadata.file_name"), F.col("_metadata.file_block_start")
    rows = back.select("date", "city", "channel", file.alias("file"), block.alias("block"))
    rows = rows.withColumn("line", F.monotonically_increasing_id())  # rises within a block
    return number_sorted(rows, F.col("file"), F.col("block"), F.col("line")).drop("file", "block", "line")


def _daily_by_date(spark, sf_dir):
    path = scratch_path(spark, "daily")
    write_partitioned_csv(stage(star_sales(spark, sf_dir).daily_unsorted, "daily"), path, sort_by=["city", "channel"])
    reader = spark.read.schema(DAILY_SCHEMA + ", date_key string").option("header", True)
    return reader.csv(path, sep=";")


@query
def sink_partitioned(spark, sf_dir):
    return _daily_by_date(spark, sf_dir)


@query
def sink_partitioned_filter(spark, sf_dir):
    """One year of the dates: the other folders are not read."""
    return _daily_by_date(spark, sf_dir).filter(F.col("date_key").between("19970101", "19971231"))


@query
def sink_partitioned_rerun(spark, sf_dir):
    """All months, then 1995 again with other amounts: only its folders are replaced."""
    path = scratch_path(spark, "monthly")
    month = F.date_format(F.trunc("o_orderdate", "month"), "yyyy-MM-dd").alias("date")
    orders = star.table(spark, sf_dir, "orders").groupBy(month, "o_orderstatus")
    monthly = stage(orders.agg(F.round(F.sum("o_totalprice"), 2).alias("total")), "monthly", compact=True)
    again = monthly.filter(F.col("date").startswith("1995-")).withColumn("total", -F.col("total"))
    for run in (monthly, again):
        write_partitioned_csv(run, path, sort_by=["o_orderstatus"])
    reader = spark.read.schema("date string, o_orderstatus string, total double, date_key string")
    return reader.option("header", True).csv(path, sep=";")


@query
def dates_from_table(spark, sf_dir):
    """Line items of the months in which some order was urgent and cost over 490,000: the months come
    from a table, and the other folders are not read."""
    path = scratch_path(spark, "lines")
    lines = star.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")
    lines = lines.withColumn("month", F.date_format("l_shipdate", "'m'yyyyMM")).drop("l_shipdate")
    lines.repartition("month").write.partitionBy("month").parquet(path)
    orders = star.table(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT' and o_totalprice > 490000")
    months = orders.select(F.date_format("o_orderdate", "'m'yyyyMM").alias("month"))
    stored = spark.read.schema("l_orderkey long, l_linenumber int, l_quantity double, month string").parquet(path)
    return keep_dates(stored, months, "month", "month")


def _table_name(path: str) -> str:
    return path.rsplit("/", 1)[1].replace("-", "_")


@query
def sink_table_swap(spark, sf_dir):
    """A table of all daily sales, replaced by those of the web channel, which are read from the table
    itself."""
    path = scratch_path(spark, "daily")
    name = _table_name(path)
    replace_table(rounded_daily(star_sales(spark, sf_dir).daily_unsorted), name, path=path)
    replace_table(spark.table(name).filter("channel = 'web'"), name, path=path)
    return spark.table(name)


@query
def join_bucketed(spark, sf_dir):
    """Orders with the sums of their line items, both from tables that are stored by order."""
    orders, lines = scratch_path(spark, "orders"), scratch_path(spark, "lines")
    save_bucketed(star.table(spark, sf_dir, "orders"), _table_name(orders), ["o_orderkey"], 8, path=orders)
    save_bucketed(star.table(spark, sf_dir, "lineitem"), _table_name(lines), ["l_orderkey"], 8, path=lines)
    sums = spark.table(_table_name(lines)).groupBy("l_orderkey").agg(F.sum("l_quantity").alias("quantity"))
    stored = spark.table(_table_name(orders)).select("o_orderkey", "o_totalprice")
    return stored.join(sums, F.col("o_orderkey") == F.col("l_orderkey"), "left").drop("l_orderkey")


@query
def sink_table(spark, sf_dir):
    path = scratch_path(spark, "daily")
    name = _table_name(path)
    save_table(rounded_daily(star_sales(spark, sf_dir).daily_city_sales), name, path=path)
    return spark.table(name)


@query
def sink_table_fallback(spark, sf_dir):
    """No such JDBC driver: the rows go to CSV instead."""
    path = scratch_path(spark, "daily")
    save_table(
        star_sales(spark, sf_dir).daily_city_sales,
        "daily_city_sales",
        format="jdbc",
        url="jdbc:none:daily",
        driver="none.Driver",
        fallback_format="csv",
        fallback_path=path,
    )
    return spark.read.schema(DAILY_SCHEMA).option("header", True).csv(path, sep=";")


@query
def run_metrics_(spark, sf_dir):
    customers = star.raw_customers(spark, sf_dir)
    refunds = star.raw_shipment_refunds(spark, sf_dir)
    orders = stage(star.nested_orders(spark, sf_dir), "orders")
    tables = build_daily_sales(star.customers(spark, sf_dir), clean_refunds(refunds), orders)
    tables = tables.on_staged(stage(tables.per_order, "per_order"))
    return run_metrics(
        metrics.customer_counts(customers),
        metrics.refund_counts(refunds),
        metrics.order_counts(orders),
        metrics.row_count(tables.orders_clean, "orders_clean_rows"),
        metrics.row_count(tables.daily_unsorted, "daily_city_sales_rows"),
    )


def _run_job(spark, sf_dir, **options) -> tuple[str, DataFrame]:
    source, out = scratch_path(spark, "input"), scratch_path(spark, "output")
    write_csv(star.raw_customers(spark, sf_dir), f"{source}/customers", sep=",")
    write_csv(star.raw_shipment_refunds(spark, sf_dir), f"{source}/refunds", sep=",")
    _write_order_lines(spark, sf_dir, f"{source}/orders")
    report = run_sales_job(
        spark,
        f"{source}/customers",
        f"{source}/refunds",
        f"{source}/orders/*.json.gz",
        out,
        multiline=False,
        **options,
    )
    return out, report


@query
def job_daily(spark, sf_dir):
    """The whole job from files to files; its daily CSV."""
    out, _ = _run_job(spark, sf_dir)
    path = f"{out}/out/daily_summary_all"
    return spark.read.schema(DAILY_SCHEMA).option("header", True).csv(path, sep=";")


@query
def job_fallback(spark, sf_dir):
    """The whole job without the driver of its database: the daily table as CSV instead, in the
    format of the job's other files."""
    jdbc = {"url": "jdbc:none:daily", "driver": "none.Driver"}
    out, _ = _run_job(spark, sf_dir, jdbc=jdbc, sep=",", float_format=None)
    path = f"{out}/db/daily_city_sales"
    return rounded_daily(spark.read.schema(DAILY_SCHEMA).option("header", True).csv(path, sep=","))


@query
def job_rejects(spark, sf_dir):
    """The rejects that the whole job writes, read back."""
    out, _ = _run_job(spark, sf_dir)
    reader = spark.read.schema(REJECTS_SCHEMA).option("header", True)
    return reader.csv(f"{out}/rejects/rejects_items", sep=";")


@query
def run_report(spark, sf_dir):
    """The whole job from files to files; the counters of its report."""
    _, report = _run_job(spark, sf_dir)
    return report.select("status", *metrics.COUNTERS)
