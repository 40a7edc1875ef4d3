"""From order lines to ``orders_clean`` and ``daily_city_sales``. Nothing here reads or writes."""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesflow.functions import parse_date, safe_double
from salesflow.operators import explode_items, keep_first, route_rejects

# The status that counts, and the columns of the results in their order.
PAID = "paid"
ORDER_KEYS = ["order_id", "customer_id", "channel", "created_at"]
ORDERS_CLEAN = [
    "order_id",
    "customer_id",
    "city",
    "channel",
    "order_date",
    "items_sold",
    "gross_revenue_eur",
]
DAILY_GROUPS = ["date", "city", "channel"]
DAILY_CITY_SALES = [
    *DAILY_GROUPS,
    "orders_count",
    "unique_customers",
    "items_sold",
    "gross_revenue_eur",
    "refunds_eur",
    "net_revenue_eur",
]


@dataclass(frozen=True)
class SalesOptions:
    """dedup: "line" keeps the first surviving line of each order; "order" drops repeated
    orders and keeps all lines of the first one. on_bad_date: "null" or "error".
    money: "double", or "decimal" for exact sums: quantities and prices are taken to four decimals,
    their products added as they are, and only the daily sums are rounded to cents, once.
    dedup_customers: keep one city per customer instead of one result row per duplicate."""

    dedup: str = "line"
    keep_empty: bool = False
    on_bad_date: str = "null"
    money: str = "double"
    dedup_customers: bool = False

    def __post_init__(self):
        if self.dedup not in ("line", "order"):
            raise ValueError(f"dedup must be 'line' or 'order', not {self.dedup!r}")
        if self.money not in ("double", "decimal"):
            raise ValueError(f"money must be 'double' or 'decimal', not {self.money!r}")
        if self.on_bad_date not in ("null", "error"):
            raise ValueError(f"on_bad_date must be 'null' or 'error', not {self.on_bad_date!r}")


@dataclass(frozen=True)
class SalesTables:
    """The tables of the sales plan; the later ones are planned when they are first asked for."""

    customers: DataFrame
    refunds: DataFrame
    kept: DataFrame
    rejects: DataFrame
    order_totals: DataFrame
    options: SalesOptions
    staged_per_order: DataFrame | None = None

    @cached_property
    def per_order(self) -> DataFrame:
        if self.staged_per_order is not None:
            return self.staged_per_order
        return with_refunds(self.order_totals, self.refunds, self.options.money)

    @cached_property
    def active_customers(self) -> DataFrame:
        return active_customers(self.customers, self.options.dedup_customers)

    @cached_property
    def orders_clean(self) -> DataFrame:
        return orders_clean(self.per_order, self.active_customers, self.options.on_bad_date)

    @cached_property
    def daily_unsorted(self) -> DataFrame:
        return daily_city_sales(self.per_order, self.active_customers, self.options)

    @cached_property
    def daily_city_sales(self) -> DataFrame:
        return self.daily_unsorted.orderBy(*DAILY_GROUPS)

    def on_staged(self, per_order: DataFrame) -> SalesTables:
        """The same tables with ``per_order``, written and read back, as their new start."""
        return replace(self, staged_per_order=per_order)


def paid_orders(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("payment_status") == PAID)


def clean_lines(lines: DataFrame) -> DataFrame:
    """Quantity and price as doubles beside the raw columns."""
    return lines.withColumns(
        {
            "item_qty_d": safe_double("item_qty"),
            "item_unit_price_d": safe_double("item_unit_price"),
        }
    )


def split_lines(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, rejects): lines with a negative unit price are rejected."""
    return route_rejects(clean_lines(lines), F.col("item_unit_price_d") < 0)


FACTOR, AMOUNT = "decimal(13,4)", "decimal(27,8)"  # the product of two factors is an amount


def _line_gross(money: str) -> Column:
    if money == "decimal":
        return (F.col("item_qty_d").cast(FACTOR) * F.col("item_unit_price_d").cast(FACTOR)).cast(AMOUNT)
    return F.col("item_qty_d") * F.col("item_unit_price_d")


def _sum_money(amount: Column, money: str) -> Column:
    return F.sum(amount).cast(AMOUNT) if money == "decimal" else F.sum(amount)


def per_order(lines: DataFrame, money: str = "double") -> DataFrame:
    """Items and gross revenue per order, summed over all its lines."""
    return lines.groupBy(*ORDER_KEYS).agg(
        F.sum("item_qty_d").cast("long").alias("items_sold"),
        _sum_money(_line_gross(money), money).alias("gross_revenue_eur"),
    )


def first_line_per_order(lines: DataFrame, money: str = "double") -> DataFrame:
    """The same columns from each order's first line. One line per order is left, so there is
    nothing to sum and no second aggregation. Only the columns of the result are compared and
    shuffled: lines that tie on all of them give the same result."""
    needed = lines.select(*ORDER_KEYS, "pos", "item_qty_d", "item_unit_price_d")
    return keep_first(needed, ["order_id"], ["created_at", "pos"]).select(
        *ORDER_KEYS,
        F.col("item_qty_d").cast("long").alias("items_sold"),
        _line_gross(money).alias("gross_revenue_eur"),
    )


def refunds_per_order(refunds: DataFrame, money: str = "double") -> DataFrame:
    amount = F.col("amount").cast(FACTOR).cast(AMOUNT) if money == "decimal" else F.col("amount")
    total = _sum_money(amount, money)
    return refunds.groupBy("order_id").agg(total.alias("refunds_eur"))


def with_refunds(orders: DataFrame, refunds: DataFrame, money: str = "double") -> DataFrame:
    """Add the refunds of each order, 0.0 where there are none. Refunds of other orders are
    dropped. After the dedup both sides are partitioned by order_id, so the join itself shuffles
    nothing."""
    return orders.join(refunds_per_order(refunds, money), "order_id", "left").withColumn(
        "refunds_eur", F.coalesce("refunds_eur", F.lit(0).cast(AMOUNT if money == "decimal" else "double"))
    )


def active_customers(customers: DataFrame, dedup: bool = False) -> DataFrame:
    active = customers.filter("is_active").select("customer_id", "city")
    return active.groupBy("customer_id").agg(F.min("city").alias("city")) if dedup else active


def with_city(orders: DataFrame, active: DataFrame) -> DataFrame:
    """Orders of active customers with their city. Filtering the customers first and joining
    inner equals a left join followed by the filter, and moves less data."""
    return orders.join(active, "customer_id")


def orders_clean(orders: DataFrame, active: DataFrame, on_bad_date: str = "null") -> DataFrame:
    return (
        with_city(orders, active)
        .withColumn("order_date", parse_date("created_at", on_bad_date))
        .withColumn("gross_revenue_eur", F.col("gross_revenue_eur").cast("double"))
        .select(*ORDERS_CLEAN)
    )


def daily_city_sales(
    orders: DataFrame, active: DataFrame, options: SalesOptions = SalesOptions()
) -> DataFrame:
    """Sales per date, city and channel, unsorted.

    Orders are summed per date, channel and customer before customers are joined: a customer
    with a third of all orders shrinks to a few rows first. As ``orders`` holds each order once,
    counting rows there is counting distinct orders, and customers are distinct per group
    already, so no DISTINCT aggregate (and no copy of the rows per aggregate) is needed.
    A customer listed twice in one city counts double in the sums, but once in the counts."""
    date = parse_date("created_at", options.on_bad_date).alias("date")
    money = ["gross_revenue_eur", "refunds_eur"]
    cities = active.groupBy("customer_id", "city").agg(F.count("*").cast("int").alias("listed"))
    parts = orders.groupBy(date, "channel", "customer_id").agg(
        F.count("order_id").alias("orders_count"),
        F.sum("items_sold").alias("items_sold"),
        *[_sum_money(F.col(c), options.money).alias(c) for c in money],
    )
    daily = (
        parts.join(cities, "customer_id")
        .groupBy(*DAILY_GROUPS)
        .agg(
            F.sum("orders_count").alias("orders_count"),
            F.count("customer_id").alias("unique_customers"),
            F.sum(F.col("items_sold") * F.col("listed")).alias("items_sold"),
            *[F.sum(F.col(c) * F.col("listed")).alias(c) for c in money],
        )
    )
    net = F.col("gross_revenue_eur") + F.col("refunds_eur")
    amounts = {**{c: F.col(c) for c in money}, "net_revenue_eur": net}
    if options.money == "decimal":
        amounts = {name: F.round(amount, 2) for name, amount in amounts.items()}
    return daily.select(
        *DAILY_GROUPS,
        "orders_count",
        "unique_customers",
        "items_sold",
        *[amount.cast("double").alias(name) for name, amount in amounts.items()],
    )


def sales_from_lines(
    customers: DataFrame,
    refunds: DataFrame,
    lines: DataFrame,
    options: SalesOptions = SalesOptions(),
) -> SalesTables:
    """All tables from flat order lines: one row per item, with its place ``pos`` in the order."""
    if options.dedup != "line":
        raise ValueError("flat lines can only be deduplicated by line")
    kept, rejects = split_lines(paid_orders(lines))
    totals = first_line_per_order(kept, options.money)
    return SalesTables(customers, refunds, kept, rejects.drop("pos"), totals, options)


def build_daily_sales(
    customers: DataFrame,
    refunds: DataFrame,
    orders: DataFrame,
    options: SalesOptions = SalesOptions(),
) -> SalesTables:
    """All tables from nested orders (``items`` is an array of structs), cleaned customers and
    cleaned refunds."""
    paid = paid_orders(orders)
    kept, rejects = split_lines(explode_items(paid, keep_empty=options.keep_empty))
    if options.dedup == "line":
        totals = first_line_per_order(kept, options.money)
    else:
        first = keep_first(paid, ["order_id"], ["created_at"])
        kept, _ = split_lines(explode_items(first, keep_empty=options.keep_empty))
        totals = per_order(kept, options.money)
    return SalesTables(customers, refunds, kept, rejects.drop("pos"), totals, options)
