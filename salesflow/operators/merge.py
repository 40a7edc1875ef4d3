from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesflow.operators.order import number_sorted
from salesflow.staging import stage


def merge_values(
    df: DataFrame,
    key: Column,
    value: Column,
    merge: Callable[[Column, Column], Column],
    *,
    order_by: list[Column] = (),
    fan_in: int = 1000,
) -> DataFrame:
    """``(key, value)``: all values of a key merged into one by the caller's expression, ``merge(a, b)``
    of two values, which must be associative and give the type of the values. Values are merged in the
    order of ``order_by`` and, where that leaves it open, in no particular order. Null values are left
    out; a key without others has no row. ``key=F.lit(0)`` merges all rows.

    A distributed sort gives each value its place in its key. Neighbours are folded by ``fan_in``, what
    they give is folded again, until one is left: no task holds more than ``fan_in`` values of a key at
    once, and a hot key is folded by many tasks. Keys of fewer rows than that take one level."""
    order = {f"_order{i}": c for i, c in enumerate(order_by)}
    rows = df.select(
        key.alias("key"),
        value.alias("value"),
        *[c.alias(name) for name, c in order.items()],
        F.monotonically_increasing_id().alias("_row"),
    ).filter(F.col("value").isNotNull())
    numbered = number_sorted(rows, F.col("key"), *map(F.col, order), F.col("_row"), name="_number")
    first = stage(numbered.groupBy(F.col("key").alias("_key")).agg(F.min("_number").alias("_first")), "first", compact=True)
    # Spark broadcasts ``first`` by its measured size, or splits a large key in the join
    rows = numbered.join(first, F.col("key").eqNullSafe(F.col("_key"))).select(
        "key", (F.col("_number") - F.col("_first")).alias("_at"), "value"
    )
    last = rows.agg(F.coalesce(F.max("_at"), F.lit(0))).first()[0]
    while True:
        block = F.floor(F.col("_at") / fan_in).alias("_at")
        blocks = rows.groupBy("key", block).agg(F.sort_array(F.collect_list(F.struct("_at", "value"))).alias("_rows"))
        values = F.transform("_rows", lambda r: r["value"])
        rows = blocks.select("key", "_at", values.alias("_values")).select(
            "key", "_at", F.reduce(F.slice("_values", 2, fan_in), F.element_at("_values", 1), merge).alias("value")
        )
        last //= fan_in
        if not last:
            return rows.select("key", "value")
