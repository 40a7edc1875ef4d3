from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesflow.operators.order import number_sorted
from salesflow.staging import stage


def reconcile(left: DataFrame, right: DataFrame, ndigits: int = 2, numeric: tuple[str, ...] = ()) -> DataFrame:
    """Rows in which two tables differ, after rounding numbers; empty when they are equal.

    Adds ``side`` ('left' or 'right') and ``copies``, how many more of the row that side has.
    ``numeric`` names text columns to compare as numbers. Both tables are counted together in
    one aggregation, instead of two EXCEPT ALL passes."""
    if left.columns != right.columns:
        raise ValueError(f"different columns: {left.columns} and {right.columns}")

    def rounded(df: DataFrame, weight: int) -> DataFrame:
        columns = []
        for field in df.schema.fields:
            c = F.col(field.name)
            if field.name in numeric or isinstance(field.dataType, T.DecimalType):
                c = c.cast("double")
            if field.name in numeric or isinstance(field.dataType, T.FractionalType):
                c = F.round(c.cast("double"), ndigits)
            columns.append(c.alias(field.name))
        return df.select(*columns, F.lit(weight).cast("long").alias("_weight"))

    balance = (
        rounded(left, 1)
        .unionByName(rounded(right, -1))
        .groupBy(*left.columns)
        .agg(F.sum("_weight").alias("_balance"))
        .filter("_balance <> 0")
    )
    return balance.select(
        *left.columns,
        F.when(F.col("_balance") > 0, "left").otherwise("right").alias("side"),
        F.abs("_balance").alias("copies"),
    )


ROWS = "*"  # stands for the number of rows where a difference is no column's


def _same(keys: list[str], other: list[str]) -> Column:
    return reduce(Column.__and__, (F.col(a).eqNullSafe(F.col(b)) for a, b in zip(keys, other, strict=True)))


def _numbered_in_key(rows: DataFrame, keys: list[str], rest: list[str]) -> DataFrame:
    """``_nth``: the place of a row among those of its key and side, by a distributed sort."""
    sides = ["_side", *keys]
    numbered = number_sorted(rows, *map(F.col, [*sides, *rest, "_copies"]), name="_at")
    names = [f"_first{i}" for i in range(len(sides))]
    first = numbered.groupBy(*[F.col(c).alias(n) for c, n in zip(sides, names, strict=True)]).agg(F.min("_at").alias("_first"))
    joined = numbered.join(stage(first, "first", compact=True), _same(sides, names))
    return joined.select(*rows.columns, (F.col("_at") - F.col("_first")).alias("_nth"))


def diff_by_key(
    left: DataFrame, right: DataFrame, keys: list[str], *, abs_tol: float = 0.0, rel_tol: float = 0.0
) -> DataFrame:
    """What differs between two tables with the same columns: ``(keys..., nth, column, left, right, delta)``,
    a row per key and column, values as text, and for numbers ``right - left``. Numbers agree within
    ``abs_tol`` or within ``rel_tol`` of the larger; nulls agree with nulls, NaN with NaN. Null is a key
    like any other.

    Rows found on both sides cancel out first, copy for copy, in one aggregation that sums copies
    inside each task. The rest is aligned by key in another. Keys that repeat on a side are aligned in the order of
    the other columns, ``nth`` from 0; they are numbered by a distributed sort, so that a key with very
    many rows meets in no task. A row with no partner, or another number of copies than its partner, is
    a row with column ``*`` whose values are numbers of rows."""
    rest = [c for c in left.columns if c not in keys]
    if set(left.columns) != set(right.columns) or not set(keys) <= set(left.columns):
        raise ValueError(f"different columns, or no such keys: {left.columns}, {right.columns}, {keys}")
    weighted = left.withColumn("_weight", F.lit(1)).unionByName(right.withColumn("_weight", F.lit(-1)))
    balance = weighted.groupBy(*left.columns).agg(F.sum("_weight").alias("_balance")).filter("_balance <> 0")
    side = F.when(F.col("_balance") > 0, "left").otherwise("right")
    rows = stage(balance.select(*keys, *rest, side.alias("_side"), F.abs("_balance").alias("_copies")), "unequal")

    values = F.struct(*rest, "_copies")
    of_side = lambda name: F.col("_side") == name
    aligned = [
        F.max(F.when(of_side("left"), values)).alias("_l"),
        F.max(F.when(of_side("right"), values)).alias("_r"),
    ]
    counts = [F.count_if(of_side("left")).alias("_nl"), F.count_if(of_side("right")).alias("_nr")]
    by_key = stage(rows.groupBy(*keys).agg(*aligned, *counts), "by_key")
    single = F.greatest("_nl", "_nr") == 1
    one = by_key.filter(single).select(*keys, F.lit(0).cast("long").alias("_nth"), "_l", "_r")
    names = [f"_key{i}" for i in range(len(keys))]
    repeated = by_key.filter(~single).select(*[F.col(c).alias(n) for c, n in zip(keys, names, strict=True)])
    many = rows.join(repeated, _same(keys, names), "left_semi")
    pairs = one.unionByName(_numbered_in_key(many, keys, rest).groupBy(*keys, "_nth").agg(*aligned))

    def copies(side: str) -> Column:
        return F.coalesce(F.col(side)["_copies"], F.lit(0)).cast("long")

    def difference(name: str, left: Column, right: Column, unequal: Column, delta: Column) -> Column:
        found = F.struct(
            F.lit(name).alias("column"),
            left.cast("string").alias("left"),
            right.cast("string").alias("right"),
            delta.cast("double").alias("delta"),
        )
        return F.when(unequal, found)

    both = F.col("_l").isNotNull() & F.col("_r").isNotNull()
    found = [difference(ROWS, copies("_l"), copies("_r"), copies("_l") != copies("_r"), copies("_r") - copies("_l"))]
    for field in left.schema.fields:
        if field.name in rest:
            a, b = F.col("_l")[field.name], F.col("_r")[field.name]
            equal, delta = a.eqNullSafe(b), F.lit(None)
            if isinstance(field.dataType, T.NumericType):
                x, y = a.cast("double"), b.cast("double")
                delta = y - x
                near = F.abs(delta) <= F.greatest(F.lit(float(abs_tol)), F.lit(float(rel_tol)) * F.greatest(F.abs(x), F.abs(y)))
                # a difference that is infinite or no number is within no tolerance
                equal = equal | F.coalesce(near & (F.abs(delta) < math.inf), F.lit(False))
            found.append(difference(field.name, a, b, both & ~equal, delta))
    each = F.explode(F.filter(F.array(*found), lambda d: d.isNotNull())).alias("_found")
    return pairs.select(*keys, F.col("_nth").alias("nth"), each).select(*keys, "nth", "_found.*")
