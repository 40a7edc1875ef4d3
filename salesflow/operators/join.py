from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesflow.staging import stage


def join_dimension(
    facts: DataFrame, dimension: DataFrame, fact_key: str, dimension_key: str, how: str = "inner"
) -> DataFrame:
    """Join a large table that may be skewed on its key with a dimension.

    Inner and left joins go to Spark as they are: a small dimension is broadcast, and a hot key
    on the fact side is split at run time. Spark can do neither for right and full joins, so
    these take the inner or left join and add the dimension rows that no fact refers to. All
    columns of both sides are in the result, in their order; equal names stay apart by position."""
    if how not in ("inner", "left", "right", "full"):
        raise ValueError(f"how must be inner, left, right or full, not {how!r}")
    left = facts.toDF(*[f"f{i}" for i in range(len(facts.columns))])
    right = dimension.toDF(*[f"d{i}" for i in range(len(dimension.columns))])
    a, b = f"f{facts.columns.index(fact_key)}", f"d{dimension.columns.index(dimension_key)}"
    names = [*facts.columns, *dimension.columns]
    if how in ("inner", "left"):
        return left.join(right, left[a] == right[b], how).toDF(*names)
    matched = left.join(right, left[a] == right[b], "inner" if how == "right" else "left")
    used = left.select(left[a].alias("used")).distinct()
    unused = right.join(used, right[b] == used["used"], "left_anti")
    return matched.unionByName(unused, allowMissingColumns=True).toDF(*names)


def keep_dates(df: DataFrame, dates: DataFrame, partition: str, date: str) -> DataFrame:
    """Rows of ``df``, stored in one folder per value of ``partition``, whose value is among those of the
    column ``date``, text as well. The values never pass through the driver: they are written, as one row per
    date, and broadcast (the calendar bounds them), and the scan of ``df`` is pruned by that broadcast at run
    time, so that other folders are not read."""
    wanted = stage(dates.select(F.col(date).cast("string").alias("_date")).distinct(), "dates", compact=True)
    # Spark prunes by a side that is filtered; all dates pass this filter, null does not
    wanted = wanted.filter(F.col("_date") >= "")
    return df.join(F.broadcast(wanted), F.col(partition) == F.col("_date"), "left_semi")
