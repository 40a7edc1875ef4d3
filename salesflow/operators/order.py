from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesflow.staging import stage

_ROW_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def top_k(df: DataFrame, k: int, *order_by: Column) -> DataFrame:
    """The first k rows in a total order; each task keeps only its own k best."""
    return df.orderBy(*order_by).limit(k)


def number_sorted(df: DataFrame, *order_by: Column, name: str = "position") -> DataFrame:
    """Rows with their place (from 1) in the global sort order. ``order_by`` must be total.

    The sort stays distributed. It is written once with row numbers per sort partition; the
    start of each partition is then a running sum over one row per partition."""
    rows = stage(df.orderBy(*order_by).withColumn("_at", F.monotonically_increasing_id()), "sorted")
    partition = F.shiftright("_at", _ROW_BITS)
    before = Window.orderBy("_partition").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy(partition.alias("_partition"))
        .agg(F.count("*").alias("_rows"))
        .select("_partition", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    )
    row = F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    # one row per sort partition, so never more than spark.sql.shuffle.partitions rows
    return rows.join(F.broadcast(starts), partition == F.col("_partition")).select(
        *df.columns, (F.col("_start") + row + 1).alias(name)
    )
