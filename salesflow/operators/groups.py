from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesflow.operators.order import number_sorted
from salesflow.staging import stage


def group_values(df: DataFrame, key: Column, value: Column, max_values: int = 10_000) -> DataFrame:
    """All values per key as sorted arrays of at most ``max_values``: rows ``(key, chunk, values)``,
    whatever the sizes. Chunk 0 of a key holds its first values, chunk 1 the next, and so on.

    The rows are numbered by a distributed sort, so a value's place within its key is its number
    less that of the key's first row, and neither a large key nor many copies of one value ever
    meet in one task."""
    rows = df.select(key.alias("key"), value.alias("value"), F.monotonically_increasing_id().alias("_row"))
    numbered = number_sorted(rows, F.col("key"), F.col("value"), F.col("_row"), name="_number")
    first = numbered.groupBy(F.col("key").alias("_key")).agg(F.min("_number").alias("_first"))
    chunk = F.floor((F.col("_number") - F.col("_first")) / max_values)
    # No broadcast hint: Spark measures ``first`` at run time, broadcasts it when it is small and
    # otherwise splits a large key in the join. Reading ``first`` from files and the explicit
    # repartition let it do so.
    return (
        numbered.join(stage(first, "first"), F.col("key").eqNullSafe(F.col("_key")))
        .select("key", chunk.cast("long").alias("chunk"), "_number", "value")
        .repartition("key", "chunk")
        .groupBy("key", "chunk")
        .agg(F.sort_array(F.collect_list(F.struct("_number", "value"))).alias("_sorted"))
        .select("key", "chunk", F.transform("_sorted", lambda v: v["value"]).alias("values"))
    )
