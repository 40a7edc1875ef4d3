from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_sketches(df: DataFrame, keys: list[str], values: Mapping[str, str], log_size: int = 12) -> DataFrame:
    """Per key a sketch of the distinct values of some columns, {sketch name: column}: a binary of at
    most about 2**log_size bytes, however many rows there are, which can be stored and merged later.
    Values are whole numbers, text or binary; nulls do not count. Sketches are built in each task
    before the shuffle, so a hot key sends no more than any other."""
    return df.groupBy(*keys).agg(*[F.hll_sketch_agg(c, F.lit(log_size)).alias(name) for name, c in values.items()])


def merge_sketches(df: DataFrame, keys: list[str | Column], sketches: list[str]) -> DataFrame:
    """Sketches of coarser keys (months from days) from stored ones: the same as sketches of all the
    rows, which are not read again."""
    return df.groupBy(*keys).agg(*[F.hll_union_agg(c, F.lit(False)).alias(c) for c in sketches])


def distinct_estimates(df: DataFrame, sketches: list[str]) -> DataFrame:
    """Each sketch replaced by its estimate."""
    return df.withColumns({c: F.hll_sketch_estimate(c) for c in sketches})


def relative_error(log_size: int = 12) -> float:
    """Standard error of an estimate, as a share of the count."""
    return 1.04 / 2 ** (log_size / 2)
