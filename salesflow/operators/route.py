from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def route_rejects(df: DataFrame, condition: Column) -> tuple[DataFrame, DataFrame]:
    """Split rows into (kept, rejects). A condition that is null keeps its row, so that every
    row lands on exactly one side."""
    bad = F.coalesce(condition, F.lit(False))
    return df.filter(~bad), df.filter(bad)
