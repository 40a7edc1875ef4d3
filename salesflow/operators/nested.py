from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def explode_items(
    df: DataFrame,
    column: str = "items",
    prefix: str = "item_",
    position: str = "pos",
    keep_empty: bool = False,
) -> DataFrame:
    """One row per element of an array of structs, its fields as columns with a prefix.

    ``position`` holds the element's place in the array. Rows with an empty or null array
    vanish unless keep_empty=True, which gives them one row of nulls."""
    rest = [c for c in df.columns if c != column]
    fields = df.schema[column].dataType.elementType.names
    explode = F.posexplode_outer if keep_empty else F.posexplode
    return df.select(*rest, explode(column).alias(position, "_item")).select(
        *rest, position, *[F.col("_item")[f].alias(prefix + f) for f in fields]
    )
