"""CSV files whose columns drift: added, missing, in another order, or of another type."""

from __future__ import annotations

import csv
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesflow.sources.files import Paths, _load

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def common_type(types: list[T.DataType]) -> T.DataType:
    """The narrowest type that holds the values of all types; text holds everything."""
    if all(t == types[0] for t in types):
        return types[0]
    if all(isinstance(t, _WHOLE) for t in types):
        return T.LongType()
    if all(isinstance(t, T.NumericType) for t in types):
        return T.DoubleType()
    if all(isinstance(t, (T.DateType, T.TimestampType)) for t in types):
        return T.TimestampType()
    return T.StringType()


def _headers(spark: SparkSession, path: Paths) -> list[tuple[str, list[str]]]:
    """(header line, its files), the header of the first file first. A file's header is its first line
    that is not empty, found by one pass over the lines; only that line leaves a task. The list of
    files is as long as the one that Spark's own reader holds."""
    lines = _load(spark.read, "text", path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),  # rises within a block
    )
    first = lines.filter("block = 0 and trim(value) <> ''").groupBy("file").agg(F.min_by("value", "at").alias("header"))
    groups = first.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files"))
    return [(r["header"], r["files"]) for r in groups.orderBy(F.col("files")[0]).collect()]


def _names(header: str, sep: str) -> list[str]:
    names = [n.strip() for n in next(csv.reader([header.removeprefix("\ufeff")], delimiter=sep))]
    if len({n.lower() for n in names}) < len(names) or "" in names:
        raise ValueError(f"repeated or empty column name in header {header!r}")
    return names


def read_drifting_csv(spark: SparkSession, path: Paths, *, sep: str = ",", infer: bool = True) -> DataFrame:
    """All rows of CSV files (UTF-8, with headers) that need not agree on their columns.

    Files with the same header are read together, and the groups are united by column name: a column
    that a file lacks is null in its rows. With ``infer`` the types found in each group are widened to a
    common one (whole to fractional numbers, dates to timestamps, anything else to text), which every
    file is then read with, so that no value is cast that does not fit; a column without any value has no
    say. Without ``infer`` all columns are text. Columns are in the order in which the files, by name,
    bring them. Names that differ in case only are an error."""
    groups = [(_names(header, sep), files) for header, files in _headers(spark, path)]
    if not groups:
        raise FileNotFoundError(f"no input file with a header: {path}")
    order = list(dict.fromkeys(name for names, _ in groups for name in names))
    if len({n.lower() for n in order}) < len(order):
        raise ValueError(f"column names that differ in case only: {order}")

    def read(names: list[str], files: list[str], types: dict[str, T.DataType] | None) -> DataFrame:
        reader = spark.read.option("header", True).option("sep", sep)
        if types is None:
            return reader.option("inferSchema", True).csv(files).toDF(*names)
        return reader.schema(T.StructType([T.StructField(n, types[n]) for n in names])).csv(files)

    types: dict[str, T.DataType] = dict.fromkeys(order, T.StringType())
    if infer:
        found = [read(names, files, None) for names, files in groups]
        for name in order:
            having = [(df, df.schema[name].dataType) for df in found if name in df.columns]
            kinds = [kind for _, kind in having]
            if T.StringType() in kinds and any(k != T.StringType() for k in kinds):
                # a group in which the column is empty is inferred as text
                kinds = [k for df, k in having if k != T.StringType() or df.filter(F.col(name).isNotNull()).head(1)]
            types[name] = common_type(kinds)
    parts = [read(names, files, types) for names, files in groups]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts).select(*[f"`{n}`" for n in order])
