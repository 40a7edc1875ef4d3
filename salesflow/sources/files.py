"""File readers. A path that matches no file is an error, never an empty table."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesflow.functions import normalise_bool, safe_double
from salesflow.sources import schemas

Paths = str | list[str]


def _load(reader, method: str, path: Paths) -> DataFrame:
    try:
        df = getattr(reader, method)(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no input file: {path}") from e
        raise
    return df


def _read_csv(spark: SparkSession, path: Paths, infer: bool, sep: str, encoding: str) -> DataFrame:
    """All columns of the header, as text unless inferred. Only the first line of one file is
    read for that; files whose header differs are an error instead of being read askew."""
    reader = spark.read.option("header", True).option("sep", sep).option("enforceSchema", False)
    reader = reader.option("encoding", encoding)
    return _load(reader.option("inferSchema", infer), "csv", path)


def clean_customers(df: DataFrame, trim: bool = False) -> DataFrame:
    """Ids and city as text, ``is_active`` as boolean."""
    return df.withColumns(
        {
            "customer_id": F.col("customer_id").cast("string"),
            "city": F.col("city").cast("string"),
            "is_active": normalise_bool("is_active", trim=trim),
        }
    )


def clean_refunds(df: DataFrame) -> DataFrame:
    """``amount`` as double (bad text is 0.0), ids and ``created_at`` as text."""
    return df.withColumns(
        {
            "order_id": F.col("order_id").cast("string"),
            "amount": safe_double("amount"),
            "created_at": F.col("created_at").cast("string"),
        }
    )


def read_customers(
    spark: SparkSession,
    path: Paths,
    *,
    infer: bool = False,
    sep: str = ",",
    encoding: str = "UTF-8",
    trim: bool = False,
    raw: bool = False,
) -> DataFrame:
    """``trim=True`` takes " yes " for yes."""
    df = _read_csv(spark, path, infer, sep, encoding)
    return df if raw else clean_customers(df, trim)


def read_refunds(
    spark: SparkSession,
    path: Paths,
    *,
    infer: bool = False,
    sep: str = ",",
    encoding: str = "UTF-8",
    raw: bool = False,
) -> DataFrame:
    """``raw=True`` keeps the amount text, for counting bad amounts."""
    df = _read_csv(spark, path, infer, sep, encoding)
    return df if raw else clean_refunds(df)


def list_files(spark: SparkSession, path: Paths, ignore_missing: bool = False) -> DataFrame:
    """One row ``value`` per file, listed by Spark; the files are not read. ``path`` may hold globs.
    With ignore_missing, paths of a list that match nothing are left out."""
    paths = [path] if isinstance(path, str) else path
    found = None
    for one in paths:
        try:
            files = _load(spark.read.format("binaryFile"), "load", one).select(F.col("path").alias("value"))
        except FileNotFoundError:
            if not ignore_missing:
                raise
            continue
        found = files if found is None else found.unionByName(files)
    return spark.createDataFrame([], "value string") if found is None else found


def _plain_text(value: Column) -> Column:
    """A variant as text: text as it is, a number in digits without an exponent (values are the
    same; digits beyond the 20th decimal are cut), anything else as JSON."""
    kind = F.schema_of_variant(value)
    number = F.try_variant_get(value, "$", "double")
    text = F.try_variant_get(value, "$", "string")
    is_number = kind.rlike("^(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL.*)$")
    digits = F.when(text.rlike("[eE]"), F.format_string("%.20f", number)).otherwise(text)
    return F.when(is_number, digits).otherwise(text)


def _variants_as_text(df: DataFrame) -> DataFrame:
    """Variant fields of arrays of structs as text."""
    for field in df.schema.fields:
        kind = field.dataType
        if not (isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType)):
            continue
        fields = kind.elementType.fields
        if any(isinstance(f.dataType, T.VariantType) for f in fields):

            def text(item: Column, fields=tuple(fields)) -> Column:
                values = [
                    (_plain_text(item[f.name]) if isinstance(f.dataType, T.VariantType) else item[f.name]).alias(f.name)
                    for f in fields
                ]
                return F.when(item.isNotNull(), F.struct(*values))

            df = df.withColumn(field.name, F.transform(field.name, lambda item: text(item)))
    return df


def read_orders(
    spark: SparkSession,
    path: Paths,
    *,
    schema: str = schemas.ORDERS,
    infer: bool = False,
    multiline: bool = True,
    ignore_missing: bool = False,
    malformed: str | None = None,
) -> DataFrame:
    """Nested orders from JSON. ``path`` may hold globs (``orders_2025-03-*.json``).

    multiline=True reads files that hold one array of orders; such a file is read by one task.
    multiline=False reads one order per line and splits large files over many tasks.
    Fields outside ``schema`` are not read; infer=True takes all fields and types found in the
    data, at the price of one more pass. A quantity or price may be a JSON number in any notation,
    or text, which is left to the cleaners as it is. With ignore_missing, paths of a list that
    match nothing (days without a file) are left out, as long as one is left.

    A record that cannot be read, or not in full, is a row with nulls for what is missing.
    ``malformed`` names a column for the raw text of such a record (of the whole file, if it is one
    array that breaks off), null in all other rows, and ``<malformed>_file`` for its file: stage the
    orders, then divide them by ``split_malformed``."""
    if ignore_missing and not isinstance(path, str):
        path = [p for p in path if list_files(spark, [p], True).head(1)]
        if not path:
            raise FileNotFoundError("no input file: none of the paths has any")
    reader = spark.read.option("multiLine", multiline).option("mode", "PERMISSIVE")
    if malformed:
        reader = reader.option("columnNameOfCorruptRecord", malformed)
        schema = f"{schema}, `{malformed}` string"
    if not infer:
        reader = reader.schema(schema)
    df = _load(reader, "json", path)
    if malformed:
        if malformed not in df.columns:  # nothing malformed was found while inferring
            df = df.withColumn(malformed, F.lit(None).cast("string"))
        file = F.when(F.col(malformed).isNotNull(), F.col("_metadata.file_path"))
        df = df.withColumn(f"{malformed}_file", file)
    if not list_files(spark, path).head(1):  # a folder without files
        raise FileNotFoundError(f"no input file: {path}")
    return _variants_as_text(df)


def split_malformed(orders: DataFrame, malformed: str) -> tuple[DataFrame, DataFrame]:
    """(orders, quarantine) of what ``read_orders`` read with a column for malformed records. All rows
    stay among the orders, with whatever could be read of them; the quarantine has the raw text of those
    that are not whole: ``file``, ``record``. Pass staged orders: Spark does not read raw text alone."""
    file = f"{malformed}_file"
    quarantine = orders.filter(F.col(malformed).isNotNull())
    return orders.drop(malformed, file), quarantine.select(F.col(file).alias("file"), F.col(malformed).alias("record"))


def read_lines(spark: SparkSession, path: Paths) -> DataFrame:
    """Text files or folders of part files, one row ``value`` per line."""
    return _load(spark.read, "text", path)
