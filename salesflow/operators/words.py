from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# What separates words. The raw flavour splits on what Python's str.split() calls
# white space, which is Unicode white space and the four separators x1c to x1f.
WORD = r"\w+"
RAW_SEPARATOR = r"(?U)[\s\x1c-\x1f]+"


def split_words(
    df: DataFrame, column: str = "value", normalise: bool = True, unicode: bool = False
) -> DataFrame:
    """One row ``word`` per word of a text column.

    normalise=True: lower case, every character outside [A-Za-z0-9_] separates words
    (unicode=True keeps accented letters too). normalise=False: split at white space only."""
    if normalise:
        pattern = F.lit(("(?U)" if unicode else "") + WORD)
        words = df.select(F.explode(F.regexp_extract_all(column, pattern, 0)).alias("word"))
        return words.select(F.lower("word").alias("word"))
    words = df.select(F.explode(F.split(column, RAW_SEPARATOR)).alias("word"))
    return words.filter("word <> ''")


def word_count(
    df: DataFrame, column: str = "value", normalise: bool = True, unicode: bool = False
) -> DataFrame:
    """``(word, count)`` over whole texts; counted inside each task before the shuffle."""
    return split_words(df, column, normalise, unicode).groupBy("word").count()
