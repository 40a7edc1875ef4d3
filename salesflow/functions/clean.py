"""Cleaners from Column to Column. All of them are built-in expressions, so they stay
inside whole-stage code generation and can be used in any select, filter or lambda."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as a number, as "true", and as a date.
NUMBER_PATTERN = r"^\s*[-+]?(?:\d+(?:\.\d+)?|\.\d+)\s*$"
TRUE_WORDS = ("1", "true", "yes", "y", "t")
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_FORMAT = "yyyy-MM-dd"

_NUMBER_TYPES = "^(tinyint|smallint|int|bigint|float|double|decimal.*)$"


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _has_number_type(c: Column) -> Column:
    # typeof() is a constant once the plan is analysed, so Catalyst drops the branch not taken.
    return F.typeof(c).rlike(_NUMBER_TYPES)


def _with_point(c: Column) -> Column:
    return F.replace(c.cast("string"), F.lit(","), F.lit("."))


def _is_finite(number: Column) -> Column:
    return F.abs(number) < F.lit(float("inf"))  # NaN sorts above infinity


def safe_double(c: Column | str) -> Column:
    """Number held as text to double. A decimal comma is read as a point; whatever is not a
    plain decimal number, and null, becomes 0.0, and so do numbers beyond a double. Columns that
    already hold numbers are taken as they are, so 1.0E7 is not mistaken for bad text."""
    c = _column(c)
    native = c.try_cast("double")
    text = _with_point(c)
    return (
        F.when(_has_number_type(c), F.when(_is_finite(native), native).otherwise(0.0))
        .when(text.rlike(NUMBER_PATTERN) & _is_finite(text.try_cast("double")), text.try_cast("double"))
        .otherwise(0.0)
    )


def is_non_numeric(c: Column | str) -> Column:
    """True where ``safe_double`` replaces a bad value by 0.0; null stays null (not bad)."""
    c = _column(c)
    text = _with_point(c)
    number = text.rlike(NUMBER_PATTERN) & _is_finite(F.coalesce(text.try_cast("double"), F.lit(0.0)))
    return F.when(_has_number_type(c), ~_is_finite(c.try_cast("double"))).otherwise(~number)


def normalise_bool(c: Column | str, trim: bool = False) -> Column:
    """Text such as 'TRUE', 'y' or '1' to boolean; null stays null."""
    text = F.lower(_column(c).cast("string"))
    return (F.trim(text) if trim else text).isin(*TRUE_WORDS)


def parse_date(c: Column | str, on_bad: str = "null") -> Column:
    """Timestamp text or date text to 'yyyy-MM-dd' text, whichever format fits.

    on_bad="null" turns other text into null, on_bad="error" fails the job."""
    if on_bad not in ("null", "error"):
        raise ValueError(f"on_bad must be 'null' or 'error', not {on_bad!r}")
    c = _column(c)
    # Text of one format is never as long as text of the other. Choosing by length spares the
    # failed parse, which costs an exception per row.
    day = (
        F.when(F.length(c) >= len(TIMESTAMP_FORMAT), F.try_to_date(c, TIMESTAMP_FORMAT))
        .otherwise(F.try_to_date(c, DATE_FORMAT))
        .cast("string")
    )
    if on_bad == "null":
        return day
    message = F.concat(F.lit("not a date: "), c)
    return F.when(day.isNull() & c.isNotNull(), F.raise_error(message)).otherwise(day)


def date_key(c: Column | str) -> Column:
    """'2025-03-01' to '20250301', as used in the names of daily outputs."""
    return F.replace(_column(c), F.lit("-"), F.lit(""))


def money_text(c: Column | str, pattern: str = "%.2f") -> Column:
    """Number to fixed-point text, so that large sums are not written as 1.2E8."""
    c = _column(c)
    return F.when(c.isNotNull(), F.format_string(pattern, c))
