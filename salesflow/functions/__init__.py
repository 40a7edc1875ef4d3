"""Column expressions for dirty text: numbers, booleans, dates, money."""

from .clean import (
    date_key,
    is_non_numeric,
    money_text,
    normalise_bool,
    parse_date,
    safe_double,
)

__all__ = [
    "date_key",
    "is_non_numeric",
    "money_text",
    "normalise_bool",
    "parse_date",
    "safe_double",
]
