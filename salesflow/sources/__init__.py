"""Readers for customers, refunds, orders and text lines."""

from .drift import common_type, read_drifting_csv
from .files import (
    clean_customers,
    clean_refunds,
    list_files,
    read_customers,
    read_lines,
    read_orders,
    read_refunds,
    split_malformed,
)

__all__ = [
    "clean_customers",
    "clean_refunds",
    "common_type",
    "list_files",
    "read_customers",
    "read_drifting_csv",
    "read_lines",
    "read_orders",
    "read_refunds",
    "split_malformed",
]
