"""The sales plan: from orders, customers and refunds to revenue per day, city and channel."""

from .job import run_sales_job
from .metrics import run_metrics
from .sales import SalesOptions, SalesTables, build_daily_sales, sales_from_lines

__all__ = [
    "SalesOptions",
    "SalesTables",
    "build_daily_sales",
    "run_metrics",
    "run_sales_job",
    "sales_from_lines",
]
