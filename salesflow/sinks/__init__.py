"""Writers for CSV, date-partitioned CSV, JSON arrays, tables and text lines."""

from .files import save_table, write_csv, write_json_arrays, write_lines, write_partitioned_csv
from .tables import replace_table, save_bucketed, table_location

__all__ = [
    "replace_table",
    "save_bucketed",
    "save_table",
    "table_location",
    "write_csv",
    "write_json_arrays",
    "write_lines",
    "write_partitioned_csv",
]
