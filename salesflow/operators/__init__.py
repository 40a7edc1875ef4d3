"""General operators from DataFrame to DataFrame."""

from .compare import diff_by_key, reconcile
from .dedup import keep_first
from .groups import group_values
from .join import join_dimension, keep_dates
from .merge import merge_values
from .nested import explode_items
from .order import number_sorted, top_k
from .route import route_rejects
from .sets import intersect
from .sketch import distinct_estimates, distinct_sketches, merge_sketches, relative_error
from .words import split_words, word_count

__all__ = [
    "diff_by_key",
    "distinct_estimates",
    "distinct_sketches",
    "explode_items",
    "group_values",
    "intersect",
    "join_dimension",
    "keep_dates",
    "keep_first",
    "merge_sketches",
    "merge_values",
    "number_sorted",
    "reconcile",
    "relative_error",
    "route_rejects",
    "split_words",
    "top_k",
    "word_count",
]
