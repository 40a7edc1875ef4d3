"""Operators of a training-data pipeline: filters, deduplication, scoring, masking, mixing."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with the plan, which then need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
