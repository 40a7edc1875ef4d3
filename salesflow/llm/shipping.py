"""Values of a bounded size for the functions that run in tasks."""

from __future__ import annotations

import pickle
from collections.abc import Callable
from typing import TypeVar

from pyspark import cloudpickle
from pyspark.sql import SparkSession

T = TypeVar("T")


def shipped(spark: SparkSession, value: T) -> Callable[[], T]:
    """Broadcast a value; the function returned gives it inside tasks, unpacked once per task. It is
    packed with its class, so executors need no copy of this package."""
    sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    held: list[T] = []

    def get() -> T:
        if not held:
            held.append(pickle.loads(sent.value))
        return held[0]

    return get


def resident(spark: SparkSession, value: T) -> Callable[[], T]:
    """As ``shipped``, but unpacked once per Python worker and kept there from task to task: for values
    that fill a cache, whose state never changes a result."""
    sent = spark.sparkContext.broadcast({"packed": cloudpickle.dumps(value)})

    def get() -> T:
        holder = sent.value  # one object per worker
        if "value" not in holder:
            holder["value"] = pickle.loads(holder["packed"])
        return holder["value"]

    return get
