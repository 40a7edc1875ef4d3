"""Comparison of two tables key by key."""

import math
import random

import pytest
from conftest import plan_of

from salesflow.operators import diff_by_key
from salesflow.staging import stage

SCHEMA = "k string, d int, a double, b string"


def diff(spark, left, right, keys=("k", "d"), schema=SCHEMA, **options):
    found = diff_by_key(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema), list(keys), **options)
    assert found.columns == [*keys, "nth", "column", "left", "right", "delta"]
    return sorted((tuple(r) for r in found.collect()), key=repr)


def test_differences_by_key_and_column(spark):
    left = [("x", 1, 1.0, "p"), ("y", 1, 2.0, "q"), ("z", 1, None, None), (None, 1, 5.0, "n"), ("only", 1, 1.0, "l")]
    right = [("x", 1, 1.5, "P"), ("y", 1, 2.0, "q"), ("z", 1, 3.0, None), (None, 1, 5.0, "m"), ("new", 1, 1.0, "r")]
    assert diff(spark, left, right) == sorted(
        [
            ("x", 1, 0, "a", "1.0", "1.5", 0.5),
            ("x", 1, 0, "b", "p", "P", None),
            ("z", 1, 0, "a", None, "3.0", None),
            (None, 1, 0, "b", "n", "m", None),
            ("only", 1, 0, "*", "1", "0", -1.0),
            ("new", 1, 0, "*", "0", "1", 1.0),
        ],
        key=repr,
    )
    assert diff(spark, left, left) == [] == diff(spark, [], [])
    assert [r[3] for r in diff(spark, left[:1], [])] == ["*"]


def test_tolerances(spark):
    left = [("x", 1, 100.0, ""), ("y", 1, 1e6, ""), ("z", 1, math.nan, ""), ("i", 1, math.inf, ""), ("j", 1, math.inf, "")]
    right = [("x", 1, 100.4, ""), ("y", 1, 1e6 + 50, ""), ("z", 1, math.nan, ""), ("i", 1, math.inf, ""), ("j", 1, 5.0, "")]
    keys = lambda found: [r[0] for r in found]
    assert keys(diff(spark, left, right)) == ["j", "x", "y"]
    assert keys(diff(spark, left, right, abs_tol=0.5)) == ["j", "y"]
    assert keys(diff(spark, left, right, rel_tol=1e-4)) == ["j", "x"]
    assert keys(diff(spark, left, right, abs_tol=0.5, rel_tol=1e-4)) == ["j"]


def test_repeated_keys(spark):
    left = [("x", 1, 1.0, "a")] * 3 + [("x", 1, 2.0, "b"), ("x", 1, 9.0, "z")] + [("w", 1, 1.0, "c")] * 2
    right = [("x", 1, 1.0, "a")] * 3 + [("x", 1, 2.5, "b")] + [("x", 1, 7.0, "y")] * 2 + [("w", 1, 1.0, "c")]
    assert diff(spark, left, right) == sorted(
        [
            ("w", 1, 0, "*", "1", "0", -1.0),
            ("x", 1, 0, "a", "2.0", "2.5", 0.5),
            ("x", 1, 1, "a", "9.0", "7.0", -2.0),
            ("x", 1, 1, "b", "z", "y", None),
            ("x", 1, 1, "*", "1", "2", 1.0),
        ],
        key=repr,
    )


def test_random_tables_against_plain_code(spark):
    pick = random.Random(8)
    left = {i: (pick.choice([1.0, 2.0, None]), pick.choice("pq")) for i in range(300)}
    right = {i + pick.choice([0, 0, 0, 1000]): (a if pick.random() < 0.8 else 3.0, b if pick.random() < 0.8 else "r") for i, (a, b) in left.items()}
    wanted = []
    for key in left.keys() | right.keys():
        l, r = left.get(key), right.get(key)  # noqa: E741
        if l is None or r is None:
            wanted.append((key, "*"))
        else:
            wanted += [(key, name) for name, x, y in zip("ab", l, r, strict=True) if x != y]
    rows = lambda d: [(k, *v) for k, v in d.items()]
    found = diff(spark, rows(left), rows(right), ["k"], "k int, a double, b string")
    assert sorted((r[0], r[2]) for r in found) == sorted(wanted)


def test_a_hot_key_is_numbered_in_many_tasks(spark):
    """One key has all rows of both sides, all of them different: aligned by their order."""
    left = stage(spark.range(0, 20_000, 1, 4).selectExpr("'hot' as k", "id as v"), "left")
    right = stage(spark.range(0, 20_000, 1, 4).selectExpr("'hot' as k", "id + 20000 as v"), "right")
    found = diff_by_key(left, right, ["k"])
    assert found.agg({"delta": "min"}).first()[0] == found.agg({"delta": "max"}).first()[0] == 20_000
    assert found.count() == 20_000 and found.select("nth").distinct().count() == 20_000
    assert "row_number" not in plan_of(found)


def test_other_columns_are_an_error(spark):
    one = spark.createDataFrame([(1, 2)], "k int, a int")
    for other, keys in ((one.withColumnRenamed("a", "b"), ["k"]), (one, ["j"])):
        with pytest.raises(ValueError):
            diff_by_key(one, other, keys)
    assert diff_by_key(one, one.select("a", "k"), ["k"]).count() == 0  # their order does not matter
