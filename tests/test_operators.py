import random
import re
from collections import Counter, defaultdict

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from salesflow.operators import (
    explode_items,
    group_values,
    intersect,
    join_dimension,
    keep_first,
    number_sorted,
    reconcile,
    route_rejects,
    split_words,
    top_k,
    word_count,
)

ITEMS = "id int, items array<struct<qty: int, sku: string>>"


def test_explode_drops_empty_and_null_arrays(spark):
    df = spark.createDataFrame([(1, [(5, "a"), (6, None)]), (2, []), (3, None), (4, [None])], ITEMS)
    assert explode_items(df).columns == ["id", "pos", "item_qty", "item_sku"]
    assert rows(explode_items(df)) == [(1, 0, 5, "a"), (1, 1, 6, None), (4, 0, None, None)]
    kept = rows(explode_items(df, keep_empty=True))
    assert kept == rows(explode_items(df))[:2] + [(2,) + (None,) * 3, (3,) + (None,) * 3, (4, 0, None, None)]


def test_route_puts_every_row_on_one_side(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (None,), (2.0,)], "price double")
    kept, rejects = route_rejects(df, F.col("price") < 0)
    assert rows(rejects) == [(-1.0,)]
    assert rows(kept) == [(None,), (0.0,), (2.0,)]


def test_keep_first_does_not_depend_on_the_partitioning(spark):
    rng = random.Random(1)
    data = [(rng.choice([None, "a", "b"]), rng.randrange(2), rng.randrange(3), str(i)) for i in range(200)]
    data += [("hot", 1, 1, str(i)) for i in range(300)]
    expected = {}
    for r in data:
        key = (r[1], r[2], r[3])
        expected[r[0]] = min(expected.get(r[0], key), key)
    for n in (1, 3, 7):
        rng.shuffle(data)
        df = spark.createDataFrame(data, "k string, a int, b int, c string").repartition(n)
        assert {r[0]: tuple(r[1:]) for r in keep_first(df, ["k"], ["a"]).collect()} == expected


def test_keep_first_cuts_each_key_before_the_shuffle(spark):
    plan = plan_of(keep_first(spark.range(9).selectExpr("id % 2 as k", "id as v"), ["k"], ["v"]))
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


def test_group_values_has_one_shape_and_bounded_arrays(spark):
    rng = random.Random(2)
    data = [("hot", rng.randrange(10_000)) for _ in range(3000)]
    data += [("copies", 7)] * 1500 + [("small", v) for v in (3, 1, 2, 2, None)] + [(None, 4), (None, 5)]
    data += [("steps", 100 * v) for v in range(1000)]  # multiples of the bound
    expected = defaultdict(list)
    for k, v in sorted(data, key=lambda r: (r[1] is not None, r[1])):
        expected[k].append(v)
    rng.shuffle(data)
    df = spark.createDataFrame(data, "k string, v int")
    for bound in (100, 10_000):
        result = group_values(df, F.col("k"), F.col("v"), max_values=bound).collect()
        found = {(r["key"], r["chunk"]): r["values"] for r in result}
        want = {(k, i // bound): v[i : i + bound] for k, v in expected.items() for i in range(0, len(v), bound)}
        assert found == want and len(result) == len(want)


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
def test_join_dimension_equals_the_plain_join(spark, how):
    facts = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, "x"), (5, None)], "id int, k string")
    facts = facts.unionByName(spark.range(50).selectExpr("cast(id + 10 as int) as id", "'a' as k"))
    dims = spark.createDataFrame([("a", 10), ("b", 20), ("b", 21), ("c", 30), (None, 40)], "key string, v int")
    plain = facts.join(dims, facts.k == dims.key, how)
    joined = join_dimension(facts, dims, "k", "key", how)
    assert joined.columns == plain.columns
    assert rows(joined) == rows(plain)
    with pytest.raises(ValueError):
        join_dimension(facts, dims, "k", "key", "cross")


def test_intersect(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y"), (None, None), (3, None)], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (2, "z"), (None, None), (None, None), (3, None)], "k int, v string")
    assert rows(intersect(a, b)) == rows(a.intersect(b)) == [(None, None), (1, "x"), (3, None)]
    assert "Join" not in plan_of(intersect(a, b))


def test_reconcile(spark):
    a = spark.createDataFrame([("p", 1.001), ("q", 2.0), ("q", 2.0), ("r", None)], "k string, v double")
    b = spark.createDataFrame([("r", None), ("p", 1.004), ("q", 2.0), ("s", -0.0)], "k string, v double")
    assert rows(reconcile(a, b)) == [("q", 2.0, "left", 1), ("s", 0.0, "right", 1)]
    assert rows(reconcile(a, a)) == []
    assert rows(reconcile(a, b, ndigits=3), "k", "side") == [
        ("p", "left"), ("p", "right"), ("q", "left"), ("s", "right"),
    ]
    text = a.withColumn("v", F.col("v").cast("string"))
    assert rows(reconcile(text, text.withColumn("v", F.concat("v", F.lit("0"))), numeric=("v",))) == []
    with pytest.raises(ValueError):
        reconcile(a, b.withColumnRenamed("v", "w"))


def test_number_sorted(spark):
    rng = random.Random(3)
    data = [(rng.choice([1, 1, 1, 2, 3]), i) for i in range(1000)]
    df = spark.createDataFrame(data, "k int, id int").repartition(5)
    expected = sorted(data, key=lambda r: (-r[0], r[1]))
    numbered = number_sorted(df, F.col("k").desc(), F.col("id"))
    assert [tuple(r)[:2] for r in numbered.orderBy("position").collect()] == expected
    assert [r.position for r in numbered.orderBy("position").collect()] == list(range(1, 1001))
    assert rows(number_sorted(df.limit(0), F.col("k"))) == []


def test_top_k_does_not_sort_everything(spark):
    df = spark.range(100).selectExpr("id % 10 as k", "id")
    best = top_k(df, 3, F.col("k").desc(), F.col("id"))
    assert [tuple(r) for r in best.collect()] == [(9, 9), (9, 19), (9, 29)]
    assert "TakeOrderedAndProject" in plan_of(best)


TEXT = "Été, déjà-vu  don't_stop"


def words(spark, text, **options):
    df = spark.createDataFrame([(text,)], "value string")
    return [r.word for r in split_words(df, **options).collect()]


def test_words(spark):
    assert words(spark, TEXT) == ["t", "d", "j", "vu", "don", "t_stop"]
    assert words(spark, TEXT, unicode=True) == ["été", "déjà", "vu", "don", "t_stop"]
    assert words(spark, TEXT, normalise=False) == TEXT.split()
    assert words(spark, " ... ") == []


def test_raw_words_split_where_python_does(spark):
    spaces = [chr(c) for c in range(0x3001) if chr(c).isspace()]
    text = "".join(f"w{i}{s}{s}" for i, s in enumerate(spaces)) + "end​one"
    assert words(spark, text, normalise=False) == text.split()


def plain_words(text):
    """Words by Python's re, as ASCII classes: marks become spaces, then split."""
    return re.sub(r"[^a-zA-Z0-9_\s]", " ", text, flags=re.A).lower().split()


def test_word_counts_equal_python(spark):
    rng = random.Random(4)
    alphabet = "aB9_é,.-' \t\nK "
    data = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(300)]
    df = spark.createDataFrame([(t,) for t in data], "value string")
    expected = Counter(w for t in data for w in plain_words(t))
    assert dict(rows(word_count(df))) == expected


# the operators of the tables, on data that can be checked by eye

STOCK = [("bolt", "north", 40, 0.25), ("nut", "north", 75, 0.1), ("hinge", "south", 12, 3.5), ("bolt", "south", 9, 0.3), ("saw", "east", 2, 18.0)]


@pytest.fixture
def stock(spark):
    return spark.createDataFrame(STOCK, "part string, depot string, pieces int, price double")


def test_filters_and_sums(stock):
    assert rows(stock.filter("pieces > 11").select("part")) == [("bolt",), ("hinge",), ("nut",)]
    worth = stock.select("depot", F.round(F.col("pieces") * F.col("price"), 2).alias("worth"))
    assert rows(worth.groupBy("depot").agg(F.sum("worth"))) == [("east", 36.0), ("north", 17.5), ("south", 44.7)]
    assert rows(top_k(worth, 2, F.col("worth").desc())) == [("east", 36.0), ("south", 42.0)]


def test_groups_by_a_key_and_by_an_expression(stock):
    assert rows(group_values(stock, F.col("part"), F.col("depot")), "key", "values") == [
        ("bolt", ["north", "south"]), ("hinge", ["south"]), ("nut", ["north"]), ("saw", ["east"]),
    ]
    tens = group_values(stock, F.floor(F.col("pieces") / 10), F.col("pieces"))
    assert rows(tens, "key", "values") == [(0, [2, 9]), (1, [12]), (4, [40]), (7, [75])]


def test_sets(stock):
    parts, depots = stock.select("part"), stock.select("depot")
    assert rows(parts.distinct()) == [("bolt",), ("hinge",), ("nut",), ("saw",)]
    assert parts.unionByName(depots.withColumnRenamed("depot", "part")).count() == 10
    cheap, many = stock.filter("price < 1").select("part"), stock.filter("pieces > 20").select("part")
    assert rows(intersect(cheap, many)) == [("bolt",), ("nut",)]


def test_join_of_equal_names(stock, spark):
    depots = spark.createDataFrame([("north", 1), ("west", 2)], "depot string, pieces int")
    joined = join_dimension(stock, depots, "depot", "depot", "full")
    assert joined.columns == ["part", "depot", "pieces", "price", "depot", "pieces"]
    matched = {(r[0], r[4], r[5]) for r in joined.collect() if r[4]}
    assert matched == {("bolt", "north", 1), ("nut", "north", 1), (None, "west", 2)} and joined.count() == 6
