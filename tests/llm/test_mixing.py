import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from salesflow.llm import mixing
from salesflow.llm.mixing import MixingOptions

TOPICS = {"a": ["apple", "pear", "plum"], "b": ["bolt", "nut", "screw"], "c": ["cat", "dog", "cow"]}


def corpus(spark, n=240, mixed=True):
    rng = np.random.default_rng(2)
    rows, labels = [], []
    for i in range(n):
        own = "aab"[i % 3] if i % 10 else "c"
        other = rng.choice(list(TOPICS))
        size = int(rng.integers(5, 60))
        words = [rng.choice(TOPICS[other if mixed and rng.random() < 0.2 else own]) for _ in range(size)]
        rows.append((i, " ".join(words)))
        if i % 4 != 1:
            labels.append((i, own))
    return spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, topic string")


def totals(rows, names):
    tokens = sum(r["n_tokens"] for r in rows)
    return {d: sum(r["rate"] * r["n_tokens"] * r[f"p_{d}"] for r in rows) / tokens for d in names}


def test_targets_are_met(spark):
    docs, labels = corpus(spark)
    targets = {"a": 0.3, "b": 0.3, "c": 0.4}
    rows = mixing.mix(docs, labels, F.col("topic"), targets).collect()
    assert all(r["rate"] >= 0 for r in rows)
    for d, share in totals(rows, targets).items():
        assert share == pytest.approx(targets[d], abs=2e-5)
    for r in rows:
        assert math.floor(r["rate"]) <= r["copies"] <= math.ceil(r["rate"])
    likely = [max("abc", key=lambda d: r[f"p_{d}"]) for r in rows]
    own = ["aab"[r["doc_id"] % 3] if r["doc_id"] % 10 else "c" for r in rows]
    assert np.mean([x == y for x, y in zip(likely, own, strict=True)]) > 0.95


@pytest.mark.parametrize("precision", [1, 2])
def test_targets_are_met_in_unrounded_posteriors(spark, precision):
    """However coarse the cells: a document's posterior counts with all its digits."""
    docs, labels = corpus(spark)
    targets = {"a": 0.45, "b": 0.35, "c": 0.2}
    options = MixingOptions(evidence=6, precision=precision)
    rows = mixing.mix(docs, labels, F.col("topic"), targets, options).collect()
    assert any(abs(r["p_c"] - round(r["p_c"], precision)) > 1e-6 for r in rows)
    for d, share in totals(rows, targets).items():
        assert share == pytest.approx(targets[d], abs=1.1e-5)


def test_cells_are_exact_sums(spark):
    docs, labels = corpus(spark, 120)
    model = mixing.fit_domains(labels, docs, F.col("topic"), MixingOptions(evidence=6))
    read = docs.select(F.size(mixing.words_of(F.col("text"))).alias("n"), model.posterior(mixing.words_of(F.col("text"))).alias("p"))
    read = read.union(spark.createDataFrame([(0, [0.5, 0.25, 0.25])], "n int, p array<double>"))
    read = read.withColumn("c", mixing.cell_of(F.col("p"), 1))
    want = {}
    for r in read.collect():
        tokens, mass = want.get(tuple(r["c"]), (0, np.zeros(3)))
        want[tuple(r["c"])] = tokens + r["n"], mass + r["n"] * np.array(r["p"])
    got = mixing.cells_of(read, "p", "n", "c", 3).collect()
    assert {tuple(r["cell"]): r["tokens"] for r in got} == {c: t for c, (t, _) in want.items()}
    for r in got:
        tokens, mass = want[tuple(r["cell"])]
        assert np.allclose(r["posterior"], mass / tokens if tokens else r["cell"], atol=1e-10)
    again = mixing.cells_of(read.repartition(7), "p", "n", "c", 3).collect()
    assert sorted(map(tuple, again), key=str) == sorted(map(tuple, got), key=str)


def test_rates_match_plain_projected_gradient(spark):
    rng = np.random.default_rng(7)
    p = np.round(rng.dirichlet([1.0, 0.6, 0.3], 60), 2)
    tokens = rng.integers(1, 100, 60)
    cells = spark.createDataFrame([(list(map(float, a)), int(t)) for a, t in zip(p, tokens, strict=True)], "posterior array<double>, tokens bigint")
    cells = cells.groupBy("posterior").agg(F.sum("tokens").alias("tokens"))
    w = tokens / tokens.sum()
    for targets in ([0.2, 0.3, 0.5], [0.0, 0.0, 1.0]):  # the second is out of reach
        rated, reached = mixing.fit_rates(cells, targets, MixingOptions(max_steps=250, patience=80))
        x = np.ones(60)
        for _ in range(60_000):
            x = np.maximum(0, x - p @ ((w * x) @ p - targets))
        want = (w * x) @ p
        assert np.linalg.norm(np.array(reached) - targets) <= np.linalg.norm(want - targets) + 2e-3
        got = {tuple(r["posterior"]): r["rate"] for r in rated.collect()}
        shares = sum(wi * got[tuple(pi)] * pi for wi, pi in zip(w, p, strict=True))
        assert np.allclose(shares, reached)


def test_posterior_equals_a_plain_one(spark):
    docs, labels = corpus(spark, 60)
    options = MixingOptions(buckets=64, evidence=20)
    model = mixing.fit_domains(labels, docs, F.col("topic"), options)
    rows = docs.withColumn("p", model.posterior(mixing.words_of(F.col("text")))).collect()
    bucket = {
        r["w"]: r["b"]
        for r in spark.createDataFrame([(w,) for ws in TOPICS.values() for w in ws], "w string")
        .withColumn("b", mixing.bucket_of(F.col("w"), 64))
        .collect()
    }
    for r in rows:
        words = r["text"].split()
        scale = min(1, 20 / len(words))
        odds = [pr + scale * sum(wt[bucket[w]] for w in words) for pr, wt in zip(model.priors, model.weights, strict=True)] + [0.0]
        e = np.exp(np.array(odds) - max(odds))
        assert np.allclose(r["p"], e / e.sum(), atol=1e-6)


def test_odd_rows(spark):
    docs, labels = corpus(spark, 60)
    odd = [(900, None), (901, ""), (None, "apple pear"), (None, "apple pear"), (902, "apple " * 100_000)]
    docs = docs.union(spark.createDataFrame(odd, docs.schema))
    docs = docs.withColumns({"rate": F.lit("x"), "_mixing": F.lit(1), "p_a": F.lit(2), "posterior": F.lit(3)})
    labels = labels.union(spark.createDataFrame([(None, "a"), (3, None), (1, "b"), (777, "c")], labels.schema))
    got = mixing.mix(docs, labels, F.col("topic"), {"a": 0.5, "zzz": 0.1})
    rows = {r["doc_id"]: r for r in got.collect()}
    assert got.count() == 65 and rows[902]["n_tokens"] == 100_000 and rows[900]["n_tokens"] == rows[901]["n_tokens"] == 0
    assert rows[900]["p_a"] == rows[901]["p_a"] and rows[900]["p_zzz"] == 0.0 and rows[900]["_mixing"] == 1
    assert rows[3]["posterior"] == 3


def test_no_labels_and_empty_table(spark):
    docs, labels = corpus(spark, 30)
    row = mixing.mix(docs, labels.limit(0), F.col("topic"), {"a": 1.0}).first()
    assert (row["rate"], row["copies"], row["p_a"]) == (1.0, 1, None)
    assert mixing.mix(docs.limit(0), labels, F.col("topic"), {"a": 1.0}).count() == 0
    blank = docs.withColumn("text", F.lit(""))
    assert {r["rate"] for r in mixing.mix(blank, labels, F.col("topic"), {"a": 1.0}).collect()} == {1.0}


def test_no_python_on_executors(spark):
    docs, labels = corpus(spark, 30)
    plan = mixing.mix(docs, labels, F.col("topic"), {"a": 1.0})._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
