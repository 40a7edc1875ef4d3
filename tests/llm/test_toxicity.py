import math
import random

import numpy as np
import pytest

from salesflow.llm import toxicity
from salesflow.llm.toxicity import FtrlOptions

BAD = ["scoundrel", "nitwit", "buffoon"]


def texts(n, seed=1):
    rng = random.Random(seed)
    common = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(n):
        words = rng.choices(common, k=rng.randint(5, 120))
        label = int(rng.random() < 0.3)
        if label:
            for _ in range(rng.randint(2, 4)):
                words.insert(rng.randrange(len(words)), rng.choice(BAD) + rng.choice(["", "s", "ish"]))
        rows.append((i, " ".join(words), label))
    return rows


@pytest.fixture(scope="module")
def fitted(spark):
    rows = texts(900)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows if r[0] % 3], "doc_id bigint, toxic int")
    return rows, docs, toxicity.fit(labels, docs, FtrlOptions(bits=16, l1=5.0))


def test_held_out_accuracy(fitted):
    rows, docs, model = fitted
    got = {r["doc_id"]: r for r in toxicity.score_documents(docs, model).collect()}
    right = [got[i]["predicted"] == label for i, _, label in rows if i % 3 == 0]
    assert np.mean(right) > 0.97
    assert len(model.features) < 400  # sparse
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_scores_are_sums_of_weights(fitted):
    rows, docs, model = fitted
    weights = dict(zip(model.features.tolist(), model.weights.tolist(), strict=True))
    got = {r["doc_id"]: r["score"] for r in toxicity.score_documents(docs, model).collect()}
    for i, text, _ in rows[:50]:
        logit = model.intercept + sum(weights.get(f, 0.0) for f in set(toxicity.features(text, model.bits).tolist()))
        assert got[i] == pytest.approx(1 / (1 + math.exp(-logit)), rel=1e-4)


def test_ftrl_equals_a_plain_loop():
    rows, options = texts(60, seed=4), FtrlOptions(bits=10, alpha=0.5, l1=0.3, l2=0.1, epochs=2)
    z, n = {}, {}

    def weight(f):
        l1 = 0 if f == "bias" else options.l1
        if abs(z.get(f, 0)) <= l1:
            return 0.0
        return -(z[f] - math.copysign(l1, z[f])) / ((options.beta + math.sqrt(n[f])) / options.alpha + options.l2)

    for _ in range(options.epochs):
        for _, text, label in rows:
            found = [*set(toxicity.features(text, options.bits).tolist()), "bias"]
            w = {f: weight(f) for f in found}
            g = 1 / (1 + math.exp(-sum(w.values()))) - label
            for f in found:
                old = n.get(f, 0.0)
                n[f] = old + g * g
                z[f] = z.get(f, 0.0) + g - (math.sqrt(n[f]) - math.sqrt(old)) / options.alpha * w[f]
    at, weights, intercept = toxicity.ftrl([r[1] for r in rows], [r[2] for r in rows], options)
    want = {f: weight(f) for f in z if f != "bias" and weight(f)}
    got = dict(zip(at.tolist(), weights.tolist(), strict=True))
    assert got.keys() == want.keys()
    assert all(got[f] == pytest.approx(want[f], rel=1e-2, abs=1e-4) for f in want)
    assert intercept == pytest.approx(weight("bias"), rel=1e-2)


def test_odd_rows_and_filter(spark, fitted):
    model = fitted[2]
    rows = [(1, None, 9, "a"), (2, "", 9, "a"), (None, "buffoons nitwit scoundrel", 9, "a"), (4, "w1 " * 100_000, 9, None)]
    docs = spark.createDataFrame([*rows, rows[2]], "doc_id bigint, text string, score int, predicted string")
    got = toxicity.score_documents(docs, model).collect()
    base = 1 / (1 + math.exp(-model.intercept))
    assert [r["score"] for r in got[:2]] == [pytest.approx(base), pytest.approx(base)]
    assert [r["predicted"] for r in got] == [0, 0, 1, 0, 1]
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns and [r["doc_id"] for r in kept.collect()] == [1, 2, 4]
    assert toxicity.score_documents(docs.limit(0), model).count() == 0


def test_labels_that_allow_no_model(spark, fitted):
    docs = fitted[1]
    schema = "doc_id bigint, toxic int"
    share = lambda rows: toxicity.score_documents(docs, toxicity.fit(spark.createDataFrame(rows, schema), docs)).first()["score"]
    assert share([]) == pytest.approx(0.5)
    assert share([(1, 1), (2, 1)]) == pytest.approx(1.0, abs=1e-6)
    assert share([(None, 1), (1, None), (3, 0)]) == pytest.approx(0.0, abs=1e-6)
