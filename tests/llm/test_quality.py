import pickle
import random

import numpy as np
import pandas as pd
import pytest

from salesflow.llm import quality
from salesflow.llm.quality import CoTraining
from salesflow.staging import stage

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def made_up(n=700, seed=5):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        good = rng.random() < 0.75
        words = [rng.choice(["river", "stone", "walk", "light", "green"] if good else ["BUY", "now", "click", "cheap"]) for _ in range(rng.randint(8, 80))]
        words = [w if good or rng.random() < 0.6 else w + "!!!" for w in words]
        text = "\n".join(" ".join(words[k : k + 9]) for k in range(0, len(words), 9))
        rows.append((i, text, rng.choice(["en", "de"]), "good.org" if good == (rng.random() < 0.9) else "spam.biz", len(text)))
        labels.append((i, int(good)))
    return rows, labels


def test_held_out_accuracy(spark):
    rows, labels = made_up()
    docs = spark.createDataFrame(rows, SCHEMA)
    some = spark.createDataFrame([x for x in labels if x[0] % 4 == 0], "doc_id bigint, quality int")
    model = quality.fit(some, docs, CoTraining(bits=12))
    got = {r["doc_id"]: r for r in quality.score_documents(docs, model).collect()}
    truth = dict(labels)
    assert np.mean([got[i]["kept"] == bool(truth[i]) for i in truth if i % 4]) > 0.97
    assert np.mean([(got[i]["p_content"] >= 0.5) == bool(truth[i]) for i in truth if i % 4]) > 0.95
    assert np.mean([(got[i]["p_layout"] >= 0.5) == bool(truth[i]) for i in truth if i % 4]) > 0.9


def test_pseudo_labels_help_the_weaker_view():
    """With few labels, the content view learns words it has no label for from the layout view."""
    rng = np.random.default_rng(1)
    label = np.array(([1] * 10 + [0] * 10) * 2 + [-1] * 400)
    truth = np.where(label >= 0, label, rng.integers(0, 2, len(label)))
    options = CoTraining(bits=10, groups=1, rounds=3, confident=0.9)
    word = lambda t, known: 10 * t + (0 if known else rng.integers(0, 8))
    first = [(np.array([word(t, k >= 0)]), np.array([1.0])) for t, k in zip(truth, label, strict=True)]
    second = [np.array([t + rng.normal(0, 0.25), *([0.0] * 10)]) for t in truth]
    with_rounds = quality.co_train((first, second), label, options)
    without = quality.co_train((first, second), label, CoTraining(bits=10, groups=1, rounds=0))
    pool = label < 0
    rows = [first[i] for i in np.flatnonzero(pool)]
    right = lambda m: np.mean((m.views[0].odds(rows) > 0) == truth[pool])
    assert right(with_rounds) > 0.9 > right(without)


def test_logistic_is_a_minimum():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((300, 3))
    y = (x @ [1.0, -2.0, 0.5] + rng.standard_normal(300) > 0.3).astype(float)

    def loss(w):
        z = x @ w[:-1] + w[-1]
        return np.logaddexp(0, z).sum() - y @ z + 0.5 * (w[:-1] ** 2).sum()

    w = quality.logistic(x, y, 1.0)
    for i in range(4):
        for d in (-1e-3, 1e-3):
            other = w.copy()
            other[i] += d
            assert loss(other) > loss(w)


def test_odd_rows_and_missing_columns(spark):
    rows, labels = made_up(200)
    rows += [(900, None, None, None, None), (901, "", "", "", 0), (None, "river", "en", "x", 5), (902, "river " * 100_000, "en", "x", None)]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'k' as score", "1 as _quality", "2 as id", "3 as label")
    marked = spark.createDataFrame([*labels, (None, 1), (5, None), (5, 1)], "doc_id bigint, quality int")
    model = quality.fit(marked, docs, CoTraining(bits=10))
    got = quality.score_documents(docs, model)
    assert got.count() == 204 and got.filter("score between 0 and 1 and _quality = 1").count() == 204
    bare = docs.select("doc_id", "text")
    assert quality.score_documents(bare, quality.fit(marked, bare, CoTraining(bits=10))).count() == 204
    assert quality.score_documents(docs.limit(0), model).count() == 0


def test_labels_that_allow_no_model(spark):
    docs = spark.createDataFrame(made_up(20)[0], SCHEMA)
    score = lambda rows: quality.score_documents(docs, quality.fit(spark.createDataFrame(rows, "doc_id bigint, quality int"), docs)).first()["score"]
    assert score([]) == 0.5
    assert score([(1, 1), (2, 1), (3, 0), (4, 1)]) == pytest.approx(0.75)


def test_all_unlabelled_documents_take_part(spark):
    """Words in few of 20,000 unlabelled documents, and in no labelled one, are learned; the sums of
    the Spark pool are those of the rows in memory."""
    rows, labels = made_up(400)
    rng = random.Random(3)
    for i in range(400, 20_400):
        good = i % 2
        text = " ".join(rng.choice(["river", "stone", "walk"] if good else ["BUY", "now", "click"]) for _ in range(12))
        rows.append((i, text, "en", "good.org" if good else "spam.biz", len(text)))
    rows += [(30_000 + i, ("Fjord " if i % 2 else "XYZZY!!! ") + rows[400 + i][1], *rows[400 + i][2:]) for i in range(1, 61)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    options = CoTraining(bits=12, rounds=2, confident=0.9)
    model = pickle.loads(quality.fit(spark.createDataFrame(labels, "doc_id bigint, quality int"), docs, options))
    weight = lambda word: model.views[0].weights[quality.content([word], 12)[0][0]]
    untouched = quality.co_train(
        quality.features(pd.DataFrame(rows[:400], columns=SCHEMA.replace(" bigint", "").replace(" string", "").split(", ")), options),
        np.array([k for _, k in labels]), options,
    )
    start = lambda word: untouched.views[0].weights[quality.content([word], 12)[0][0]]
    assert weight("Fjord") > weight("XYZZY") + 1 and abs(start("Fjord") - start("XYZZY")) < 1
    table = pd.DataFrame(rows, columns=["doc_id", "text", "lang", "source", "n_chars"])
    plain = quality.co_train(quality.features(table, options), np.array([k for _, k in labels] + [-1] * (len(rows) - 400)), options)
    assert weight("Fjord") == pytest.approx(plain.views[0].weights[quality.content(["Fjord"], 12)[0][0]], abs=0.3)


def test_features_found_before_give_the_same(spark):
    rows, labels = made_up(300)
    docs = spark.createDataFrame([*rows, (None, "river", "en", "x", 5), (5, "other text", "en", "x", 1)], SCHEMA)
    some = spark.createDataFrame([x for x in labels if x[0] % 3], "doc_id bigint, quality int")
    options = CoTraining(bits=10)
    ready = stage(quality.encode(docs, options).select("doc_id", "features"), "features")
    got = quality.score_documents(ready, quality.fit(some, ready, options, features_col="features"), features_col="features")
    want = quality.score_documents(docs, quality.fit(some, docs, options))
    scores = [sorted((r["doc_id"] or -1, r["score"]) for r in t.collect()) for t in (got, want)]
    assert len(scores[0]) == 302 and np.allclose(*scores, atol=1e-4)


def test_the_pool_is_all_documents_outside_the_sample(spark):
    """Each sum of the Spark pool is that of its rows in memory, whatever the partitions."""
    rows, labels = made_up(300)
    options = CoTraining(bits=10, confident=0.6)
    found = quality.features(pd.DataFrame(rows, columns=["doc_id", "text", "lang", "source", "n_chars"]), options)
    y = np.array([k for _, k in labels])
    counts = np.zeros((2, 1 << options.bits))
    quality.add_counts(counts, found[0], y)
    content, line = quality.ContentView(counts, options), np.array([20.0, 0.0])
    layouts = quality.LayoutView(np.zeros(41), np.ones(41), np.linspace(-0.1, 0.1, 42))
    local, given = quality.LocalPool(found, options), np.array([7.0, 900.0])
    for parts in (1, 5):
        table = quality.encode(spark.createDataFrame(rows, SCHEMA), options).select("features.*").repartition(parts)
        pool = quality.SparkPool(table, options, lambda df, name: stage(df, name))
        assert np.allclose(pool.moments(), local.moments(), rtol=1e-5)
        assert np.allclose(pool.token_counts(layouts, line), local.token_counts(layouts, line), rtol=1e-5, atol=1e-4)
        sums = [p.layout_sums(content, line, given)(layouts) for p in (pool, local)]
        assert np.allclose(*sums, rtol=1e-4, atol=1e-4) and np.abs(sums[0]).max() > 1


def test_the_round_kept_of_a_view_is_no_worse_than_none():
    rows, labels = made_up(900, seed=8)
    options = CoTraining(bits=12, confident=0.9)
    found = quality.features(pd.DataFrame(rows, columns=["doc_id", "text", "lang", "source", "n_chars"]), options)
    truth = np.array([k for _, k in labels])
    label = np.where(np.arange(900) % 9 == 0, truth, -1)
    known = np.flatnonzero(label >= 0)
    test = np.concatenate([known[label[known] == k][::5] for k in (0, 1)])
    losses = []
    for rounds in (0, 1, 3):
        model = quality.co_train(found, label, CoTraining(bits=12, confident=0.9, rounds=rounds))
        p = model.probabilities(tuple([f[i] for i in test] for f in found))
        losses.append([quality.log_loss(p[:, v], truth[test]) for v in (0, 1)])
    assert all(a >= b >= c for a, b, c in zip(*losses, strict=True))


def test_a_view_that_a_round_made_worse_does_not_teach():
    """The unlabelled rows spoil the layout view, so the first one goes on teaching: its labels are asked
    for once, and what the content view learned from them is kept."""
    rows, labels = made_up(400)
    rng = random.Random(3)
    for i in range(400, 8400):
        good = i % 2
        text = " ".join(rng.choice(["river", "stone", "walk"] if good else ["BUY", "now", "click"]) for _ in range(12))
        rows.append((i, text, "en", "good.org" if good else "spam.biz", len(text)))
    rows += [(30_000 + i, ("Fjord " if i % 2 else "XYZZY!!! ") + rows[400 + i][1], *rows[400 + i][2:]) for i in range(1, 61)]
    options = CoTraining(bits=12, rounds=3, confident=0.9)
    found = quality.features(pd.DataFrame(rows, columns=["doc_id", "text", "lang", "source", "n_chars"]), options)
    asked = []

    class Pool(quality.LocalPool):
        def token_counts(self, view, line):
            asked.append(view)
            return super().token_counts(view, line)

    known = tuple(f[:400] for f in found)
    pool = Pool(tuple(f[400:] for f in found), options)
    model = quality.co_train(known, np.array([k for _, k in labels]), options, pool)
    weight = lambda word: model.views[0].weights[quality.content([word], 12)[0][0]]
    assert len(asked) == len(set(map(id, asked))) < 3 and weight("Fjord") > weight("XYZZY") + 1


def test_features_against_plain_code():
    """Token by token, also after more tokens than are kept."""
    rng = random.Random(4)
    texts = ["", "a", "A A a !!! !!! 1 \u00c4\u00c4", "x" * 70_000] + [
        " ".join(rng.choice(["UP", "up", "!?", "\u00e9t\u00e9", str(rng.random())]) for _ in range(rng.randint(1, 400))) for _ in range(60)
    ]
    held = quality._tokens
    quality._tokens = quality._Tokens()
    quality._tokens.limit = 500
    try:
        for text in texts:
            tokens = quality._TOKEN.findall(text)
            hashed = [quality.xxhash.xxh64_intdigest(t.encode()) >> 54 for t in tokens]
            hashed += [quality.xxhash.xxh64_intdigest(quality._REPEAT) >> 54] * sum(a == b for a, b in zip(tokens, tokens[1:], strict=False))
            at, weight = quality.content(tokens, 10)
            assert {int(a): w for a, w in zip(at, weight, strict=True)} == {h: 1 + np.log(hashed.count(h)) for h in set(hashed)}
            got = quality.layout(text, tokens, None, "s", float(len(text)), 4)
            words = [t for t in tokens if t[0].isalnum()]
            n, letters = max(len(words), 1), max(sum(map(len, words)), 1)
            assert got[4] == np.log1p(100 * (sum(map(len, tokens)) - sum(map(len, words))) / letters)
            assert got[5] == np.log1p(100 * sum(w.isupper() for w in words) / n) and got[6] == len(set(words)) / n
            assert got[7] == np.log1p(100 * sum(a == b for a, b in zip(words, words[1:], strict=False)) / n)
    finally:
        quality._tokens = held
