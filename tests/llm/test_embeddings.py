import numpy as np
import pytest

from salesflow.llm import embeddings
from salesflow.llm.embeddings import CodeOptions, Codes, bounds, rotation


def brute(rows, threshold=0.93):
    """{position: (links, smallest position reachable)} by comparing all pairs."""
    ok = []
    for _, vector, label in rows:
        v = None if vector is None or None in vector else np.array(vector, dtype=np.float32).astype(float)
        good = label is not None and v is not None and len(v) and np.isfinite(v).all() and (v != 0).any()
        ok.append(v / np.linalg.norm(v) if good else None)
    n = len(rows)
    near = [
        [j for j in range(n) if j != i and ok[i] is not None and ok[j] is not None and rows[i][2] == rows[j][2]
         and len(ok[i]) == len(ok[j]) and ok[i] @ ok[j] >= threshold]
        for i in range(n)
    ]
    low, changed = list(range(n)), True
    while changed:
        changed = False
        for i in range(n):
            for j in near[i]:
                if low[j] < low[i]:
                    low[i], changed = low[j], True
    return {i: (len(near[i]), low[i]) for i in range(n)}


def near_vectors(seed, n, dims):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((max(n // 6, 1), dims))
    noise = rng.uniform(0, 0.5, (n, 1)) * rng.standard_normal((n, dims))
    return base[rng.integers(0, len(base), n)] + noise


@pytest.mark.parametrize("dims", [8, 64, 100])
def test_matches_brute_force(spark, dims):
    vectors = near_vectors(dims, 240, dims)
    vectors[200:220] = vectors[10]
    rows = [(i, [float(x) for x in v], i % 2) for i, v in enumerate(vectors)]
    rows = sorted(rows)
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    got = embeddings.near_duplicates(frame, CodeOptions(tile=40, rows=16)).collect()
    want = brute(rows)
    assert len(got) == len(rows)
    for r in got:
        links, low = want[r["vec_id"]]
        assert (r["n_links"], r["component_id"], r["kept"]) == (links, low, low == r["vec_id"])
    assert any(links for links, _ in want.values())


def test_given_table_matches_brute_force(spark, sf_dir):
    frame = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = sorted((r["vec_id"], r["embedding"], r["label"]) for r in frame.collect())
    want = {rows[i][0]: (links, rows[low][0]) for i, (links, low) in brute(rows).items()}
    got = embeddings.near_duplicates(frame).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got} == want


def test_bounds_hold_and_estimates_are_unbiased():
    vectors = near_vectors(1, 200, 64)
    estimates = []
    for seed in range(60):
        turn = rotation(64, seed)
        codes = Codes(vectors, turn)
        s = codes.products(slice(0, 5), codes)
        cosine = codes.unit[:5] @ codes.unit.T
        low, high = bounds(s.astype(float), codes.error[:5, None] + 1e-5, codes.factor[None, :], 64, 6.5)
        least = embeddings.least_product(codes.factor, 64, CodeOptions())
        assert (s + codes.error[:5, None] + 1e-5 >= least)[high >= 0.93].all()
        assert (low <= cosine + 1e-9).all() and (cosine <= high + 1e-9).all()
        estimates.append(s / codes.factor[None, :])
    assert np.abs(np.mean(estimates, axis=0) - cosine).max() < 0.12
    # and the bounds are of use: far pairs are decided without the exact product
    assert (high[cosine < 0.3] < 0.93).mean() > 0.99


def test_odd_rows(spark):
    unit = [1.0, 0.0]
    rows = [
        (4, unit, 1, 0, "a"), (2, [2.0, 0.0], 1, 0, "a"), (2, [2.0, 0.0], 1, 0, "a"), (None, unit, 1, 0, "a"),
        (5, None, 1, 0, "a"), (6, [0.0, 0.0], 1, 0, None), (7, [1.0, None], 1, 0, "a"), (8, [float("nan"), 1.0], 1, 0, "a"),
        (9, [float("inf"), 1.0], 1, 0, "a"), (10, unit, None, 0, "a"), (11, [], 1, 0, "a"), (12, unit, 2, 0, "a"),
        (13, [1.0, 0.0, 0.0], 1, 0, "a"), (None, None, None, None, None),
    ]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int, n_links int, node string")
    got = sorted((tuple(r) for r in embeddings.near_duplicates(frame).collect()), key=str)
    alone = [(i, 0, i, True) for i in (5, 6, 7, 8, 9, 10, 11, 12, 13)]
    want = [(4, 3, 2, False), (2, 3, 2, True), (2, 3, 2, True), (None, 3, 2, False), (None, 0, None, True), *alone]
    assert got == sorted(want, key=str)


def test_empty_table(spark):
    frame = spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")
    assert embeddings.near_duplicates(frame).count() == 0


def test_pairs_at_the_threshold_do_not_depend_on_their_block():
    """The same pairs, alone and among many open ones, at a threshold that many of them meet exactly."""
    rng = np.random.default_rng(11)
    vectors = near_vectors(11, 120, 64)
    turn = rotation(64, 1)
    codes = Codes(vectors, turn)
    pairs = rng.integers(0, 120, (60, 2))
    for a, b in pairs:
        cosine = float(np.einsum("ij,ij->i", codes.unit[[a]], codes.unit[[b]])[0])
        options = CodeOptions(threshold=cosine)
        alone = [n.tolist() for _, n in embeddings.linked(codes.take(np.array([a])), codes.take(np.array([b])), options)]
        whole = dict((i, n.tolist()) for i, n in embeddings.linked(codes, codes, options))
        assert alone == [[0]] and b in whole[a]
