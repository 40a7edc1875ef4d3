import numpy as np
import xxhash

from salesflow.llm import simhash
from salesflow.llm.components import connected_components

SCHEMA = "doc_id bigint, text string, fingerprint int, component_id string, mask int"


def brute_print(text, shingle=3):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split(" ")]
    words = [x for w in words for y in w.split("\n") for x in y.split("\t") if x]
    parts = [" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """{position: smallest position reachable}, by comparing all pairs."""
    n = len(prints)
    low = list(range(n))
    changed = True
    while changed:
        changed = False
        for i in range(n):
            for j in range(n):
                if (prints[i] ^ prints[j]).bit_count() <= 2 and low[j] < low[i]:
                    low[i], changed = low[j], True
    return low


def test_fingerprint_matches_a_plain_one():
    for text in ("", None, "One", "two WORDS", "a b c", "a b c a b c a b c", "É è\tÄ x\ny z Z", "w " * 500):
        assert simhash.fingerprint(text) == brute_print(text)


def test_spark_hash_is_the_one_used(spark):
    got = spark.sql("select xxhash64('a b c')").first()[0]
    assert got % (1 << 64) == xxhash.xxh64_intdigest(b"a b c", 42)


def test_documents_match_brute_force(spark, documents):
    rows = {r["doc_id"]: r for r in simhash.near_duplicates(documents).collect()}
    docs = sorted((r["doc_id"], r["text"]) for r in documents.collect())
    prints = [brute_print(t) for _, t in docs]
    low = brute_components(prints)
    for (doc_id, _), p, at in zip(docs, prints, low, strict=True):
        assert rows[doc_id]["fingerprint"] == f"{p:016x}"
        assert rows[doc_id]["component_id"] == docs[at][0]


def test_shards_of_every_size_find_the_same_links(spark):
    rng = np.random.default_rng(3)
    centre = rng.integers(0, 1 << 63, 3)
    near = [int(c) ^ (1 << int(a)) ^ (1 << int(b)) for c in centre for a, b in rng.integers(0, 20, (250, 2))]
    prints = sorted({*near, *(int(x) for x in rng.integers(0, 1 << 63, 300))})
    table = spark.createDataFrame([(p,) for p in prints], "print bigint")
    roots = {}
    for max_shard in (1, 1 << 20):  # the smallest allowed one splits the near ones several times
        found = connected_components(simhash.links(table, 2, max_shard)).collect()
        roots[max_shard] = {r["node"]: r["root"] for r in found}
    low = brute_components(prints)
    want = {p: prints[i] for p, i in zip(prints, low, strict=True) if low.count(i) > 1}
    assert roots[1] == roots[1 << 20] == want


def test_bk_tree_search_equals_a_scan():
    rng = np.random.default_rng(5)
    values = np.unique(rng.integers(0, 1 << 16, 400).astype(np.uint64))
    nodes = simhash.bk_tree(values)
    assert sorted(n[0] for n in nodes) == list(range(len(values)))
    found = {(int(q), v) for v, near in simhash.bk_search(values, nodes, values, 2) for q in near}
    scan = {(i, j) for i in range(len(values)) for j in range(len(values)) if int(values[i] ^ values[j]).bit_count() <= 2}
    assert found == scan


def test_odd_rows(spark):
    long = "word " * 200_000
    rows = [
        (5, "same text here", 1, "x", 1), (3, "same text here", 1, "x", 1), (3, "same text here", 1, "x", 1),
        (7, None, 2, "y", 1), (8, "", 2, "y", None), (None, "same text here", 3, None, 1), (9, long, 0, "z", 0),
        (None, "another one of no id", 3, None, 1),
    ]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = sorted(((r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(docs).collect()), key=str)
    want = [(3, 3), (3, 3), (5, 3), (None, 3), (7, 7), (8, 7), (9, 9), (None, None)]
    assert got == sorted(want, key=str)
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == [3, 7, 9, None]


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(docs).count() == 0
    assert simhash.drop_near_duplicates(docs).count() == 0


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 100), (7, None), (60, 50)], "a bigint, b bigint")
    got = {r["node"]: r["root"] for r in connected_components(edges).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 50: 50, 60: 50}
