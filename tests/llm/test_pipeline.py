import pytest
from test_decontaminate import brute as leaks
from test_simhash import brute_components, brute_print

import __spark_entry__ as contract
import corpus_pipeline
from corpus_pipeline import TARGETS
from salesflow.llm import pii, toxicity
from salesflow.llm.queries import PII_KEY, held_out


@pytest.fixture(scope="module")
def stages(spark, sf_dir, documents):
    """The rows that each stage got, and its result's columns and rows."""
    docs, out = documents, {}
    for name, step in corpus_pipeline.STAGES:
        rows = [r.asDict() for r in docs.collect()]
        docs = step(spark, docs, sf_dir)
        out[name] = (rows, docs.columns, [r.asDict() for r in docs.collect()])
    return out


def ids(rows):
    return {r["doc_id"] for r in rows}


def test_names_and_columns(stages, documents):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "simhash_near_dedup", "benchmark_decontamination", "pii", "mixing",
    ]
    for name in list(stages)[:-1]:
        assert stages[name][1] == documents.columns


def test_toxicity_stage(stages, spark, sf_dir, documents):
    before, _, after = stages["toxicity"]
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(labels.filter(~held_out()), documents)
    scores = {r["doc_id"]: r["score"] for r in toxicity.score_documents(documents, model).collect()}
    assert ids(after) == {r["doc_id"] for r in before if scores[r["doc_id"]] < 0.7}
    clean = {r["doc_id"] for r in labels.filter("toxic = 0").collect()}
    assert len(clean - ids(after)) <= 0.01 * len(clean)


def test_near_duplicate_stage(stages):
    before, _, after = stages["simhash_near_dedup"]
    before = sorted(before, key=lambda r: r["doc_id"])
    low = brute_components([brute_print(r["text"]) for r in before])
    assert ids(after) == {before[i]["doc_id"] for i in set(low)} and len(after) == len(set(low)) < len(before)


def test_decontamination_stage(stages, spark, sf_dir):
    before, _, after = stages["benchmark_decontamination"]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    found = {d for d, _ in leaks([(r["doc_id"], r["text"]) for r in before], items)}
    assert ids(after) == ids(before) - found


def test_pii_stage(stages, spark):
    before, _, after = stages["pii"]
    table = spark.createDataFrame([(r["doc_id"], r["text"]) for r in before], "doc_id bigint, text string")
    want = {r["doc_id"]: r["text"] for r in pii.pseudonymise(table, PII_KEY).collect()}
    assert {r["doc_id"]: r["text"] for r in after} == want


def test_mixing_stage(stages):
    before, columns, after = stages["mixing"]
    assert ids(after) == ids(before) and len(after) == len(before)
    assert columns[-2:] == ["rate", "copies"] and all(r["rate"] >= 0 for r in after)
    total = sum(r["n_tokens"] for r in after)
    start = {d: sum(r["n_tokens"] * r[f"p_{d}"] for r in after) / total for d in TARGETS}
    end = {d: sum(r["rate"] * r["n_tokens"] * r[f"p_{d}"] for r in after) / total for d in TARGETS}
    miss = lambda shares: sum((shares[d] - TARGETS[d]) ** 2 for d in TARGETS)
    assert miss(end) < 0.1 * miss(start)


def test_run_is_the_stages_in_turn(stages, spark, sf_dir):
    got = {r["doc_id"]: (r["text"], round(r["rate"], 6)) for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert got == {r["doc_id"]: (r["text"], round(r["rate"], 6)) for r in stages["mixing"][2]}


def test_all_queries_are_registered():
    names = contract.queries()
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)] == [1] * 10 and "pipeline" in names


def test_odd_rows_and_empty_table(spark, sf_dir, documents):
    rows = [(None, None, None, None, None), (5000, "", "", "", 0), (5000, "", "", "", 0), (5001, "token " * 100_000, "en", "x", 1)]
    docs = documents.union(spark.createDataFrame(rows, documents.schema)).withColumn("rate", documents.lang)
    for _, step in corpus_pipeline.STAGES:
        docs = step(spark, docs, sf_dir)
    assert {5000, 5001} & ids([r.asDict() for r in docs.collect()]) == {5001} or docs.filter("doc_id = 5000").count() <= 1
    docs = documents.limit(0)
    for _, step in corpus_pipeline.STAGES:
        docs = step(spark, docs, sf_dir)
        assert docs.count() == 0
