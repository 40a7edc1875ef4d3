"""The queries that SQL can express, run by DuckDB over the same tables, and the shape of the others."""

import os
import zlib
from glob import glob

import duckdb
import pytest

from salesflow.llm.queries import ORACLES, QUERIES

COLUMNS = {
    "op2_rotation_codes": ["vec_id", "n_links", "component_id", "kept"],
    "op4_url_digests": ["page_id", "host", "path", "rule", "verdict"],
    "op5_simhash": ["doc_id", "fingerprint", "component_id"],
    "op6_blob_ledger": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op7_ftrl_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op8_site_templates": ["page_id", "url", "text", "n_chars"],
    "op11_range_maxima": ["item_id", "rank", "doc_id", "score"],
    "op12_q_chunks": ["word", "form", "root", "n", "n_near", "form_n"],
    "op13_sentencepiece": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
}


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for path in glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from '{path}'")
    return connection


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_sql(spark, duck, sf_dir, name):
    result = QUERIES[name](spark, sf_dir)
    expected = duck.sql(ORACLES[name])
    columns = sorted(result.columns)
    assert sorted(expected.columns) == columns
    found = sorted((tuple(r) for r in result.select(*columns).collect()), key=repr)
    assert found == sorted(expected.select(", ".join(columns)).fetchall(), key=repr) and found


@pytest.mark.parametrize("name", COLUMNS)
def test_contract_columns(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).columns[: len(COLUMNS[name])] == COLUMNS[name]


def test_held_out_rows_of_the_toxicity_query(spark, sf_dir):
    rows = QUERIES["op7_ftrl_toxicity"](spark, sf_dir).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in rows)
