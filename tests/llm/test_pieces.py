"""Encoding and decoding against the sentencepiece library."""

import hashlib
import random
import struct

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from salesflow.llm import pieces
from salesflow.llm.queries import QUERIES

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def data():
    with open(PATH, "rb") as file:
        return file.read()


@pytest.fixture(scope="module")
def ours(data):
    return pieces.Tokenizer(data)


@pytest.fixture(scope="module")
def library(data):
    return SentencePieceProcessor(model_proto=data)


def odd_texts():
    pick = random.Random(2)
    signs = "ab e▁.,\n\tthe<0x0A></s><s><unk>é漢字😀\x00́﻿  \xa0"
    parts = ["the", "ing", " ", "_", "==", "--", "http://", "tion", "()", "{}", ".", "\n", "    ", "▁", "é"]
    texts = ["".join(pick.choices(signs, k=pick.randrange(30))) for _ in range(2000)]
    texts += ["".join(pick.choices(parts, k=pick.randrange(50))) for _ in range(2000)]
    return texts + ["", " ", "  ", "\n", "▁", "<s>", "a" * 50_000, " " * 5000, "\U0010ffff", "ab " * 20_000, "😀" * 500]


def test_equals_the_library(ours, library):
    texts = odd_texts()
    ids = [ours.encode(text) for text in texts]
    assert ids == library.encode(texts, add_bos=True, add_eos=True)
    assert [ours.decode(i) for i in ids] == library.decode(ids)


def test_whole_words_without_the_cache(data, ours, library):
    """The agenda alone, without parts that are divided or looked up."""
    plain = pieces.Tokenizer(data)
    for text in [t for t in odd_texts() if t][::20]:
        marked = "▁" + text.replace(" ", "▁")
        assert list(plain._merged(marked)) == library.encode(text) == ours.encode(text)[1:-1]


def test_decodes_any_ids(ours, library):
    pick = random.Random(3)
    some = lambda: pick.choice([0, 1, 2, 3, 200, 29871, pick.randrange(130, 260), pick.randrange(32000)])
    for _ in range(5000):
        ids = [some() for _ in range(pick.randrange(12))]
        assert ours.decode(ids) == library.decode(ids)


def _message(*fields):
    out = b""
    for number, value in fields:
        if isinstance(value, int):
            out += bytes([number << 3 & 127 | (128 if number > 15 else 0)]) + (bytes([number >> 4]) if number > 15 else b"")
            out += bytes([value])
        elif isinstance(value, float):
            out += bytes([number << 3 | 5]) + struct.pack("<f", value)
        else:
            out += bytes([number << 3 | 2, len(value)]) + value
    return out


def _model(texts, trainer=((3, 2), (35, 1)), rules=((3, 1), (4, 0)), kind=1):
    special = [("<unk>", 2), ("<s>", 3), ("</s>", 3), *[(f"<0x{b:02X}>", 6) for b in range(256)]]
    found = [_message((1, t.encode()), (2, 0.0), (3, k)) for t, k in special]
    found += [_message((1, t.encode()), (2, float(score)), (3, kind)) for t, score in texts]
    parts = [(1, f) for f in found] + [(2, _message(*trainer)), (3, _message(*rules))]
    return _message(*parts)


def test_scores_and_places_order_the_agenda():
    vocabulary = [("a", 0), ("b", 0), ("ab", -2), ("ba", -2), ("aa", -3), ("aba", -1), ("▁", 0), ("b▁a", -1), ("b▁", -2)]
    ours = pieces.Tokenizer(_model(vocabulary))
    library = SentencePieceProcessor(model_proto=_model(vocabulary))
    pick = random.Random(4)
    for _ in range(500):
        text = "".join(pick.choices("ab x", k=pick.randrange(14)))
        assert ours.encode(text) == library.encode(text, add_bos=True, add_eos=True), text
        assert ours.decode(ours.encode(text)) == library.decode(library.encode(text))


def test_other_models_are_refused():
    for model in (
        _model([("a", 0)], trainer=((3, 1), (35, 1))),
        _model([("a", 0)], trainer=((3, 2),)),
        _model([("a", 0)], rules=((2, b"x"), (4, 0))),
        _model([("a", 0)], rules=((4, 1),)),
        _model([("a", 0)], kind=4),
    ):
        with pytest.raises(ValueError):
            pieces.read_model(model)


def test_columns(spark, library):
    rows = [(1, None, 5), (2, "", 6), (2, "", 6), (3, "Été  😀\n", 7), (None, "x" * 5000, 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    tokenizer = pieces.load(spark, PATH)
    encoded = pieces.encode(docs, tokenizer, ("ids", "packed", "n_tokens", "decoded"))
    assert encoded.columns == ["doc_id", "text", "ids", "packed", "n_tokens", "decoded"]
    found = encoded.collect()
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in found) == sorted((r[0] or 0, r[1] or "") for r in rows)
    for row in found:
        assert row["ids"] == library.encode(row["text"] or "", add_bos=True, add_eos=True)
        assert row["decoded"] == (row["text"] or "") and row["n_tokens"] == len(row["ids"])
        assert row["packed"] == struct.pack(f"<{len(row['ids'])}I", *row["ids"])
    again = encoded.select(pieces.decode("ids", tokenizer).alias("t"), "decoded")
    assert all(r["t"] == r["decoded"] for r in again.collect())
    same = pieces.same_as_library("text", "ids", "decoded", tokenizer).alias("same")
    assert all(r["same"] for r in encoded.select(same).collect())
    assert not any(r["same"] for r in encoded.withColumn("ids", F.reverse("ids")).select(same).collect())
    empty = pieces.encode(docs.limit(0), tokenizer)
    assert empty.count() == 0 and empty.dtypes == [("doc_id", "bigint"), ("text", "string"), ("ids", "array<int>")]
    nothing = docs.select(pieces.decode(F.lit(None).cast("array<int>"), tokenizer).alias("t")).collect()
    assert all(row["t"] is None for row in nothing)


def test_a_difference_from_the_library_is_an_error(data):
    ours = pieces.Tokenizer(data)
    ours.encode_checked(["some words", None, "", "\nmore\n words", "y" * 500])
    ours._ids = dict.fromkeys(ours._ids, 5)
    ours.encode_checked(["some words"])  # looked up, checked before
    with pytest.raises(RuntimeError, match="wonder"):
        ours.encode_checked(["wonder"])


def test_memory_is_bounded(data, library, monkeypatch):
    monkeypatch.setattr(pieces, "_CACHE_PARTS", 50)
    ours = pieces.Tokenizer(data)
    texts = [f"w{i} w{i % 7} " + " ".join(f"t{j}" for j in range(i, i + 5)) for i in range(300)]
    assert [ours.encode(t) for t in texts + texts] == library.encode(texts + texts, add_bos=True, add_eos=True)
    assert len(ours._cache) + len(ours._older) < 200


def test_query(spark, sf_dir, library):
    found = {r["doc_id"]: r for r in QUERIES["op13_sentencepiece"](spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert len(found) == len(docs)
    for doc in docs:
        ids = library.encode(doc["text"] or "", add_bos=True, add_eos=True)
        row = found[doc["doc_id"]]
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_all_documents_against_the_library(spark, documents):
    tokenizer = pieces.load(spark, PATH)
    encoded = pieces.encode(documents, tokenizer, ("ids", "decoded"))
    same = pieces.same_as_library("text", "ids", "decoded", tokenizer)
    assert encoded.filter(same).count() == documents.count()
