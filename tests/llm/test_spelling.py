"""Spelling variants against all pairs of words, compared in plain Python."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from salesflow.llm import spelling
from salesflow.llm.spelling import count_words, near_pairs, runs_of_letters, slip, variants


def edits(word, other):
    """Whether exactly one code point is inserted, deleted or replaced."""
    if len(word) > len(other):
        word, other = other, word
    if len(word) == len(other):
        return sum(a != b for a, b in zip(word, other, strict=True)) == 1
    return len(other) - len(word) == 1 and any(other[:i] + other[i + 1 :] == word for i in range(len(other)))


def plain_variants(counts, ratio=2):
    near = {w: [v for v in counts if edits(w, v)] for w in counts}
    form = {}
    for word, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        if best is not None and counts[best] >= ratio * counts[word]:
            form[word] = best

    def root(word):
        while word in form:
            word = form[word]
        return word

    return sorted(
        (w, form.get(w), root(w), n, len(near[w]), counts[form[w]] if w in form else None) for w, n in counts.items()
    )


def rows_of(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(tuple(r) for r in df.collect())


def random_words(seed):
    pick = random.Random(seed)
    words = {"".join(pick.choices("abé", k=pick.randrange(5, 9))) for _ in range(150)}
    words |= {"prefixprefix" + "".join(pick.choices("abcd", k=4)) for _ in range(120)}
    words |= {"".join(pick.choices("xy", k=3)) + "suffixsuffix" for _ in range(8)}
    words |= {"aaaaa", "aaaaaa", "aaaaaaa", "baaaaa", "aaaaab", "abababab", "babababa", "ababababa"}
    words |= {"étéété", "eteete", "étéete", "x" * 200, "x" * 199, "x" * 199 + "y"}
    return {w: pick.choice([3, 3, 4, 6, 12, 24, 24, 50]) for w in words}


@pytest.mark.parametrize("max_pairs", [0, 40, 10_000])
def test_equals_all_pairs(spark, max_pairs):
    """With max_pairs=0 every group is divided to the end."""
    counts = random_words(5)
    words = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    assert rows_of(variants(words, max_pairs=max_pairs)) == plain_variants(counts)


def test_every_single_edit_is_found(spark):
    words = {"abcdefgh", "abcdefghi"}
    for word in list(words):
        for i in range(len(word) + 1):
            words |= {word[:i] + "q" + word[i:], word[:i] + "q" + word[i + 1 :], word[:i] + word[i + 1 :]}
    wanted = sorted((a, b) for a in words for b in words if edits(a, b))
    table = spark.createDataFrame([(w, 1) for w in sorted(words)], "word string, n long")
    for max_pairs in (0, 20, 10_000):
        pairs = near_pairs(table, max_pairs).select("word", "near").collect()
        assert sorted(tuple(p) for p in pairs) == wanted


def test_a_hot_chunk_makes_few_candidates(spark, monkeypatch):
    """Words that share their first half: candidates grow with the words, not with their square."""
    pick = random.Random(1)
    made = []
    verified = spelling._verified

    def counted(rows):
        sides = rows.groupBy("key").agg(F.count_if(F.col("is_chunk")).alias("a"), F.count("*").alias("b"))
        made.append(sides.agg(F.coalesce(F.sum(F.expr("a * (b - a)")), F.lit(0))).first()[0])
        return verified(rows)

    monkeypatch.setattr(spelling, "_verified", counted)
    totals = []
    for size in (1000, 4000):
        words = {"commonchunk" + "".join(pick.choices("abcdefghijklmnop", k=11)) for _ in range(size)}
        table = spark.createDataFrame([(w, 1) for w in words], "word string, n long")
        made.clear()
        near_pairs(table, 1000).count()
        totals.append(sum(made))
    assert totals[1] < 10 * totals[0] and totals[1] < 4000 * 50


def test_roots_follow_long_chains(spark):
    counts = {"a" * (5 + i): 3 * 2**i for i in range(12)}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    found = rows_of(variants(words))
    assert found == plain_variants(counts) and {r[2] for r in found} == {"a" * 16}


def plain_counts(docs, every, min_length, min_count):
    counts = Counter()
    for doc, text in docs:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= min_length and n >= min_count}


def test_words_of_texts(spark):
    docs = [
        (1, "Éteint ÉTEINT éteint, l'ÉTÉ×÷ abcde ABCDE abcdé 12abcde34 abcde_abcde"),
        (2, None),
        (3, ""),
        (None, "abcde abcdf 日本語abcde ab-cde abcd"),
        (3, "long " * 20000 + "longer " * 20000),
    ]
    docs += [(i, "common words of documents") for i in range(1500)]
    table = spark.createDataFrame(docs, "doc_id long, text string").withColumn("run", F.lit("x"))
    runs = runs_of_letters(table, 5)
    words = runs.select(slip(F.col("run"), F.col("doc"), 97).alias("word"))
    found = {r["word"]: r["n"] for r in count_words(words, 5, 3).collect()}
    assert found == plain_counts(docs, 97, 5, 3)
    assert len(found) > 5  # some slips of one word are the same


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, word string, n int")
    runs = runs_of_letters(docs, 5)
    assert count_words(runs.select(F.col("run").alias("word")), 5, 3).count() == 0
    words = spark.createDataFrame([], "word string, n long, form string, key int")
    assert rows_of(variants(words)) == []
    lone = spark.createDataFrame([("single", 3, "x", 1)], "word string, n long, form string, key int")
    assert rows_of(variants(lone)) == [("single", None, "single", 3, 0, None)]
