"""Spelling variants: words one insertion, deletion or replacement of a character apart, and for each
word the common form it leads to.

Of two words that are one edit apart, the one that is not longer contributes two disjoint chunks, its
first and its second half, and the other one its positional grams of the same length. The edit lies in one
half at most, so the other is found among the grams: a first half in its own place, a second half
moved by the difference of the lengths, 0 or 1. Grams in other places, and at a greater shift, cannot
come from one edit and are not made. Pairs that share a chunk are verified by their edit distance.

A chunk that many words share is no good key. If a group has more than ``max_pairs`` pairs, its words
are divided again: what is left of them besides the shared chunk is one edit apart too, so it has two
chunks of its own, of which one is kept. This goes on until a group is small, or all of a word but one
character is shared, which bounds the group by the alphabet. No pair is lost or capped, and nothing is
emitted for a group before it is small.

A word's form is its near word with the largest count, ties by code points, if that count is at least
``ratio`` times its own; roots follow forms to the end, by pointer jumping: each round doubles the steps.

Null or empty texts have no words; texts are whole, of any length. Repeated rows count again, and a null
id is an empty one. Columns other than the named ones are not read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesflow.staging import stage, staging

LETTERS = "A-Za-zÀ-ÿ"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_PAIR = ("word", "n", "near", "near_n")


def runs_of_letters(docs: DataFrame, min_length: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc, run``: every run of letters with at least ``min_length`` of them, A-Z lower-cased, repeats
    included. A shorter run is never part of a match, and a match starts where its run does."""
    pattern = F.lit(f"[{LETTERS}]{{{min_length},}}")
    runs = F.explode(F.regexp_extract_all(F.col(text_col).cast("string"), pattern, F.lit(0)))
    doc = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return docs.select(doc.alias("doc"), runs.alias("run")).select("doc", _lower(F.col("run")).alias("run"))


def _lower(text: Column) -> Column:
    """A-Z only."""
    return F.translate(text, _UPPER, _UPPER.lower())


def slip(run: Column, doc: Column, every: int) -> Column:
    """A run of letters as it is, or, for one in ``every`` by a hash of it and its document, without one
    character: misspellings as a benchmark plants them."""
    h = F.crc32(F.concat(doc, F.lit(":"), run).cast("binary"))
    place = (F.pmod(h, F.length(run)) + 1).cast("int")
    return F.when(h % every == 0, F.overlay(run, F.lit(""), place, F.lit(1))).otherwise(run)


def count_words(words: DataFrame, min_length: int, min_count: int) -> DataFrame:
    """``word, n`` of a column ``word``."""
    long = words.filter(F.length("word") >= min_length)
    return long.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= min_count)


def _divided(rows: DataFrame) -> DataFrame:
    """Each row twice, with either half of what its word does not yet share added to the key.

    A row is a word in one of its roles: of a pair whose shorter word has ``size`` characters. Those from
    ``low`` to ``high`` are not shared, nor the ``longer`` (0 or 1) characters after them that the word
    has more. ``key`` tells the
    halves that are."""
    middle = F.col("low") + F.floor((F.col("high") - F.col("low")) / 2).cast("int")

    def part(begin: Column, end: Column) -> Column:
        return F.substring("word", begin + 1, end - begin)

    halves = F.array(
        F.struct(
            F.lit("<").alias("side"), part(F.col("low"), middle).alias("text"), middle.alias("low"), F.col("high")
        ),
        F.struct(
            F.lit(">").alias("side"),
            part(middle + F.col("longer"), F.col("high") + F.col("longer")).alias("text"),
            F.col("low"),
            middle.alias("high"),
        ),
    )
    rest = ["word", "n", "size", "longer", "is_chunk"]
    half = F.col("half")
    return rows.select("*", F.explode(halves).alias("half")).select(
        *rest,
        half["low"].alias("low"),
        half["high"].alias("high"),
        # a key equal by chance only adds a pair that is verified
        F.xxhash64("key", "size", half["side"], half["text"]).alias("key"),
    )


def _roles(words: DataFrame) -> DataFrame:
    """Every word as the one with chunks, and as the one with grams of a partner as long as it, or
    shorter by one."""
    length = F.length("word")

    def role(size: Column, longer: int, is_chunk: bool) -> Column:
        return F.struct(size.alias("size"), F.lit(longer).alias("longer"), F.lit(is_chunk).alias("is_chunk"))

    roles = F.explode(F.array(role(length, 0, True), role(length, 0, False), role(length - 1, 1, False)))
    return words.select("word", "n", roles.alias("role")).select(
        "word", "n", "role.*", F.lit(0).alias("low"), F.col("role.size").alias("high"), F.lit(0).cast("long").alias("key")
    )


def near_pairs(words: DataFrame, max_pairs: int = 10_000) -> DataFrame:
    """``word, n, near, near_n``: pairs of distinct words one edit apart, both ways, from distinct
    ``word, n``."""
    with staging(words.sparkSession, "spelling") as keep:
        rows, found, level = keep(_divided(_roles(words)), "rows1"), [], 1
        while True:
            groups = rows.groupBy("key").agg(
                F.count_if(F.col("is_chunk")).alias("chunks"), F.count_if(~F.col("is_chunk")).alias("grams")
            )
            pairs = F.col("chunks") * F.col("grams")
            # written before it is joined, so that Spark sees its size and can split a large group
            groups = keep(groups.filter(pairs > 0).select("key", (pairs > max_pairs).alias("large")), f"groups{level}")
            rows = rows.join(groups, "key")
            split = F.col("large") & (F.col("high") - F.col("low") > 1)
            small = keep(_verified(rows.filter(~split)), f"found{level}", compact=True)
            found.append(small)
            rows = keep(_divided(rows.filter(split)), f"rows{level + 1}")
            if not rows.head(1):
                break
            level += 1
        pairs = found[0]
        for more in found[1:]:
            pairs = pairs.unionAll(more)
        both = pairs.distinct()
        return stage(both.unionAll(both.select("near", "near_n", "word", "n")).toDF(*_PAIR), "near", compact=True)


def _verified(rows: DataFrame) -> DataFrame:
    chunks = rows.filter("is_chunk").select("key", "word", "n")
    grams = rows.filter(~F.col("is_chunk")).select("key", F.col("word").alias("near"), F.col("n").alias("near_n"))
    as_long = F.length("word") == F.length("near")
    return (
        chunks.join(grams, "key")
        .filter(~as_long | (F.col("word") < F.col("near")))  # words of one length meet both ways
        .filter(F.levenshtein("word", "near", 1) == 1)
        .select(*_PAIR)
        .distinct()
    )


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` from ``word, form``, where following forms ends: counts rise with each step."""
    with staging(forms.sparkSession, "roots") as keep:
        to, step = keep(forms.select("word", F.col("form").alias("root")), "step0", compact=True), 0
        while True:
            step += 1
            onward = to.select(F.col("word").alias("root"), F.col("root").alias("next"))
            moved = keep(to.join(onward, "root", "left").select("word", "root", "next"), f"step{step}", compact=True)
            to = moved.select("word", F.coalesce("next", "root").alias("root"))
            if not moved.filter(F.col("next").isNotNull()).head(1):
                return stage(to, "roots", compact=True)


def variants(words: DataFrame, ratio: int = 2, max_pairs: int = 10_000) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for distinct ``word, n``."""
    words = stage(words.select("word", "n"), "words", compact=True)
    near = near_pairs(words, max_pairs)
    best = F.min(F.struct((-F.col("near_n")).alias("rank"), F.col("near").alias("word")))
    forms = near.groupBy("word", "n").agg(F.count("*").alias("n_near"), best.alias("best"))
    forms = forms.withColumn("common", -F.col("best.rank") >= ratio * F.col("n")).select(
        "word",
        "n_near",
        F.when(F.col("common"), F.col("best.word")).alias("form"),
        F.when(F.col("common"), -F.col("best.rank")).alias("form_n"),
    )
    forms = stage(forms, "forms", compact=True)
    roots = _roots(forms.filter(F.col("form").isNotNull()).select("word", "form"))
    return (
        words.join(forms, "word", "left")
        .join(roots, "word", "left")
        .select(
            "word",
            "form",
            F.coalesce("root", "word").alias("root"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            "form_n",
        )
    )
