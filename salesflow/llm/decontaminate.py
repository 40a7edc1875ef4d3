"""Benchmark decontamination: a BM25 index of the test items, searched with block maxima.

The test items are the indexed side and are broadcast, in parts of at most ``max_index_chars``
characters, each part searched by one pass over the documents; a benchmark of any size is handled, and
the parts do not show in the result. Every passage of every document is a query: windows of words so
long, and so far apart, that a copy of the longest item of the benchmark lies whole in one of them.

A BM25 score is divided by the score an item gives its own text, so it says how much of the item's
weight a passage holds, and one threshold serves all items. Items are numbered in blocks, and each
term's list stores, for each block, the largest impact. As in WAND, an item is scored only if the
bounds allow it to reach the threshold: the terms with the smallest impacts are set aside, their
block maxima added up once; the other terms' block maxima are summed per passage, and only blocks in
which the two sums reach the threshold are opened and scored exactly. Nothing that would reach the
threshold is skipped.

What is retrieved is verified: the passage must hold at least ``min_similarity`` of the distinct word
shingles of the question and the answer together, and of the distinct words of each of the two at
least ``min_overlap``, so that a question without its answer is no leak."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesflow.llm.shipping import shipped

_WORD = re.compile(r"\w+")
_SHARES = ("score", "similarity", "question_overlap", "answer_overlap")
_FOUND = {"passage": T.IntegerType(), **dict.fromkeys(_SHARES, T.DoubleType())}


@dataclass(frozen=True)
class Bm25Options:
    """``threshold``: least share of an item's own score. ``block``: items per block."""

    threshold: float = 0.5
    min_similarity: float = 0.8
    min_overlap: float = 0.8
    shingle: int = 5
    k1: float = 1.2
    b: float = 0.75
    block: int = 4
    max_index_chars: int = 16_000_000


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def split_item(words: list[str], shingle: int) -> tuple[list[str], list[str]]:
    """Question and answer of an item that does not mark them: its last quarter, at least a
    shingle, is the answer; an item of less than two shingles is both."""
    if len(words) < 2 * shingle:
        return words, words
    cut = len(words) - max(shingle, len(words) // 4)
    return words[:cut], words[cut:]


def shingles(words: list[str], size: int) -> set[tuple[str, ...]]:
    """Distinct runs of ``size`` words; fewer words are one run, no words none."""
    if len(words) < size:
        return {tuple(words)} if words else set()
    return set(zip(*(words[i:] for i in range(size)), strict=False))


def overlaps(item: tuple[list[str], list[str]], passage: list[str], size: int) -> tuple[float, float, float]:
    """Shares of an item that a passage has: of all shingles of question and answer (one shorter
    than a shingle counts as a run of its length), of the question's distinct words, and of the
    answer's. A part without words has nothing to share: 0."""
    wanted = {(len(run), run) for part in item for run in shingles(part, size)}
    having = {n: shingles(passage, n) for n in {n for n, _ in wanted}}
    words = set(passage)
    held = sum(run in having[n] for n, run in wanted)
    shares = [len(set(part) & words) / len(set(part)) if part else 0.0 for part in item]
    return (held / len(wanted) if wanted else 0.0, *shares)


class Bm25Index:
    """Impacts of the terms of some items, with block maxima.

    ``items``: (question words, answer words) in the order of their numbers; ``frequencies``: in how
    many of all ``n_items`` items each term occurs; ``mean_length``: words of all items, on average;
    ``longest``: words of the longest of all items (by default, of these)."""

    def __init__(
        self,
        items: list[tuple[list[str], list[str]]],
        frequencies: dict[str, int],
        n_items: int,
        mean_length: float,
        options: Bm25Options,
        longest: int | None = None,
    ) -> None:
        self.options = options
        self.parts = items
        whole = [q + a if q is not a else q for q, a in items]
        longest = max(map(len, whole), default=1) if longest is None else longest
        self.stride = max(1, math.ceil(1.25 * longest))
        self.terms = {t: i for i, t in enumerate(sorted({w for item in whole for w in item}))}
        self.item_terms: list[np.ndarray] = []
        self.item_impacts: list[np.ndarray] = []
        for words in whole:
            counts = Counter(words)
            terms = np.array([self.terms[w] for w in counts], dtype=np.int64)
            tf = np.array(list(counts.values()), dtype=np.float64)
            df = np.array([frequencies[w] for w in counts], dtype=np.float64)
            idf = np.log(1 + (n_items - df + 0.5) / (df + 0.5))
            long = options.k1 * (1 - options.b + options.b * len(words) / max(mean_length, 1))
            impacts = idf * tf * (options.k1 + 1) / (tf + long)
            self.item_terms.append(terms)
            self.item_impacts.append(impacts / impacts.sum() if len(words) else impacts)
        self._add_blocks()

    def _add_blocks(self) -> None:
        """Lists (term, block, largest impact) in the order of the terms, and the terms set aside:
        the smallest list maxima, as many as stay below half the threshold in every block."""
        size, n = self.options.block, len(self.item_terms)
        lengths = [len(t) for t in self.item_terms]
        self.n_blocks = -(-n // size)
        item = np.repeat(np.arange(n), lengths)
        term = np.concatenate([*self.item_terms, np.zeros(0, dtype=np.int64)])
        impact = np.concatenate([*self.item_impacts, np.zeros(0)])
        key, at = np.unique(term * max(self.n_blocks, 1) + item // size, return_inverse=True)
        top = np.zeros(len(key))
        np.maximum.at(top, at, impact)
        term, block = np.divmod(key, max(self.n_blocks, 1))
        starts = np.searchsorted(term, np.arange(len(self.terms) + 1))
        aside = np.zeros(self.n_blocks)
        essential = np.ones(len(self.terms), dtype=bool)
        maxima = np.maximum.reduceat(top, starts[:-1]) if len(top) else np.zeros(0)
        for t in np.argsort(maxima, kind="stable"):
            here = slice(starts[t], starts[t + 1])
            raised = aside[block[here]] + top[here]
            if raised.max() >= self.options.threshold / 2:
                break
            aside[block[here]] = raised
            essential[t] = False
        self.list_block, self.list_top, self.list_start = block, top, starts
        self.aside, self.essential = aside, essential

    def candidates(self, window: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, block) whose bounds reach the threshold; ``window, term``: distinct pairs of a
        passage and a term that is not set aside."""
        lengths = self.list_start[term + 1] - self.list_start[term]
        first = np.repeat(self.list_start[term] - (np.cumsum(lengths) - lengths), lengths)
        posting = first + np.arange(lengths.sum())
        key, at = np.unique(np.repeat(window, lengths) * self.n_blocks + self.list_block[posting], return_inverse=True)
        bound = np.bincount(at, weights=self.list_top[posting], minlength=len(key))
        window, block = np.divmod(key, max(self.n_blocks, 1))
        reached = bound + self.aside[block] >= self.options.threshold - 1e-9
        return window[reached], block[reached]

    def search(self, texts: list[str | None]) -> list[list[dict]]:
        """Per text the verified items: number, best passage, score and overlaps."""
        get, stride = self.terms.get, self.stride
        words = [words_of(t) for t in texts]
        numbers = map(get, chain.from_iterable(words), repeat(-1))
        term = np.fromiter(numbers, dtype=np.int64, count=sum(map(len, words)))
        lengths = np.array([len(ws) for ws in words], dtype=np.int64)
        starts = np.cumsum(lengths) - lengths
        at = np.flatnonzero(np.append(self.essential, False)[term])  # -1: not a term
        text = np.searchsorted(starts, at, side="right") - 1
        # window c of a text: words c * stride to (c + 2) * stride
        chunk = (at - starts[text]) // stride
        first_window = np.cumsum(-(-lengths // stride)) - -(-lengths // stride)
        window = first_window[text] + chunk
        pairs = np.concatenate([window, (window - 1)[chunk > 0]]) * len(self.terms)
        pairs = np.unique(pairs + np.concatenate([term[at], term[at][chunk > 0]]))
        opened, blocks = self.candidates(*np.divmod(pairs, max(len(self.terms), 1)))
        best: dict[tuple[int, int], dict] = {}
        has = np.zeros(len(self.terms), dtype=bool)
        for w in np.unique(opened):
            t = int(np.searchsorted(first_window, w, side="right")) - 1
            passage = int(w - first_window[t])
            run = words[t][passage * stride : (passage + 2) * stride]
            own = [n for n in map(get, run) if n is not None]
            has[own] = True
            scores = [
                (item, float(self.item_impacts[item][has[self.item_terms[item]]].sum()))
                for block in blocks[opened == w]
                for item in range(block * self.options.block, min((block + 1) * self.options.block, len(self.parts)))
            ]
            has[own] = False
            scores = [x for x in scores if x[1] >= self.options.threshold]
            if not scores:
                continue
            for item, score in scores:
                similarity, *shares = overlaps(self.parts[item], run, self.options.shingle)
                if similarity < self.options.min_similarity or min(shares) < self.options.min_overlap:
                    continue
                hit = dict(zip(("item", *_FOUND), (item, passage, score, similarity, *shares), strict=True))
                rank = lambda h: (h["similarity"], round(h["score"], 9), -h["passage"])
                if (t, item) not in best or rank(hit) > rank(best[t, item]):
                    best[t, item] = hit
        found: list[list[dict]] = [[] for _ in texts]
        for (t, _), hit in sorted(best.items()):
            found[t].append(hit)
        return found


def build_indexes(
    benchmark: DataFrame,
    options: Bm25Options = Bm25Options(),
    *,
    id_col: str = "item_id",
    question_col: str = "text",
    answer_col: str | None = None,
) -> Iterator[tuple[Bm25Index, list]]:
    """Indexes of the parts of the benchmark, each with its item ids, one held at a time. Term
    frequencies and lengths are taken over all items by Spark; a part, bounded by its characters, is
    gathered to be broadcast."""
    answer = F.lit(None).cast("string") if answer_col is None else F.col(answer_col).cast("string")
    items = benchmark.select(F.col(id_col).alias("id"), F.col(question_col).cast("string").alias("q"), answer.alias("a"))
    text = F.concat_ws(" ", "q", "a")
    chars = items.agg(F.sum(F.length(text)).alias("n"), F.count("*").alias("items")).first()
    if not chars["items"]:
        return
    parts = -(-(chars["n"] or 0) // (options.max_index_chars // 2)) or 1
    words = items.select(F.regexp_extract_all(F.lower(text), F.lit(r"(?U)\w+"), 0).alias("words"))
    sizes = words.agg(F.sum(F.size("words")).alias("words"), F.max(F.size("words")).alias("longest")).first()
    totals, longest = sizes["words"], sizes["longest"] or 1
    for part in range(parts):
        rows = items.filter(F.pmod(F.xxhash64("id", "q", "a"), F.lit(parts)) == part).orderBy("id", "q", "a").collect()
        split = []
        for row in rows:
            question, answer_words = words_of(row["q"]), words_of(row["a"])
            split.append((question, answer_words) if answer_words else split_item(question, options.shingle))
        frequencies = Counter(w for q, a in split for w in {*q, *a})
        if parts > 1:  # the part's own counts, raised to those over all items
            wanted = benchmark.sparkSession.createDataFrame([(w,) for w in frequencies], "term string")
            terms = words.select(F.explode(F.array_distinct("words")).alias("term")).groupBy("term").count()
            counted = terms.join(wanted, "term", "left_semi").collect()
            frequencies |= Counter({r["term"]: r["count"] for r in counted})
        index = Bm25Index(split, frequencies, chars["items"], (totals or 0) / chars["items"], options, longest)
        yield index, [r["id"] for r in rows]


_AT_ONCE = 1_000_000  # characters searched together, however long the texts


def _hits(index: Bm25Index, ids: list, id_type: T.DataType, docs: DataFrame, text: Column) -> Column:
    """Array of the items found in a text, with their ids as ``item``."""
    held = shipped(docs.sparkSession, (index, ids))
    fields = [T.StructField("item", id_type), *(T.StructField(c, t) for c, t in _FOUND.items())]

    @F.pandas_udf(T.ArrayType(T.StructType(fields)))
    def searched(texts: pd.Series) -> pd.Series:
        index, ids = held()
        found: list[list[dict]] = []
        todo: list[str | None] = []
        chars = 0
        for text in texts:
            todo.append(text)
            chars += len(text or "")
            if chars >= _AT_ONCE:
                found += index.search(todo)
                todo, chars = [], 0
        found += index.search(todo) if todo else []
        return pd.Series([[hit | {"item": ids[hit["item"]]} for hit in hits] for hits in found])

    return searched(text.cast("string"))


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    options: Bm25Options = Bm25Options(),
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    question_col: str = "text",
    answer_col: str | None = None,
) -> DataFrame:
    """One row per document and test item it holds: both ids, ``passage`` (number of its best
    window), ``score`` (share of the item's BM25 weight), ``similarity`` (share of its shingles),
    ``question_overlap``, ``answer_overlap`` (shares of their words).

    Null and empty texts and items hold and match nothing. Repeated rows of either side give
    repeated result rows; rows with a null id are searched too. An empty side gives no rows. Of
    ``docs`` only the two named columns are read."""
    keys = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    id_type, item_type = docs.schema[id_col].dataType, benchmark.schema[item_col].dataType
    indexes = build_indexes(benchmark, options, id_col=item_col, question_col=question_col, answer_col=answer_col)
    out = None
    for index, ids in indexes:
        hits = keys.select("_id", F.explode(_hits(index, ids, item_type, docs, F.col("_text"))).alias("hit"))
        names = {"item": item_col, **{c: c for c in _FOUND}}
        part = hits.select(F.col("_id").alias(id_col), *[F.col(f"hit.{c}").alias(name) for c, name in names.items()])
        out = part if out is None else out.unionByName(part)
    if out is None:
        fields = {id_col: id_type, item_col: item_type, **_FOUND}
        schema = T.StructType([T.StructField(name, kind) for name, kind in fields.items()])
        out = docs.sparkSession.createDataFrame([], schema)
    return out


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, options: Bm25Options = Bm25Options(), *, text_col: str = "text", **items
) -> DataFrame:
    """The rows of ``docs`` that hold no test item, all columns as they are; null and empty texts
    stay. A filter per part of the benchmark: no shuffle."""
    item_type = benchmark.schema[items.get("id_col", "item_id")].dataType
    for index, ids in build_indexes(benchmark, options, **items):
        docs = docs.filter(F.size(_hits(index, ids, item_type, docs, F.col(text_col))) == 0)
    return docs
