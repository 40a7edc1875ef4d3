"""Ranked lexical search: the k best documents of each query, by BM25 scores in whole numbers.

The documents are searched in blocks. A block has, for each term of the queries, a posting list in the
order of the documents, with the score the term adds to each, and over each list a sparse table that
tells the list's largest impact between any two documents (a range maximum query, two look-ups). For a
query, open intervals of documents wait with the sum of their lists' maxima, which no document in the
interval exceeds. The intervals with the largest sums are split first, each at the document that has its
largest single impact: that document is scored, and the two intervals beside it wait in turn. An
interval whose sum cannot reach the k-th best score found is closed, and the search ends when none is
open. Nothing that belongs in the result is skipped.

Documents are read twice. The first pass counts each document's terms and those of the queries in it;
these counts are staged, and the statistics are sums of them. The second builds the blocks, a task one
after the other, of at most ``block_postings`` postings (a larger document is a block of its own), and
keeps the k best of each query. It starts from the k-th best score within one document in 64, a bound
that any part of the documents gives: so few rows leave a task, however many tasks there are.

Queries are sent to the tasks in parts of at most ``max_query_chars`` characters (a longer one alone),
each part searched and let go before the next is read; results do not depend on the parts.

Null and empty texts have no terms and are in no result; a query without terms has no rows. Texts are
whole, of any length. Each row of a table counts as one document or query: repeated rows rank one after
the other. Equal scores rank by ascending id, a null id last. Other columns are not read."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesflow.llm.shipping import shipped
from salesflow.staging import stage, staging

# Fixed values of the score.
_WEIGHT, _SCALE, _TF, _LENGTH = 1000, 1_000_000_000, 1000, 20
_FLAT, _PROPORTIONAL = 50, 50

_LAST_ID = np.iinfo(np.int64).max  # a null id among equal scores
_SAMPLE = 64
_WIDTH = 64  # intervals that are split at once
# ASCII letters and digits, lower-cased, and all bytes of other characters are parts of terms
_TERM_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


@dataclass(frozen=True)
class SearchOptions:
    k: int = 50
    block_postings: int = 400_000
    max_query_chars: int = 2_000_000


def terms_of(text: str | None) -> list[bytes]:
    """Runs of letters, digits and all characters beyond ASCII, A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TERM_BYTES).split()


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(_WEIGHT * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Block:
    """Posting lists of some documents with their sparse tables.

    ``ids``: ascending; ``doc``, ``term``, ``impact``: postings, the documents in the order of the ids."""

    def __init__(self, ids: np.ndarray, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, n_terms: int) -> None:
        order = np.argsort(term, kind="stable")
        self.ids, self.n_docs = ids, len(ids)
        self.doc, self.impact = doc[order], impact[order]
        self.key = term[order].astype(np.int64) * self.n_docs + self.doc
        self.starts = np.searchsorted(self.key, np.arange(n_terms + 1, dtype=np.int64) * self.n_docs)
        longest = int(np.diff(self.starts).max(initial=1))
        # level j: where the largest impact among 2**j postings from here on is, the first of equals
        tops = [np.arange(len(order), dtype=np.int32)]
        for level in range(1, longest.bit_length()):
            half, below = 1 << (level - 1), tops[-1]
            left, right = below[:-half], below[half:]
            top = below.copy()
            top[:-half] = np.where(self.impact[right] > self.impact[left], right, left)
            tops.append(top)
        self.tops = np.stack(tops)

    def maxima(self, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Largest impact of each range of postings, 0 if it is empty, and where it is."""
        size = end - begin
        some = size > 0
        level = np.frexp(np.maximum(size, 1).astype(np.float64))[1] - 1
        last = len(self.impact) - 1
        left = self.tops[level, np.minimum(begin, last)]
        right = self.tops[level, np.clip(end - (1 << level), 0, last)]
        at = np.where(self.impact[right] > self.impact[left], right, left)
        return np.where(some, self.impact[at], 0), at


@dataclass
class Found:
    """The k best of one query so far, and what a further document has to reach: a score, and for that
    score an id that is no larger."""

    k: int
    score: int = 1
    last_id: int = _LAST_ID

    def __post_init__(self) -> None:
        self.scores = self.ids = np.zeros(0, dtype=np.int64)

    def reaches(self, scores: np.ndarray, ids: np.ndarray) -> np.ndarray:
        return (scores > self.score) | ((scores == self.score) & (ids <= self.last_id))

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        good = self.reaches(scores, ids)
        if not good.any():
            return
        scores, ids = np.append(self.scores, scores[good]), np.append(self.ids, ids[good])
        best = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[best], ids[best]
        if len(best) == self.k:
            self.score, self.last_id = int(self.scores[-1]), int(self.ids[-1])


def search_block(block: Block, terms: np.ndarray, found: Found) -> None:
    """Add a block's best documents for one query, given by its distinct terms."""
    first = block.starts[terms]
    terms, first, last = (x[block.starts[terms + 1] > first] for x in (terms, first, block.starts[terms + 1]))
    if not len(terms):
        return
    base = terms.astype(np.int64) * block.n_docs

    def opened(low, high, begin, end):
        """Intervals of documents with their ranges of postings, bounds and split documents."""
        value, at = block.maxima(begin, end)
        bound = value.sum(axis=1)
        largest = value.argmax(axis=1)
        split = block.doc[np.take_along_axis(at, largest[:, None], axis=1)[:, 0]]
        keep = (bound > 0) & found.reaches(bound, block.ids[np.minimum(low, block.n_docs - 1)])
        return tuple(x[keep] for x in (bound, low, high, begin, end, split))

    waiting = opened(np.array([0]), np.array([block.n_docs]), first[None, :], last[None, :])
    while len(waiting[0]):
        best = np.argsort(-waiting[0], kind="stable")
        taken, rest = best[:_WIDTH], best[_WIDTH:]
        _, low, high, begin, end, split = (x[taken] for x in waiting)
        wanted = base + split[:, None]
        place = np.searchsorted(block.key, wanted)
        holds = (place < end) & (block.key[np.minimum(place, len(block.key) - 1)] == wanted)
        scores = np.where(holds, block.impact[np.minimum(place, len(block.key) - 1)], 0).sum(axis=1)
        found.add(scores, block.ids[split])
        halves = opened(
            np.append(low, split + 1),
            np.append(split, high),
            np.concatenate([begin, place + holds]),
            np.concatenate([place, end]),
        )
        bound, low = waiting[0][rest], waiting[1][rest]
        still = rest[found.reaches(bound, block.ids[low])]
        waiting = tuple(np.concatenate([x[still], y]) for x, y in zip(waiting, halves, strict=True))


@dataclass(frozen=True)
class Queries:
    """``terms``: per query the numbers of its distinct terms; ``weights``: by number; ``starts``: per
    query the score and id that the search starts from."""

    terms: list[np.ndarray]
    weights: np.ndarray
    n_docs: int
    n_words: int
    starts: list[tuple[int, int]]
    options: SearchOptions

    def block(self, counts: pa.Table) -> Block:
        counts = counts.combine_chunks()
        ids = counts["doc_id"].fill_null(int(_LAST_ID)).to_numpy()
        order = np.argsort(ids, kind="stable")
        counts = counts.take(pa.array(order)).combine_chunks()
        words = counts["n"].to_numpy()
        terms, tfs = (counts[c].combine_chunks() for c in ("terms", "tfs"))
        sizes = np.diff(terms.offsets.to_numpy())
        term, tf = terms.flatten().to_numpy(), tfs.flatten().to_numpy().astype(np.int64)
        doc = np.repeat(np.arange(len(words)), sizes)
        length = 100 - _FLAT + (_PROPORTIONAL * words * self.n_docs) // max(self.n_words, 1)
        impact = self.weights[term] * ((_SCALE * tf) // (_TF * tf + _LENGTH * length[doc]))
        return Block(ids[order], doc, term, impact, len(self.weights))

    def best(self, tables: Iterable[pa.Table]) -> pa.RecordBatch:
        found = [Found(self.options.k, *start) for start in self.starts]
        for table in tables:
            block = self.block(table)
            for terms, of_query in zip(self.terms, found, strict=True):
                search_block(block, terms, of_query)
        ids = np.concatenate([f.ids for f in found])
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(np.arange(len(found), dtype=np.int32), [len(f.ids) for f in found])),
                pa.array(ids, mask=ids == _LAST_ID),
                pa.array(np.concatenate([f.scores for f in found])),
            ],
            ["query", "doc_id", "score"],
        )


def _blocks(batches: Iterable[pa.RecordBatch], postings: int) -> Iterator[pa.Table]:
    """Rows in their order, as tables of at most so many postings, or of one row."""
    held: list[pa.RecordBatch] = []
    room = postings
    for batch in batches:
        ends = np.cumsum(batch["terms"].value_lengths().to_numpy())
        start = done = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(ends, done + room, side="right"))
            if stop == start and not held:
                stop += 1
            if stop > start:
                held.append(batch.slice(start, stop - start))
                room -= int(ends[stop - 1]) - done
                start, done = stop, int(ends[stop - 1])
            if start < batch.num_rows:
                yield pa.Table.from_batches(held)
                held, room = [], postings
    if held:
        yield pa.Table.from_batches(held)


def count_terms(docs: DataFrame, numbers) -> DataFrame:
    """Per document its number of terms ``n``, repeats included, and of the numbered ones (``numbers()``
    gives {term: number}) which it holds, ``terms``, and how often, ``tfs``."""

    @F.arrow_udf("n long, terms array<int>, tfs array<int>")
    def counted(texts: pa.Array) -> pa.Array:
        number = numbers().get
        n, terms, tfs, ends = [], [], [], [0]
        for text in texts:
            words = terms_of(text.as_py())
            held = Counter(map(number, words))
            held.pop(None, None)
            n.append(len(words))
            terms += held.keys()
            tfs += held.values()
            ends.append(len(terms))
        lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, pa.int32())) for x in (terms, tfs)]
        return pa.StructArray.from_arrays([pa.array(n, pa.int64()), *lists], ["n", "terms", "tfs"])

    return docs.select("doc_id", counted("text").alias("_counts")).select("doc_id", "_counts.*")


def _parts(queries: DataFrame, max_chars: int) -> Iterator[list[tuple]]:
    """(id, text) of the queries, in parts of so many characters; one part is held at a time."""
    part, size = [], 0
    for row in queries.toLocalIterator():
        chars = len(row["text"] or "")
        if part and size + chars > max_chars:
            yield part
            part, size = [], 0
        part.append((row["item_id"], row["text"]))
        size += chars
    if part:
        yield part


def _schema(**types: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in types.items()])


def search(
    docs: DataFrame,
    queries: DataFrame,
    options: SearchOptions = SearchOptions(),
    *,
    doc_id_col: str = "doc_id",
    query_id_col: str = "item_id",
    text_col: str = "text",
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``options.k`` best documents with a score above 0 of each
    query, from rank 1. Ids of documents are integers."""
    docs = docs.select(F.col(doc_id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    queries = queries.select(F.col(query_id_col).alias("item_id"), F.col(text_col).cast("string").alias("text"))
    id_type = queries.schema["item_id"].dataType
    found = [_search_part(docs, part, id_type, options) for part in _parts(queries, options.max_query_chars)]
    if not found:
        schema = _schema(item_id=id_type, rank=T.IntegerType(), doc_id=T.LongType(), score=T.LongType())
        return docs.sparkSession.createDataFrame([], schema)
    return reduce(DataFrame.unionAll, found)


def _search_part(docs: DataFrame, part: list[tuple], id_type: T.DataType, options: SearchOptions) -> DataFrame:
    spark = docs.sparkSession
    words = [sorted(set(terms_of(text))) for _, text in part]
    numbers = {term: i for i, term in enumerate(sorted({w for of_query in words for w in of_query}))}
    with staging(spark, "search") as keep:
        counts = keep(count_terms(docs, shipped(spark, numbers)), "counts")
        n_docs, n_words = counts.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        weights = np.zeros(len(numbers), dtype=np.int64)  # of terms in no document: never used
        # at most one row per term of the queries
        held = counts.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
        for term, df in held:
            weights[term] = term_weight(n_docs, df)
        terms = [np.array([n for w in of_query if weights[n := numbers[w]] > 0], dtype=np.int64) for of_query in words]

        def best(rows: DataFrame, starts: list[tuple[int, int]]) -> DataFrame:
            """The k best of each query among some of the documents, in no order."""
            wanted = shipped(spark, Queries(terms, weights, n_docs, n_words, starts, options))

            def of_task(batches):
                mine = wanted()
                yield mine.best(_blocks(batches, mine.options.block_postings))

            ranked = rows.mapInArrow(of_task, "query int, doc_id long, score long")
            order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
            return ranked.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= options.k)

        every = [(1, int(_LAST_ID))] * len(part)
        some = best(counts.filter(F.pmod(F.xxhash64("doc_id"), F.lit(_SAMPLE)) == 0), every)
        starts = every.copy()
        for row in some.filter(F.col("rank") == options.k).collect():  # one row per query
            starts[row["query"]] = (row["score"], int(_LAST_ID) if row["doc_id"] is None else row["doc_id"])
        schema = _schema(query=T.IntegerType(), item_id=id_type)
        ids = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(part)], schema)
        ranked = best(counts, starts).join(F.broadcast(ids), "query")  # bounded by max_query_chars
        return stage(ranked.select("item_id", "rank", "doc_id", "score"), "ranked", compact=True)
