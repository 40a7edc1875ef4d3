"""Toxicity scores: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Words count as they are and by their stems (leading characters), which gathers inflected forms.

Each coordinate has its own learning rate, and the L1 term keeps all weights at zero that the
labels do not pay for, so the fitted model is a short list of (feature, weight) which is small
enough to broadcast; its length is checked. Fitting reads a bounded sample of the labelled rows
(``max_per_class`` documents of either class, those with the smallest hashes of their ids), whole
texts, in one task, as the method is sequential; if that task's executor is lost, the same rows in
the same order give the same model. Class shares are counted over all labels, and the sample's
are corrected for in the intercept. Scoring is a map over all documents."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesflow.llm.shipping import shipped

_WORD = re.compile(r"[^\W_]+")
_STEMS = (4, 5)  # leading characters: inflected forms of a word share them


class _Hashes:
    """64-bit hashes of a word and its stems, kept for words seen before."""

    limit = 1 << 18

    def __init__(self) -> None:
        self.row: dict[str, int] = {}
        self.table = np.zeros((1 << 10, 1 + len(_STEMS)), dtype=np.uint64)

    def of(self, words: list[str]) -> np.ndarray:
        if len(self.row) > self.limit:
            self.row.clear()
        rows = [self.row.get(w, -1) for w in words]
        for i, row in enumerate(rows):
            if row < 0:
                rows[i] = self._add(words[i])
        return self.table[rows]

    def _add(self, word: str) -> int:
        row = self.row.setdefault(word, len(self.row))
        if row == len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        whole = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        stems = [xxhash.xxh64_intdigest(word[:k].encode("utf-8", "surrogatepass"), k) for k in _STEMS]
        self.table[row] = [whole, *stems]
        return row


_hashes = _Hashes()


@dataclass(frozen=True)
class FtrlOptions:
    """``bits``: log2 of the number of hashed features. ``alpha, beta, l1, l2``: FTRL-proximal."""

    bits: int = 22
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 10.0
    l2: float = 0.0
    epochs: int = 5
    max_per_class: int = 8192
    max_weights: int = 1 << 20


@dataclass(frozen=True)
class ToxicityModel:
    """Non-zero weights by feature, sorted, and the intercept."""

    bits: int
    features: np.ndarray
    weights: np.ndarray
    intercept: float


def features(text: str | None, bits: int) -> np.ndarray:
    """Feature numbers, with repeats, of all lower-cased words, their stems, word pairs, and pairs
    with one word between."""
    words = _WORD.findall((text or "").lower())
    if not words:
        return np.zeros(0, dtype=np.int64)
    hashes = _hashes.of(words)
    one = hashes[:, 0]
    pair = one[:-1] * np.uint64(3) + one[1:]
    skip = one[:-2] * np.uint64(5) + one[2:]
    mixed = np.concatenate([hashes.ravel(), pair, skip]) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(64 - bits)).astype(np.int64)


def ftrl(texts: list[str | None], labels: list[int], options: FtrlOptions) -> tuple[np.ndarray, np.ndarray, float]:
    """``(features, weights, intercept)`` after the epochs over the rows in their order. A feature
    counts once per text. The intercept is an unregularised feature of every text."""
    size = 1 << options.bits
    z, n = np.zeros(size + 1, dtype=np.float32), np.zeros(size + 1, dtype=np.float32)
    l1 = np.float32(options.l1)

    def weight(at: np.ndarray) -> np.ndarray:
        strength = np.where(at == size, 0, l1)
        shrunk = np.sign(z[at]) * np.maximum(np.abs(z[at]) - strength, 0)
        return -shrunk / ((options.beta + np.sqrt(n[at])) / options.alpha + options.l2)

    rows = [np.append(np.unique(features(t, options.bits)), size).astype(np.int32) for t in texts]
    for _ in range(options.epochs):
        for at, label in zip(rows, labels, strict=True):
            w = weight(at)
            gradient = np.float32(1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label)
            root = np.sqrt(n[at])
            n[at] += gradient * gradient
            z[at] += gradient - (np.sqrt(n[at]) - root) / options.alpha * w
    kept = np.flatnonzero(np.abs(z[:size]) > l1)
    return kept, weight(kept).astype(np.float64), float(weight(np.array([size]))[0])


def fit(
    labels: DataFrame,
    docs: DataFrame,
    options: FtrlOptions = FtrlOptions(),
    *,
    label_col: str = "toxic",
    id_col: str = "doc_id",
    text_col: str = "text",
) -> ToxicityModel:
    """Fit on the documents that ``labels`` marks 0 or 1. Null labels, null ids and ids without a
    document are not used; of an id marked twice the higher label counts, of an id with several
    texts the smallest text. Without rows of both classes the score is the share of label 1
    (0.5 without any label) for every text."""
    spark = docs.sparkSession
    marked = (
        labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("id"))
        .agg(F.max(label_col).cast("int").alias("label"))
    )
    order = [F.xxhash64("id"), F.col("id")]
    chosen = [marked.filter(F.col("label") == k).orderBy(*order).limit(options.max_per_class) for k in (0, 1)]
    # at most 2 * max_per_class rows of an id and a label
    sample = F.broadcast(chosen[0].union(chosen[1]))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = (
        texts.join(sample, "id")
        .groupBy("id", "label")
        .agg(F.min("text").alias("text"))
        .repartition(1)
        .sortWithinPartitions(F.xxhash64("id", F.lit(1)), "id")
    )

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, marks = [], []
        for batch in batches:
            texts += batch.column("text").to_pylist()
            marks += batch.column("label").to_pylist()
        if len(set(marks)) == 2:
            at, weights, intercept = ftrl(texts, marks, options)
            ones = sum(marks)
            at, weights = np.append(at, [-1, -2]), np.append(weights, [intercept, np.log(ones / (len(marks) - ones))])
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(weights)], ["feature", "weight"])

    model = rows.mapInArrow(train, "feature bigint, weight double").limit(options.max_weights + 3).toPandas()
    if len(model) > options.max_weights + 2:
        raise ValueError("more weights than max_weights: raise l1")
    shares = {r["label"]: r["count"] for r in marked.groupBy("label").count().collect()}
    if model.empty:
        share = (shares.get(1, 0) + 0.5) / (sum(shares.values()) + 1)
        share = share if len(shares) != 1 else float(1 in shares)
        logit = float(np.clip(np.log(max(share, 1e-9) / max(1 - share, 1e-9)), -20, 20))
        return ToxicityModel(options.bits, np.zeros(0, dtype=np.int64), np.zeros(0), logit)
    special = dict(zip(model.feature[model.feature < 0], model.weight[model.feature < 0], strict=True))
    model = model[model.feature >= 0].sort_values("feature")
    intercept = special[-1] - special[-2] + np.log(shares[1] / shares[0])
    return ToxicityModel(options.bits, model.feature.to_numpy(), model.weight.to_numpy(), float(intercept))


def logit(text: str | None, dense: np.ndarray, bits: int, intercept: float) -> float:
    at = features(text, bits)
    at = np.unique(at[dense[at] != 0])
    return intercept + float(dense[at].sum(dtype=np.float64))


def score(model: ToxicityModel, spark: SparkSession, text: Column) -> Column:
    """Probability of label 1 as a column; null and empty texts have that of the intercept."""
    held = shipped(spark, model)
    dense: list[np.ndarray] = []

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        fitted = held()
        if not dense:
            dense.append(np.zeros(1 << fitted.bits, dtype=np.float32))
            dense[0][fitted.features] = fitted.weights
        logits = np.array([logit(t, dense[0], fitted.bits, fitted.intercept) for t in texts], dtype=np.float64)
        return pd.Series(1 / (1 + np.exp(-np.clip(logits, -35, 35))))

    return scored(text.cast("string"))


def score_documents(
    docs: DataFrame, model: ToxicityModel, *, threshold: float = 0.7, text_col: str = "text"
) -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` (1 if score >= threshold, else 0). Every row is
    scored on its whole text, by the text alone; columns of these names are replaced."""
    scored = docs.withColumn("score", score(model, docs.sparkSession, F.col(text_col)))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def drop_toxic(
    docs: DataFrame, model: ToxicityModel, *, threshold: float = 0.7, text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, all columns as they are."""
    return docs.filter(score(model, docs.sparkSession, F.col(text_col)) < threshold)
