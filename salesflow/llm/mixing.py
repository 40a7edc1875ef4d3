"""Mixing documents to target token shares of domains they belong to in part.

A naive Bayes classifier over hashed words, fitted on a labelled table, gives every document a
posterior over domains (its soft membership). Each document then gets a rate, the expected number
of times it is used, so that the expected tokens of every domain, ``sum(rate * tokens *
posterior)``, come as near to the targets as nonnegative rates allow: least squares by accelerated
projected gradient.

The gradient of a document's rate depends on its posterior only, so documents with equal posteriors
have equal rates in every step. Documents whose posteriors agree to ``precision`` digits share a rate:
they are a cell, and the descent runs on the table of cells, which Spark aggregates once. A cell holds
its tokens and the exact sums of tokens times unrounded posterior, so the totals that the descent
brings to the targets are those of the unrounded posteriors. Each step is one aggregation of as many
sums as there are domains, and its residual is all that reaches the driver. No step reads the
documents again.

Words are hashed and counted by SQL functions; nothing runs Python on the executors. Fitting reads
at most ``max_labelled`` labelled documents (those with the smallest hashes of their ids), whole
texts; the fitted weights have a fixed size, buckets times domains."""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesflow.staging import stage

_SPLIT = r"[\s.,;:!?()|\"']+"


@dataclass(frozen=True)
class MixingOptions:
    """``evidence``: how many of a document's words count at most; a longer one's evidence is scaled
    down to that many, so that posteriors stay soft. ``precision``: digits to which posteriors agree
    that share a rate. ``tolerance``: distance from the targets, as a share of all tokens."""

    buckets: int = 4096
    max_labelled: int = 16_384
    smoothing: float = 0.5
    evidence: int = 64
    precision: int = 2
    max_steps: int = 400
    steps_at_once: int = 25
    patience: int = 40
    tolerance: float = 1e-5


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), _SPLIT), lambda w: w != "")


def bucket_of(word: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(buckets)).cast("int")


def _constant(numbers: list[float]) -> Column:
    """An array literal, folded from one string: thousands of literals would be slow to plan."""
    return F.from_json(F.lit(json.dumps(numbers)), "array<double>")


@dataclass(frozen=True)
class DomainModel:
    """``weights[k][bucket]``: log likelihood of a word in domain k less that in the last domain;
    ``priors[k]`` likewise. A domain without labelled rows is not in ``domains``."""

    domains: list[str]
    priors: list[float]
    weights: list[list[float]]
    options: MixingOptions

    def posterior(self, words: Column) -> Column:
        """Array of posteriors in the order of the domains. Without words: the priors."""
        n, options = F.size(words), self.options
        numbers = F.transform(words, lambda w: bucket_of(w, options.buckets))
        odds = []
        for prior, weights in zip(self.priors, self.weights, strict=True):
            table = _constant(weights)
            total = _sum_of(numbers, table)
            scale = F.least(F.lit(1.0), F.lit(float(options.evidence)) / F.greatest(n, F.lit(1)))
            odds.append(F.lit(prior) + total * scale)
        odds.append(F.lit(0.0))
        return _softmax(F.array(*odds))


def _sum_of(numbers: Column, table: Column) -> Column:
    return F.aggregate(numbers, F.lit(0.0), lambda acc, b: acc + F.get(table, b))


def _softmax(odds: Column) -> Column:
    powers = F.transform(F.array(odds), lambda o: F.transform(o, lambda x: F.exp(x - F.array_max(o))))[0]
    return F.transform(
        F.array(powers),
        lambda p: F.transform(p, lambda x: x / F.aggregate(p, F.lit(0.0), lambda a, b: a + b)),
    )[0]


def cell_of(posterior: Column, precision: int) -> Column:
    """Cell of a posterior: its digits up to ``precision``."""
    return F.transform(posterior, lambda x: F.round(x, precision))


def cells_of(docs: DataFrame, posterior: str, tokens: str, cell: str, domains: int) -> DataFrame:
    """One row per cell: ``cell``, ``tokens`` and ``posterior``, the mean of its documents' posteriors
    by token. Sums are decimal, so they do not depend on the order of the rows. A cell without tokens
    has itself as posterior; it weighs nothing."""
    sums = [F.sum((F.col(tokens) * F.col(posterior)[i]).cast("decimal(28,12)")).alias(f"m{i}") for i in range(domains)]
    grouped = docs.groupBy(F.col(cell).alias("cell")).agg(F.sum(tokens).alias("tokens"), *sums)
    mean = F.array(*[F.col(f"m{i}").cast("double") / F.col("tokens") for i in range(domains)])
    return grouped.select("cell", "tokens", F.when(F.col("tokens") > 0, mean).otherwise(F.col("cell")).alias("posterior"))


def fit_domains(
    labelled: DataFrame,
    docs: DataFrame,
    domain: Column,
    options: MixingOptions = MixingOptions(),
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DomainModel | None:
    """Fit on the documents of the labelled table; ``domain`` is an expression over that table. Rows
    with a null domain or id, and ids without a document, are not used; of an id with several
    domains or texts the smallest counts. Without usable rows there is no model."""
    chosen = (
        labelled.select(F.col(id_col).alias("id"), domain.cast("string").alias("domain"))
        .dropna()
        .groupBy("id")
        .agg(F.min("domain").alias("domain"))
    )
    sample = F.broadcast(chosen.orderBy(F.xxhash64("id"), "id").limit(options.max_labelled))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = texts.join(sample, "id").groupBy("id", "domain").agg(F.min("text").alias("text"))
    words = rows.select("id", "domain", F.explode_outer(words_of(F.col("text"))).alias("word"))
    counts = (
        words.groupBy("domain", bucket_of(F.col("word"), options.buckets).alias("bucket"))
        .agg(F.count("word").alias("n"))
        .collect()  # at most buckets x domains rows
    )
    shares = {r["domain"]: r["count"] for r in chosen.groupBy("domain").count().collect()}
    domains = sorted({r["domain"] for r in counts})
    if not domains:
        return None
    logs = {}
    for d in domains:
        n = [options.smoothing] * options.buckets
        for r in counts:
            if r["domain"] == d and r["n"]:
                n[r["bucket"]] += r["n"]
        total = sum(n)
        logs[d] = [math.log(x / total) for x in n]
    last = domains[-1]
    weights = [[round(a - b, 6) for a, b in zip(logs[d], logs[last], strict=True)] for d in domains[:-1]]
    priors = [math.log(shares[d] / shares[last]) for d in domains[:-1]]
    return DomainModel(domains, priors, weights, options)


def fit_rates(cells: DataFrame, targets: list[float], options: MixingOptions) -> tuple[DataFrame, list[float]]:
    """``cells(posterior, tokens, ...)`` with a column ``rate``, and the shares that the rates reach.

    Minimises half the squared distance between the expected shares, in units of all tokens, and
    the targets, over nonnegative rates, starting from using every document once. In the metric
    in which a cell weighs its share of the tokens, the gradient of a cell's rate is its posterior
    times the residual; the step is one over the largest eigenvalue of the domains' K x K matrix
    of second moments. The steps since the table was last written are applied to its rows anew
    in each aggregation, and written after every ``steps_at_once``."""
    k = len(targets)
    total = cells.agg(F.sum("tokens").alias("n")).first()["n"]
    if not total:
        return cells.withColumn("rate", F.lit(1.0)), [0.0] * k
    columns = cells.columns
    cells = cells.withColumn("weight", F.col("tokens") / F.lit(float(total)))
    p = [F.col("posterior")[i] for i in range(k)]
    moments = cells.agg(*[F.sum(F.col("weight") * p[i] * p[j]) for i in range(k) for j in range(k)]).first()
    # the largest absolute row sum bounds the largest eigenvalue
    step = 1 / max(sum(abs(moments[i * k + j]) for j in range(k)) for i in range(k))

    cells = cells.withColumns({"x": F.lit(1.0), "y": F.lit(1.0)})
    history: list[list[float]] = []  # since x and y: per step, step * residual of each domain, momentum

    def now(name: str) -> Column:
        if not history:
            return F.col(name)

        def advance(s: Column, h: Column) -> Column:
            products = F.zip_with(F.col("posterior"), F.slice(h, 1, k), lambda a, b: a * b)
            slope = F.aggregate(products, F.lit(0.0), lambda a, b: a + b)
            new = F.greatest(F.lit(0.0), s["y"] - slope)
            return F.struct(new.alias("x"), (new + h[k] * (new - s["x"])).alias("y"))

        folded = F.from_json(F.lit(json.dumps(history)), "array<array<double>>")
        return F.aggregate(folded, F.struct("x", "y"), advance)[name]

    def shares() -> tuple[list[float], list[float]]:
        found = cells.select("posterior", "weight", now("x").alias("x"), now("y").alias("y"))
        row = found.agg(*[F.sum(F.col("weight") * F.col(c) * d) for c in ("x", "y") for d in p]).first()
        return list(row[:k]), list(row[k:])

    momentum, best, best_at = 1.0, math.inf, 0
    for at in range(options.max_steps):
        reached, ahead = shares()
        error = math.dist(reached, targets)
        if error < 0.99 * best:
            best, best_at = error, at
        if error < options.tolerance or at - best_at > options.patience:
            break  # on target, or as near to targets out of reach as it gets
        grown = (1 + math.sqrt(1 + 4 * momentum * momentum)) / 2
        history.append([*(step * (a - b) for a, b in zip(ahead, targets, strict=True)), (momentum - 1) / grown])
        momentum = grown
        if len(history) == options.steps_at_once:
            cells = stage(cells.withColumns({"x": now("x"), "y": now("y")}), "rates", compact=True)
            history.clear()
    cells = stage(cells.withColumns({"x": now("x"), "y": now("y")}), "rates", compact=True)
    history.clear()
    return cells.select(*columns, F.col("x").alias("rate")), shares()[0]


def mix(
    docs: DataFrame,
    labelled: DataFrame,
    domain: Column,
    targets: dict[str, float],
    options: MixingOptions = MixingOptions(),
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``docs`` with ``n_tokens`` (words), one ``p_<domain>`` per target, ``rate``, and ``copies``,
    the rate as a whole number: its fraction is rounded up for that share of the documents, by a hash
    of their ids, so totals meet the targets and a repeated run gives the same.

    Targets are shares of all tokens and need not sum to one. A target without labelled rows has
    posterior 0 everywhere, domains without a target have none: their tokens are to come to nothing
    unless they share documents. Documents without words (null or empty text) have the priors as
    posterior and add no tokens. Without any usable label, rates are 1 and posteriors null. Repeated
    rows are mixed one by one; rows with a null id share their rounding. ``p_<domain>`` is not rounded. Columns named like a new
    one are replaced, all others kept."""
    model = fit_domains(labelled, docs, domain, options, id_col=id_col, text_col=text_col)
    names = [f"p_{d}" for d in targets]
    if model is None:
        out = docs.withColumn("n_tokens", F.size(words_of(F.col(text_col).cast("string"))))
        out = out.withColumns({n: F.lit(None).cast("double") for n in names})
        return out.withColumns({"rate": F.lit(1.0), "copies": F.lit(1).cast("long")})
    hidden = "_mixing"
    while any(c.startswith(hidden) for c in docs.columns):
        hidden = f"_{hidden}"
    words, cell = f"{hidden}_words", f"{hidden}_cell"
    read = docs.withColumn(words, words_of(F.col(text_col).cast("string")))
    read = read.withColumns({"n_tokens": F.size(words), hidden: model.posterior(F.col(words))}).drop(words)
    read = stage(read, "mixing").withColumn(cell, cell_of(F.col(hidden), options.precision))
    cells = stage(cells_of(read, hidden, "n_tokens", cell, len(model.domains)), "cells", compact=True)
    wanted = [targets.get(d, 0.0) for d in model.domains]
    rated, _ = fit_rates(cells, wanted, options)
    rated = stage(rated.select(F.col("cell").alias(f"{hidden}_of"), F.col("rate").alias(f"{hidden}_rate")), "rates", compact=True)
    out = read.join(rated, F.col(cell) == F.col(f"{hidden}_of"))
    place = {d: i for i, d in enumerate(model.domains)}
    known = lambda d: F.col(hidden)[place[d]] if d in place else F.lit(0.0)
    out = out.withColumns({f"p_{d}": known(d) for d in targets} | {"rate": F.col(f"{hidden}_rate")})
    chance = F.pmod(F.xxhash64(F.lit("mixing"), F.col(id_col)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    copies = F.floor("rate") + (chance < F.col("rate") - F.floor("rate")).cast("long")
    return out.withColumn("copies", copies).drop(hidden, cell, f"{hidden}_of", f"{hidden}_rate")
