"""Document quality by co-training two views.

One classifier sees what a text says: naive Bayes over hashed tokens (words in their case, runs of
marks, immediate repetitions). The other sees only the metadata and layout of a document (language,
source, declared length, lines, shares of capitals, marks and distinct words): a logistic
regression. Each round, both views score all unlabelled documents, and either labels those it is sure
of for the other to learn from. The pseudo-labels of a class weigh ``trust`` times as much as its true
labels, however many there are, so the classes keep their shares. After each round both are calibrated
on labelled documents that neither was fitted on; of each view the round with the least log loss there
is kept, of equal ones the last, and teaches the other view in the next round. A logistic regression over
the two calibrated log odds combines them.

Fitting reads a bounded sample of labelled documents, whole texts: ``max_labelled``, those with the
smallest hashes of their ids; their features lie on the driver. The unlabelled side has no bound: all
documents outside that sample take part, their own labels unseen. Their features are written once, scored
in maps and summed up by Spark; the driver gets only sums of a fixed size: token counts per class for
naive Bayes, gradient and second derivatives for each Newton step of the logistic regression. Scoring
is a map over all documents."""

from __future__ import annotations

import pickle
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesflow.llm.shipping import shipped
from salesflow.staging import staging

_TOKEN = re.compile(r"\w+|[^\w\s]+")
_REPEAT = "\x01repeat"
_EQUAL_LOSS = 1e-4  # losses so close tell no difference; the later round has learned from more documents


@dataclass(frozen=True)
class CoTraining:
    """``confident``: least probability of a pseudo-label; ``trust``: weight of all pseudo-labels of a
    class against its true ones; ``groups``: hashed values of a metadata column."""

    bits: int = 18
    rounds: int = 4
    confident: float = 0.97
    trust: float = 10.0
    max_labelled: int = 8192
    groups: int = 16
    ridge: float = 1.0
    smoothing: float = 1.0


class _Tokens(dict):
    """Tokens seen before and their numbers, which count up; for each number the token's hash and length,
    and whether it is a word, and in capitals."""

    limit = 1 << 18

    def __init__(self) -> None:
        super().__init__()
        self.hashes, self.lengths = np.zeros(1024, np.uint64), np.zeros(1024, np.int64)
        self.words, self.capitals = np.zeros(1024, bool), np.zeros(1024, bool)
        self.new: list[str] = []

    def __missing__(self, token: str) -> int:
        at = self[token] = len(self)
        self.new.append(token)
        return at

    def of(self, tokens: list[str]) -> np.ndarray:
        """The tokens' numbers, which hold until the next call."""
        if len(self) > self.limit:
            self.clear()
        ids = np.fromiter(map(self.__getitem__, tokens), np.int64, len(tokens))
        if self.new:
            self._describe(len(self) - len(self.new))
            self.new = []
        return ids

    def _describe(self, start: int) -> None:
        new, end = self.new, len(self)
        if end > len(self.hashes):
            for name in ("hashes", "lengths", "words", "capitals"):
                held = getattr(self, name)
                setattr(self, name, np.concatenate([held, np.zeros(2 * end - len(held), held.dtype)]))
        digest = xxhash.xxh64_intdigest
        self.hashes[start:end] = np.array([digest(t.encode("utf-8", "surrogatepass")) for t in new], np.uint64)
        self.lengths[start:end] = [len(t) for t in new]
        self.words[start:end] = [t[0].isalnum() for t in new]
        self.capitals[start:end] = [t.isupper() for t in new]


_tokens = _Tokens()


def content(tokens: list[str], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct feature numbers of a text and 1 + log of how often each occurs."""
    return _content(_tokens.of(tokens), bits)


def _content(ids: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    numbers = (_tokens.hashes[ids] >> np.uint64(64 - bits)).astype(np.int64)
    repeats = np.count_nonzero(ids[1:] == ids[:-1])
    repeat = xxhash.xxh64_intdigest(_REPEAT) >> (64 - bits)
    at, n = np.unique(np.concatenate([numbers, np.full(repeats, repeat, np.int64)]), return_counts=True)
    return at, 1 + np.log(n)


def layout(text: str, tokens: list[str], lang: str | None, source: str | None, n_chars: float | None, groups: int):
    """Numbers about a document's form and metadata, without its words."""
    return _layout(text, _tokens.of(tokens), lang, source, n_chars, groups)


def _layout(text: str, ids: np.ndarray, lang: str | None, source: str | None, n_chars: float | None, groups: int):
    words = ids[_tokens.words[ids]]
    n = max(len(words), 1)
    in_words = int(_tokens.lengths[words].sum())
    letters = max(in_words, 1)
    marks = int(_tokens.lengths[ids].sum()) - in_words
    lines = text.count("\n") + 1
    numbers = [
        np.log1p(len(text)),
        np.log1p(lines),
        np.log1p(len(text) / lines),
        min(letters / n, 40.0),
        np.log1p(100 * marks / letters),
        np.log1p(100 * np.count_nonzero(_tokens.capitals[words]) / n),
        len(np.unique(words)) / n,
        np.log1p(100 * np.count_nonzero(words[1:] == words[:-1]) / n),
        float(n_chars is not None and abs(n_chars - len(text)) > 0.01 * len(text) + 1),
    ]
    kinds = np.zeros(2 * groups)
    for i, value in enumerate((lang, source)):
        digest = xxhash.xxh64_intdigest(("" if value is None else str(value)).encode("utf-8", "surrogatepass"), i)
        kinds[i * groups + digest % groups] = 1
    return np.concatenate([numbers, kinds])


def logistic(x: np.ndarray, y: np.ndarray, ridge: float, steps: int = 30) -> np.ndarray:
    """Weights of a ridge logistic regression, the intercept (not shrunk) last; Newton's method."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    shrink = np.full(len(w), ridge)
    shrink[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + shrink * w
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(shrink), gradient)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return w


def newton_sums(x: np.ndarray, y: np.ndarray, w: np.ndarray, weight: np.ndarray | float = 1.0) -> np.ndarray:
    """Gradient and, below it, second derivatives of the logistic loss; the intercept is last."""
    x = np.column_stack([x, np.ones(len(x))])
    p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
    curve = weight * (p * (1 - p) + 1e-9)
    return np.vstack([x.T @ (weight * (p - y)), (x * curve[:, None]).T @ x])


def log_loss(p: np.ndarray, y: np.ndarray) -> float:
    p = np.clip(p, 1e-12, 1 - 1e-12)
    return float(-np.mean(np.where(y > 0, np.log(p), np.log(1 - p)))) if len(y) else 0.0


def probability(odds: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def add_counts(counts: np.ndarray, rows: list, y: np.ndarray) -> None:
    for (at, weight), label in zip(rows, y, strict=True):
        counts[int(label)][at] += weight


class ContentView:
    """Naive Bayes log odds over token features, of the counts of either class."""

    def __init__(self, counts: np.ndarray, options: CoTraining) -> None:
        counts = counts + options.smoothing
        logs = np.log(counts / counts.sum(axis=1, keepdims=True))
        self.weights = (logs[1] - logs[0]).astype(np.float32)

    def odds(self, rows: list) -> np.ndarray:
        # per feature, as naive Bayes is too sure of long texts
        return np.array([float(self.weights[at] @ w) / max(w.sum(), 1.0) for at, w in rows])


class LayoutView:
    """Logistic regression on standardised layouts; ``sums`` are the ``newton_sums`` of its rows."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray) -> None:
        self.mean, self.scale, self.weights = mean, scale, weights

    @classmethod
    def fitted(cls, start: LayoutView, sums: Callable, ridge: float, steps: int = 30) -> LayoutView:
        """The minimum, which is the same from any start."""
        view, mean, scale = start, start.mean, start.scale
        shrink = np.full(len(mean) + 1, ridge)
        shrink[-1] = 1e-6
        for _ in range(steps):
            found = sums(view)
            step = np.linalg.solve(found[1:] + np.diag(shrink), found[0] + shrink * view.weights)
            view = cls(mean, scale, view.weights - step)
            if np.abs(step).max() < 1e-4:
                break
        return view

    def standard(self, rows: list) -> np.ndarray:
        return (np.array(rows, dtype=np.float64).reshape(-1, len(self.mean)) - self.mean) / self.scale

    def sums(self, rows: list, y: np.ndarray, class_weights: np.ndarray = np.ones(2)) -> np.ndarray:
        return newton_sums(self.standard(rows), y, self.weights, class_weights[y.astype(np.int64)])

    def odds(self, rows: list) -> np.ndarray:
        return self.standard(rows) @ self.weights[:-1] + self.weights[-1]


def pseudo_labels(view: ContentView | LayoutView, line: np.ndarray, rows: list, confident: float) -> np.ndarray:
    """1 or 0 where the calibrated view is sure, -1 elsewhere."""
    if not len(rows):
        return np.zeros(0, dtype=np.int64)
    p = probability(line[0] * view.odds(rows) + line[1])
    return np.where(p >= confident, 1, np.where(1 - p >= confident, 0, -1))


class LocalPool:
    """Unlabelled rows in memory."""

    def __init__(self, rows: tuple[list, list], options: CoTraining) -> None:
        self.rows, self.options = rows, options

    def moments(self) -> np.ndarray:
        """Rows: how many, sums and sums of squares of the layouts."""
        return moments(self.rows[1])

    def token_counts(self, view: LayoutView, line: np.ndarray) -> np.ndarray:
        """Token counts of either class as the layout view labels the rows."""
        counts = np.zeros((2, 1 << self.options.bits))
        y = pseudo_labels(view, line, self.rows[1], self.options.confident)
        add_counts(counts, [self.rows[0][i] for i in np.flatnonzero(y >= 0)], y[y >= 0])
        return counts

    def layout_sums(self, view: ContentView, line: np.ndarray, given: np.ndarray) -> Callable[[LayoutView], np.ndarray]:
        """``newton_sums`` of the rows that the content view labels, at a layout view's weights; the
        rows of a class weigh as much as ``given`` says."""
        y = pseudo_labels(view, line, self.rows[0], self.options.confident)
        rows = [self.rows[1][i] for i in np.flatnonzero(y >= 0)]
        y = y[y >= 0]
        weights = class_weights(given, np.bincount(y, minlength=2))
        return lambda at: at.sums(rows, y, weights)


def class_weights(given: np.ndarray, found: np.ndarray) -> np.ndarray:
    """What a unit of either class counts, so that those found weigh as much as given; no more than 1."""
    return np.minimum(given / np.maximum(found, 1e-9), 1.0)


def moments(rows: list) -> np.ndarray:
    x = np.array(rows, dtype=np.float64)
    return np.vstack([np.full(x.shape[1], float(len(x))), x.sum(axis=0), (x * x).sum(axis=0)]) if len(x) else np.zeros((3, 1))


def packed(values: np.ndarray, kind: str) -> bytes:
    """Four-byte numbers, first bytes first, which compresses well."""
    return np.ascontiguousarray(values, dtype=kind).view(np.uint8).reshape(-1, 4).T.tobytes()


def unpacked(data: bytes, kind: str) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, dtype=np.uint8).reshape(4, -1).T).view(kind).ravel()


def unpacked_tokens(batch: pd.DataFrame) -> list:
    return [
        (unpacked(at, "<u4"), unpacked(weight, "<f4").astype(np.float64))
        for at, weight in zip(batch["at"], batch["weight"], strict=True)
    ]


def unpacked_layouts(batch: pd.DataFrame) -> np.ndarray | list:
    """A row for each layout; all are of one length."""
    if not len(batch):
        return []
    data = np.frombuffer(b"".join(batch["layout"]), dtype=np.uint8).reshape(len(batch), 4, -1)
    return np.ascontiguousarray(data.transpose(0, 2, 1)).view("<f4")[:, :, 0]


class SparkPool:
    """All unlabelled rows, as the table of their features. Every method is a map in which tasks sum up
    their rows, and an aggregation of these sums; what reaches the driver does not grow."""

    def __init__(self, table: DataFrame, options: CoTraining, write: Callable[[DataFrame, str], DataFrame]) -> None:
        self.table, self.options, self.write, self.written = table, options, write, 0

    @staticmethod
    def _summed(table: DataFrame, sums_of: Callable[[pd.DataFrame], np.ndarray], shape: tuple[int, int]) -> np.ndarray:
        def summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = np.zeros(shape)
            for batch in batches:
                if len(batch):
                    total = total + sums_of(batch)
            cells = np.flatnonzero(total)
            yield pd.DataFrame({"cell": cells.astype(np.int32), "n": total.ravel()[cells]})

        # exact decimals, so that the sum does not depend on the tasks' order
        exact = F.sum(F.col("n").cast("decimal(28,9)")).cast("double")
        found = table.mapInPandas(summed, "cell int, n double").groupBy("cell").agg(exact.alias("n")).toArrow()
        out = np.zeros(shape[0] * shape[1])  # at most a row for each cell
        out[found["cell"].to_numpy()] = found["n"].to_numpy()
        return out.reshape(shape)

    def moments(self) -> np.ndarray:
        width = 9 + 2 * self.options.groups
        return self._summed(self.table.select("layout"), lambda batch: moments(unpacked_layouts(batch)), (3, width))

    def token_counts(self, view: LayoutView, line: np.ndarray) -> np.ndarray:
        held, options = shipped(self.table.sparkSession, (view, line)), self.options

        def counted(batch: pd.DataFrame) -> np.ndarray:
            counts = np.zeros((2, 1 << options.bits))
            y = pseudo_labels(*held(), unpacked_layouts(batch), options.confident)
            add_counts(counts, unpacked_tokens(batch[y >= 0]), y[y >= 0])
            return counts

        return self._summed(self.table, counted, (2, 1 << options.bits))

    def layout_sums(self, view: ContentView, line: np.ndarray, given: np.ndarray) -> Callable[[LayoutView], np.ndarray]:
        held, options = shipped(self.table.sparkSession, (view, line)), self.options

        def labelled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                y = pseudo_labels(*held(), unpacked_tokens(batch), options.confident)
                yield pd.DataFrame({"layout": batch["layout"][y >= 0], "y": y[y >= 0]})

        self.written += 1
        rows = self.write(self.table.mapInPandas(labelled, "layout binary, y int"), f"given-{self.written}")
        found = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
        weights = class_weights(given, np.array([found.get(0, 0), found.get(1, 0)]))

        def sums(at: LayoutView) -> np.ndarray:
            of = lambda batch: at.sums(unpacked_layouts(batch), batch["y"].to_numpy(), weights)
            return self._summed(rows, of, (len(at.weights) + 1, len(at.weights)))

        return sums


class QualityModel:
    """Two fitted views, their calibrations (slope, intercept) and the weights that combine them."""

    def __init__(self, views: list, calibration: list[np.ndarray], combine: np.ndarray, options: CoTraining) -> None:
        self.views, self.calibration, self.combine, self.options = views, calibration, combine, options

    def probabilities(self, rows: tuple[list, list]) -> np.ndarray:
        """Columns: content view, layout view, both."""
        odds = [c[0] * v.odds(r) + c[1] for v, c, r in zip(self.views, self.calibration, rows, strict=True)]
        both = np.column_stack(odds) @ self.combine[:-1] + self.combine[-1]
        return probability(np.column_stack([*odds, both]))


def features(rows: pd.DataFrame, options: CoTraining) -> tuple[list, list]:
    """Of rows ``text, lang, source, n_chars``: the two views' features."""
    first, second = [], []
    for text, lang, source, n_chars in zip(rows.text, rows.lang, rows.source, rows.n_chars, strict=True):
        text = text if isinstance(text, str) else ""
        ids = _tokens.of(_TOKEN.findall(text))
        first.append(_content(ids, options.bits))
        n_chars = None if n_chars is None or pd.isna(n_chars) else float(n_chars)
        lang, source = (v if isinstance(v, str) else None for v in (lang, source))
        second.append(_layout(text, ids, lang, source, n_chars, options.groups))
    return first, second


def co_train(rows: tuple[list, list], label: np.ndarray, options: CoTraining, pool=None) -> QualityModel:
    """``label``: 1, 0, or -1 for unlabelled rows, which are the pool unless one is given. Every fifth
    labelled row only calibrates."""
    known = np.flatnonzero(label >= 0)
    test = np.concatenate([known[label[known] == k][::5] for k in (0, 1)])
    base, free = np.setdiff1d(known, test), np.flatnonzero(label < 0)
    if pool is None:
        pool = LocalPool(tuple([mine[i] for i in free] for mine in rows), options)
    picked = lambda view, at: [rows[view][i] for i in at]
    y, truth = label[base].astype(np.float64), label[test].astype(np.float64)
    counts = np.zeros((2, 1 << options.bits))
    add_counts(counts, picked(0, base), y)
    n, total, squares = moments(picked(1, base)) + pool.moments()
    mean = total / n
    scale = np.sqrt(np.maximum(squares / n - mean**2, 0)) + 1e-6
    own = picked(1, base)

    def fitted(
        start: LayoutView, more_counts: np.ndarray | float, more_sums: Callable[[LayoutView], np.ndarray] | None
    ) -> list:
        content_view = ContentView(counts + more_counts, options)
        sums = lambda at: at.sums(own, y) + (more_sums(at) if more_sums else 0)
        views = [content_view, LayoutView.fitted(start, sums, options.ridge)]
        return [(m, logistic(m.odds(picked(v, test))[:, None], truth, 1e-3)) for v, m in enumerate(views)]

    def loss(v: int, view: ContentView | LayoutView, line: np.ndarray) -> float:
        return log_loss(probability(line[0] * view.odds(picked(v, test)) + line[1]), truth)

    given = options.trust * np.bincount(label[base], minlength=2)
    models = fitted(LayoutView(mean, scale, np.zeros(len(mean) + 1)), 0.0, None)
    best, least = list(models), [loss(v, *m) for v, m in enumerate(models)]
    more, asked = 0.0, None
    for _ in range(options.rounds):
        teachers = list(best)
        if teachers[1] is not asked:  # the same view labels the same rows again
            asked = teachers[1]
            more = pool.token_counts(*asked)
            more *= class_weights(options.trust * counts.sum(axis=1), more.sum(axis=1))[:, None]
        models = fitted(models[1][0], more, pool.layout_sums(*teachers[0], given))
        for v, m in enumerate(models):
            found = loss(v, *m)
            if found <= least[v] + _EQUAL_LOSS:
                best[v], least[v] = m, min(found, least[v])
        if best[0] is teachers[0] and best[1] is teachers[1]:
            break  # all further rounds would be like this one
    odds = np.column_stack([line[0] * m.odds(picked(v, test)) + line[1] for v, (m, line) in enumerate(best)])
    return QualityModel([m for m, _ in best], [line for _, line in best], logistic(odds, truth, 1e-2), options)


def fit(
    labels: DataFrame,
    docs: DataFrame,
    options: CoTraining = CoTraining(),
    *,
    label_col: str = "quality",
    id_col: str = "doc_id",
    features_col: str | None = None,
) -> bytes | float:
    """The fitted model, serialised. All documents with an id outside the labelled sample are the pool. Null labels, null ids and ids without a document are not used; of
    an id with several labels the highest counts, of one with several texts the one with the smallest
    features. With less than ten labels of either class there is no model but the share of label 1
    (0.5 without any). ``features_col``: where ``docs`` has what ``encode`` found, staged."""
    marked = (
        labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("id"))
        .agg(F.max(label_col).cast("int").alias("label"))
    )
    order = [F.xxhash64("id"), F.col("id")]
    with staging(docs.sparkSession, "co_training") as write:
        known = write(marked.orderBy(*order).limit(options.max_labelled), "known", compact=True)
        if features_col:
            read = docs.select(F.col(id_col).alias("id"), F.col(features_col).alias("f"))
        else:
            read = docs.select(F.col(id_col).alias("id"), *_inputs(docs))
            read = write(encode(read, options, features_col="f").select("id", "f"), "features")
        # at most max_labelled rows
        rows = read.join(F.broadcast(known), "id").groupBy("id", "label").agg(F.min("f").alias("f"))
        base = rows.orderBy(F.xxhash64("id", F.lit(1)), "id").select("label", "f.*").toArrow().to_pandas()
        marks = base["label"].to_numpy(np.int64)
        if min((marks == 0).sum(), (marks == 1).sum()) < 10:
            shares = {r["label"]: r["count"] for r in marked.groupBy("label").count().collect()}
            return shares.get(1, 0) / sum(shares.values()) if shares else 0.5
        others = read.filter("id is not null").join(F.broadcast(known.select("id")), "id", "left_anti")
        pool = SparkPool(others.select("f.*"), options, partial(write, compact=True))
        model = co_train((unpacked_tokens(base), unpacked_layouts(base)), marks, options, pool)
    return cloudpickle.dumps(model)


def encode(
    docs: DataFrame, options: CoTraining = CoTraining(), *, features_col: str = "features"
) -> DataFrame:
    """``docs`` with both views' features of each row, to be staged before use."""
    return docs.withColumn(features_col, _encoder(options)(*_inputs(docs)))


def _encoder(options: CoTraining) -> Callable[..., Column]:
    """A function of the columns that the views read: both views' features."""

    @F.pandas_udf("struct<at:binary,weight:binary,layout:binary>")
    def encoded(text: pd.Series, lang: pd.Series, source: pd.Series, n_chars: pd.Series) -> pd.DataFrame:
        rows = pd.DataFrame({"text": text, "lang": lang, "source": source, "n_chars": n_chars})
        out: dict[str, list] = {"at": [], "weight": [], "layout": []}
        for start in range(0, len(rows), 256):  # features of a few hundred texts at a time
            first, second = features(rows.iloc[start : start + 256], options)
            out["at"] += [packed(at, "<u4") for at, _ in first]
            out["weight"] += [packed(weight, "<f4") for _, weight in first]
            out["layout"] += [packed(x, "<f4") for x in second]
        return pd.DataFrame(out)

    return encoded


def _inputs(docs: DataFrame) -> list[Column]:
    """The columns that the views read; those a table lacks are null."""
    kinds = {"text": "string", "lang": "string", "source": "string", "n_chars": "double"}
    return [
        (F.col(c).try_cast(t) if c in docs.columns else F.lit(None).cast(t)).alias(c) for c, t in kinds.items()
    ]


def score_documents(
    docs: DataFrame, model: bytes | float, *, threshold: float = 0.5, features_col: str | None = None
) -> DataFrame:
    """``docs`` with ``p_content`` and ``p_layout``, the views' calibrated probabilities of quality
    1, ``score``, the combined one, and ``kept`` (score >= threshold). Null and empty texts, languages
    and sources are values like others. Every row is scored by itself on its whole text; columns
    named like a new one are replaced, all others kept. ``features_col``: as for ``fit``."""
    names = ("p_content", "p_layout", "score")
    if isinstance(model, float):
        return docs.withColumns({n: F.lit(model) for n in names} | {"kept": F.lit(model >= threshold)})
    held = shipped(docs.sparkSession, pickle.loads(model))

    @F.pandas_udf("struct<p_content:double,p_layout:double,score:double>")
    def scored(text: pd.Series, lang: pd.Series, source: pd.Series, n_chars: pd.Series) -> pd.DataFrame:
        fitted, out = held(), []
        rows = pd.DataFrame({"text": text, "lang": lang, "source": source, "n_chars": n_chars})
        for at in range(0, len(rows), 256):  # features of a few hundred texts at a time
            out.append(fitted.probabilities(features(rows.iloc[at : at + 256], fitted.options)))
        return pd.DataFrame(np.concatenate(out) if out else np.zeros((0, 3)), columns=list(names))

    @F.pandas_udf("struct<p_content:double,p_layout:double,score:double>")
    def scored_features(at: pd.Series, weight: pd.Series, layouts: pd.Series) -> pd.DataFrame:
        rows = pd.DataFrame({"at": at, "weight": weight, "layout": layouts})
        found = held().probabilities((unpacked_tokens(rows), unpacked_layouts(rows)))
        return pd.DataFrame(found, columns=list(names))

    found = "_quality"
    while found in docs.columns:
        found = f"_{found}"
    if features_col:
        out = docs.withColumn(found, scored_features(*[F.col(features_col)[c] for c in ("at", "weight", "layout")]))
    else:
        out = docs.withColumn(found, scored(*_inputs(docs)))
    out = out.withColumns({n: F.col(found)[n] for n in names})
    return out.withColumn("kept", F.col("score") >= threshold).drop(found)
