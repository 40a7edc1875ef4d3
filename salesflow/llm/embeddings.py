"""Embedding near duplicates: randomised-rotation binary codes decide which pairs need an exact cosine.

Vectors are scaled to length one and rotated by a random orthogonal matrix. A vector's code is the
signs of its rotated coordinates, one bit each; stored with it is the correction factor, the inner
product of the vector with its code as a unit vector. For a query q, the inner product with the code,
divided by the factor, is an unbiased estimate of the cosine, over random rotations. It is computed
from bits: the query's coordinates are rounded to four bits, so four population counts per word of
the code give it, up to a rounding error that is known for each query.

Two bounds around the estimate decide. One always holds: what of the vector is not along its code is
orthogonal to it, so the cosine is at most ``factor * s + sqrt(1 - factor²) * sqrt(1 - s²)`` for a
query with inner product s with the code, and at least the same with a minus. The other is the
confidence bound of the random rotation, ``confidence`` standard errors wide, and tighter in many
dimensions. Pairs whose upper bound is below the threshold are no links, pairs whose lower bound is
above it are, and only the rest is recomputed in double precision.

Equal vectors of a label are one, with a count. The vectors of a label are dealt to tiles of a
bounded size, and every pair of tiles of one label is a task of its own, so a label with a third of
all rows is many tasks. Tasks return, per vector, the number of links and the smallest vector
reachable inside the pair of tiles; pairs of vectors are never rows. No link is missed; the price is
that the codes of a label are compared with each other, with bit operations, in blocks."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesflow.llm.components import connected_components
from salesflow.llm.simhash import smallest_linked
from salesflow.staging import stage

_WORD = 64
_QUERY_BITS = 4
_SAFE = 1e-9  # more than the rounding of sums of doubles
_SINGLE = 1e-5  # and of singles


@dataclass(frozen=True)
class CodeOptions:
    """``tile``: vectors per tile; ``rows``: queries compared at once; ``confidence``: standard errors."""

    threshold: float = 0.93
    confidence: float = 6.5
    tile: int = 2048
    rows: int = 256
    seed: int = 7


def rotation(dims: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix over the dimensions filled up to whole words of bits."""
    size = -(-dims // _WORD) * _WORD
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, size)))
    return (q * np.sign(np.diag(r)))[:dims]


class Codes:
    """Unit vectors with their codes, factors and, as queries, rounded coordinates."""

    def __init__(self, vectors: np.ndarray, turn: np.ndarray) -> None:
        self.unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
        turned = self.unit @ turn
        size = turned.shape[1]
        self.root = np.sqrt(size)
        self.code = self._pack(turned > 0)
        self.ones = np.bitwise_count(self.code).sum(axis=1, dtype=np.int64)
        self.factor = np.minimum(np.abs(turned).sum(axis=1) / self.root, 1.0)
        self.low = turned.min(axis=1)
        self.width = np.maximum((turned.max(axis=1) - self.low) / ((1 << _QUERY_BITS) - 1), 1e-300)
        level = np.rint((turned - self.low[:, None]) / self.width[:, None]).astype(np.int64)
        rounded = self.low[:, None] + level * self.width[:, None]
        self.total = rounded.sum(axis=1)
        self.error = np.abs(rounded - turned).sum(axis=1) / self.root
        self.planes = [self._pack(level >> i & 1) for i in range(_QUERY_BITS)]

    @staticmethod
    def _pack(bits: np.ndarray) -> np.ndarray:
        return np.packbits(bits.astype(bool), axis=1, bitorder="little").view(np.uint64)

    def take(self, at: np.ndarray) -> Codes:
        some = object.__new__(Codes)
        for name, value in vars(self).items():
            value = [p[at] for p in value] if isinstance(value, list) else value
            setattr(some, name, value[at] if isinstance(value, np.ndarray) else value)
        return some

    def products(self, rows: slice, other: Codes) -> np.ndarray:
        """Inner products of the rounded queries ``rows`` with the other's codes as unit vectors."""
        weighted = np.zeros((len(self.low[rows]), len(other.code)), dtype=np.uint32)
        for i, plane in enumerate(self.planes):
            for word in range(plane.shape[1]):
                common = np.bitwise_count(plane[rows, word][:, None] & other.code[:, word][None, :])
                weighted += np.left_shift(common, i, dtype=np.uint32)
        single = lambda x: x.astype(np.float32)
        sums = single(weighted) * single(2 * self.width[rows] / self.root)[:, None]
        sums += single(2 * self.low[rows] / self.root)[:, None] * single(other.ones)[None, :]
        sums -= single(self.total[rows] / self.root)[:, None]
        return sums


def bounds(s: np.ndarray, error: np.ndarray, factor: np.ndarray, size: int, confidence: float):
    """Lower and upper bounds of the cosine for an inner product with the code within s ± error."""
    off = np.sqrt(1 - factor * factor)

    def side(at: np.ndarray, sign: int) -> np.ndarray:
        always = factor * at + sign * off * np.sqrt(np.maximum(1 - at * at, 0))
        likely = (at + sign * confidence * off / np.sqrt(max(size - 1, 1))) / factor
        return np.minimum(always, likely) if sign > 0 else np.maximum(always, likely)

    # the certain upper bound rises with s up to s = factor and then falls: take its top in between
    high, low = np.minimum(s + error, 1), np.maximum(s - error, -1)
    upper = side(high, 1)
    upper = np.where((low <= factor) & (factor <= high), np.maximum(upper, 1), np.maximum(upper, side(low, 1)))
    return np.minimum(side(low, -1), side(high, -1)), upper


def least_product(factor: np.ndarray, size: int, options: CodeOptions) -> np.ndarray:
    """The smallest inner product with a code at which the upper bound can reach the threshold."""
    always = np.cos(np.minimum(np.arccos(factor) + np.arccos(options.threshold), np.pi))
    off = np.sqrt(1 - factor * factor)
    likely = factor * options.threshold - options.confidence * off / np.sqrt(max(size - 1, 1))
    return np.maximum(always, likely)


def linked(queries: Codes, others: Codes, options: CodeOptions) -> Iterator[tuple[int, np.ndarray]]:
    """For each query with any, the positions of the others at a cosine of the threshold or more."""
    size = int(others.root**2 + 0.5)
    least = least_product(others.factor, size, options)
    for start in range(0, len(queries.code), options.rows):
        rows = slice(start, min(start + options.rows, len(queries.code)))
        s = queries.products(rows, others)
        error = queries.error[rows] + _SINGLE
        i, j = np.nonzero(s >= (least[None, :] - error[:, None] - _SINGLE).astype(np.float32))
        low, high = bounds(s[i, j].astype(np.float64), error[i], others.factor[j], size, options.confidence)
        sure = low >= options.threshold + _SAFE
        open_ = np.flatnonzero((high >= options.threshold - _SAFE) & ~sure)
        if len(open_) > s.size // 16:  # most of the block: one product is less work than many rows
            cosine = (queries.unit[rows] @ others.unit.T)[i[open_], j[open_]]
            sure[open_] = cosine >= options.threshold
            # near the threshold the order of the sum could tell: one sum decides, whatever the way here
            open_ = open_[np.abs(cosine - options.threshold) < _SAFE]
        for at in range(0, len(open_), 1 << 14):
            some = open_[at : at + (1 << 14)]
            cosine = np.einsum("ij,ij->i", queries.unit[start + i[some]], others.unit[j[some]])
            sure[some] = cosine >= options.threshold
        i, j = i[sure], j[sure]
        found, first = np.unique(i, return_index=True)
        for row, near in zip(found, np.split(j, first[1:]), strict=True) if len(found) else ():
            yield start + int(row), near


def _valid(vector: Column) -> Column:
    """Not null, not empty, all components finite, one of them not zero."""
    finite = F.forall(
        vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))
    )
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _compare(options: CodeOptions):
    """A pair of tiles (rows ``low, high, tile, id, copies, vector``) to rows ``id, links, reach``."""

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("id")
        parts = []
        for dims, same in rows.groupby(rows.vector.map(len), sort=False):
            turn = rotation(dims, options.seed)
            ids, copies, tile = (same[c].to_numpy() for c in ("id", "copies", "tile"))
            codes = Codes(np.stack(same.vector.to_numpy()).astype(np.float64), turn)
            links = np.zeros(len(same), dtype=np.int64)
            both = rows.low.iloc[0] != rows.high.iloc[0]
            first = np.flatnonzero(tile == rows.low.iloc[0])
            second = np.flatnonzero(tile == rows.high.iloc[0])
            if not len(first) or not len(second):
                continue
            left, right = codes.take(first), codes.take(second)

            def stars(left=left, right=right, first=first, second=second, links=links, copies=copies, both=both):
                for row, near in linked(left, right, options):
                    here, there = first[row], second[near]
                    there = there if both else there[there != here]
                    if len(there):
                        links[here] += copies[there].sum()
                        if both:
                            links[there] += copies[here]
                        yield int(here), there

            low = smallest_linked(len(same), stars())
            touched = links > 0
            parts.append(pd.DataFrame({"id": ids[touched], "links": links[touched], "reach": ids[low[touched]]}))
        return pd.concat(parts) if parts else pd.DataFrame({"id": [], "links": [], "reach": []}, dtype="int64")

    return compare


def near_duplicates(
    vectors: DataFrame,
    options: CodeOptions = CodeOptions(),
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """One row per row of ``vectors``: the id, ``n_links`` (other rows of an equal label at a cosine
    of the threshold or more), ``component_id`` (the smallest id reachable over links, itself
    included) and ``kept`` (the id is its component's).

    Rows with a null label, and vectors that are null, empty or zero or hold null or non-finite
    components, link with nothing and are their own component, as are vectors of different lengths.
    Repeated rows and ids are vectors of their own. Rows with a null id link like others; kept is
    false for them unless their component has no other id, and their component_id is null then.
    Other columns are not read; an empty table gives an empty table."""
    rows = vectors.select(
        F.col(id_col).alias("id"),
        F.col(label_col).alias("label"),
        F.when(_valid(F.col(vector_col)) & F.col(label_col).isNotNull(), F.col(vector_col)).alias("vector"),
    )
    distinct = (
        rows.filter(F.col("vector").isNotNull())
        .groupBy("label", "vector")
        .agg(F.count("*").alias("copies"), F.min("id").alias("low_id"))
    )
    # a number of its own for each distinct vector, as ids may repeat or be null
    distinct = stage(distinct.withColumn("node", F.monotonically_increasing_id()), "distinct")
    sizes = distinct.groupBy(F.col("label").alias("of")).agg(F.count("*").alias("n")).filter("n > 1")
    sizes = sizes.select("of", F.ceil(F.col("n") / options.tile).cast("int").alias("tiles"))
    tiled = distinct.join(stage(sizes, "tiles", compact=True), F.col("label") == F.col("of")).select(
        "label",
        F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int").alias("tile"),
        F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other"),
        F.col("node").alias("id"),
        "copies",
        "vector",
    )
    compared = (
        tiled.withColumns({"low": F.least("tile", "other"), "high": F.greatest("tile", "other")})
        .select("label", "low", "high", "tile", "id", "copies", "vector")
        .repartition("label", "low", "high")
        .groupBy("label", "low", "high")
        .applyInPandas(_compare(options), "id bigint, links bigint, reach bigint")
    )
    compared = stage(compared, "compared", compact=True)
    links = compared.groupBy(F.col("id").alias("linked")).agg(F.sum("links").alias("links"))
    roots = connected_components(compared.select(F.col("id").alias("a"), F.col("reach").alias("b")))
    nodes = distinct.join(links, F.col("node") == F.col("linked"), "left")
    nodes = nodes.join(roots.withColumnRenamed("node", "member"), F.col("node") == F.col("member"), "left")
    nodes = stage(
        nodes.select(
            "label", "vector", "low_id",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("root", "node").alias("root"),
        ),
        "nodes",
    )
    lowest = nodes.groupBy("root").agg(F.min("low_id").alias("component_id"))
    lowest = stage(lowest, "lowest", compact=True)
    nodes = stage(nodes.join(lowest, "root").select("label", "vector", "n_links", "component_id"), "groups")
    nodes = nodes.withColumnsRenamed({"label": "node_label", "vector": "node_vector"})
    same = (F.col("label") == F.col("node_label")) & (F.col("vector") == F.col("node_vector"))
    lone = F.col("node_label").isNull()
    component = F.when(lone, F.col("id")).otherwise(F.col("component_id"))
    return rows.join(nodes, same, "left").select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id").eqNullSafe(component), F.lit(False)).alias("kept"),
    )
