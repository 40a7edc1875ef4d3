"""Near duplicates by SimHash fingerprints and BK-trees.

A document's fingerprint holds, for each of 64 bits, the majority over the hashes of its word
shingles. Fingerprints within a few bits of each other are linked.

The search runs on distinct fingerprints only. They are dealt to shards: two fingerprints that
differ in at most ``radius`` bits agree on at least one of ``radius + 1`` blocks of bits, so a
shard holds the fingerprints that agree on one block, and every link lies inside a shard. Each
shard has a BK-tree, children keyed by their integer Hamming distance to the parent, and is
searched along the edges within the radius only. A shard's tree goes to the one task that holds
its queries, by the shuffle: broadcasting all trees to all tasks would have no bound on its size,
and a query needs no tree of a block it does not share.

A shard above ``max_shard`` fingerprints (a large group of near copies) is divided again, by
blocks of the bits not yet agreed on, until all shards are small; as a shard that agrees on all but
8 bits has at most 256 members, that ends, drops no link, and bounds every task's group. Inside a
shard links are contracted to one row per fingerprint, so no pairs of a group are ever emitted."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesflow.llm.components import connected_components
from salesflow.staging import stage

_BITS = 64
_SEED = 42
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """SimHash of a whole text: A-Z lower-cased, words between ASCII white space, shingles with
    their repeats. Fewer words than a shingle count as one shingle; no word gives 0."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    parts = zip(*(words[i:] for i in range(shingle)), strict=False) if len(words) >= shingle else [words]
    digest, join = xxhash.xxh64_intdigest, b" ".join
    hashes = np.array([digest(join(p), _SEED) for p in parts], dtype="<u8")
    ones = np.zeros(_BITS, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 15):
        some = hashes[at : at + (1 << 15)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(some, axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    majority = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(majority.view("<u8")[0])


def with_fingerprint(docs: DataFrame, name: str, shingle: int = 3, text_col: str = "text") -> DataFrame:
    """``docs`` with the fingerprint as a signed bigint column."""

    @F.pandas_udf("bigint")
    def hashed(texts: pd.Series) -> pd.Series:
        prints = np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64)
        return pd.Series(prints.view(np.int64))

    return docs.withColumn(name, hashed(F.col(text_col).cast("string")))


def distances(values: np.ndarray, one: np.uint64) -> np.ndarray:
    return np.bitwise_count(values ^ one).astype(np.int64)


def bk_tree(values: np.ndarray) -> list[tuple[int, dict[int, int]]]:
    """Nodes ``(position of the value, {distance: child node})``, node 0 the root, over distinct
    values. The first value of a set is its node; the others go to the child of their distance,
    which is where inserting them one by one would take them."""
    nodes: list[tuple[int, dict[int, int]]] = []
    todo: list[tuple[np.ndarray, dict[int, int] | None, int]] = [(np.arange(len(values)), None, 0)]
    while todo:
        members, parent, key = todo.pop()
        if parent is not None:
            parent[key] = len(nodes)
        children: dict[int, int] = {}
        nodes.append((int(members[0]), children))
        rest = members[1:]
        apart = distances(values[rest], values[members[0]])
        for d in np.unique(apart):
            todo.append((rest[apart == d], children, int(d)))
    return nodes


def bk_search(
    values: np.ndarray, nodes: list[tuple[int, dict[int, int]]], queries: np.ndarray, radius: int
) -> Iterator[tuple[int, np.ndarray]]:
    """``(value position, positions of the queries within the radius of it)``, each value that has
    any once. All queries walk the tree together; those that follow an edge of key k are those at
    a distance within k ± radius."""
    todo = [(0, np.arange(len(queries)))] if nodes else []
    while todo:
        node, here = todo.pop()
        position, children = nodes[node]
        apart = distances(queries[here], values[position])
        near = here[apart <= radius]
        if len(near):
            yield position, near
        for key, child in children.items():
            follow = here[np.abs(apart - key) <= radius]
            if len(follow):
                todo.append((child, follow))


def smallest_linked(n: int, stars: Iterable[tuple[int, np.ndarray]]) -> np.ndarray:
    """For each of n positions the smallest one reachable over links, given as stars: a position
    and those linked to it. Holds n numbers, however many links there are."""
    parent = np.arange(n)

    def roots(of: np.ndarray) -> np.ndarray:
        found = parent[of]
        while (parent[found] != found).any():
            found = parent[found]
        return found

    for centre, linked in stars:
        together = roots(np.append(linked, centre))
        parent[together] = together.min()
    return roots(np.arange(n))


def _split(mask: int, radius: int) -> list[int]:
    """The mask with one of radius + 1 blocks of its unset bits added, for each block."""
    free = [i for i in range(_BITS) if not mask >> i & 1]
    blocks = np.array_split(np.array(free), min(radius + 1, len(free)))
    return [mask | sum(1 << int(i) for i in block) for block in blocks]


def _signed(mask: int) -> int:
    return mask - (1 << _BITS) if mask >> (_BITS - 1) else mask


def _links_in_shards(radius: int):
    """Of each shard's fingerprints (rows ``mask, bits, print`` sorted by shard), those that have a
    smaller one in reach: ``(a, b)``, b the smallest reachable within the shard."""

    def shard(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        prints = np.unique(prints)  # also sorts them
        values = prints.view(np.uint64)
        low = smallest_linked(len(values), bk_search(values, bk_tree(values), values, radius))
        moved = low != np.arange(len(low))
        return prints[moved], prints[low[moved]]

    def table(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        a, b = (np.concatenate(x) for x in zip(*found, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = np.zeros((0, 3), dtype=np.int64)  # the last shard of a batch may go on in the next
        for batch in batches:
            new = np.column_stack([batch.column(i).to_numpy() for i in range(3)]).astype(np.int64)
            rows = np.concatenate([rest, new])
            if not len(rows):
                continue
            starts = np.flatnonzero(np.r_[True, (rows[1:, :2] != rows[:-1, :2]).any(axis=1)])
            rest = rows[starts[-1] :]
            ends = starts[1:]
            found = [shard(rows[s:e, 2].copy()) for s, e in zip(starts[:-1], ends, strict=True) if e - s > 1]
            if found:
                yield table(found)
        if len(rest) > 1:
            yield table([shard(rest[:, 2].copy())])

    return linked


def links(prints: DataFrame, radius: int = 2, max_shard: int = 2048) -> DataFrame:
    """``(a, b)``: rows that connect all fingerprints within ``radius`` bits of each other, given
    distinct fingerprints ``(print)``. Written to the scratch folder."""
    if not 0 <= radius <= 16:
        raise ValueError("radius must be from 0 to 16")
    max_shard = max(max_shard, 256, 2 << radius)  # larger ones still have more than radius bits free
    next_masks = {0: _split(0, radius)}
    shards = prints.select(F.lit(0).cast("long").alias("mask"), F.lit(0).cast("long").alias("bits"), "print")
    found = None
    while True:
        deeper = {m: _split(m, radius) for masks in next_masks.values() for m in masks}
        options = F.create_map(
            *[F.lit(x) for m, masks in next_masks.items() for x in (_signed(m), [_signed(k) for k in masks])]
        )
        shards = shards.select("print", F.explode(options[F.col("mask")]).alias("mask"))
        shards = shards.select("mask", F.col("mask").bitwiseAND(F.col("print")).alias("bits"), "print")
        shards = stage(shards, "shards")
        large = shards.groupBy("mask", "bits").count().filter(F.col("count") > max_shard)
        large = stage(large, "large", compact=True)
        some_large = bool(large.head(1))
        small = shards.join(large, ["mask", "bits"], "left_anti") if some_large else shards
        small = small.repartition("mask", "bits").sortWithinPartitions("mask", "bits")
        level = small.mapInArrow(_links_in_shards(radius), "a bigint, b bigint")
        level = stage(level, "links", compact=True)
        found = level if found is None else found.union(level)
        if not some_large:
            return found
        shards = shards.join(large, ["mask", "bits"], "left_semi")
        next_masks = deeper


def near_duplicates(
    docs: DataFrame,
    *,
    shingle: int = 3,
    radius: int = 2,
    max_shard: int = 2048,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: its id, ``fingerprint`` (16 hex digits) and ``component_id``, the
    smallest id reachable over links of at most ``radius`` differing bits, itself included.

    Null and empty texts have fingerprint 0 and are linked like any other. Rows with a null id take
    part; a component of null ids only has a null component_id. Repeated rows and repeated ids are
    kept as they are. An empty table gives an empty table. Other columns, whatever their names, are
    not read."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    prints = stage(with_fingerprint(rows, "print", shingle).drop("text"), "prints")
    groups = _groups(prints, radius, max_shard).select("print", "component_id")
    return prints.join(groups, "print").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(
    docs: DataFrame,
    *,
    shingle: int = 3,
    radius: int = 2,
    max_shard: int = 2048,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``docs`` with one row of each component: the one whose id is the component's smallest. Of
    rows that repeat that id one stays: that with the smallest fingerprint, or any of equal rows.
    Of a component of null ids one row stays. All columns of ``docs`` are kept as they are."""
    print_col = "_print"
    while print_col in docs.columns:
        print_col = f"_{print_col}"
    marked = stage(with_fingerprint(docs, print_col, shingle, text_col), "marked")
    prints = marked.select(F.col(id_col).alias("id"), F.col(print_col).alias("print"))
    keepers = (
        _groups(prints, radius, max_shard)
        .filter(F.col("low_id").eqNullSafe(F.col("component_id")))
        .groupBy("root")
        .agg(F.min_by(F.struct("print", "low_id"), "print").alias("keeper"))
        .select("keeper.*")
    )
    keepers = stage(keepers, "keepers", compact=True)
    same = marked[print_col].eqNullSafe(keepers.print) & marked[id_col].eqNullSafe(keepers.low_id)
    return marked.join(keepers, same, "left_semi").dropDuplicates([print_col, id_col]).drop(print_col)


def _groups(prints: DataFrame, radius: int, max_shard: int) -> DataFrame:
    """``(print, low_id, root, component_id)`` per distinct fingerprint of ``(id, print)``."""
    distinct = stage(prints.groupBy("print").agg(F.min("id").alias("low_id")), "distinct", compact=True)
    roots = connected_components(links(distinct.select("print"), radius, max_shard))
    rooted = stage(
        distinct.join(roots, distinct.print == roots.node, "left").select(
            "print", "low_id", F.coalesce("root", "print").alias("root")
        ),
        "rooted",
        compact=True,
    )
    lowest = rooted.groupBy("root").agg(F.min("low_id").alias("component_id"))
    return stage(rooted.join(stage(lowest, "lowest", compact=True), "root"), "groups", compact=True)
