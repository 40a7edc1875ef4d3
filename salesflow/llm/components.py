"""Connected components of a graph that is never gathered in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesflow.staging import stage, staging


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` of bigint to ``(node, root)``: one row per node of an edge, root the
    smallest node reachable. Edges with a null end and loops add nothing; no edges, no rows.

    Alternating large and small stars: every round each node hands its larger neighbours, then its
    smaller ones, to the smallest node it knows, until only stars are left (a number of rounds
    logarithmic in the nodes). A round is a few minima per node and joins with them. The minima
    are written before they are joined, so that Spark can split the join at a node with many
    edges; their partial aggregates already split the minimum."""
    spark = edges.sparkSession
    a, b = F.col("a"), F.col("b")
    with staging(spark, "components") as keep:
        stars = keep(
            edges.filter(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(),
            "edges",
            compact=True,
        )
        before, at = _signature(stars), 0
        while before[0]:
            at += 1
            both = stars.union(stars.select("b", "a"))
            low = keep(both.groupBy("a").agg(F.least("a", F.min("b")).alias("low")), f"low{at}", compact=True)
            large = both.filter(b > a).join(low, "a").select(b.alias("a"), F.col("low").alias("b"))
            large = keep(large, f"large{at}", compact=True)
            low = keep(large.groupBy("a").agg(F.min("b").alias("low")), f"least{at}", compact=True)
            moved = large.join(low, "a").filter(b != F.col("low")).select(b.alias("a"), F.col("low").alias("b"))
            stars = keep(moved.union(low.select("a", F.col("low").alias("b"))).distinct(), f"stars{at}", compact=True)
            after = _signature(stars)
            if after == before:
                break
            before = after
        found = stars.select(a.alias("node"), b.alias("root"))
        return stage(found.union(stars.select(b.alias("node"), b.alias("root"))).distinct(), "roots", compact=True)


def _signature(edges: DataFrame) -> tuple:
    """One row: how many edges, and sums over two hashes of them."""
    total = lambda c: F.sum(c.cast("decimal(38,0)"))
    return tuple(edges.agg(F.count("*"), total(F.xxhash64("a", "b")), total(F.xxhash64("b", "a"))).first())
