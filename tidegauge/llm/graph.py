"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.sources.workspace import Scratch


def components(links: DataFrame, scratch: Scratch, label: str) -> DataFrame:
    """``node, root`` for every node of ``links`` (``a, b``): root is its smallest node.

    Alternates two steps until nothing changes: each node hands its smallest
    neighbour to its larger neighbours, then to its smaller ones. The number of
    rounds grows with the logarithm of the longest chain. Each round is two
    grouped minimums and joins over the links; a node with very many links is
    pre-aggregated, and its join goes through adaptive skew handling.
    """
    edges = scratch.table(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        f"{label}-0",
    )
    before, turn = _state(edges), 0
    while before[0]:
        turn += 1
        large = _toward_smallest(edges.union(edges.select("v", "u")), "v > u")
        small = _toward_smallest(large, None)
        edges = scratch.table(small, f"{label}-{turn}")
        scratch.drop(f"{label}-{turn - 1}")
        after = _state(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def _toward_smallest(pairs: DataFrame, larger: str | None) -> DataFrame:
    """Link the neighbours ``v`` of each ``u``, and ``u`` itself, with the smallest of them all."""
    smallest = pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    near = pairs.join(smallest, "u")
    if larger:
        near = near.where(larger)
        moved = near.select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = near.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            smallest.select("u", F.col("m").alias("v"))
        )
    return moved.where("u <> v").distinct()
