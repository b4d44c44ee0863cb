"""Connected components of a graph given as edges, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gableboard.llm.tables import written


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % (1 << 40))).first())


def components(links: DataFrame) -> DataFrame:
    """node, root (the smallest node it is connected with) for every node of `links` (a, b).

    Each round hangs all neighbours of a node under the smallest one. Only the minimum of a node's
    neighbours is gathered, by a combinable aggregate, so a node with very many links costs one row per
    task. The number of rounds grows with the logarithm of the longest path.
    """
    ordered = links.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = written(ordered.distinct(), "edges")
    before = _state(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        edges = written(small.filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                        .union(small.select("a", F.col("m").alias("b"))).filter("a != b").distinct(), "edges")
        after = _state(edges)
        if after == before:
            break
        before = after
    found = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return found.union(edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).groupBy("node").agg(
        F.min("root").alias("root"))


def joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """node, root as `components` of the links behind `roots` and further ones: only links between components make rounds."""
    for side in ("a", "b"):
        known = roots.select(F.col("node").alias(side), F.col("root").alias("known"))
        links = links.join(known, side, "left").withColumn(side, F.coalesce("known", side)).drop("known")
    found = written(components(links), "merged")
    top = found.select(F.col("node").alias("root"), F.col("root").alias("top"))
    moved = roots.join(top, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    return moved.union(found.join(roots, "node", "left_anti").select("node", "root"))
