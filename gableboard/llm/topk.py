"""Exact top-k inner products by branch and bound over ball trees, one tree per shard.

Vectors are dealt into shards of bounded size by the hash of their components. A shard's tree splits its
points at the median of the widest axis; a node knows its centre c and radius r, so that no point below
it scores more than q.c + |q| r. A search visits a shard's leaves in the order of that bound and stops at
the first that cannot reach the current kth score.

The search has two rounds. First each query runs against its own shard; the kth score found there is a
lower bound of the kth score over all. Then blocks of queries, with these bounds, meet all other shards,
and a shard returns only what may still enter the result. Query blocks and shards have bounded sizes, so
that a task holds one tree and one block. Equal vectors are searched as one: of equal candidates only the
k + 1 smallest ids can matter (one of them may be the query's own), and equal queries share one search. A
search keeps k candidates and as many more as there are vectors of the query's own id, which are left out last.

Scores are int64; the products run in double precision where that is exact and in int64 otherwise. Null
and empty vectors and those with a null, NaN or infinite component take no part. Vectors of different
lengths are never compared. Null ids take no part. Equal scores go to the smaller id; a repeated row of
the same id and vector counts once. An empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gableboard.llm.tables import written

LEAF = 128
#: Vectors of a shard and distinct queries of a block.
SHARD_ROWS, BLOCK_ROWS = 8192, 2048
FOUND = "_query binary, vec_id long, score long"


def quantised(vectors: DataFrame, scale: int = 256, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id and v: floor(scale * x) of every component as long; rows that take no part are left out."""
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("x"))
    finite = F.forall("x", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    rows = rows.filter(F.col("vec_id").isNotNull() & (F.size("x") > 0) & finite)
    return rows.select("vec_id", F.transform("x", lambda e: F.floor(e * float(scale)).cast("long")).alias("v")).distinct()


class BallTree:
    """A ball tree over the rows of an int64 matrix, split at medians down to LEAF rows."""

    def __init__(self, points: np.ndarray):
        self.order = np.arange(len(points))
        self.centres, self.radii, self.parents, self.leaves = [], [], [], []
        exact = points.astype(np.float64)
        todo = [(0, len(points), -1)]
        while todo:
            a, b, parent = todo.pop()
            rows = exact[self.order[a:b]]
            node, centre = len(self.centres), rows.mean(axis=0)
            self.centres.append(centre)
            self.radii.append(math.sqrt(((rows - centre) ** 2).sum(axis=1).max()))
            self.parents.append(parent)
            if b - a <= LEAF:
                self.leaves.append((node, a, b))
                continue
            axis, middle = np.ptp(rows, axis=0).argmax(), (b - a) // 2
            split = np.argpartition(rows[:, axis], middle)
            self.order[a:b] = self.order[a:b][split]
            todo += [(a, a + middle, node), (a + middle, b, node)]
        self.points = points[self.order]
        self.exact = self.points.astype(np.float64)
        self.largest = float(np.abs(self.exact).max())
        self.centres, self.radii = np.array(self.centres), np.array(self.radii)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Upper bound of the score of each leaf for each query; no leaf exceeds its parents' bounds."""
        q = queries.astype(np.float64)
        at = q @ self.centres.T + np.sqrt((q ** 2).sum(axis=1))[:, None] * self.radii
        at += 1e-9 * (np.abs(at) + np.abs(q).sum(axis=1)[:, None] * self.largest) + 1e-3  # rounding
        for node, parent in enumerate(self.parents):
            if parent >= 0:
                np.minimum(at[:, node], at[:, parent], out=at[:, node])
        return at[:, [leaf[0] for leaf in self.leaves]]

    def search(self, queries: np.ndarray, lowest: np.ndarray, most: np.ndarray):
        """For each query the rows and scores that may be among its `most` best: at least `lowest`, ties kept."""
        bounds = self.bounds(queries)
        in_double = self.largest * float(np.abs(queries).max(initial=0)) * queries.shape[1] < 2 ** 52
        for q, bound, low, k in zip(queries, bounds, lowest, most, strict=True):
            rows, scores, kth = [], [], low
            best = np.zeros(0, np.int64)
            exact = q.astype(np.float64)
            for leaf in np.argsort(-bound, kind="stable"):
                if bound[leaf] < kth:
                    break
                _, a, b = self.leaves[leaf]
                score = (self.exact[a:b] @ exact).astype(np.int64) if in_double else self.points[a:b] @ q
                near = np.flatnonzero(score >= kth)
                if not len(near):
                    continue
                rows.append(a + near)
                scores.append(score[near])
                best = np.sort(np.concatenate([best, scores[-1]]))[-k:]
                if len(best) == k:
                    kth = max(kth, best[0])
            if rows:
                row, score = np.concatenate(rows), np.concatenate(scores)
                near = score >= kth
                yield self.order[row[near]], score[near]
            else:
                yield np.zeros(0, np.int64), np.zeros(0, np.int64)


def _matrix(column) -> np.ndarray:
    return np.array([np.frombuffer(x, np.int64) for x in column])


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5,
          shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the k rows of `vectors` with the largest inner product for each row
    of `queries`, other than the row of the same id. Both have vec_id and v (array of long)."""
    # Components as fixed-width text are a key that hashes, groups and joins like any binary.
    packed = F.unhex(F.array_join(F.transform("v", lambda e: F.lpad(F.hex(e), 16, "0")), ""))
    swap = lambda column: np.frombuffer(column, ">i8").astype(np.int64)
    candidates = vectors.select("vec_id", packed.alias("_v"))
    wanted = queries.select(F.col("vec_id").alias("query_id"), packed.alias("_query"))
    first = W.partitionBy("_v").orderBy("vec_id")
    kept = candidates.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= k + 1).drop("n")
    kept = written(kept, "vectors")
    shards = max(1, math.ceil(kept.count() / shard_rows))
    times = candidates.distinct().groupBy("vec_id").agg(F.count("*").alias("own")).filter("own > 1")
    distinct = (wanted.join(times, F.col("query_id") == F.col("vec_id"), "left").groupBy("_query")
                .agg((F.max(F.coalesce("own", F.lit(1))) + k).cast("int").alias("most")))
    distinct = written(distinct, "queries")
    most = distinct.agg(F.max("most")).first()[0] or k + 1
    shard = lambda c: F.pmod(F.xxhash64(c), F.lit(shards)).cast("int")

    def trees(points: pd.DataFrame) -> tuple[BallTree, np.ndarray, np.ndarray]:
        keys, at = np.unique(points["_v"].to_numpy(), return_inverse=True)
        return BallTree(np.array([swap(x) for x in keys])), at, points["vec_id"].to_numpy()

    def results(points: pd.DataFrame, asked: list, lowest: np.ndarray, most: np.ndarray) -> pd.DataFrame:
        out = {"_query": [], "vec_id": [], "score": []}
        if len(points) and len(asked):
            tree, at, ids = trees(points)
            by_row = np.argsort(at, kind="stable")
            begin = np.searchsorted(at[by_row], np.arange(len(tree.order) + 1))
            matrix = np.array([swap(x) for x in asked])
            for query, (rows, scores) in zip(asked, tree.search(matrix, lowest, most), strict=True):
                for row, score in zip(rows, scores, strict=True):
                    own = ids[by_row[begin[row]:begin[row + 1]]]
                    out["_query"] += [query] * len(own)
                    out["vec_id"] += own.tolist()
                    out["score"] += [score] * len(own)
        frame = pd.DataFrame(out)
        if not len(frame):
            return frame.astype({"vec_id": "int64", "score": "int64"})
        # Of one query's rows here only the best `most` can be in the result.
        frame = frame.sort_values(["score", "vec_id"], ascending=[False, True])
        return frame[frame.groupby("_query", sort=False).cumcount() < frame["_query"].map(dict(zip(asked, most, strict=True)))]

    none = np.iinfo(np.int64).min

    def at_home(key, points: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        return results(points, asked["_query"].tolist(), np.full(len(asked), none), asked["most"].to_numpy())

    def elsewhere(key, points: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        return results(points, asked["_query"].tolist(), asked["lowest"].to_numpy(), asked["most"].to_numpy())

    # A shard holds vectors of one length: the length is part of every key.
    placed = kept.withColumn("d", F.octet_length("_v")).withColumn("s", shard("_v"))
    homes = distinct.withColumn("d", F.octet_length("_query")).withColumn("s", shard("_query"))
    by = ("d", "s")
    home = written(placed.groupBy(*by).cogroup(homes.groupBy(*by)).applyInPandas(at_home, FOUND), "home")

    # Round two: query blocks with their bounds against every other shard.
    full = home.groupBy("_query").agg(F.min("score").alias("lowest"), F.count("*").alias("n"))
    bounded = homes.join(full, "_query", "left").withColumn(
        "lowest", F.when(F.col("n") >= F.col("most"), F.col("lowest")).otherwise(F.lit(none)))
    blocks = max(1, math.ceil(distinct.count() / block_rows))
    others = (bounded.withColumn("b", F.pmod(F.xxhash64("_query", F.lit(1)), F.lit(blocks)).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).filter("other != s")
              .select("d", F.col("other").cast("int").alias("s"), "b", "_query", "lowest", "most"))
    copies = placed.withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    by = ("d", "s", "b")
    away = copies.groupBy(*by).cogroup(others.groupBy(*by)).applyInPandas(elsewhere, FOUND)
    found = home.unionByName(away) if shards > 1 else home
    best = W.partitionBy("_query").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("n", F.row_number().over(best)).filter(F.col("n") <= most).drop("n")
    own = W.partitionBy("query_id", "_query").orderBy(F.desc("score"), "vec_id")
    return (wanted.join(found, "_query").filter("vec_id != query_id")
            .withColumn("rank", F.row_number().over(own)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
