"""Nearest neighbours by largest inner product, with a vantage-point tree for each shard.

A vector x becomes (x, sqrt(M^2 - |x|^2)) with M the greatest norm, and a query becomes (q, 0); then distances are
Euclidean and the nearest point has the largest inner product. Each shard of about ``SHARD_ROWS`` vectors gets a tree
whose nodes split their points at the median distance to a vantage point and keep the least and greatest distance of
each side. A query skips a side if ``factor`` times the triangle inequality's bound exceeds the distance to its k-th
neighbour so far: factor 1 is exact search, greater factors skip more. Queries go through a tree in blocks, so distances
are matrix products. Every shard meets every block of the stated query set once; blocks are routed by shard, and a
query's few neighbours from each shard are merged by rank.

Defined cases: vectors that are null, zero, or hold a null or a non-finite component take no part, nor do vectors of
another length than the most frequent one (the smallest on a tie), nor rows with a null vec_id; equal scores go to the
smaller vec_id; a row that repeats is a candidate each time, but rows with a query's own vec_id never are; a repeated
query is answered once, for one of its vectors; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .scratch import Scratch

NEIGHBOURS = 20

#: Rows of a shard, about; queries of a block; points of a leaf.
SHARD_ROWS, BLOCK_ROWS, LEAF = 4_096, 8_192, 256

#: How much the triangle inequality's bound is stretched; 1 is exact.
FACTOR = 2.0


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and the vector in double precision, for rows that take part."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & F.forall("v", finite) & F.exists("v", lambda x: x != 0))
    sizes = rows.groupBy(F.size("v").alias("size")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "size").first()
    return rows.filter(F.size("v") == (sizes["size"] if sizes else 0))


class Tree:
    """Points in Euclidean space with inner-product scores on the original vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, greatest: float):
        self.ids, self.vectors, self.greatest = ids, vectors, greatest
        rest = np.sqrt(np.maximum(greatest**2 - (vectors**2).sum(axis=1), 0))
        points = np.hstack((vectors, rest[:, None]))
        self.order = np.arange(len(ids))
        self.nodes: list[tuple] = []
        if len(ids):
            self._grow(points, 0, len(ids), np.random.default_rng(5))

    def _grow(self, points: np.ndarray, lo: int, hi: int, rng: np.random.Generator) -> int:
        """Makes a node of order[lo:hi]: (lo, hi), or (lo, hi, vantage, inner node, its distances, outer node, its distances)."""
        at = len(self.nodes)
        self.nodes.append((lo, hi))
        if hi - lo <= LEAF:
            return at
        some = self.order[lo:hi]
        vantage = some[rng.integers(len(some))]
        far = np.linalg.norm(points[some] - points[vantage], axis=1)
        if far.max() == far.min():
            return at  # all at one distance: a leaf, however many
        mid = len(some) // 2
        by = np.argpartition(far, mid)
        self.order[lo:hi], far = some[by], far[by]
        ends = [(float(x.min()), float(x.max())) for x in (far[:mid], far[mid:])]
        inner, outer = self._grow(points, lo, lo + mid, rng), self._grow(points, lo + mid, hi, rng)
        self.nodes[at] = (lo, hi, int(vantage), inner, ends[0], outer, ends[1])
        return at

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray, int]:
        """(scores, ids) of each query's k best in this tree, -inf and -1 where there are fewer; and how many scores were computed."""
        n = len(queries)
        self.best, self.found = np.full((n, k), -np.inf), np.full((n, k), -1, np.int64)
        self.queries, self.query_ids, self.k, self.factor, self.work = queries, query_ids, k, factor, 0
        self.norms = (queries**2).sum(axis=1)
        # distances are compared with a margin for rounding, so that ties are never skipped
        self.margin = 1e-9 * (self.greatest + np.sqrt(self.norms)) + 1e-12
        if self.nodes and n:
            self._visit(0, np.arange(n))
        return self.best, self.found, self.work

    def _visit(self, at: int, who: np.ndarray) -> None:
        node = self.nodes[at]
        if len(node) == 2:
            self._leaf(node[0], node[1], who)
            return
        _, _, vantage, inner, inner_ends, outer, outer_ends = node
        far = np.sqrt(np.maximum(self.norms[who] + self.greatest**2 - 2 * (self.queries[who] @ self.vectors[vantage]), 0))
        bounds = [np.maximum(np.maximum(ends[0] - far, far - ends[1]), 0) for ends in (inner_ends, outer_ends)]
        first_inner = np.abs(far - sum(inner_ends) / 2) <= np.abs(far - sum(outer_ends) / 2)
        for child, bound, turn in ((inner, bounds[0], first_inner), (outer, bounds[1], ~first_inner), (outer, bounds[1], first_inner), (inner, bounds[0], ~first_inner)):
            # the distance that the k-th best score so far stands for
            reach = np.sqrt(np.maximum(self.norms[who] + self.greatest**2 - 2 * self.best[who, -1], 0))
            go = turn & (self.factor * bound <= reach + self.margin[who])
            if go.any():
                self._visit(child, who[go])

    def _leaf(self, lo: int, hi: int, who: np.ndarray) -> None:
        for start in range(lo, hi, 2 * LEAF):
            some = self.order[start : min(start + 2 * LEAF, hi)]
            ids = self.ids[some]
            scores = self.queries[who] @ self.vectors[some].T
            self.work += scores.size
            scores[self.query_ids[who][:, None] == ids[None, :]] = -np.inf
            # only queries with something new at this leaf are merged
            near = np.flatnonzero(scores.max(axis=1) >= self.best[who, -1])
            if not len(near):
                continue
            rows, scores = who[near], scores[near]
            ids = np.broadcast_to(ids, scores.shape)
            if scores.shape[1] > self.k:
                top = np.argpartition(-scores, self.k - 1, axis=1)[:, : self.k]
                least = np.take_along_axis(scores, top, axis=1).min(axis=1)
                tied = np.flatnonzero((scores >= least[:, None]).sum(axis=1) > self.k)
                if len(tied):
                    top[tied] = np.lexsort((ids[tied], -scores[tied]), axis=1)[:, : self.k]
                scores, ids = np.take_along_axis(scores, top, axis=1), np.take_along_axis(ids, top, axis=1)
            scores, ids = np.hstack((self.best[rows], scores)), np.hstack((self.found[rows], ids))
            order = np.argsort(-scores, axis=1)
            by = np.take_along_axis(scores, order, axis=1)
            if len(tied := np.flatnonzero((by[:, 1:] == by[:, :-1]).any(axis=1))):
                order[tied] = np.lexsort((ids[tied], -scores[tied]), axis=1)
            order = order[:, : self.k]
            self.best[rows] = np.take_along_axis(scores, order, axis=1)
            self.found[rows] = np.take_along_axis(ids, order, axis=1)

    def to_bytes(self) -> bytes:
        return pickle.dumps((self.ids, self.vectors, self.greatest, self.order, self.nodes), protocol=5)

    @classmethod
    def from_bytes(cls, raw: bytes) -> Tree:
        out = cls.__new__(cls)
        out.ids, out.vectors, out.greatest, out.order, out.nodes = pickle.loads(raw)
        return out


def build_trees(rows: DataFrame, greatest: float, shards: int) -> DataFrame:
    """shard, tree: the pickled tree of each shard; shards are dealt by a hash of vec_id and vector."""

    def build(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"shard": [key[0]], "tree": [Tree(pdf["vec_id"].to_numpy(), np.stack(pdf["v"].to_numpy()), greatest).to_bytes()]})

    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id", "v"), F.lit(shards)).cast("int"))
    return dealt.groupBy("shard").applyInPandas(build, "shard int, tree binary")


def nearest(spark: SparkSession, vectors: DataFrame, k: int = NEIGHBOURS, factor: float = FACTOR, every: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose vec_id is divisible by ``every``, its k nearest others."""
    scratch = Scratch(spark, "vptree")
    rows = scratch.keep(usable(vectors), "rows")
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    n, greatest = rows.agg(F.count(F.lit(1)), F.max(norm)).first()
    shards = max(1, -(-n // SHARD_ROWS))
    trees = scratch.keep(build_trees(rows, greatest or 0.0, shards), "trees")
    asked = rows.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("v").alias("v"))
    blocks = max(1, -(-n // (every * BLOCK_ROWS)))

    def block(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"block": [key[0]], "ids": [pdf["vec_id"].to_numpy(np.int64).tobytes()], "queries": [np.stack(pdf["v"].to_numpy()).astype(np.float64).tobytes()]})

    asked = asked.withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(blocks)).cast("int"))
    asked = scratch.keep(asked.groupBy("block").applyInPandas(block, "block int, ids binary, queries binary"), "asked")
    # each block of queries goes to each shard
    routed = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    both = trees.join(routed, "shard").select("tree", "ids", "queries")

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tree, ids, queries in zip(*batch.columns, strict=True):
                ids = np.frombuffer(ids.as_py(), np.int64)
                scores, found, _ = Tree.from_bytes(tree.as_py()).search(ids, np.frombuffer(queries.as_py(), np.float64).reshape(len(ids), -1), k, factor)
                real = np.isfinite(scores)
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, real.sum(axis=1))), pa.array(found[real]), pa.array(scores[real])], ["query_id", "vec_id", "score"])

    # a row holds a tree and a block, some MB
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    found = scratch.keep(both.repartition(max(1, min(2_000, shards * blocks))).mapInArrow(answer, "query_id long, vec_id long, score double"), "found")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    best = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", best).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
