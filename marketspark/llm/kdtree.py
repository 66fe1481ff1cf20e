"""Exact top-k inner products by one KD-tree per shard.

Rows are hashed into shards of bounded size and queries into blocks.  A shard's
tree splits at medians and keeps a tight bounding box at every node.  A query
walks it best-first: the box-to-query bound (for each axis the larger product
with the two box sides) orders the nodes, and the walk ends at the first bound
below the k-th score so far.  Queries first search the shard that they live in; the k-th score
found there travels with them to all other shards.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import materialize

SHARD_ROWS = 16_384
BLOCK_QUERIES = 16_384
LEAF = 128
FOUND = "query_id long, vec_id long, score double, kth double, kth_id long"


class Tree:
    """Nodes in arrays: bounds of rows, box, least id, children (0: leaf)."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, leaf: int = LEAF):
        order = np.arange(len(ids))
        span, left, right, lo, hi, least = [(0, len(ids))], [0], [0], [], [], []
        node = 0
        while node < len(span):
            a, b = span[node]
            own = x[order[a:b]]
            lo.append(own.min(0))
            hi.append(own.max(0))
            least.append(ids[order[a:b]].min())
            axis = int(np.argmax(hi[-1] - lo[-1]))
            if b - a > leaf and hi[-1][axis] > lo[-1][axis]:
                middle = (b - a) // 2
                order[a:b] = order[a:b][np.argpartition(own[:, axis], middle)]
                left[node], right[node] = len(span), len(span) + 1
                span += [(a, a + middle), (a + middle, b)]
                left += [0, 0]
                right += [0, 0]
            node += 1
        self.span, self.left, self.right = span, left, right
        self.lo, self.hi, self.least = np.array(lo), np.array(hi), np.array(least)
        self.ids, self.x = ids[order], x[order]

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Upper bound of the score of each query with any row below each node."""
        return np.maximum(queries, 0) @ self.hi.T + np.minimum(queries, 0) @ self.lo.T

    def search(self, own: int, query: np.ndarray, bound: np.ndarray, k: int, kth: float, kth_id: int) -> list[tuple[float, int]]:
        """Up to k best (score, id), best first; rows that come after (kth, kth_id) may be missing."""
        best: list[tuple[float, int]] = []
        heap = [(-bound[0], 0)]
        while heap:
            top, node = heapq.heappop(heap)
            if -top < kth:
                break
            if -top == kth and self.least[node] > kth_id:
                continue
            if self.left[node]:
                for child in (self.left[node], self.right[node]):
                    if bound[child] >= kth:
                        heapq.heappush(heap, (-bound[child], child))
                continue
            a, b = self.span[node]
            scores, ids = self.x[a:b] @ query, self.ids[a:b]
            hit = np.flatnonzero((scores >= kth) & (ids != own))
            if len(hit) > k:
                hit = hit[np.lexsort((ids[hit], -scores[hit]))[:k]]
            best = sorted([*best, *zip(scores[hit].tolist(), ids[hit].tolist())], key=lambda r: (-r[0], r[1]))[:k]
            if len(best) == k and (-best[-1][0], best[-1][1]) < (-kth, kth_id):
                kth, kth_id = best[-1]
        return best


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks().flatten()
    return flat.to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _search(k: int):
    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        out: dict[str, list] = {n: [] for n in ("query_id", "vec_id", "score", "kth", "kth_id")}
        if rows.num_rows and queries.num_rows:
            tree = Tree(rows["vec_id"].to_numpy(), _matrix(rows["x"]))
            q, own = _matrix(queries["query"]), queries["query_id"].to_pylist()
            kth, kth_id = queries["kth"].to_pylist(), queries["kth_id"].to_pylist()
            for lo in range(0, len(own), 512):
                bound = tree.bounds(q[lo : lo + 512])
                for i in range(lo, min(lo + 512, len(own))):
                    for score, vec in tree.search(own[i], q[i], bound[i - lo], k, kth[i], kth_id[i]):
                        for name, v in zip(out, (own[i], vec, score, kth[i], kth_id[i])):
                            out[name].append(v)
        kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64()]
        return pa.table({n: pa.array(v, t) for (n, v), t in zip(out.items(), kinds)})

    return run


def integer_vectors(embeddings: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, x): floor(scale * component) as doubles; rows with a null id, null vector, or null or non-finite component are left out."""
    x = F.col("embedding").cast("array<double>")
    # A comparison with infinity is false for NaN's negation and for infinities, null for nulls.
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return embeddings.where(F.col("vec_id").isNotNull() & (F.size(x) > 0) & finite).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda v: F.floor(v * float(scale)).cast("double")).alias("x"))


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, shard_rows: int = SHARD_ROWS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """query_id, rank, vec_id, score (long) of each query's k best other rows; ties go to the smaller id.

    ``vectors``: vec_id long, x array<double> of whole numbers, so that scores are exact.
    Vectors of another length than the query's are no candidates of it.  Rows with
    the query's id are its own; exact repeats of a row count once.
    """
    rows = materialize(vectors.select("vec_id", "x", is_query.alias("__query")).dropDuplicates(["vec_id", "x"]), "knn-rows")
    counts = rows.groupBy().agg(F.count("*").alias("n"), F.count_if("__query").alias("q")).first()
    shards, blocks = -(-counts["n"] // shard_rows) or 1, -(-counts["q"] // block_queries) or 1
    dim = F.size("x").alias("dim")
    shard = F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int")
    block = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).cast("int")
    base = rows.select("vec_id", "x", dim, shard.alias("shard"))
    asked = rows.where("__query").select(F.col("vec_id").alias("query_id"), F.col("x").alias("query"), dim, shard.alias("home"), block.alias("block"))
    # Every shard meets every block of queries once.
    placed = base.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    key = ["dim", "shard", "block"]
    start = asked.withColumns({"shard": F.col("home"), "kth": F.lit(float("-inf")), "kth_id": F.lit(2**63 - 1)})
    at_home = placed.groupBy(*key).cogroup(start.groupBy(*key)).applyInArrow(_search(k), FOUND)
    at_home = materialize(at_home.select("query_id", "vec_id", "score"), "knn-home")
    if shards == 1:
        found = at_home
    else:
        last = at_home.groupBy("query_id").agg(F.count("*").alias("n"), F.max(F.struct(-F.col("score"), "vec_id")).alias("last"))
        full = F.coalesce(F.col("n") == k, F.lit(False))
        others = asked.join(last, "query_id", "left").select(
            "query_id", "query", "dim", "block", "home",
            F.when(full, -F.col("last")["col1"]).otherwise(float("-inf")).alias("kth"),
            F.when(full, F.col("last")["vec_id"]).otherwise(2**63 - 1).alias("kth_id"),
        ).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).where("shard <> home")
        away = placed.groupBy(*key).cogroup(others.groupBy(*key)).applyInArrow(_search(k), FOUND)
        found = at_home.unionByName(away.select("query_id", "vec_id", "score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", F.col("score").cast("long").alias("score"))
