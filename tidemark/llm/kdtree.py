"""Exact top-k by inner product with a KD-tree per shard.

Vectors are dealt to shards by a hash of their row, about `shard_rows` each, apart by length. A shard's tree
splits at the median of its widest dimension; every node has the tight box of its vectors and their smallest
id. The inner product of a query with anything in a box is at most the sum of max(q * low, q * high), so a
best-first walk stops at the first box that cannot beat the k-th score found.

Two rounds spread the k-th score: each query first walks one shard, and what it finds there is where all other
walks begin. A task streams the queries past its shard, so it holds one shard and one batch; results are k rows
per query and shard at most, merged by a grouped top-k.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import stored, table
from tidemark.llm.registry import query

K = 5
EVERY = 50  # queries: ids that this divides
SCALE = 256
SHARD_ROWS = 8192
LEAF_ROWS = 64
_EXACT = 2.0 ** 52  # sums of products up to here are exact in doubles


class Tree:
    """Median splits with tight boxes. points: int64 or object array (n, d), in the order of rising ids. keys tell rows apart."""

    def __init__(self, ids: np.ndarray, points: np.ndarray, keys: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.points, self.keys = ids[order], points[order], keys[order]
        self.low, self.high, self.least, self.children, self.leaf = [], [], [], [], []
        self._grow(np.arange(len(ids)))
        self.low, self.high = np.array(self.low), np.array(self.high)
        self.floats = None
        if self.points.dtype != object:
            self.top = int(np.abs(self.points).max(initial=0))
            self.floats = [a.astype(float) for a in (self.low, self.high, self.points)]

    def _grow(self, rows: np.ndarray) -> int:
        node, own = len(self.children), self.points[rows]
        low, high = own.min(axis=0), own.max(axis=0)
        self.low.append(low), self.high.append(high), self.least.append(int(self.ids[rows].min()))
        self.children.append(()), self.leaf.append(None)
        spread = high - low
        if len(rows) <= LEAF_ROWS or not spread.any():  # equal points stay one leaf; its box is a point
            self.leaf[node] = np.sort(rows)
            return node
        axis = int(np.argmax(spread))
        order = np.argsort(own[:, axis], kind="stable")
        half = len(rows) // 2
        self.children[node] = (self._grow(rows[order[:half]]), self._grow(rows[order[half:]]))
        return node

    def search(self, own: int, q: np.ndarray, k: int, floor: tuple | None) -> list[tuple]:
        """The k best (score, -id), the row whose key is `own` aside. floor: the k-th of another shard; nothing below it is looked for."""
        exact = self.floats is not None and q.dtype != object and (
            float(self.top) * float(np.abs(q).max(initial=0)) * max(1, len(q)) < _EXACT)
        if exact:
            low, high, points = self.floats
            q = q.astype(float)
        else:
            low, high, points, q = (a.astype(object) for a in (self.low, self.high, self.points, q))
        plus, minus = np.where(q > 0, q, 0), np.where(q > 0, 0, q)
        bounds = high @ plus + low @ minus
        best: list[tuple] = []
        kth = floor
        heap = [(-bounds[0], self.least[0], 0)]
        while heap:
            bound, least, node = heapq.heappop(heap)
            if kth is not None and (-bound, -least) < kth:
                if -bound < kth[0]:
                    break  # and so is every box still in the heap
                continue
            if self.children[node]:
                for c in self.children[node]:
                    heapq.heappush(heap, (-bounds[c], self.least[c], c))
                continue
            rows = self.leaf[node]
            scores = points[rows] @ q
            keep = np.argsort(-scores, kind="stable")[: k + 1]  # rows rise by id, so ties go to the smaller
            for i in keep:
                found = (int(scores[i]), -int(self.ids[rows[i]]))
                if self.keys[rows[i]] == own or kth is not None and found < kth:
                    continue
                if len(best) < k:
                    heapq.heappush(best, found)
                elif found > best[0]:
                    heapq.heapreplace(best, found)
                if len(best) == k and (kth is None or best[0] > kth):
                    kth = best[0]
        return best


def quantized(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id and v = floor(256 * x) of every component."""
    x = F.transform(embedding, lambda e: e.cast("double"))
    finite = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != float("inf")))
    # a long holds what the contract can score; larger components are cut to its range
    v = F.transform(x, lambda e: F.floor(F.greatest(F.least(e * SCALE, F.lit(9.2e18)), F.lit(-9.2e18))))
    return (vectors.where(F.col(vec_id).isNotNull() & F.col(embedding).isNotNull() & finite)
            .select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v")))


def _matrix(column: pa.ListArray, d: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), d)


_FOUND = "query_row long, query_id long, vec_id long, score long"
_RANGE = (1 << 63) - 1


def _walk(k: int):
    """Batches sorted by (dims, shard, is_query): a shard's vectors, then its queries."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parts, tree = None, [], None
        for batch in batches:
            dims, shard, is_query = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            step = np.flatnonzero((np.diff(dims) != 0) | (np.diff(shard) != 0) | (np.diff(is_query) != 0)) + 1
            for a, b in zip([0, *step], [*step, len(dims)]):
                if a == b:
                    continue
                if key != (dims[a], shard[a]):
                    key, parts, tree = (dims[a], shard[a]), [], None
                part = batch.slice(a, b - a)
                ids, points, keys = part.column(3).to_numpy(), _matrix(part.column(4), int(dims[a])), part.column(7).to_numpy()
                if not is_query[a]:
                    parts.append((ids, points, keys))
                    continue
                if tree is None and parts:
                    tree = Tree(*[np.concatenate([p[i] for p in parts]) for i in range(3)])
                if tree is None:
                    continue
                out = []
                for own, row, q, s, v in zip(ids, keys, points, part.column(5).to_pylist(), part.column(6).to_pylist()):
                    for score, minus in tree.search(int(row), q, k, None if s is None else (s, -v)):
                        out.append((int(row), int(own), -minus, max(-_RANGE, min(_RANGE, score))))
                if out:
                    cols = list(zip(*out))
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["query_row", "query_id", "vec_id", "score"])
    return run


def top_k(vectors: DataFrame, k: int = K, every: int = EVERY, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k highest inner products of each query, ties to the smaller id.

    Queries are the ids that `every` divides, candidates all other rows. Null ids, null vectors and vectors with a
    null or non-finite component take no part. Rows that repeat an id, or all of a row, are queries and candidates
    each; only a query's own row is none for it. Vectors of different lengths do not meet. Scores are exact; one that leaves the range of
    a long is given as its end. Fewer than k others: all of them; none, or an empty table: no rows.
    """
    spark = vectors.sparkSession
    own = stored(quantized(vectors).withColumn("row", F.monotonically_increasing_id()), "vectors")  # written, so that numbers stay
    own = own.withColumn("dims", F.size("v"))
    counts = own.groupBy("dims").count().withColumn("shards", F.ceil(F.col("count") / shard_rows).cast("int"))
    # one row per length of vector
    own = own.join(counts.select("dims", "shards"), "dims").withColumn("shard", F.pmod(F.xxhash64("row"), "shards").cast("int"))
    own = stored(own, "shards")
    queries = own.where(F.col("vec_id") % every == 0)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    none = F.lit(None).cast("long")

    def walk(asked: DataFrame) -> DataFrame:
        columns = ["dims", "shard", "is_query", "vec_id", "v", "floor_score", "floor_id", "row"]
        rows = own.withColumns({"is_query": F.lit(0), "floor_score": none, "floor_id": none}).select(columns).unionByName(
            asked.withColumn("is_query", F.lit(1)).select(columns))
        dealt = rows.repartition(n, "dims", "shard").sortWithinPartitions("dims", "shard", "is_query")
        return dealt.mapInArrow(_walk(k), _FOUND)

    first = stored(walk(queries.withColumns({"floor_score": none, "floor_id": none})), "first")
    by_score = W.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    kth = (first.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") == k)
           .select(F.col("query_row").alias("row"), F.col("score").alias("floor_score"), F.col("vec_id").alias("floor_id")))
    others = (queries.join(kth, "row", "left").withColumnRenamed("shard", "_home")
              .withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1))).where("shard <> _home"))
    found = first.unionByName(walk(others))
    return (found.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


_SQL = f"""
WITH own AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (SELECT q.r, q.vec_id AS query_id, c.vec_id, list_dot_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
    FROM own q, own c WHERE q.vec_id % {EVERY} = 0 AND q.r <> c.r AND len(q.v) = len(c.v))
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM pairs) WHERE rank <= {K}"""


@query(_SQL)
def op4_kd_tree_search(spark, sf_dir):
    return top_k(table(spark, sf_dir, "embeddings"))
