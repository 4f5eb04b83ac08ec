"""Exact top-k inner products with one KD-tree per shard.

Vectors become integers, floor(1024 * x).  Every row goes to a shard by the
hash of its id and each shard task builds a KD-tree: median splits on the
widest side down to small leaves, with the tight box of every node.  For a
query a node's box gives an upper bound of the inner product,
``sum max(q * low, q * high)``; nodes are visited best first and a node whose
bound is below the query's kth score so far is cut, with all nodes after it.

The kth score is propagated: each query first searches one shard (chosen by
its own hash), and that kth score enters the search of all other shards.
Queries meet shards in blocks of ``QUERY_BLOCK``; a task holds one shard and
one block, however many there are.  Each shard returns at most k rows per
query, and the last step ranks them.

Rows whose vector is null, empty, or holds null
or non-finite components take no part, nor do those of another length than the
most common one.  Ties go to the smaller id; rows with
the same id are each candidates (all rows but the query's own: rows that share
the query's id are excluded as its own).  With fewer rows than k all are
returned; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import table

K = 10
LEAF = 128
#: Rows of one shard and queries of one block: both bound what a task holds.
SHARD_ROWS = 50_000
QUERY_BLOCK = 2_000


class KdTree:
    """Median splits with tight boxes over integer vectors; leaves are slices of the reordered rows."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf: int = LEAF):
        self.order = np.arange(len(ids))
        self.low: list[np.ndarray] = []
        self.high: list[np.ndarray] = []
        self.span: list[tuple[int, int]] = []
        todo = [(0, len(ids), -1)]
        links: dict[int, list[int]] = {}
        while todo:
            a, b, parent = todo.pop()
            part = vectors[self.order[a:b]]
            node = len(self.span)
            low, high = part.min(axis=0), part.max(axis=0)
            self.low.append(low)
            self.high.append(high)
            self.span.append((a, b))
            links[node] = []
            if parent >= 0:
                links[parent].append(node)
            axis = int((high - low).argmax())
            if b - a > leaf and high[axis] > low[axis]:
                mid = (b - a) // 2
                by = np.argpartition(part[:, axis], mid)
                self.order[a:b] = self.order[a:b][by]
                todo += [(a, a + mid, node), (a + mid, b, node)]
        self.kids = [tuple(links[n]) for n in range(len(self.span))]
        self.low, self.high = np.array(self.low), np.array(self.high)
        self.ids, self.vectors = ids[self.order], vectors[self.order]

    def search(self, query_id: int, q: np.ndarray, k: int, floor: int | None) -> list[tuple[int, int]]:
        """The best ``(score, id)``, at most k and none below ``floor``."""
        bound = np.maximum(self.low * q, self.high * q).sum(axis=1)
        best: list[tuple[int, int]] = []  # heap of (score, -id)
        queue = [(-int(bound[0]), 0)]
        while queue:
            upper, node = heapq.heappop(queue)
            least = best[0][0] if len(best) == k else floor
            if least is not None and -upper < least:
                break
            if self.kids[node]:
                for child in self.kids[node]:
                    heapq.heappush(queue, (-int(bound[child]), child))
                continue
            a, b = self.span[node]
            score = self.vectors[a:b] @ q
            ids = self.ids[a:b]
            ok = ids != query_id
            if least is not None:
                ok &= score >= least
            at = np.flatnonzero(ok)
            if len(at) > k:
                at = at[np.lexsort((ids[at], -score[at]))[:k]]
            for i in at:
                item = (int(score[i]), -int(ids[i]))
                if len(best) < k:
                    heapq.heappush(best, item)
                elif item > best[0]:
                    heapq.heapreplace(best, item)
        return [(s, -i) for s, i in best]


def integer_vectors(df: DataFrame, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, v array<long>`` of the rows whose vectors are whole and finite."""
    x = F.transform(F.col(vector), lambda c: c.cast("double"))
    ok = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return (df.filter(F.col(id_col).isNotNull() & F.col(vector).isNotNull()).select(F.col(id_col).cast("long").alias("vec_id"), x.alias("x"))
            .filter((F.size("x") > 0) & ok)
            .select("vec_id", F.transform("x", lambda c: F.floor(c * 1024).cast("long")).alias("v")))


_SCHEMA = "query_id long, vec_id long, score long"


def _matrix(col: pa.ChunkedArray) -> np.ndarray:
    flat = pa.chunked_array([c.flatten() for c in col.chunks]).to_numpy()
    return flat.reshape(len(col), -1) if len(col) else np.zeros((0, 1), np.int64)


def _search_group(k: int):
    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int]] = []
        if rows.num_rows and queries.num_rows:
            tree = KdTree(rows.column("vec_id").to_numpy(), _matrix(rows.column("v")))
            floors = queries.column("floor").to_pylist()
            for i, q, f in zip(queries.column("query_id").to_pylist(), _matrix(queries.column("q")), floors, strict=True):
                out += [(i, vec, s) for s, vec in tree.search(i, q, k, f)]
        cols = list(zip(*out, strict=True)) or [[], [], []]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("query_id", "vec_id", "score"), cols, strict=True)})

    return run


def top_k(rows: DataFrame, queries: DataFrame, k: int = K, shard_rows: int = SHARD_ROWS,
          query_block: int = QUERY_BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score`` for ``queries(query_id, q)`` against ``rows(vec_id, v)``."""
    sizes = rows.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").first()
    dim, n_rows = (sizes.dim, sizes.n) if sizes else (0, 0)
    rows, queries = rows.filter(F.size("v") == dim), queries.filter(F.size("q") == dim)
    n_queries = queries.count()
    shards = max(-(-n_rows // shard_rows), min(16, -(-n_rows // 2_000)), 1)
    blocks = max(1, -(-n_queries // query_block))
    shard = F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int")
    block = F.pmod(F.xxhash64("query_id", F.lit(1)), F.lit(blocks)).cast("int")
    home = F.pmod(F.xxhash64("query_id", F.lit(2)), F.lit(shards)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    placed = rows.select(shard.alias("shard"), every.alias("block"), "vec_id", "v")
    asked = queries.select(block.alias("block"), home.alias("home"), "query_id", "q")

    def search(q: DataFrame) -> DataFrame:
        return (placed.groupBy("shard", "block").cogroup(q.groupBy("shard", "block"))
                .applyInArrow(_search_group(k), _SCHEMA))

    near = search(asked.select(F.col("home").alias("shard"), "block", "query_id", "q", F.lit(None).cast("long").alias("floor")))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    floors = (near.withColumn("r", F.row_number().over(best)).groupBy("query_id")
              .agg(F.max(F.when(F.col("r") == k, F.col("score"))).alias("floor")))
    others = (asked.join(floors, "query_id", "left")
              .select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), "block", "query_id", "q", "floor"))
    found = search(others)
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op7_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best rows for every row of ``embeddings`` whose id is divisible by 100."""
    rows = integer_vectors(table(spark, sf_dir, "embeddings"))
    queries = rows.filter(F.col("vec_id") % 100 == 0).select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"))
    return top_k(rows, queries)


OP7_SQL = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 10
"""
