"""Centroid clustering with heap-ordered bounds.

Vectors become integers, ``floor(scale * x)``.  The first centroids are the
``k`` vectors with the smallest sha256 of ``1:<vec_id>``.  Each round assigns
every vector to the nearest centroid (squared Euclidean distance, ties to the
smaller number) and then moves each non-empty centroid to the componentwise
floor of its vectors' mean; a last assignment ends it.

Vectors lie in blocks, one row of a written table each.  A block keeps one heap
per cluster.  Its entries are gaps, the distance to the second nearest centroid
less that to the own one, found by an exact scan and offset by the cluster's
drift accumulated until then.  When centroids move by ``d``, the gap of a
vector in cluster ``c`` shrinks by at most ``d[c]`` plus the largest move of
any other; that sum is added to the cluster's accumulated drift, one number for
the whole cluster.  An entry above the accumulated drift proves its vector's
assignment; only entries that are not are popped, and those vectors alone are
scanned against all centroids, exactly, in integers.  Gaps are rounded down and
drifts up, so rounding costs scans and never a wrong assignment.

The blocks send sums of what entered and left each cluster, ``k * (dim + 1)``
numbers after aggregation, to the driver, which holds the sums, centroids and
drifts and nothing that grows with the input.  Every round writes the blocks
anew in the shared folder and removes those of the round before; a lost
executor repeats single blocks.

Vectors that are null, of another length than ``dim`` or hold null or
non-finite components take no part.  A row without ``vec_id`` is clustered but
becomes no first centroid unless there are fewer than ``k`` others; rows that
share an id are separate vectors, ordered by their components among the first
centroids.  With fewer vectors than ``k`` there are as many centroids.  An
empty table gives no rows; extra columns are ignored.  Components beyond
``2**27`` in amount, whose squared distances a long cannot hold, raise an error.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import discard, table, written

K, ROUNDS, SCALE, DIM = 16, 3, 64, 64
#: Vectors of a block: what one step holds in memory.
BLOCK = 2048
LARGEST = 1 << 27
#: Relative slack on bounds, far above the rounding of doubles.
SLACK = 1e-9

_STATE = ("ids array<long>, v binary, keys array<double>, members array<int>, ends array<int>, "
          "delta array<long>, scanned long")
_ARROW = pa.schema([("ids", pa.list_(pa.int64())), ("v", pa.binary()), ("keys", pa.list_(pa.float64())),
                    ("members", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32())),
                    ("delta", pa.list_(pa.int64())), ("scanned", pa.int64())])


def integer_vectors(df: DataFrame, dim: int = DIM, scale: int = SCALE, vector: str = "embedding") -> DataFrame:
    """``vec_id, v array<long>`` of the rows that take part."""
    x = F.transform(F.col(vector), lambda c: c.cast("double"))
    ok = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    small = F.forall("x", lambda c: F.abs(c * scale) < F.lit(float(LARGEST)))
    whole = F.transform("x", lambda c: F.floor(c * scale).cast("long"))
    return (df.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"))
            .filter(F.col("x").isNotNull() & (F.size("x") == dim)).filter(ok)
            .select("vec_id", F.when(small, whole).otherwise(F.raise_error(F.lit("a component is too large to square"))).alias("v")))


def scan(v: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest centroid (smaller number on ties), its squared distance and the second smallest one (infinite for k = 1)."""
    top = max(int(np.abs(v).max(initial=0)), int(np.abs(centroids).max(initial=0)))
    if 4 * top * top * v.shape[1] < 1 << 52:  # every sum is a whole number that a double holds
        x, c = v.astype(np.float64), centroids.astype(np.float64)
    else:
        x, c = v.astype(np.int64), centroids
    d = (x * x).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c * c).sum(axis=1)
    best = d.argmin(axis=1)
    at = np.arange(len(v))
    first = d[at, best]
    if d.shape[1] == 1:
        return best, first, np.full(len(v), np.inf)
    other = d.astype(np.float64)
    other[at, best] = np.inf
    return best, first, other.min(axis=1)


@dataclass(frozen=True)
class Model:
    """Centroids and, per cluster, the drift accumulated since the first round."""

    centroids: np.ndarray
    drift: tuple[float, ...]

    def moved(self, centroids: np.ndarray) -> Model:
        step = [math.sqrt(sum((int(a) - int(b)) ** 2 for a, b in zip(new, old, strict=True))) * (1 + SLACK)
                for new, old in zip(centroids, self.centroids, strict=True)]
        others = [max((s for j, s in enumerate(step) if j != c), default=0.0) for c in range(len(step))]
        return Model(centroids, tuple((a + s + o) * (1 + SLACK) for a, s, o in zip(self.drift, step, others, strict=True)))

    def entries(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cluster and heap key of each vector, by an exact scan."""
        best, first, second = scan(v, self.centroids)
        near, far = np.sqrt(first.astype(np.float64)), np.sqrt(second)
        offset = np.array(self.drift)[best]
        return best, (far - near) + offset - SLACK * (np.where(np.isinf(far), 0, far) + near + offset + 1)


class Block:
    """Some vectors and one heap of ``(key, member)`` per cluster."""

    def __init__(self, v: np.ndarray, heaps: list[list[tuple[float, int]]]):
        self.v, self.heaps, self.scanned = v, heaps, 0
        self.sums = np.zeros((len(heaps), v.shape[1]), np.int64)
        self.counts = np.zeros(len(heaps), np.int64)

    @classmethod
    def first(cls, v: np.ndarray, model: Model) -> Block:
        block = cls(v, [[] for _ in model.centroids])
        block._enter(np.arange(len(v)), model)
        return block

    @classmethod
    def read(cls, row: dict, dim: int) -> Block:
        n = len(row["ids"])
        v = np.frombuffer(row["v"], f"<i{len(row['v']) // (n * dim)}").reshape(n, dim).astype(np.int64)
        entries = list(zip(row["keys"], row["members"], strict=True))
        return cls(v, [entries[a:b] for a, b in zip(row["ends"][:-1], row["ends"][1:], strict=True)])

    def _enter(self, members: np.ndarray, model: Model) -> None:
        best, keys = model.entries(self.v[members])
        self.scanned += len(members)
        np.add.at(self.sums, best, self.v[members])
        self.counts += np.bincount(best, minlength=len(self.heaps))
        for c, entry in zip(best.tolist(), zip(keys.tolist(), members.tolist()), strict=True):
            heapq.heappush(self.heaps[c], entry)

    def step(self, model: Model) -> None:
        """Pop every entry that the drift has reached and scan its vector."""
        popped: list[int] = []
        for c, (heap, drift) in enumerate(zip(self.heaps, model.drift, strict=True)):
            before = len(popped)
            while heap and heap[0][0] <= drift:
                popped.append(heapq.heappop(heap)[1])
            left = popped[before:]
            self.sums[c] -= self.v[left].sum(axis=0)
            self.counts[c] -= len(left)
        if popped:
            self._enter(np.array(popped), model)

    def row(self, ids: list) -> dict:
        entries = [e for heap in self.heaps for e in heap]
        size = next(s for s in (2, 4) if -(1 << 8 * s - 1) <= self.v.min() and self.v.max() < 1 << 8 * s - 1)
        return {"ids": ids, "v": self.v.astype(f"<i{size}").tobytes(), "keys": [k for k, _ in entries],
                "members": [m for _, m in entries], "ends": [0, *np.cumsum([len(h) for h in self.heaps]).tolist()],
                "delta": np.concatenate([self.sums.ravel(), self.counts]).tolist(), "scanned": self.scanned}

    def assigned(self, model: Model) -> tuple[np.ndarray, np.ndarray]:
        """Cluster and exact squared distance of each vector."""
        cluster = np.zeros(len(self.v), np.int64)
        for c, heap in enumerate(self.heaps):
            cluster[[m for _, m in heap]] = c
        return cluster, ((self.v - model.centroids[cluster]) ** 2).sum(axis=1)


def _begin(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                b = batch.slice(at, BLOCK)
                v = b.column("v").flatten().to_numpy().reshape(b.num_rows, -1)
                row = Block.first(v, model).row(b.column("vec_id").to_pylist())
                yield pa.RecordBatch.from_pylist([row], schema=_ARROW)

    return run


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield from batch.slice(i, 1).to_pylist()


def _step(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _each(batches):
            block = Block.read(row, model.centroids.shape[1])
            block.step(model)
            yield pa.RecordBatch.from_pylist([block.row(row["ids"])], schema=_ARROW)

    return run


def _finish(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _each(batches):
            block = Block.read(row, model.centroids.shape[1])
            block.step(model)
            cluster, distance = block.assigned(model)
            yield pa.RecordBatch.from_arrays([pa.array(row["ids"], pa.int64()), pa.array(cluster.astype(np.int32)), pa.array(distance)],
                                             names=["vec_id", "cluster", "distance"])

    return run


def first_centroids(vectors: DataFrame, k: int = K) -> list[list[int]]:
    """``k`` vectors by ascending sha256 of ``1:<vec_id>``."""
    key = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256)
    return [r.v for r in vectors.orderBy(key.asc_nulls_last(), "v").limit(k).collect()]


def _deltas(state: DataFrame) -> list[int]:
    """Per sum, what all blocks add to it: as many rows as there are sums."""
    sums = state.select(F.posexplode("delta")).groupBy("pos").agg(F.sum(F.col("col").cast("decimal(38,0)")).alias("s")).collect()
    return [int(r.s) for r in sorted(sums)]


def cluster(vectors: DataFrame, k: int = K, rounds: int = ROUNDS) -> tuple[DataFrame, list[list[int]], list[int]]:
    """``vec_id, cluster, distance`` per row of ``vectors(vec_id, v)``, the final centroids, and how many
    vectors each assignment but the last had to scan."""
    spark = vectors.sparkSession
    start = first_centroids(vectors, k)
    if not start:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long"), [], []
    n, dim = len(start), len(start[0])
    model = Model(np.array(start, np.int64), (0.0,) * n)
    state = written(spark, vectors.mapInArrow(_begin(model), _STATE), "blocks")
    sums, scanned = [0] * (n * (dim + 1)), []
    for left in range(rounds, 0, -1):
        sums = [a + b for a, b in zip(sums, _deltas(state), strict=True)]
        scanned.append(state.agg(F.sum("scanned")).first()[0])
        new = [[s // sums[n * dim + c] for s in sums[c * dim:(c + 1) * dim]] if sums[n * dim + c] else model.centroids[c].tolist()
               for c in range(n)]
        model = model.moved(np.array(new, np.int64))
        after = (written(spark, state.mapInArrow(_step(model), _STATE), "blocks") if left > 1 else
                 written(spark, state.mapInArrow(_finish(model), "vec_id long, cluster int, distance long"), "assigned"))
        discard(spark, state)
        state = after
    return state, model.centroids.tolist(), scanned


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixteen clusters of ``embeddings`` after three rounds."""
    rows, centroids, _ = cluster(integer_vectors(table(spark, sf_dir, "embeddings")))
    inertia = {r.cluster: int(r.s) for r in rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]

    def of_cluster(values: list, kind: str) -> F.Column:
        return F.element_at(F.array(*map(F.lit, values)).cast(f"array<{kind}>"), F.col("cluster") + 1)

    return rows.select("vec_id", "cluster", "distance",
                       of_cluster([inertia.get(c, 0) for c in range(len(centroids))], "long").alias("cluster_inertia"),
                       F.lit(sum(inertia.values())).cast("long").alias("inertia"),
                       of_cluster(digest, "string").alias("centroid_sha256"))


def _sql(k: int = K, rounds: int = ROUNDS) -> str:
    near = """
a{r} AS (
    SELECT u, min({{'d': d, 'c': c}}) AS best
    FROM (SELECT u, c, list_sum(list_transform(list_zip(v.v, m.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d
          FROM v CROSS JOIN m{r} m) GROUP BY u)"""
    move = """
s{r} AS (
    SELECT best.c AS c, i, sum(v[i]) AS s, count(*)::HUGEINT AS n
    FROM a{r} JOIN v USING (u), unnest(range(1, len(v) + 1)) AS t(i) GROUP BY 1, 2),
m{next} AS (
    SELECT m.c, coalesce(x.v, m.v) AS v FROM m{r} m LEFT JOIN (
        SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS v FROM s{r} GROUP BY c) x USING (c))"""
    steps = [near.format(r=0)]
    for r in range(rounds):
        steps += [move.format(r=r, next=r + 1), near.format(r=r + 1)]
    return f"""
WITH v AS (
    SELECT row_number() OVER () AS u, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v
    FROM embeddings WHERE len(embedding) = {DIM} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
m0 AS (
    SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id) NULLS LAST, v) - 1 AS c, v FROM v
    QUALIFY c < {k}),{",".join(steps)}
SELECT vec_id, best.c::INTEGER AS cluster, best.d AS distance,
       (sum(best.d) OVER (PARTITION BY best.c))::BIGINT AS cluster_inertia, (sum(best.d) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(m{rounds}.v, ',')) AS centroid_sha256
FROM a{rounds} JOIN v USING (u) JOIN m{rounds} ON m{rounds}.c = best.c
"""


OP11_SQL = _sql()
