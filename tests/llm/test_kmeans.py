"""Centroid clustering against plain loops in whole numbers and against the SQL; heaps scan only what they must."""

import hashlib

import duckdb
import numpy as np
import pytest

from tessera.llm import kmeans as M
from tessera.session import scratch_path


def plain(rows, k=M.K, rounds=M.ROUNDS, dim=M.DIM, scale=M.SCALE):
    """``rows(vec_id, embedding)``: list of (vec_id, cluster, distance), centroids."""
    kept = [(i, [int(np.floor(scale * float(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and np.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    cents = [list(v) for _, v in order[:k]]
    for step in range(rounds + 1):
        d = [[sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in cents] for _, v in kept]
        near = [x.index(min(x)) for x in d]
        if step == rounds:
            break
        for c in range(len(cents)):
            own = [v for (_, v), n in zip(kept, near, strict=True) if n == c]
            if own:
                cents[c] = [sum(col) // len(own) for col in zip(*own, strict=True)]
    return [(i, c, x[c]) for (i, _), c, x in zip(kept, near, d, strict=True)], cents


def _sorted():
    key = lambda t: tuple((x is None, x if x is not None else 0) for x in t)
    return lambda rows: sorted(map(tuple, rows), key=key)


same = _sorted()


def frame(spark, rows, extra=False):
    if extra:
        return spark.createDataFrame([(i, v, "x", 1, 2) for i, v in rows], "vec_id long, embedding array<float>, v string, cluster int, distance int")
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def grid(n, dim, seed, step=0.25):
    r = np.random.default_rng(seed)
    return [(int(i), [float(x) for x in np.round(r.normal(0, 1, dim) / step) * step]) for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_plain_loops(spark, seed):
    rows = grid(150, 3, seed, 0.5)
    rows += rows[:20]                                    # repeated rows: ties in ids, hashes and distances
    rows += [(i, v) for i, v in zip(range(500, 520), [x for _, x in rows[20:40]], strict=True)]  # equal vectors
    rows += [(7, [9.0, 9.0, 9.0]), (None, [1.0, 0.0, 1.0]), (600, None), (601, [1.0, None, 2.0]), (602, [1.0, float("nan"), 0.0]),
             (603, [float("inf"), 0.0, 0.0]), (604, [1.0]), (605, []), (606, [0.1] * 4)]
    vectors = M.integer_vectors(frame(spark, rows, extra=True), dim=3, scale=64)
    got, cents, _ = M.cluster(vectors, k=16)
    want, want_cents = plain(rows, dim=3)
    assert cents == want_cents and same(got.collect()) == same(want)


def test_few_vectors_empty_clusters_and_none(spark):
    for rows in (grid(5, 2, 3), [(i, [1.0, 1.0]) for i in range(40)], [(1, [0.5, 0.5])], [(None, [0.5, 0.5]), (3, None)]):
        got, cents, _ = M.cluster(M.integer_vectors(frame(spark, rows), dim=2), k=16)
        want, want_cents = plain(rows, dim=2)
        assert cents == want_cents and same(got.collect()) == same(want)
    got, cents, _ = M.cluster(M.integer_vectors(frame(spark, []), dim=2), k=16)
    assert got.collect() == [] and cents == [] and got.columns == ["vec_id", "cluster", "distance"]


def test_large_components_are_exact_or_refused(spark):
    rows = [(i, [float(np.float32(x)) for x in np.random.default_rng(i).normal(0, 3e5, 4)]) for i in range(60)]
    got, cents, _ = M.cluster(M.integer_vectors(frame(spark, rows), dim=4), k=4)
    want, want_cents = plain(rows, k=4, dim=4)
    assert cents == want_cents and same(got.collect()) == same(want)
    with pytest.raises(Exception, match="too large"):
        M.cluster(M.integer_vectors(frame(spark, [(1, [1e30, 0.0])]), dim=2), k=2)


def test_only_expired_gaps_are_scanned(spark):
    """Well-parted groups: after the first rounds most gaps outlast the drift, and results stay exact."""
    r = np.random.default_rng(5)
    centre = r.normal(0, 20, (8, 8))
    rows = [(i, [float(x) for x in centre[i % 8] + r.normal(0, 0.2, 8)]) for i in range(1600)]
    vectors = M.integer_vectors(frame(spark, rows), dim=8)
    got, cents, scanned = M.cluster(vectors, k=8, rounds=6)
    want, want_cents = plain(rows, k=8, rounds=6, dim=8)
    assert cents == want_cents and same(got.collect()) == same(want)
    assert scanned[0] == 1600 and scanned[-1] < 400


def test_heap_keys_bound_every_gap():
    """After moves, an entry above its cluster's drift has its own centroid strictly nearest."""
    r = np.random.default_rng(9)
    v = r.integers(-200, 200, (300, 6))
    model = M.Model(r.integers(-200, 200, (7, 6)), (0.0,) * 7)
    block = M.Block.first(v, model)
    for _ in range(12):
        model = model.moved(model.centroids + r.integers(-12, 13, (7, 6)))
        best, first, second = M.scan(v, model.centroids)
        for c, heap in enumerate(block.heaps):
            assert all(heap[i] <= heap[j] for i in range(len(heap)) for j in (2 * i + 1, 2 * i + 2) if j < len(heap))
            for key, m in heap:
                assert key <= model.drift[c] or (best[m] == c and first[m] < second[m])
        block.step(model)
        cluster, distance = block.assigned(model)
        assert (cluster == best).all() and (distance == first).all()


@pytest.mark.parametrize("bad", [False, True])
def test_query_equals_sql(spark, bad):
    rows = grid(300, 64, 11)
    if bad:
        rows += rows[:30] + [(900, None), (901, [0.5] * 63), (902, [float("nan")] + [0.5] * 63), (903, [None] + [0.5] * 63)]
    path = scratch_path(spark, "vectors")
    frame(spark, rows).write.parquet(f"{path}/embeddings.parquet")
    got = M.op11_centroid_clustering(spark, path).toPandas()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{path}/embeddings.parquet/*.parquet')")
    want = con.execute(M.OP11_SQL).df()
    cols = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(got.columns) == sorted(want.columns) == sorted(cols)
    assert same(got[cols].values.tolist()) == same(want[cols].values.tolist())
