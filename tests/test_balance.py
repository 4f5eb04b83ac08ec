"""Work per task: routed keys, output-stationary tiles, and records shuffled by Strassen's levels."""

import os
import sys
from contextlib import contextmanager

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from conftest import from_dense, ma, mb, to_dense
from plan_metrics import executed, shuffled_records
from tessera.functions.tiles import stationary_fn
from tessera.matrix import COL, ROW, Matrix, transpose
from tessera.operators.blocked import FAN_IN, GROUP_TILES, STATIONARY_BYTES, multiply_blocked, multiply_strassen_tiled, plan_grid
from tessera.operators.multiply import gram, multiply, products
from tessera.operators.strassen import operands, strassen
from tessera.sources.generate import generate_int


def skewed(spark, n=600, keys=50):
    """Two matrices whose inner key 0 holds most cells of both."""
    left = [(i, 0, float(i % 5 + 1)) for i in range(n)] + [(i % 40, 1 + i % (keys - 1), 1.0) for i in range(400)]
    right = [(0, j, float(j % 3 + 1)) for j in range(n)] + [(1 + j % (keys - 1), j % 30, 2.0) for j in range(400)]
    schema = "row int, col int, value double"
    return (Matrix(spark.createDataFrame(left, schema).groupBy("row", "col").agg(F.max("value").alias("value")), n, keys),
            Matrix(spark.createDataFrame(right, schema).groupBy("row", "col").agg(F.max("value").alias("value")), keys, n))


@contextmanager
def as_dealt(spark):
    """Tasks as the plan deals them: nothing is merged or broadcast because it is small here."""
    off = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in off}
    for k, v in off.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def per_task(df) -> list[int]:
    return sorted(r["n"] for r in df.groupBy(F.spark_partition_id().alias("t")).agg(F.count(F.lit(1)).alias("n")).collect())


def test_default_product_splits_heavy_keys_exactly(spark):
    a, b = skewed(spark)
    opts = {"broadcast_cells": 0, "min_products_per_task": 10_000}
    with as_dealt(spark):
        routed = per_task(products(a, b, **opts))
        plain = per_task(products(a, b, broadcast_cells=0, skew="aqe"))
    assert sum(routed) == sum(plain) and plain[-1] >= 360_000 > 4 * routed[-1]
    np.testing.assert_array_equal(to_dense(multiply(a, b, **opts)), to_dense(multiply(a, b)))
    # a heavy key on one side only
    thin = Matrix(b.df.filter("row <> 0 or col < 3"), b.n_rows, b.n_cols)
    np.testing.assert_array_equal(to_dense(multiply(a, thin, **opts)), to_dense(multiply(a, thin)))


def test_operands_are_computed_once_and_nothing_runs_before(spark):
    a, _ = skewed(spark)
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for pdf in batches:
            seen.add(len(pdf))
            yield pdf

    counted = Matrix(a.df.mapInPandas(count, "row int, col int, value double"), a.n_rows, a.n_cols)
    c = multiply(transpose(counted), counted, broadcast_cells=0, min_products_per_task=1000)
    assert seen.value == 0  # no counting job when the product is built
    rows, ops = executed(c.df)
    n = a.df.count()
    assert seen.value == n, "each cell of the shared operand is read and shuffled once"
    np.testing.assert_array_equal(to_dense(Matrix(spark.createDataFrame(rows, c.df.schema), c.n_rows, c.n_cols)),
                                  to_dense(multiply(transpose(a), a)))
    assert not any("CartesianProduct" in name or "NestedLoop" in name for name, _ in ops)


@pytest.mark.parametrize("vt", ["double", "bigint"])
def test_gram_routes_heavy_keys(spark, vt):
    a, _ = skewed(spark)
    a = a.cast(vt)
    want = to_dense(a).T @ to_dense(a)
    for opts in ({"min_products_per_task": 500}, {}):
        np.testing.assert_array_equal(to_dense(gram(a, transpose_first=True, broadcast_cells=0, **opts)), want)


def test_strassen_leaf_has_balanced_tasks(spark):
    """A dense row and column make one inner key of every leaf heavy."""
    n = 64
    rows = [(i, 0, 1.0) for i in range(n)] + [(i, 32, 1.0) for i in range(n)] + [(i, i, 2.0) for i in range(1, n) if i != 32]
    a = Matrix(spark.createDataFrame(rows, "row int, col int, value double"), n, n, unique=True)
    b = Matrix(spark.createDataFrame([(c, r, v) for r, c, v in rows], "row int, col int, value double"), n, n, unique=True)
    left = operands(a, "A", 1, drop_zeros=True).select((F.col("path") * 1000 + F.col(ROW)).alias(ROW), (F.col("path") * 1000 + F.col(COL)).alias(COL), "value")
    right = operands(b, "B", 1, drop_zeros=True).select((F.col("path") * 1000 + F.col(ROW)).alias(ROW), COL, "value")
    with as_dealt(spark):
        tasks = per_task(products(Matrix(left), Matrix(right), broadcast_cells=0, min_products_per_task=200, tasks=32))
    busy = [t for t in tasks if t > sum(tasks) / 64]
    assert busy[-1] <= 3 * busy[len(busy) // 2]
    np.testing.assert_array_equal(to_dense(strassen(a, b, levels=1, broadcast_cells=0, min_products_per_task=200, tasks=32)),
                                  to_dense(a) @ to_dense(b))


def test_four_levels_shuffle_about_eleven_records_a_cell(spark):
    n = 64
    a = generate_int(spark, n, value_type="double")
    rows, ops = executed(operands(a, "A", 4))
    assert len(rows) == 7 ** 4 * (n // 16) ** 2
    records = shuffled_records(ops) / n ** 2
    assert records <= sum((7 / 4) ** level for level in range(4)) + 0.01  # 11.2; copies per product would be 81
    c = strassen(a, generate_int(spark, n, a=13, b=29, value_type="double"), levels=4)
    got, ops = executed(c.df)
    np.testing.assert_array_equal(to_dense(Matrix(spark.createDataFrame(got, c.df.schema), n, n)), ma(n) @ mb(n))


def test_grid_bounds():
    for shape in [(1, 1, 1), (1, 10 ** 7, 1), (64, 64, 64), (1000, 3, 2000), (5000, 5000, 5000)]:
        for tile in (16, 64, 512):
            g = plan_grid(*shape, tile, 2000)
            m, k, n = shape
            assert g.side_m * g.side_n == 1 or g.side_m * g.side_n * tile * tile * 8 <= STATIONARY_BYTES
            assert (g.side_m + g.side_n) * -(-k // g.slabs) <= GROUP_TILES + g.side_m + g.side_n
    assert plan_grid(64, 64, 64, 512, 16).side_m > 1  # tiles are shared inside a super-block


@pytest.mark.parametrize("grid", [(1, 1, 1), (2, 3, 1), (4, 4, 5), (1, 2, 40)])
def test_stationary_product_on_any_grid(spark, monkeypatch, grid):
    from tessera.operators import blocked
    monkeypatch.setattr(blocked, "plan_grid", lambda *a, **k: blocked.Grid(*grid))
    a, b = generate_int(spark, 23, 170), generate_int(spark, 170, 31, a=13, b=29)
    want = ma(23, 170) @ mb(170, 31)
    c = multiply_blocked(a, b, tile=4)
    np.testing.assert_array_equal(to_dense(c), want)
    np.testing.assert_array_equal(to_dense(multiply_strassen_tiled(a, b, tile=4, levels=2)), want)


def test_long_inner_dimension_has_no_single_group(spark, monkeypatch):
    """EᵀE over ten times the vectors: the largest group of any step stays the same."""
    from tessera.operators import blocked
    monkeypatch.setattr(blocked, "GROUP_TILES", 32)
    largest = {}
    for n in (2_000, 20_000):
        e = generate_int(spark, n, 8, value_type="double")
        grid = blocked.plan_grid(1, -(-n // 8), 1, 8, 16)
        assert 2 * -(-(-(-n // 8)) // grid.slabs) <= 32 + 2  # tiles streamed by a group
        c = multiply_blocked(transpose(e), e, tile=8)
        _, ops = executed(c.df)
        groups = sum("FlatMapGroupsInPandas" in name for name, _ in ops)
        assert groups == -(-int(np.log(max(grid.slabs, 2))) // int(np.log(FAN_IN)))  # levels of the tree
        largest[n] = grid.slabs
        np.testing.assert_array_equal(to_dense(c), ma(n, 8).T @ ma(n, 8))
    assert largest[20_000] >= 9 * largest[2_000]


def test_each_block_of_c_leaves_its_group_once():
    import pyarrow as pa
    b, rows = 2, []
    for bk in range(50):
        for side, idx in ((0, 0), (0, 1), (1, 0)):
            rows.append((0, 0, 0, 0, bk, side, idx, [0, 3], [1.0, 2.0]))
    names = ["path", "si", "sj", "slab", "bk", "side", "idx", "pos", "val"]
    batch = pa.RecordBatch.from_pydict({n: [r[i] for r in rows] for i, n in enumerate(names)})
    batch = batch.set_column(7, "pos", batch.column("pos").cast(pa.list_(pa.int32())))
    out = list(stationary_fn(b, "double", None)(iter([batch.slice(0, 40), batch.slice(40, 61), batch.slice(101)])))
    assert [(r.column("bi")[0].as_py(), r.column("bj")[0].as_py()) for r in out] == [(0, 0), (1, 0)]
    for r in out:
        np.testing.assert_array_equal(np.frombuffer(r.column("tile")[0].as_py()).reshape(2, 2), [[50, 0], [0, 200]])


def test_tiled_strassen_forms_all_seven_products(spark):
    a = from_dense(spark, np.random.default_rng(3).integers(-9, 9, (21, 18)))
    b = from_dense(spark, np.random.default_rng(4).integers(-9, 9, (18, 25)))
    for levels in (1, 2, 3):
        np.testing.assert_array_equal(to_dense(multiply_strassen_tiled(a, b, tile=3, levels=levels)), to_dense(a) @ to_dense(b))
