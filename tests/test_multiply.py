import numpy as np
import pytest

from conftest import from_dense, ma, mb, to_dense
from tessera.matrix import Matrix, transpose
from tessera.operators.elementwise import add
from tessera.operators.multiply import find_hot_keys, multiply
from tessera.sources.generate import generate_int, identity


def test_golden_2x2_3x3(spark):
    a = from_dense(spark, [[1, 2], [3, 4]])
    b = from_dense(spark, [[5, 6], [7, 8]])
    np.testing.assert_array_equal(to_dense(multiply(a, b)), [[19, 22], [43, 50]])
    x = np.array([[1, 0, 2], [0, 3, 0], [4, 0, 5]])
    y = np.array([[2, 1, 0], [0, 1, 0], [1, 0, 3]])
    np.testing.assert_array_equal(to_dense(multiply(from_dense(spark, x), from_dense(spark, y))), x @ y)


def test_identity_zero_one_by_one(spark):
    a = generate_int(spark, 5, value_type="double")
    np.testing.assert_array_equal(to_dense(multiply(a, identity(spark, 5))), ma(5))
    zero = Matrix(spark.createDataFrame([], "row int, col int, value double"), 5, 5)
    assert multiply(a, zero).df.count() == 0
    one = from_dense(spark, [[3]])
    assert multiply(one, one).df.first()["value"] == 9.0


def test_rectangular_and_inner_check(spark):
    a = generate_int(spark, 2, 3, value_type="double")
    b = generate_int(spark, 3, 4, a=13, b=29, value_type="double")
    np.testing.assert_array_equal(to_dense(multiply(a, b)), ma(2, 3) @ mb(3, 4))
    with pytest.raises(ValueError):
        multiply(a, a)


def test_sparsity_only_matching_k(spark):
    a = from_dense(spark, [[1, 0], [0, 0]])
    b = from_dense(spark, [[0, 0], [0, 1]])
    assert multiply(a, b).df.count() == 0


def test_distributive_and_transpose_laws(spark):
    a, b = generate_int(spark, 6, value_type="double"), generate_int(spark, 6, a=13, b=29, value_type="double")
    c = generate_int(spark, 6, a=3, b=5, c=1, value_type="double")
    lhs = to_dense(multiply(add(a, b), c))
    rhs = to_dense(add(multiply(a, c), multiply(b, c)))
    np.testing.assert_array_equal(lhs, rhs)
    np.testing.assert_array_equal(to_dense(transpose(multiply(a, b))), to_dense(multiply(transpose(b), transpose(a))))


def test_self_product_reuses_one_operand(spark):
    a = generate_int(spark, 7, 3, value_type="double")
    np.testing.assert_array_equal(to_dense(multiply(transpose(a), a)), ma(7, 3).T @ ma(7, 3))


def test_bigint_exact_and_overflow_raises(spark):
    a = generate_int(spark, 8)
    c = multiply(a, a)
    assert c.value_type == "bigint"
    np.testing.assert_array_equal(to_dense(c), ma(8) @ ma(8))
    big = spark.createDataFrame([(0, 0, 2 ** 62)], "row int, col int, value bigint")
    m = Matrix(big, 1, 1)
    with pytest.raises(Exception) as e:
        multiply(m, m).df.collect()
    assert "overflow" in str(e.value).lower()


def test_duplicates_are_summed_bilinearly(spark):
    a = Matrix(spark.createDataFrame([(0, 0, 1.0), (0, 0, 2.0)], "row int, col int, value double"), 1, 1)
    b = from_dense(spark, [[5]])
    assert multiply(a, b).df.first()["value"] == 15.0


def test_hot_keys_are_salted_exactly(spark):
    # inner key 0 holds most of A's cells: a hot key
    rows = [(i, 0, float(i % 7 + 1)) for i in range(400)] + [(i, 1 + i % 3, 1.0) for i in range(40)]
    a = Matrix(spark.createDataFrame(rows, "row int, col int, value double"), 400, 4)
    b = from_dense(spark, np.arange(1, 4 * 30 + 1).reshape(4, 30) % 11)
    hot = find_hot_keys(a, b, min_products_per_task=100, tasks=16)
    assert any(h.k == 0 and h.salts > 1 for h in hot)
    salted = multiply(a, b, skew="salt", broadcast_cells=0, min_products_per_task=100, tasks=16)
    plain = multiply(a, b, broadcast_cells=0)
    np.testing.assert_array_equal(to_dense(salted), to_dense(plain))
    assert "salt" in salted.df._jdf.queryExecution().optimizedPlan().toString()


def test_proven_small_side_is_broadcast_before_any_hot_key_search(spark):
    rows = [(i, 0, 1.0) for i in range(50)]
    a = Matrix(spark.createDataFrame(rows, "row int, col int, value double"), 50, 1, unique=True)
    b = Matrix(spark.createDataFrame([(0, j, 1.0) for j in range(50)], "row int, col int, value double"), 1, 50, unique=True)
    sc = spark.sparkContext
    before = len(sc.statusTracker().getJobIdsForGroup(None))
    c = multiply(a, b, skew="salt", min_products_per_task=1, tasks=16)
    assert len(sc.statusTracker().getJobIdsForGroup(None)) == before  # no statistics jobs
    assert "BroadcastHashJoin" in c.df._jdf.queryExecution().sparkPlan().toString()
    assert c.df.count() == 2500


def test_broadcast_only_with_shape_bound(spark):
    a = generate_int(spark, 30, value_type="double")
    small = generate_int(spark, 30, a=13, b=29, value_type="double")
    plan = multiply(a, small).df._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan
    unknown = Matrix(small.df)  # no shape: no proven bound, no broadcast hint
    plan2 = multiply(a, unknown, broadcast_cells=10).df._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" in plan2
    np.testing.assert_array_equal(to_dense(multiply(a, small)), ma(30) @ mb(30))


def test_gram_equals_full_product(spark):
    from tessera.operators.multiply import gram
    a = generate_int(spark, 9, 5, value_type="double")
    x = ma(9, 5)
    np.testing.assert_array_equal(to_dense(gram(a)), x @ x.T)
    np.testing.assert_array_equal(to_dense(gram(a, transpose_first=True)), x.T @ x)
    # same cell set as the general multiply, also on the shuffle and salted paths
    sparse = from_dense(spark, np.array([[1, 0, 2], [0, 0, 3], [4, 0, 0], [0, 0, 0]]))
    want = multiply(sparse, transpose(sparse)).df.count()
    for opts in ({}, {"broadcast_cells": 0}, {"broadcast_cells": 0, "skew": "salt", "min_products_per_task": 1, "tasks": 8}):
        g = gram(sparse, **opts)
        assert g.df.count() == want
        np.testing.assert_array_equal(to_dense(g), to_dense(multiply(sparse, transpose(sparse))))
