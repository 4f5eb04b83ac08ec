"""Seeded property tests: every multiplication form equals numpy on random operands."""

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import from_dense, to_dense
from tessera.operators.blocked import multiply_blocked, multiply_strassen_tiled
from tessera.operators.elementwise import add, subtract
from tessera.operators.multiply import multiply
from tessera.operators.quadrants import merge, split
from tessera.operators.strassen import strassen

shapes = st.tuples(st.integers(1, 9), st.integers(1, 9), st.integers(1, 9))


def _operand(rng, r, c, density):
    x = rng.integers(-20, 20, size=(r, c))
    x[rng.random((r, c)) > density] = 0
    return x


@settings(max_examples=8, deadline=None, derandomize=True,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(shape=shapes, levels=st.integers(0, 3), density=st.sampled_from([0.2, 0.6, 1.0]),
       tile=st.sampled_from([2, 3, 4]), seed=st.integers(0, 10_000))
def test_products_equal_numpy(spark, shape, levels, density, tile, seed):
    m, k, n = shape
    rng = np.random.default_rng(seed)
    x, y = _operand(rng, m, k, density), _operand(rng, k, n, density)
    a, b = from_dense(spark, x), from_dense(spark, y)
    want = x @ y
    np.testing.assert_array_equal(to_dense(multiply(a, b)), want)
    np.testing.assert_array_equal(to_dense(strassen(a, b, levels=levels)), want)
    np.testing.assert_array_equal(to_dense(multiply_blocked(a, b, tile=tile)), want)
    np.testing.assert_array_equal(to_dense(multiply_strassen_tiled(a, b, tile=tile, levels=max(1, levels))), want)


@settings(max_examples=6, deadline=None, derandomize=True,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(r=st.integers(1, 9), c=st.integers(1, 9), seed=st.integers(0, 10_000))
def test_elementwise_and_quadrant_laws(spark, r, c, seed):
    rng = np.random.default_rng(seed)
    x, y = _operand(rng, r, c, 0.5), _operand(rng, r, c, 0.5)
    a, b = from_dense(spark, x), from_dense(spark, y)
    np.testing.assert_array_equal(to_dense(add(a, b)), x + y)
    np.testing.assert_array_equal(to_dense(subtract(add(a, b), b)), x)
    np.testing.assert_array_equal(to_dense(merge(*split(a), n_rows=r, n_cols=c)), x)
