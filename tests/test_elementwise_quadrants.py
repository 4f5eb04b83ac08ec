import numpy as np
import pytest

from conftest import from_dense, ma, mb, to_dense
from tessera.operators.elementwise import add, add_by_join, align, linear_combination, subtract
from tessera.operators.quadrants import merge, split, split_tagged
from tessera.sources.generate import generate_int


def test_add_subtract_golden(spark):
    a = from_dense(spark, [[1, 2], [3, 0]])
    b = from_dense(spark, [[5, 0], [7, 8]])
    np.testing.assert_array_equal(to_dense(add(a, b)), [[6, 2], [10, 8]])
    # a cell only in B gives -b
    np.testing.assert_array_equal(to_dense(subtract(a, b)), [[-4, 2], [-4, -8]])
    np.testing.assert_array_equal(to_dense(add_by_join(a, b, sign=-1)), [[-4, 2], [-4, -8]])


def test_add_then_subtract_is_identity(spark):
    a, b = generate_int(spark, 9, value_type="double"), generate_int(spark, 9, a=13, b=29, value_type="double")
    np.testing.assert_array_equal(to_dense(subtract(add(a, b), b)), ma(9))
    np.testing.assert_array_equal(to_dense(add_by_join(a, b)), ma(9) + mb(9))


def test_linear_combination_types_and_shapes(spark):
    a = generate_int(spark, 4)
    c = linear_combination([(a, 2), (a, -1)])
    assert c.value_type == "bigint"
    np.testing.assert_array_equal(to_dense(c), ma(4))
    with pytest.raises(ValueError):
        add(generate_int(spark, 3), generate_int(spark, 4))


def test_align_absent_is_zero(spark):
    a = from_dense(spark, [[1, 0], [0, 0]])
    b = from_dense(spark, [[0, 2], [0, 0]])
    rows = {(r["row"], r["col"]): (r["a"], r["b"]) for r in align(a, b).collect()}
    assert rows == {(0, 0): (1.0, 0.0), (0, 1): (0.0, 2.0)}


@pytest.mark.parametrize("n,m", [(8, 8), (7, 7), (5, 9), (1, 1)])
def test_merge_of_split_is_identity(spark, n, m):
    a = generate_int(spark, n, m)
    q = split(a)
    assert sum(x.n_rows * x.n_cols for x in q) == n * m
    back = merge(*q, n_rows=n, n_cols=m)
    assert back.df.count() == n * m  # no overlapping quadrants, no duplicates for odd sizes
    np.testing.assert_array_equal(to_dense(back), ma(n, m))


def test_split_quadrants_rebased(spark):
    a = generate_int(spark, 6)
    a11, a12, a21, a22 = split(a)
    full = ma(6)
    np.testing.assert_array_equal(to_dense(a12), full[:3, 3:])
    np.testing.assert_array_equal(to_dense(a21), full[3:, :3])
    tagged = split_tagged(a).toPandas()
    assert sorted(tagged["q"].unique()) == [11, 12, 21, 22]
    sub = tagged[tagged.q == 22]
    assert set(zip(sub["row"], sub["col"])) == {(i, j) for i in range(3) for j in range(3)}
