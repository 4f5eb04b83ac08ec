import numpy as np
import pytest

from conftest import ma, mb, to_dense
from tessera.functions.coefficients import ALPHA, BETA, GAMMA
from tessera.matrix import Matrix
from tessera.operators.blocked import multiply_blocked, multiply_strassen_tiled
from tessera.operators.multiply import multiply
from tessera.operators.strassen import levels_for, operands, strassen
from tessera.sources.generate import generate_int


def test_coefficients_reproduce_block_product():
    rng = np.random.default_rng(0)
    a = {q: rng.integers(0, 9, (2, 2)) for q in (11, 12, 21, 22)}
    b = {q: rng.integers(0, 9, (2, 2)) for q in (11, 12, 21, 22)}
    m = {p: sum(w * a[q] for q, w in ALPHA[p]) @ sum(w * b[q] for q, w in BETA[p]) for p in range(1, 8)}
    c = {q: sum(w * m[p] for p in range(1, 8) for qq, w in GAMMA[p] if qq == q) for q in (11, 12, 21, 22)}
    full_a = np.block([[a[11], a[12]], [a[21], a[22]]])
    full_b = np.block([[b[11], b[12]], [b[21], b[22]]])
    np.testing.assert_array_equal(np.block([[c[11], c[12]], [c[21], c[22]]]), full_a @ full_b)


def test_levels_rule():
    assert levels_for(256) == 0
    assert levels_for(1024) == 2
    assert levels_for(2 ** 15) == 4
    assert levels_for(300) == 1


@pytest.mark.parametrize("m,k,n,levels", [(16, 16, 16, 1), (16, 16, 16, 3), (13, 13, 13, 2), (7, 5, 3, 2),
                                          (37, 50, 64, 2), (1, 1, 1, 1)])
def test_strassen_equals_standard(spark, m, k, n, levels):
    a = generate_int(spark, m, k, value_type="double")
    b = generate_int(spark, k, n, a=13, b=29, value_type="double")
    c = strassen(a, b, levels=levels)
    np.testing.assert_array_equal(to_dense(c), ma(m, k) @ mb(k, n))
    assert c.df.filter("row >= %d or col >= %d" % (m, n)).count() == 0


def test_strassen_bigint_and_compact(spark):
    a = generate_int(spark, 12)
    b = generate_int(spark, 12, a=13, b=29)
    c = strassen(a, b, levels=2, compact_zeros=True)
    assert c.value_type == "bigint"
    np.testing.assert_array_equal(to_dense(c), ma(12) @ mb(12))
    assert c.df.filter("value = 0").count() == 0


def test_strassen_plan_is_lazy_single_plan(spark):
    a = generate_int(spark, 32, value_type="double")
    b = generate_int(spark, 32, a=13, b=29, value_type="double")
    sc = spark.sparkContext
    before = sc.statusTracker().getJobIdsForGroup(None)
    c = strassen(a, b, levels=2)  # shapes known: building must not run a job
    after = sc.statusTracker().getJobIdsForGroup(None)
    assert len(after) == len(before)
    plan = c.df._jdf.queryExecution().sparkPlan().toString()
    assert "CartesianProduct" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert plan.count("Join") == 1  # one leaf join for all 49 products


def test_operands_count_and_paths(spark):
    a = generate_int(spark, 8, value_type="double")
    ops = operands(a, "A", 1).toPandas()
    assert sorted(ops["path"].unique()) == list(range(1, 8))
    # operand 6 is A21 - A11
    full = ma(8).astype(float)
    o6 = np.zeros((4, 4))
    sub = ops[ops.path == 6]
    o6[sub["row"], sub["col"]] = sub["value"]
    np.testing.assert_array_equal(o6, full[4:, :4] - full[:4, :4])


@pytest.mark.parametrize("n,tile,vt", [(16, 4, "double"), (19, 8, "double"), (10, 16, "bigint")])
def test_blocked_equals_coordinate(spark, n, tile, vt):
    a = generate_int(spark, n, value_type=vt)
    b = generate_int(spark, n, a=13, b=29, value_type=vt)
    c = multiply_blocked(a, b, tile=tile)
    assert c.value_type == vt
    np.testing.assert_array_equal(to_dense(c), to_dense(multiply(a, b)))


@pytest.mark.parametrize("m,k,n,tile,levels", [(16, 16, 16, 4, 1), (21, 13, 9, 4, 2), (12, 12, 12, 8, 1)])
def test_strassen_tiled(spark, m, k, n, tile, levels):
    a = generate_int(spark, m, k, value_type="double")
    b = generate_int(spark, k, n, a=13, b=29, value_type="double")
    c = multiply_strassen_tiled(a, b, tile=tile, levels=levels)
    np.testing.assert_array_equal(to_dense(c), ma(m, k) @ mb(k, n))


def test_blocked_bigint_overflow_raises(spark):
    big = Matrix(spark.createDataFrame([(0, 0, 2 ** 40), (0, 1, 2 ** 40)], "row int, col int, value bigint"), 2, 2)
    bt = Matrix(spark.createDataFrame([(0, 0, 2 ** 40), (1, 0, 2 ** 40)], "row int, col int, value bigint"), 2, 2)
    with pytest.raises(Exception) as e:
        multiply_blocked(big, bt, tile=2).df.collect()
    assert "overflow" in str(e.value).lower()


def test_chooser_rule_and_dispatch(spark):
    from tessera.operators.choose import choose_algorithm, product
    assert choose_algorithm(2048, 2048, 2048, 2048 ** 2, 2048 ** 2) == "blocked"
    assert choose_algorithm(2048, 2048, 2048, 1000, 2048 ** 2) == "standard"       # sparse A
    assert choose_algorithm(64, 64, 64, 64 ** 2, 64 ** 2) == "standard"            # small
    a = generate_int(spark, 12, value_type="double")
    b = generate_int(spark, 12, a=13, b=29, value_type="double")
    want = ma(12) @ mb(12)
    for alg in ("auto", "standard", "strassen", "blocked", "strassen_tiled"):
        np.testing.assert_array_equal(to_dense(product(a, b, algorithm=alg, tile=4, levels=1)), want)
    with pytest.raises(ValueError):
        product(a, b, algorithm="nope")


def test_strassen_cut_lineage_checkpoints_operands(spark):
    a = generate_int(spark, 20, value_type="double")
    b = generate_int(spark, 20, a=13, b=29, value_type="double")
    c = strassen(a, b, levels=2, cut_lineage=True)
    plan = c.df._jdf.queryExecution().optimizedPlan().toString()
    assert "LogicalRDD" in plan and "Range" not in plan  # operands come from the checkpoint
    np.testing.assert_array_equal(to_dense(c), ma(20) @ mb(20))


def test_tiles_collapse_copies_of_a_coordinate(spark):
    # one coordinate copied many times (a "group of copies"): summed before tiles are gathered
    rows = [(1, 1, 1.0)] * 500 + [(0, 0, 2.0), (2, 3, 4.0)]
    a = Matrix(spark.createDataFrame(rows, "row int, col int, value double"), 4, 4)
    from tessera.operators.blocked import to_tiles
    t = to_tiles(a, 4).collect()
    assert len(t) == 1 and len(t[0]["pos"]) == 3
    eye = Matrix(spark.createDataFrame([(i, i, 1.0) for i in range(4)], "row int, col int, value double"), 4, 4)
    got = {(r["row"], r["col"]): r["value"] for r in multiply_blocked(a, eye, tile=4).df.collect()}
    assert got == {(0, 0): 2.0, (1, 1): 500.0, (2, 3): 4.0}
