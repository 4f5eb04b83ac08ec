"""The linear product check, the contract on read, quadrant layouts, generators on cells, resumable sweeps."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import from_dense, ma, to_dense
from tessera.matrix import Matrix, transpose
from tessera.operators.blocked import multiply_blocked
from tessera.operators.multiply import multiply
from tessera.operators.quadrants import split
from tessera.operators.strassen import strassen
from tessera.plans.compare import check_product, compare_algorithms
from tessera.plans.sweep import SweepCase, read_log, run_sweep
from tessera.session import scratch_path
from tessera.sources.generate import generate_int, generate_random, perturb_int, perturb_random
from tessera.sources.io import read_matrix, read_merged, read_split, write_matrix, write_quadrants

COO = "row int, col int, value double"


def with_cell(m: Matrix, row: int, col: int, add: float) -> Matrix:
    """``m`` with one cell changed."""
    hit = (F.col("row") == row) & (F.col("col") == col)
    return m.with_df(m.df.withColumn("value", F.when(hit, F.col("value") + add).otherwise(F.col("value")).cast(m.value_type)))


@pytest.mark.parametrize("vt", ["double", "bigint"])
def test_right_products_pass_and_wrong_cells_are_seen(spark, vt):
    a, b = generate_int(spark, 30, 20, value_type=vt), generate_int(spark, 20, 25, a=13, b=29, value_type=vt)
    want = to_dense(a) @ to_dense(b)
    for product in (multiply, multiply_blocked, lambda x, y: strassen(x, y, levels=2)):
        r = check_product(a, b, product(a, b)).first()
        assert (r.max_abs_diff, r.n_mismatch, r.n_rows, r.trials) == (0.0, 0, 30, 8)
        assert r.n_cells == np.count_nonzero(want)
        i, j = np.indices(want.shape)
        assert r.checksum == (want * ((i * 31 + j * 17) % 101 + 1)).sum()
    c = multiply(a, b)
    for row, col, add in ((0, 0, 1), (29, 24, -3), (11, 7, 100)):
        r = check_product(a, b, with_cell(c, row, col, add)).first()
        assert r.n_mismatch == 1 and r.max_abs_diff == abs(add)
    missing = c.with_df(c.df.filter("row <> 4"))
    assert check_product(a, b, missing).first().n_mismatch == 1
    extra = c.with_df(c.df.unionByName(spark.createDataFrame([(77, 0, 5)], "row int, col int, value int")))
    assert check_product(a, b, extra).first().n_mismatch == 1


def test_check_is_linear_and_seeded(spark):
    a, b = generate_random(spark, 40, seed=1), generate_random(spark, 40, seed=2)
    c = multiply(a, b)
    plan = check_product(a, b, read_back(spark, c), tolerance=1e-12)
    assert plan.first().n_mismatch == 0
    assert check_product(a, b, with_cell(c, 3, 3, 1.0), tolerance=1e-12).first().n_mismatch == 1
    caught = [check_product(a, b, with_cell(with_cell(c, 3, 3, 1.0), 3, 4, 1.0), trials=1, seed=s, tolerance=1e-12).first().n_mismatch for s in range(8)]
    assert 0 < sum(caught) < 8  # two equal errors hide from half of the sign vectors
    one = check_product(a, b, c, trials=1, seed=5).collect()
    assert one == check_product(a, b, c.with_df(c.df.repartition(7)), trials=1, seed=5).collect() or abs(one[0].max_abs_diff) < 1e-6
    with pytest.raises(ValueError):
        check_product(a, b, c, trials=33)


def read_back(spark, m: Matrix) -> Matrix:
    path = scratch_path(spark, "product")
    write_matrix(m, path)
    return read_matrix(spark, path)


def test_empty_operands_check_out(spark):
    none = Matrix(spark.createDataFrame([], COO), 3, 3)
    r = check_product(none, none, none).first()
    assert (r.n_rows, r.max_abs_diff, r.n_mismatch, r.n_cells, r.checksum) == (0, 0.0, 0, 0, 0.0)


def test_compare_algorithms_counts_the_product(spark):
    a = generate_int(spark, 9, value_type="double")
    r = compare_algorithms(a, a, levels=1).first()
    assert r.n_cells == np.count_nonzero(ma(9) @ ma(9)) and r.checksum > 0
    broken = compare_algorithms(a, a, second=lambda x, y: with_cell(multiply(x, y), 1, 1, 2.0)).first()
    assert broken.n_mismatch == 1 and broken.max_abs_diff == 2.0


@pytest.mark.parametrize("rows, message", [
    ([(0, 0, 1.0), (0, None, 2.0)], "NULL coordinate"), ([(0, 0, None)], "NULL value"), ([(5, 0, 1.0)], "outside"),
    ([(-1, 0, 1.0)], "outside"), ([(0, 0, 1.0), (1, 1, 1.0), (0, 0, 2.0)], "stands twice")])
def test_a_bad_cell_fails_the_query_that_reads_it(spark, rows, message):
    path = scratch_path(spark, "bad")
    spark.createDataFrame(rows, COO).write.parquet(path)
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    m = read_matrix(spark, path, n_rows=3, n_cols=3, value_type="double", check=True)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) == before
    with pytest.raises(Exception, match=message):
        m.df.collect()
    assert read_matrix(spark, path, n_rows=3, n_cols=3).df.count() == len(rows)  # unchecked scans are as before


def test_manifest_spares_the_check_of_uniqueness(spark):
    path = scratch_path(spark, "good")
    write_matrix(generate_int(spark, 6), path)
    m = read_matrix(spark, path, check=True)
    assert m.shape == (6, 6) and m.unique and m.value_type == "bigint"
    plan = m.df.filter("row < 3")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "LessThan(row,3)" in plan
    np.testing.assert_array_equal(to_dense(m), ma(6))
    write_matrix(generate_int(spark, 2), path, mode="append")
    again = read_matrix(spark, path, n_rows=6, n_cols=6, check=True)
    with pytest.raises(Exception, match="stands twice"):
        again.df.collect()


@pytest.mark.parametrize("shape", [(6, 6), (7, 5), (1, 4)])
def test_quadrant_layout(spark, shape):
    m = generate_int(spark, *shape)
    path = scratch_path(spark, "quadrants")
    write_quadrants(m, path)
    for got, want in zip(read_split(spark, path), split(m)):
        assert got.shape == want.shape and got.unique
        np.testing.assert_array_equal(to_dense(got), to_dense(want))
    merged = read_merged(spark, path)
    np.testing.assert_array_equal(to_dense(merged), ma(*shape))
    plan = merged.df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Union" not in plan
    one = read_split(spark, path)[1].df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(q" in one and "= 12)]" in one
    with pytest.raises(ValueError):
        read_merged(spark, scratch_path(spark, "nothing"))


def test_generated_numbers_are_digests_of_counters(spark):
    m = generate_random(spark, 3, 4, seed=9, low=-1.0, high=1.0).df.collect()
    for r in m:
        u = int(hashlib.md5(f"9:{r.row * 4 + r.col}".encode()).hexdigest()[:13], 16) / 2 ** 52
        assert r.value == u * 2.0 - 1.0
    values = np.array([r.value for r in generate_random(spark, 100, 100, seed=1, high=1.0).df.collect()])
    assert abs(values.mean() - 0.5) < 0.01 and abs(values.var() - 1 / 12) < 0.005


def test_perturbed_cells_carry_the_generator_values(spark):
    m = from_dense(spark, np.array([[1, 0, 2], [0, 0, 3]]))
    full = to_dense(generate_random(spark, 2, 3, seed=5))
    stored = to_dense(m) != 0
    np.testing.assert_array_equal(to_dense(perturb_random(m, seed=5)), np.where(stored, to_dense(m) + full, 0))
    ints = from_dense(spark, np.array([[1, 0, 2], [0, 0, 3]]), "bigint")
    np.testing.assert_array_equal(to_dense(perturb_int(ints)), np.where(stored, to_dense(m) + ma(2, 3), 0))
    assert perturb_int(ints).value_type == "bigint"


def test_a_killed_sweep_runs_only_the_rest(spark):
    out, ran = scratch_path(spark, "resume"), []

    def case(order, fail=False):
        def load():
            ran.append(order)
            if fail:
                raise RuntimeError("no operands")
            return generate_int(spark, 4), generate_int(spark, 4)
        return SweepCase(order, 4, load)

    class Killed(BaseException):
        pass

    def killed():
        ran.append(3)
        raise Killed

    with pytest.raises(Killed):
        run_sweep(spark, [case(1), case(2), SweepCase(3, 4, killed), case(4)], out, algorithm="standard")
    assert ran == [1, 2, 3] and read_log(spark, out).count() == 2
    log = run_sweep(spark, [case(1), case(2), case(3), case(4, fail=True)], out, algorithm="standard")
    assert ran == [1, 2, 3, 3, 4]
    assert {r.order: r.status for r in log.collect()} == {1: "success", 2: "success", 3: "success", 4: "failed"}
    log = run_sweep(spark, [case(k) for k in (1, 2, 3, 4)], out, algorithm="standard")  # a failed case is tried again
    assert ran[5:] == [4] and {r.status for r in log.collect()} == {"success"} and log.count() == 4
    run_sweep(spark, [case(1)], out, algorithm="standard", resume=False)
    assert ran[6:] == [1] and read_log(spark, out).count() == 4
    np.testing.assert_array_equal(to_dense(read_matrix(spark, f"{out}/matrices_2/strassen_result_2")), ma(4) @ ma(4))
