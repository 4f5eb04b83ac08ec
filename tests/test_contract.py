"""One contract for every product: NULLs, overflow, infinities, zero cells, options, event types."""

import pytest

from tessera.matrix import Matrix
from tessera.operators.blocked import multiply_blocked
from tessera.operators.choose import product
from tessera.operators.multiply import multiply
from tessera.operators.strassen import strassen
from tessera.sources.tables import from_table, user_event

BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def matrix(spark, cells, shape, kind="double"):
    return Matrix(spark.createDataFrame(cells, f"row int, col int, value {kind}"), *shape)


def cells(m):
    return sorted((r.row, r.col, r.value) for r in m.df.collect())


def test_tiles_reject_null_values(spark):
    a = matrix(spark, [(0, 0, None), (0, 1, 5.0)], (1, 2))
    b = matrix(spark, [(0, 0, 1.0), (1, 0, 1.0)], (2, 1))
    with pytest.raises(Exception, match="NULL value"):
        multiply_blocked(a, b, tile=2).df.collect()


def test_from_table_rejects_nulls(spark):
    for row in ((None, 1, 1.0), (1, None, 1.0), (1, 1, None)):
        df = spark.createDataFrame([row], "a int, b int, c double")
        with pytest.raises(Exception, match="NULL"):
            from_table(df, "a", "b", "c").df.collect()


def test_bigint_overflow_across_tiles_raises(spark):
    a = matrix(spark, [(0, k, 2**31) for k in range(8)], (1, 8), "bigint")
    b = matrix(spark, [(k, 0, 2**30) for k in range(8)], (8, 1), "bigint")
    for run in (multiply, lambda x, y: multiply_blocked(x, y, tile=1)):
        with pytest.raises(Exception, match="(?i)overflow"):
            run(a, b).df.collect()


def test_largest_bigints_are_legal(spark):
    for x, y in ((2**62, 1), (2**63 - 1, 1), (-(2**62), 2)):
        a, b = matrix(spark, [(0, 0, x)], (1, 1), "bigint"), matrix(spark, [(0, 0, y)], (1, 1), "bigint")
        assert cells(multiply_blocked(a, b, tile=2)) == cells(multiply(a, b)) == [(0, 0, x * y)]


def test_infinities_make_no_new_cells(spark):
    a, b = matrix(spark, [(0, 0, float("inf"))], (2, 2)), matrix(spark, [(0, 0, 1.0)], (2, 2))
    assert cells(multiply_blocked(a, b, tile=2)) == cells(multiply(a, b)) == [(0, 0, float("inf"))]


def test_every_algorithm_returns_the_same_cells(spark):
    a = matrix(spark, [(0, 0, 1.0), (0, 1, 1.0), (1, 0, 2.0), (1, 1, 3.0)], (2, 2))
    b = matrix(spark, [(0, 0, 1.0), (1, 0, -1.0), (0, 1, 4.0), (1, 1, 4.0)], (2, 2))
    want = [(0, 1, 8.0), (1, 0, -1.0), (1, 1, 20.0)]
    for algorithm in ("auto", "standard", "strassen", "blocked", "strassen_tiled"):
        for tile in (1, 2, 512):
            assert cells(product(a, b, algorithm=algorithm, tile=tile)) == want


def test_options_are_passed_or_refused(spark):
    a = matrix(spark, [(0, 0, 1.0)], (1, 1))
    with pytest.raises(TypeError, match="bogus"):
        strassen(a, a, levels=1, bogus=1)
    with pytest.raises(TypeError, match="bogus"):
        strassen(a, a, levels=0, bogus=1)
    with pytest.raises(TypeError):
        product(a, a, algorithm="blocked", skew="salt")


def test_session_settings_stay(spark):
    before = spark.conf.get(BATCH)
    a = matrix(spark, [(0, 0, 1.0)], (1, 1))
    multiply_blocked(a, a, tile=512).df.collect()
    assert spark.conf.get(BATCH) == before


def test_repeated_coordinates_prove_nothing(spark):
    df = spark.range(1000).selectExpr("cast(id % 3 as int) row", "cast(id % 2 as int) col", "1.0d value")
    plan = multiply(Matrix(df, 3, 3), Matrix(df, 3, 3), broadcast_cells=100, skew="aqe").df._jdf.queryExecution().logical().toString()
    assert "broadcast" not in plan.lower()
    # by default the table of routes is, which has fewer rows than tasks; no operand is
    plan = multiply(Matrix(df, 3, 3), Matrix(df, 3, 3), broadcast_cells=100).df._jdf.queryExecution().analyzed().toString()
    lines = plan.split("\n")
    hinted = [lines[i + 1] for i, line in enumerate(lines) if "strategy=broadcast" in line]
    assert hinted and all("Project [key" in line and "val" not in line and "other" not in line for line in hinted)
    unique = multiply(Matrix(df, 3, 3, unique=True), Matrix(df, 3, 3, unique=True)).df._jdf.queryExecution().logical().toString()
    assert "broadcast" in unique.lower()


def test_unlisted_and_null_event_types_are_columns(spark, tmp_path):
    rows = [(i % 4, ["click", "zoom", None, "a new one"][i % 3 + (i % 5 == 0)]) for i in range(60)]
    spark.createDataFrame(rows, "user_id long, event_type string").write.parquet(str(tmp_path / "events.parquet"))
    u = user_event(spark, str(tmp_path))
    kinds = sorted({k for _, k in rows}, key=lambda k: (k is not None, k or ""))
    want = {}
    for i, k in rows:
        want[i, kinds.index(k)] = want.get((i, kinds.index(k)), 0) + 1
    assert u.shape == (4, len(kinds))
    assert {(r.row, r.col): r.value for r in u.df.collect()} == want and sum(want.values()) == len(rows)
