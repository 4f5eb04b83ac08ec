import os

import duckdb
import pytest

import __spark_entry__ as E
from tessera.plans.catalogue import QUERIES, SQL
from tessera.plans.compare import compare_algorithms
from tessera.plans.sweep import LOG_SCHEMA, SweepCase, run_sweep
from tessera.session import scratch_path
from tessera.sources.generate import generate_int

SF = "/root/testdata/sf0.001"
TABLES = ["lineitem", "part", "embeddings", "events"]


def test_compare_algorithms_zero(spark):
    a = generate_int(spark, 9, value_type="double")
    b = generate_int(spark, 9, a=13, b=29, value_type="double")
    r = compare_algorithms(a, b, levels=2).first()
    assert r["max_abs_diff"] == 0.0 and r["n_mismatch"] == 0


def test_sweep_logs_failures_and_continues(spark):
    def good():
        return generate_int(spark, 6, value_type="double"), generate_int(spark, 6, value_type="double")

    def bad():
        raise RuntimeError("operands missing")

    out = scratch_path(spark, "sweep-test")
    log = run_sweep(spark, [SweepCase(1, 6, good), SweepCase(2, 8, bad), SweepCase(3, 6, good)], out,
                    algorithm="strassen", levels=1)
    rows = {r["order"]: r for r in log.collect()}
    assert log.schema == LOG_SCHEMA
    assert [rows[i]["status"] for i in (1, 2, 3)] == ["success", "failed", "success"]
    assert "operands missing" in rows[2]["error"] and rows[2]["time_before_error"] is not None
    assert rows[1]["n_cells"] == 36 and rows[1]["compute_time_seconds"] >= 0
    written = spark.read.schema(LOG_SCHEMA).json(f"{out}/run_log")
    assert written.count() == 3
    assert spark.read.parquet(f"{out}/matrices_1/strassen_result_1").count() == 36


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert [f.name for f in df.schema.fields] == ["row", "col", "value"]
    assert df.count() > 0


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")
@pytest.mark.parametrize("name", sorted(SQL))
def test_queries_match_oracle_small(spark, name):
    con = duckdb.connect()
    for t in ("lineitem", "part", "embeddings", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = QUERIES[name](spark, SF).toPandas()
    want = con.execute(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    cols = sorted(got.columns)
    g = got[cols].sort_values(cols).reset_index(drop=True)
    w = want[cols].sort_values(cols).reset_index(drop=True)
    for c in cols:
        if got[c].dtype.kind in "fc":
            assert ((g[c].astype(float) - w[c].astype(float)).abs() <= 1e-6).all(), c
        else:
            assert (g[c].astype(str) == w[c].astype(str)).all(), c


def test_every_query_has_an_oracle_or_is_declared_rows_only():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(E.queries()) and set(SQL) <= set(E.oracle_sql())


def test_generate_then_multiply_sweep_on_paths(spark):
    import numpy as np
    from tessera.plans.jobs import generate_operands, multiply_sweep
    from tessera.sources.io import paths, read_matrix
    base = scratch_path(spark, "jobs-in")
    res = scratch_path(spark, "jobs-out")
    written = generate_operands(spark, base, [2, 3], seed=5)
    assert written[0].endswith("matrices_2/matrix1.parquet") and len(written) == 4
    log = multiply_sweep(spark, base, res, [2, 3, 9], algorithm="strassen", levels=1)
    status = {r["order"]: r["status"] for r in log.collect()}
    assert status == {2: "success", 3: "success", 9: "failed"}  # order 9 was never generated
    p = paths(base, 3)
    a = read_matrix(spark, p.operand_a, n_rows=8, n_cols=8).df.toPandas()
    b = read_matrix(spark, p.operand_b, n_rows=8, n_cols=8).df.toPandas()
    da, db = np.zeros((8, 8)), np.zeros((8, 8))
    da[a.row, a.col] = a.value
    db[b.row, b.col] = b.value
    c = spark.read.parquet(f"{res}/matrices_3/strassen_result_3").toPandas()
    dc = np.zeros((8, 8))
    dc[c.row, c.col] = c.value
    np.testing.assert_allclose(dc, da @ db, rtol=1e-9)
    timing = spark.read.schema(LOG_SCHEMA).json(paths(base, 3, res).timing).collect()
    assert len(timing) == 1 and timing[0]["status"] == "success" and timing[0]["order"] == 3


def test_entry_keeps_the_matrix_queries_when_a_library_is_missing():
    """Whatever import fails below the corpus operators, the other queries stay registered."""
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = "import sys; sys.modules['ahocorasick'] = None; import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    said = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True).stdout.split()
    assert said == [str(len(QUERIES)), str(len(SQL))]
