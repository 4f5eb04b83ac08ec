"""Plan properties the scale design relies on, checked with explain output."""

import __spark_entry__ as E
from plan_metrics import executed
from tessera.matrix import transpose
from tessera.operators.multiply import multiply
from tessera.sources.generate import generate_int
from tessera.sources.tables import order_part

SF = "/root/testdata/sf0.001"


def _final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_self_product_scans_and_shuffles_the_operand_once(spark):
    q = order_part(spark, SF)
    plan = _final_plan(multiply(transpose(q), q, broadcast_cells=0).df)
    assert "ReusedExchange" in plan or plan.count("FileScan parquet") == 1
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_scan_prunes_columns_and_pushes_filters(spark):
    df = E.queries()["add_matrices"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint,l_quantity:double,l_returnflag:string>" in plan
    assert "EqualTo(l_returnflag,R)" in plan  # the returned-lines filter reaches the Parquet scan


def test_spread_broadcast_join_does_not_shuffle_its_output(spark):
    a = generate_int(spark, 40, value_type="double")
    b = generate_int(spark, 40, a=13, b=29, value_type="double")
    plan = multiply(a, b).df._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan
    # the only hash exchange is the spread of the streamed side, by its row index
    exchanges = [l for l in plan.split("\n") if "Exchange hashpartitioning" in l]
    assert len(exchanges) <= 1


def test_no_python_in_coordinate_operators(spark):
    for name in ("multiply_sparse", "multiply_standard", "multiply_strassen_1", "add_matrices", "split_quadrants"):
        plan = E.queries()[name](spark, SF)._jdf.queryExecution().sparkPlan().toString()
        assert "Python" not in plan and "ArrowEval" not in plan, name


def test_every_registered_query_reads_the_tables(spark):
    for name, q in E.queries().items():
        if name == "run_log":
            continue  # a log of jobs that read the tables (checked in test_jobs_and_entry)
        plan = q(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
        assert "parquet" in plan.lower() or "Relation" in plan, name


def test_no_row_per_key_is_broadcast_on_the_planners_guess(spark):
    a = generate_int(spark, 30, 300, value_type="double")
    b = generate_int(spark, 300, 30, a=13, b=29, value_type="double")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")  # Spark's default
    try:
        df = multiply(a, b, broadcast_cells=0).df
        assert df.count() == 900
        _, ops = executed(df)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    sent = [p.metrics().apply("numOutputRows").value() for name, p in ops if name == "BroadcastExchangeExec"]
    assert sum(sent) == 0  # no key is heavy
