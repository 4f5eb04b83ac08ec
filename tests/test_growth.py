"""Work that must not grow faster than the tables: tasks of products and generators, records of the check, loads of the sweep."""

from pyspark.sql import functions as F

from conftest import from_dense, ma
from plan_metrics import executed
from test_balance import per_task
from tessera.matrix import Matrix, transpose
from tessera.operators.multiply import multiply, products
from tessera.plans.compare import check_product
from tessera.plans.sweep import SweepCase, run_sweep
from tessera.sources.generate import generate_int, generate_int_over, generate_random, generate_random_over


def test_products_keep_their_tasks_however_small_the_cells(spark):
    a = generate_int(spark, 20, 300)
    assert len(per_task(products(transpose(a), a, broadcast_cells=0))) > 10
    assert len(per_task(products(a, transpose(a), broadcast_cells=0))) > 10


def test_rows_are_generated_by_many_tasks(spark):
    ids = [0, 3, 4, 4, None]
    rows = spark.createDataFrame([(i,) for i in ids], "id long").coalesce(1)
    n = 25_003
    for over, whole in ((generate_int_over, generate_int), (generate_random_over, generate_random)):
        got = over(rows, 5, n).df.persist()
        assert len(per_task(got)) > 4 and got.count() == 4 * n
        assert got.distinct().exceptAll(whole(spark, 5, n).df.filter("row in (0, 3, 4)")).count() == 0
        assert got.filter("row = 4").groupBy("row", "col").count().filter("count <> 2").count() == 0
        got.unpersist()
    assert generate_int_over(rows, 5, 0).df.count() == 0


def test_generated_cells_take_little_room_in_files(spark, tmp_path):
    ids = [*range(0, 6000, 100), 300, 300, 1234, None]
    rows = spark.createDataFrame([(i,) for i in ids], "id long")
    n = 10_003
    values = {generate_int_over: "(row * 31L + col * 17L + row * 7L * col) % 100",
              generate_random_over: f"conv(left(md5('42:' || (row * {n}L + col)), 13), 16, 10) / 4503599627370496e0 * 1000"}
    for k, (over, room) in enumerate(((generate_int_over, 0.5), (generate_random_over, 8.5))):
        over(rows, 6000, n).df.write.parquet(f"{tmp_path}/{k}")
        got = spark.read.parquet(f"{tmp_path}/{k}")
        assert got.filter(f"value = {values[over]}").count() == 63 * n
        assert got.filter("row = 300").count() == 3 * n and got.select("row", "col").distinct().count() == 61 * n
        assert sum(f.stat().st_size for f in (tmp_path / str(k)).glob("*.parquet")) < room * 63 * n


def test_check_shuffles_cells_and_not_sums_per_task(spark):
    cells = spark.range(3000).select((F.col("id") % 1000).cast("int").alias("row"),
                                     (F.col("id") * 7 % 997).cast("int").alias("col"), F.lit(2).cast("long").alias("value"))
    one = spark.range(1000).select(F.col("id").cast("int").alias("row"), F.col("id").cast("int").alias("col"),
                                   F.lit(1).cast("long").alias("value"))
    c = Matrix(cells.repartition(8).persist(), unique=True)
    rows, ops = executed(check_product(c, Matrix(one, unique=True), c))
    assert (rows[0]["n_mismatch"], rows[0]["n_cells"], rows[0]["max_abs_diff"]) == (0, 3000, 0.0)
    size = sum(p.metrics().apply("dataSize").value() for name, p in ops if name == "ShuffleExchangeExec")
    assert size < 1_100_000
    c.df.unpersist()


def test_sweep_makes_an_operand_and_its_transpose_once(spark, tmp_path):
    made = spark.sparkContext.accumulator(0)

    def seen(v):
        made.add(1)
        return v

    m = from_dense(spark, ma(6, 4))
    b = m.with_df(m.df.withColumn("value", F.udf(seen, "double")("value")))
    n = m.df.count()
    log = run_sweep(spark, [SweepCase(1, 6, lambda: (transpose(b), b))], str(tmp_path), levels=1).first()
    assert log["status"] == "success" and made.value == n
