"""Matrices from ordinary tables.

``from_table`` turns any (row key, column key, value) projection into a
coordinate matrix; duplicate coordinates are summed in one partially
aggregated shuffle, unless the caller knows the keys are unique already
(a primary key), in which case nothing is shuffled at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..matrix import COL, ROW, VALUE, Matrix, required


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def from_table(df: DataFrame, row: str | Column, col: str | Column, value: str | Column,
               *, n_rows: int | None = None, n_cols: int | None = None,
               unique: bool = False, value_type: str = "double") -> Matrix:
    """Coordinate matrix ``M[row, col] = Σ value`` from a table.

    Keys are cast to INT (ANSI mode raises if a key does not fit).  NULL keys
    and NULL values are rejected: the task that meets one fails.
    """
    vt = "bigint" if value_type in ("bigint", "long") else "double"
    cells = df.select(
        required(_c(row), "int", ROW).alias(ROW),
        required(_c(col), "int", COL).alias(COL),
        required(_c(value), vt, VALUE).alias(VALUE),
    )
    if not unique:
        cells = cells.groupBy(ROW, COL).agg(F.sum(VALUE).cast(vt).alias(VALUE))
    return Matrix(cells, n_rows, n_cols, unique=True)


def from_array_column(df: DataFrame, row: str | Column, array: str | Column,
                      *, n_rows: int | None = None, n_cols: int | None = None) -> Matrix:
    """Dense rows stored as an array column: ``M[row, pos] = array[pos]`` (0-based).

    ``posexplode`` is a narrow per-record generator, so the matrix is produced
    without any shuffle; row keys are assumed unique (one array per row).  A
    NULL or empty array has no cells; NULL row keys and elements are rejected.
    """
    cells = df.select(required(_c(row), "int", ROW).alias(ROW), F.posexplode(_c(array)).alias(COL, VALUE))
    cells = cells.select(ROW, F.col(COL).cast("int").alias(COL), required(F.col(VALUE), "double", VALUE).alias(VALUE))
    return Matrix(cells, n_rows, n_cols)


# ---------------------------------------------------------------------------
# The matrices we take from the driver tables (see FIXTURES.md §2.3).
# Shapes come from one tiny aggregate each (max key + 1), a single-row result.
# ---------------------------------------------------------------------------

def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _extent(df: DataFrame, *cols: str) -> list[int]:
    r = df.agg(*[F.max(c).alias(c) for c in cols]).first()
    return [int(r[c]) + 1 if r[c] is not None else 0 for c in cols]


def order_part(spark: SparkSession, sf_dir: str, *, with_shape: bool = False, value_type: str = "double") -> Matrix:
    """Q[order, part] = Σ l_quantity (sparse; a few parts per order)."""
    li = _read(spark, sf_dir, "lineitem")
    m = from_table(li, "l_orderkey", "l_partkey", "l_quantity", value_type=value_type)
    if with_shape:
        n_o, n_p = _extent(li, "l_orderkey", "l_partkey")
        m = Matrix(m.df, n_o, n_p, m.unique)
    return m


def supplier_part(spark: SparkSession, sf_dir: str, *, lines: str = "all",
                  value_type: str = "double") -> Matrix:
    """Q[supplier, part] = Σ l_quantity over ``lines``: all, returned (``l_returnflag = 'R'``)
    or kept (every other line, NULL flags included).

    Returned and kept lines partition the table; the shape always covers the
    whole table so both parts share it.
    """
    li = _read(spark, sf_dir, "lineitem")
    n_s, n_p = _extent(li, "l_suppkey", "l_partkey")
    src = li
    if lines == "returned":
        src = li.filter(F.col("l_returnflag") == "R")
    elif lines == "kept":
        src = li.filter(~F.col("l_returnflag").eqNullSafe("R"))
    elif lines != "all":
        raise ValueError(lines)
    m = from_table(src, "l_suppkey", "l_partkey", "l_quantity", value_type=value_type)
    return Matrix(m.df, n_s, n_p, m.unique)


def brand_number(p_brand: str | Column) -> Column:
    """``'Brand#17'`` → 17."""
    return F.regexp_extract(_c(p_brand), r"#(\d+)$", 1).cast("int")


def part_brand(spark: SparkSession, sf_dir: str) -> Matrix:
    """I[part, brand − 1] = 1: one cell per part (p_partkey is the primary key)."""
    part = _read(spark, sf_dir, "part")
    r = part.agg(F.max("p_partkey").alias("p"), F.max(brand_number("p_brand")).alias("b")).first()
    n_p = int(r["p"]) + 1 if r["p"] is not None else 0
    n_b = int(r["b"] or 0)
    m = from_table(part, "p_partkey", brand_number("p_brand") - 1, F.lit(1.0), unique=True)
    return Matrix(m.df, n_p, n_b, m.unique)


def embedding_matrix(spark: SparkSession, sf_dir: str) -> Matrix:
    """E[vec_id, position] = embedding[position] (dense)."""
    emb = _read(spark, sf_dir, "embeddings")
    r = emb.agg(F.max("vec_id").alias("n"), F.max(F.size("embedding")).alias("d")).first()
    return from_array_column(emb, "vec_id", "embedding", n_rows=int(r["n"]) + 1, n_cols=int(r["d"]))


def user_event(spark: SparkSession, sf_dir: str) -> Matrix:
    """U[user, event type] = number of events; the distinct types found in the table, NULL
    first and then in order, are the columns."""
    ev = _read(spark, sf_dir, "events").select("user_id", "event_type")
    n_u, = _extent(ev, "user_id")
    counts = ev.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    # the window sees one row per distinct type
    types = ev.select("event_type").distinct().withColumn(
        "etype", F.row_number().over(Window.orderBy(F.col("event_type").asc_nulls_first())) - 1)
    types = types.withColumnRenamed("event_type", "kind")
    n_types = types.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    coded = counts.join(types, F.col("event_type").eqNullSafe(F.col("kind")))
    m = from_table(coded, "user_id", "etype", "n", unique=True)
    return Matrix(m.df, n_u, int(n_types), m.unique)
