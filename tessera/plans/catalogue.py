"""The registered queries and their DuckDB oracles.

Every query reads the driver tables (``lineitem``, ``part``, ``embeddings``,
``events``) and builds its matrices from them, so its work grows with the
tables.  Each callable takes ``(spark, sf_dir)`` and returns a lazy
DataFrame; the SQL next to it computes the same result in DuckDB from the
same tables (column names and types match).
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..matrix import COL, ROW, VALUE, Matrix, cell_count, transpose, validation_report
from ..operators.blocked import multiply_blocked, multiply_strassen_tiled
from ..operators.elementwise import add, add_by_join, subtract
from ..operators.multiply import gram, multiply
from ..operators.quadrants import merge, split, split_tagged
from ..operators.strassen import operands, strassen
from ..session import scratch_path
from ..sources.generate import generate_int_over, generate_random_over, perturb_int, perturb_random
from ..sources.io import read_matrix, read_merged, read_split, roundtrip, write_matrix, write_quadrants
from ..sources.tables import embedding_matrix, order_part, part_brand, supplier_part, user_event
from .compare import check_product, compare_algorithms
from .sweep import SweepCase, run_sweep

Query = Callable[[SparkSession, str], DataFrame]

# Tile edge for the tiled queries: a quarter of the embedding width, so E has four columns of tiles.
TILE = 16


# ---------------------------------------------------------------------------
# Spark side
# ---------------------------------------------------------------------------

def q_multiply_sparse(spark: SparkSession, sf: str) -> DataFrame:
    """Part co-purchase QᵀQ, Q[order, part] = Σ quantity (the flagship).

    A Gram product: only part pairs with i ≤ j are formed, then mirrored.
    """
    return gram(order_part(spark, sf), transpose_first=True).df


def _supplier_brand(spark: SparkSession, sf: str) -> Matrix:
    """S = Q[supplier, part] · I[part, brand]: quantity per supplier and brand (dense)."""
    q = supplier_part(spark, sf)
    i = part_brand(spark, sf)
    n_parts = max(q.n_cols, i.n_rows)
    return multiply(Matrix(q.df, q.n_rows, n_parts, q.unique), Matrix(i.df, n_parts, i.n_cols, i.unique))


def q_multiply_rect(spark: SparkSession, sf: str) -> DataFrame:
    """Q[supplier, part] · I[part, brand] (rectangular operands)."""
    return _supplier_brand(spark, sf).df


def _rounded(m: Matrix) -> DataFrame:
    return m.df.select(ROW, COL, F.round(VALUE, 6).alias(VALUE))


def _embeddings_gram(spark: SparkSession, sf: str) -> tuple[Matrix, Matrix]:
    e = embedding_matrix(spark, sf)
    return transpose(e), e


def q_gram_embeddings(spark: SparkSession, sf: str) -> DataFrame:
    """EᵀE, component by component over all embedding vectors (coordinate form), rounded to 6 places."""
    return _rounded(gram(embedding_matrix(spark, sf), transpose_first=True))


def _purchase_gram(spark: SparkSession, sf: str, value_type: str = "double") -> tuple[Matrix, Matrix]:
    q = order_part(spark, sf, value_type=value_type)
    return transpose(q), q


def _brand_gram(spark: SparkSession, sf: str) -> tuple[Matrix, Matrix]:
    """Sᵀ and S for the dense supplier × brand matrix S (integer-valued doubles)."""
    s = _supplier_brand(spark, sf)
    return transpose(s), s


def q_multiply_standard(spark: SparkSession, sf: str) -> DataFrame:
    """Part co-purchase QᵀQ, Q[order, part] = Σ quantity, by the general join."""
    return multiply(*_purchase_gram(spark, sf)).df


def q_multiply_integer(spark: SparkSession, sf: str) -> DataFrame:
    """QᵀQ with BIGINT cells (exact integer arithmetic, overflow raises)."""
    return multiply(*_purchase_gram(spark, sf, "bigint")).df


def q_multiply_blocked(spark: SparkSession, sf: str) -> DataFrame:
    """EᵀE over dense tiles, rounded to 6 places."""
    return _rounded(multiply_blocked(*_embeddings_gram(spark, sf), tile=TILE))


def q_multiply_strassen_tiled(spark: SparkSession, sf: str) -> DataFrame:
    """EᵀE by one Strassen level over dense tiles, rounded to 6 places."""
    return _rounded(multiply_strassen_tiled(*_embeddings_gram(spark, sf), tile=TILE, levels=1))


def q_strassen_operands(spark: SparkSession, sf: str) -> DataFrame:
    """The seven left operands Σ α·A_q of Q[supplier, part] for one level."""
    return operands(supplier_part(spark, sf), "A", 1)


def q_multiply_strassen_1(spark: SparkSession, sf: str) -> DataFrame:
    """SᵀS (brand × brand over suppliers) by Strassen, one level."""
    return strassen(*_brand_gram(spark, sf), levels=1, compact_zeros=True).df


def q_multiply_strassen_2(spark: SparkSession, sf: str) -> DataFrame:
    """SᵀS by Strassen, two levels (25 brands padded to 28)."""
    return strassen(*_brand_gram(spark, sf), levels=2, compact_zeros=True).df


def q_multiply_strassen_odd(spark: SparkSession, sf: str) -> DataFrame:
    """UᵀU, U[user, event type]: odd sizes, padded per dimension, two levels."""
    u = user_event(spark, sf)
    return strassen(transpose(u), u, levels=2, compact_zeros=True).df


def q_multiply_strassen_rect(spark: SparkSession, sf: str) -> DataFrame:
    """Q[supplier, part] · I[part, brand] by Strassen, two levels: three different odd or uneven sizes, sparse operands."""
    q, i = supplier_part(spark, sf), part_brand(spark, sf)
    n_parts = max(q.n_cols, i.n_rows)
    return strassen(Matrix(q.df, q.n_rows, n_parts, q.unique), Matrix(i.df, n_parts, i.n_cols, i.unique),
                    levels=2, compact_zeros=True).df


def q_multiply_hot_keys(spark: SparkSession, sf: str) -> DataFrame:
    """U·(UᵀU): users × event types over as few inner keys as there are types, every key heavy and dealt over a grid.

    ``broadcast_cells=0`` treats both sides as too large to broadcast, so the
    shuffle join with routed keys runs at every scale.
    """
    u = user_event(spark, sf)
    w = multiply(transpose(u), u)
    return multiply(u, w, broadcast_cells=0, min_products_per_task=1000).df


def _halves(spark: SparkSession, sf: str) -> tuple[Matrix, Matrix]:
    """Quantities of returned lines and of all other lines: together the whole table."""
    return supplier_part(spark, sf, lines="returned"), supplier_part(spark, sf, lines="kept")


def q_add_matrices(spark: SparkSession, sf: str) -> DataFrame:
    return add(*_halves(spark, sf)).df


def q_add_matrices_join(spark: SparkSession, sf: str) -> DataFrame:
    return add_by_join(*_halves(spark, sf)).df


def q_subtract_matrices(spark: SparkSession, sf: str) -> DataFrame:
    return subtract(*_halves(spark, sf)).df


def q_split_quadrants(spark: SparkSession, sf: str) -> DataFrame:
    return split_tagged(supplier_part(spark, sf))


def q_merge_quadrants(spark: SparkSession, sf: str) -> DataFrame:
    q = supplier_part(spark, sf)
    return merge(*split(q), n_rows=q.n_rows, n_cols=q.n_cols).df


def q_cell_count(spark: SparkSession, sf: str) -> DataFrame:
    return cell_count(order_part(spark, sf))


def q_validate_matrix(spark: SparkSession, sf: str) -> DataFrame:
    """The contract's counters on the raw lines, where a part may stand twice in an order."""
    lines = spark.read.parquet(f"{sf.rstrip('/')}/lineitem.parquet")
    return validation_report(lines.select(F.col("l_orderkey").alias(ROW), F.col("l_partkey").alias(COL),
                                          F.col("l_quantity").alias(VALUE)))


def q_compare_algorithms(spark: SparkSession, sf: str) -> DataFrame:
    """Standard against one-level Strassen on SᵀS, with the cell count and checksum of Strassen's product."""
    a, b = _brand_gram(spark, sf)
    return compare_algorithms(a, b, levels=1)


def q_check_product(spark: SparkSession, sf: str) -> DataFrame:
    """QᵀQ (part co-purchase, BIGINT) checked against Q in linear time by eight vectors of signs."""
    a, b = _purchase_gram(spark, sf, "bigint")
    return check_product(a, b, multiply(a, b))


def _sweep_cases(spark: SparkSession, sf: str) -> list[SweepCase]:
    def users():
        u = user_event(spark, sf)
        return transpose(u), u

    def suppliers():
        return _brand_gram(spark, sf)

    def vectors():
        return _embeddings_gram(spark, sf)

    def unequal():
        return user_event(spark, sf), embedding_matrix(spark, sf)

    sizes = [user_event(spark, sf).n_rows, supplier_part(spark, sf).n_rows, embedding_matrix(spark, sf).n_rows]
    return [SweepCase(i + 1, n, f) for i, (n, f) in enumerate(zip([*sizes, sizes[0]], (users, suppliers, vectors, unequal)))]


def q_run_log(spark: SparkSession, sf: str) -> DataFrame:
    """Sweep Strassen (one level) over UᵀU, SᵀS, EᵀE and U·E, whose shapes do not fit; the run log, read from its files."""
    log = run_sweep(spark, _sweep_cases(spark, sf), scratch_path(spark, "sweep"), algorithm="strassen", levels=1)
    return log.select("order", "matrix_size", F.coalesce("algorithm", F.lit("")).alias("algorithm"),
                      F.coalesce("n_cells", F.lit(0)).alias("n_cells"), "status")


def _supplier_rows(spark: SparkSession, sf: str) -> tuple[DataFrame, int, int]:
    q = supplier_part(spark, sf)
    rows = spark.read.parquet(f"{sf.rstrip('/')}/lineitem.parquet").select("l_suppkey").distinct()
    return rows, q.n_rows, q.n_cols


def q_generate_int(spark: SparkSession, sf: str) -> DataFrame:
    """Integer matrix (i·31 + j·17 + i·j·7) mod 100: every part column of each supplier in lineitem."""
    rows, n_rows, n_cols = _supplier_rows(spark, sf)
    return generate_int_over(rows, n_rows, n_cols).df


def q_generate_random(spark: SparkSession, sf: str) -> DataFrame:
    """Seeded uniform [0, 1000) doubles on the same cells."""
    rows, n_rows, n_cols = _supplier_rows(spark, sf)
    return generate_random_over(rows, n_rows, n_cols, seed=42).df


def _order_part(spark: SparkSession, sf: str, value_type: str) -> Matrix:
    return order_part(spark, sf, with_shape=True, value_type=value_type)


def q_perturb_int(spark: SparkSession, sf: str) -> DataFrame:
    """Q[order, part] (BIGINT) plus the integer generator's value at each of its cells."""
    return perturb_int(_order_part(spark, sf, "bigint")).df


def q_perturb_random(spark: SparkSession, sf: str) -> DataFrame:
    """Q[order, part] plus seeded uniform noise in [0, 1) at each of its cells."""
    return perturb_random(_order_part(spark, sf, "double"), seed=42, high=1.0).df


def q_scan_matrix(spark: SparkSession, sf: str) -> DataFrame:
    """Q[supplier, part] written as Parquet in the shared folder and scanned back."""
    q = supplier_part(spark, sf)
    return roundtrip(spark, q, scratch_path(spark, "scan")).df


def q_scan_checked(spark: SparkSession, sf: str) -> DataFrame:
    """Q[supplier, part] written and scanned back with the contract checked in the plan, uniqueness too."""
    q = supplier_part(spark, sf)
    path = scratch_path(spark, "scan")
    write_matrix(Matrix(q.df, q.n_rows, q.n_cols), path)
    return read_matrix(spark, path, check=True).df


def q_merge_layout(spark: SparkSession, sf: str) -> DataFrame:
    """Q[supplier, part] written by quadrant and merged again by one scan."""
    path = scratch_path(spark, "quadrants")
    write_quadrants(supplier_part(spark, sf), path)
    return read_merged(spark, path).df


def q_split_layout(spark: SparkSession, sf: str) -> DataFrame:
    """Q11 + Q22 of Q[supplier, part] read from a quadrant layout: two of four folders are scanned."""
    path = scratch_path(spark, "quadrants")
    write_quadrants(supplier_part(spark, sf), path)
    q11, _, _, q22 = read_split(spark, path)
    return add(q11, q22).df


QUERIES: dict[str, Query] = {
    "multiply_sparse": q_multiply_sparse,
    "multiply_rect": q_multiply_rect,
    "gram_embeddings": q_gram_embeddings,
    "multiply_standard": q_multiply_standard,
    "multiply_integer": q_multiply_integer,
    "multiply_blocked": q_multiply_blocked,
    "multiply_strassen_tiled": q_multiply_strassen_tiled,
    "strassen_operands": q_strassen_operands,
    "multiply_strassen_1": q_multiply_strassen_1,
    "multiply_strassen_2": q_multiply_strassen_2,
    "multiply_strassen_odd": q_multiply_strassen_odd,
    "multiply_strassen_rect": q_multiply_strassen_rect,
    "multiply_hot_keys": q_multiply_hot_keys,
    "add_matrices": q_add_matrices,
    "add_matrices_join": q_add_matrices_join,
    "subtract_matrices": q_subtract_matrices,
    "split_quadrants": q_split_quadrants,
    "merge_quadrants": q_merge_quadrants,
    "cell_count": q_cell_count,
    "validate_matrix": q_validate_matrix,
    "compare_algorithms": q_compare_algorithms,
    "check_product": q_check_product,
    "run_log": q_run_log,
    "generate_int": q_generate_int,
    "generate_random": q_generate_random,
    "perturb_int": q_perturb_int,
    "perturb_random": q_perturb_random,
    "scan_matrix": q_scan_matrix,
    "scan_checked": q_scan_checked,
    "merge_layout": q_merge_layout,
    "split_layout": q_split_layout,
}


# ---------------------------------------------------------------------------
# DuckDB oracles
# ---------------------------------------------------------------------------

def _cells(row: str, col: str, value: str, table: str, where: str = "", vt: str = "DOUBLE") -> str:
    w = f" WHERE {where}" if where else ""
    return (f"SELECT CAST({row} AS INTEGER) AS r, CAST({col} AS INTEGER) AS c, "
            f"CAST(sum(CAST({value} AS {vt})) AS {vt}) AS v FROM {table}{w} GROUP BY 1, 2")


SQL_QOP = _cells("l_orderkey", "l_partkey", "l_quantity", "lineitem")
SQL_QSP = _cells("l_suppkey", "l_partkey", "l_quantity", "lineitem")
SQL_QOP_INT = _cells("l_orderkey", "l_partkey", "l_quantity", "lineitem", vt="BIGINT")
SQL_QSP_RETURNED = _cells("l_suppkey", "l_partkey", "l_quantity", "lineitem", "l_returnflag = 'R'")
SQL_QSP_KEPT = _cells("l_suppkey", "l_partkey", "l_quantity", "lineitem", "l_returnflag IS DISTINCT FROM 'R'")
SQL_IPB = (r"SELECT CAST(p_partkey AS INTEGER) AS r, "
           r"CAST(CAST(regexp_extract(p_brand, '#(\d+)$', 1) AS INTEGER) - 1 AS INTEGER) AS c, "
           r"CAST(1.0 AS DOUBLE) AS v FROM part")
SQL_E = ("SELECT CAST(vec_id AS INTEGER) AS r, CAST(unnest(range(len(embedding))) AS INTEGER) AS c, "
         "CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings")
SQL_U = ("SELECT CAST(user_id AS INTEGER) AS r, CAST(k - 1 AS INTEGER) AS c, CAST(count(*) AS DOUBLE) AS v "
         "FROM (SELECT user_id, dense_rank() OVER (ORDER BY event_type NULLS FIRST) AS k FROM events) GROUP BY 1, 2")


def _gram_sql(cells: str, vt: str = "DOUBLE", rows_of: str = "r", inner: str = "c",
              nonzero: bool = False) -> str:
    """Σ_k X[·,k]·X[·,k] as ``(row, col, value)``; ``nonzero`` drops exact zeros."""
    having = " HAVING sum(x.v * y.v) <> 0" if nonzero else ""
    return (f'WITH q AS ({cells}) SELECT x.{rows_of} AS "row", y.{rows_of} AS col, '
            f"CAST(sum(x.v * y.v) AS {vt}) AS value FROM q x JOIN q y ON x.{inner} = y.{inner} "
            f"GROUP BY 1, 2{having}")


SQL_S = (f"WITH a AS ({SQL_QSP}), b AS ({SQL_IPB}) "
         f"SELECT a.r AS r, b.c AS c, CAST(sum(a.v * b.v) AS DOUBLE) AS v FROM a JOIN b ON a.c = b.r GROUP BY 1, 2")
SQL_E_GRAM = (f"WITH e AS ({SQL_E}) "
              f'SELECT x.c AS "row", y.c AS col, round(sum(x.v * y.v), 6) AS value '
              f"FROM e x JOIN e y ON x.r = y.r GROUP BY 1, 2")


def _elementwise_sql(op: str) -> str:
    return (f"WITH a AS ({SQL_QSP_RETURNED}), b AS ({SQL_QSP_KEPT}) "
            f'SELECT coalesce(a.r, b.r) AS "row", coalesce(a.c, b.c) AS col, '
            f"CAST(coalesce(a.v, 0) {op} coalesce(b.v, 0) AS DOUBLE) AS value "
            f"FROM a FULL OUTER JOIN b ON a.r = b.r AND a.c = b.c")


def _uniform_sql(counter: str, seed: int = 42) -> str:
    """The generator's number in [0, 1) for a counter."""
    return f"(('0x' || substr(md5('{seed}:' || CAST({counter} AS BIGINT)), 1, 13))::BIGINT::DOUBLE / 4503599627370496::DOUBLE)"


def _checked_sql(product: str, columns: str) -> str:
    """Non-zero cells and checksum of a product, after ``columns``."""
    return (f'SELECT {columns}, CAST(count(*) FILTER (value <> 0) AS BIGINT) AS n_cells, '
            f'CAST(coalesce(sum(CAST(value AS DOUBLE) * (("row" * 31 + col * 17) % 101 + 1)), 0) AS DOUBLE) AS checksum FROM ({product})')


_ALPHA_VALUES = ("(1, 0, 0, 1.0), (1, 1, 1, 1.0), (2, 1, 0, 1.0), (2, 1, 1, 1.0), (3, 0, 0, 1.0), "
                 "(4, 1, 1, 1.0), (5, 0, 0, 1.0), (5, 0, 1, 1.0), (6, 1, 0, 1.0), (6, 0, 0, -1.0), "
                 "(7, 0, 1, 1.0), (7, 1, 1, -1.0)")
_HALF = ("SELECT CAST((max(l_suppkey) + 2) // 2 AS INTEGER) AS hr, "
         "CAST((max(l_partkey) + 2) // 2 AS INTEGER) AS hc FROM lineitem")

SQL: dict[str, str] = {
    "multiply_sparse": _gram_sql(SQL_QOP, rows_of="c", inner="r"),
    "multiply_rect": f'SELECT r AS "row", c AS col, v AS value FROM ({SQL_S})',
    "gram_embeddings": SQL_E_GRAM,
    "multiply_standard": _gram_sql(SQL_QOP, rows_of="c", inner="r"),
    "multiply_integer": _gram_sql(SQL_QOP_INT, vt="BIGINT", rows_of="c", inner="r"),
    "multiply_blocked": SQL_E_GRAM,
    "multiply_strassen_tiled": SQL_E_GRAM,
    "strassen_operands": (f"WITH q AS ({SQL_QSP}), h AS ({_HALF}), alpha(p, qi, qj, w) AS (VALUES {_ALPHA_VALUES}) "
                          f'SELECT CAST(a.p AS BIGINT) AS path, CAST(q.r % h.hr AS INTEGER) AS "row", '
                          f"CAST(q.c % h.hc AS INTEGER) AS col, CAST(sum(a.w * q.v) AS DOUBLE) AS value "
                          f"FROM q CROSS JOIN h JOIN alpha a ON q.r // h.hr = a.qi AND q.c // h.hc = a.qj "
                          f"GROUP BY 1, 2, 3"),
    "multiply_strassen_1": _gram_sql(SQL_S, nonzero=True, rows_of="c", inner="r"),
    "multiply_strassen_2": _gram_sql(SQL_S, nonzero=True, rows_of="c", inner="r"),
    "multiply_strassen_odd": _gram_sql(SQL_U, nonzero=True, rows_of="c", inner="r"),
    "multiply_strassen_rect": f'SELECT r AS "row", c AS col, v AS value FROM ({SQL_S}) WHERE v <> 0',
    "multiply_hot_keys": (f"WITH u AS ({SQL_U}), w AS (SELECT x.c AS r, y.c AS c, sum(x.v * y.v) AS v "
                          f"FROM u x JOIN u y ON x.r = y.r GROUP BY 1, 2) "
                          f'SELECT u.r AS "row", w.c AS col, CAST(sum(u.v * w.v) AS DOUBLE) AS value '
                          f"FROM u JOIN w ON u.c = w.r GROUP BY 1, 2"),
    "add_matrices": _elementwise_sql("+"),
    "add_matrices_join": _elementwise_sql("+"),
    "subtract_matrices": _elementwise_sql("-"),
    "split_quadrants": (f"WITH q AS ({SQL_QSP}), h AS ({_HALF}) "
                        f"SELECT CAST(CASE WHEN q.r >= h.hr THEN 20 ELSE 10 END + "
                        f"CASE WHEN q.c >= h.hc THEN 2 ELSE 1 END AS INTEGER) AS q, "
                        f'CAST(CASE WHEN q.r >= h.hr THEN q.r - h.hr ELSE q.r END AS INTEGER) AS "row", '
                        f"CAST(CASE WHEN q.c >= h.hc THEN q.c - h.hc ELSE q.c END AS INTEGER) AS col, "
                        f"q.v AS value FROM q CROSS JOIN h"),
    "merge_quadrants": f'SELECT r AS "row", c AS col, v AS value FROM ({SQL_QSP})',
    "cell_count": f"SELECT CAST(count(*) AS BIGINT) AS n_cells FROM ({SQL_QOP})",
    "validate_matrix": ("SELECT CAST(sum(n) AS BIGINT) AS n_cells, "
                        "count(*) FILTER (r IS NULL OR c IS NULL) AS null_coordinates, "
                        "CAST(sum(nulls) AS BIGINT) AS null_values, count(*) FILTER (n > 1) AS duplicate_coordinates "
                        "FROM (SELECT l_orderkey AS r, l_partkey AS c, count(*) AS n, "
                        "count(*) FILTER (l_quantity IS NULL) AS nulls FROM lineitem GROUP BY 1, 2)"),
    "compare_algorithms": _checked_sql(_gram_sql(SQL_S, nonzero=True, rows_of="c", inner="r"),
                                       "CAST(0.0 AS DOUBLE) AS max_abs_diff, CAST(0 AS BIGINT) AS n_mismatch"),
    "check_product": _checked_sql(_gram_sql(SQL_QOP_INT, vt="BIGINT", rows_of="c", inner="r"),
                                  'CAST(8 AS INTEGER) AS trials, count(DISTINCT "row") AS n_rows, '
                                  "CAST(0.0 AS DOUBLE) AS max_abs_diff, CAST(0 AS BIGINT) AS n_mismatch"),
    "run_log": ('SELECT CAST(1 AS BIGINT) AS "order", (SELECT CAST(max(user_id) + 1 AS BIGINT) FROM events) AS matrix_size, '
                f"'strassen' AS algorithm, count(*) AS n_cells, 'success' AS status FROM ({_gram_sql(SQL_U, rows_of='c', inner='r')}) "
                "UNION ALL SELECT CAST(2 AS BIGINT), (SELECT CAST(max(l_suppkey) + 1 AS BIGINT) FROM lineitem), 'strassen', "
                f"count(*), 'success' FROM ({_gram_sql(SQL_S, rows_of='c', inner='r')}) "
                "UNION ALL SELECT CAST(3 AS BIGINT), (SELECT CAST(max(vec_id) + 1 AS BIGINT) FROM embeddings), 'strassen', "
                f"count(*), 'success' FROM ({SQL_E_GRAM}) "
                "UNION ALL SELECT CAST(4 AS BIGINT), (SELECT CAST(max(user_id) + 1 AS BIGINT) FROM events), '', 0, 'failed'"),
    "generate_int": ("WITH d AS (SELECT max(l_partkey) + 1 AS m FROM lineitem), "
                     "i AS (SELECT DISTINCT CAST(l_suppkey AS BIGINT) AS i FROM lineitem), "
                     "j AS (SELECT unnest(range(m)) AS j FROM d) "
                     'SELECT CAST(i AS INTEGER) AS "row", CAST(j AS INTEGER) AS col, '
                     "CAST((i * 31 + j * 17 + i * j * 7) % 100 AS BIGINT) AS value FROM i CROSS JOIN j"),
    "generate_random": ("WITH d AS (SELECT max(l_partkey) + 1 AS m FROM lineitem), "
                        "i AS (SELECT DISTINCT CAST(l_suppkey AS BIGINT) AS i FROM lineitem), "
                        "j AS (SELECT unnest(range(m)) AS j FROM d) "
                        'SELECT CAST(i AS INTEGER) AS "row", CAST(j AS INTEGER) AS col, '
                        f"{_uniform_sql('i * m + j')} * 1000::DOUBLE + 0::DOUBLE AS value FROM i CROSS JOIN j CROSS JOIN d"),
    "perturb_int": (f'SELECT r AS "row", c AS col, CAST(v + (r::BIGINT * 31 + c::BIGINT * 17 + r::BIGINT * c::BIGINT * 7) % 100 '
                    f"AS BIGINT) AS value FROM ({SQL_QOP_INT})"),
    "perturb_random": ("WITH d AS (SELECT max(l_partkey) + 1 AS m FROM lineitem) "
                       f'SELECT r AS "row", c AS col, v + ({_uniform_sql("r::BIGINT * m + c")} * 1::DOUBLE + 0::DOUBLE) AS value '
                       f"FROM ({SQL_QOP}) CROSS JOIN d"),
    "scan_matrix": f'SELECT r AS "row", c AS col, v AS value FROM ({SQL_QSP})',
    "scan_checked": f'SELECT r AS "row", c AS col, v AS value FROM ({SQL_QSP})',
    "merge_layout": f'SELECT r AS "row", c AS col, v AS value FROM ({SQL_QSP})',
    "split_layout": (f"WITH q AS ({SQL_QSP}), h AS ({_HALF}) "
                     f'SELECT CAST(q.r % h.hr AS INTEGER) AS "row", CAST(q.c % h.hc AS INTEGER) AS col, '
                     f"CAST(sum(q.v) AS DOUBLE) AS value FROM q CROSS JOIN h WHERE (q.r < h.hr) = (q.c < h.hc) GROUP BY 1, 2"),
}
