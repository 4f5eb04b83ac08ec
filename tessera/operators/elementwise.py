"""Element-wise operators: A + B, A − B, and cell alignment.

``add``/``subtract`` stack both operands with a sign and aggregate by
``(row, col)``: one shuffle with map-side partial sums, no join and no sort.
A cell stored in only one operand is kept (``b`` alone gives ``−b`` in
``A − B``), which is what a full outer join with ``coalesce(…, 0)`` gives
for unique coordinates.  :func:`align` is that full outer join, for callers
who need both values side by side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..matrix import COL, ROW, VALUE, Matrix, as_matrix, zero_value


def _shape(a: Matrix, b: Matrix) -> tuple[int | None, int | None]:
    for x, y in ((a.n_rows, b.n_rows), (a.n_cols, b.n_cols)):
        if x is not None and y is not None and x != y:
            raise ValueError(f"shape mismatch: {a.shape} vs {b.shape}")
    return (a.n_rows if a.n_rows is not None else b.n_rows,
            a.n_cols if a.n_cols is not None else b.n_cols)


def _result_type(a: Matrix, b: Matrix) -> str:
    return "bigint" if a.value_type == "bigint" and b.value_type == "bigint" else "double"


def linear_combination(terms: list[tuple[Matrix, int | float]]) -> Matrix:
    """``Σ wᵢ·Mᵢ`` over matrices of one shape, in a single aggregate."""
    if not terms:
        raise ValueError("no terms")
    vt = "bigint" if all(m.value_type == "bigint" and float(w).is_integer() for m, w in terms) else "double"
    shape = (terms[0][0].n_rows, terms[0][0].n_cols)
    parts = []
    for m, w in terms:
        shape = _shape(Matrix(m.df, *shape), m)
        wl = F.lit(int(w)).cast("bigint") if vt == "bigint" else F.lit(float(w))
        parts.append(m.df.select(ROW, COL, (F.coalesce(F.col(VALUE).cast(vt), zero_value(vt)) * wl).alias(VALUE)))
    stacked = parts[0]
    for p in parts[1:]:
        stacked = stacked.unionByName(p)
    out = stacked.groupBy(ROW, COL).agg(F.sum(VALUE).cast(vt).alias(VALUE))
    return Matrix(out, *shape, unique=True)


def add(a: Matrix | DataFrame, b: Matrix | DataFrame) -> Matrix:
    """A + B; an absent cell is 0."""
    return linear_combination([(as_matrix(a), 1), (as_matrix(b), 1)])


def subtract(a: Matrix | DataFrame, b: Matrix | DataFrame) -> Matrix:
    """A − B; an absent cell is 0, a cell only in B gives −b."""
    return linear_combination([(as_matrix(a), 1), (as_matrix(b), -1)])


def align(a: Matrix | DataFrame, b: Matrix | DataFrame) -> DataFrame:
    """Full outer equi-join on ``(row, col)``: ``row, col, a, b`` with absent = 0."""
    a, b = as_matrix(a), as_matrix(b)
    vt = _result_type(a, b)
    left = a.df.select(ROW, COL, F.col(VALUE).alias("a"))
    right = b.df.select(ROW, COL, F.col(VALUE).alias("b"))
    j = left.join(right, [ROW, COL], "full_outer")
    return j.select(
        ROW, COL,
        F.coalesce(F.col("a").cast(vt), zero_value(vt)).alias("a"),
        F.coalesce(F.col("b").cast(vt), zero_value(vt)).alias("b"),
    )


def add_by_join(a: Matrix | DataFrame, b: Matrix | DataFrame, sign: int = 1) -> Matrix:
    """A ± B through :func:`align` (the full-outer-join form)."""
    a, b = as_matrix(a), as_matrix(b)
    shape = _shape(a, b)
    j = align(a, b)
    v = F.col("a") + F.col("b") if sign >= 0 else F.col("a") - F.col("b")
    return Matrix(j.select(ROW, COL, v.alias(VALUE)), *shape, unique=a.unique and b.unique)

