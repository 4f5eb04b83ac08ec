"""Compare products: two algorithms cell by cell, or one product against its operands in linear time."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..matrix import COL, ROW, VALUE, Matrix
from ..operators.elementwise import align
from ..operators.multiply import DEFAULT_BROADCAST_CELLS, multiply, result_type
from ..operators.strassen import strassen

MAX_TRIALS = 32  # one digit of a digest each


def cell_weight() -> Column:
    """A small weight per coordinate, for checksums any SQL engine can repeat."""
    return (F.col(ROW).cast("long") * 31 + F.col(COL).cast("long") * 17) % 101 + 1


def compare_products(x: Matrix, y: Matrix, *, tolerance: float = 0.0) -> DataFrame:
    """``max_abs_diff DOUBLE, n_mismatch BIGINT, n_cells BIGINT, checksum DOUBLE`` over the union of stored cells.

    One full outer join on ``(row, col)``; absent cells count as 0, so an
    explicit zero in one product and no cell in the other agree.  ``n_cells``
    and ``checksum`` (``Σ value·weight`` by coordinate) are of the non-zero
    cells of ``y``.
    """
    d = align(x, y)
    diff = F.abs(F.col("a").cast("double") - F.col("b").cast("double"))
    return d.agg(
        F.coalesce(F.max(diff), F.lit(0.0)).alias("max_abs_diff"),
        F.count_if(diff > F.lit(tolerance)).cast("bigint").alias("n_mismatch"),
        F.count_if(F.col("b") != 0).cast("bigint").alias("n_cells"),
        F.coalesce(F.sum(F.col("b").cast("double") * cell_weight()), F.lit(0.0)).alias("checksum"),
    )


def compare_algorithms(a: Matrix, b: Matrix, *,
                       first: Callable[[Matrix, Matrix], Matrix] = multiply,
                       second: Callable[[Matrix, Matrix], Matrix] | None = None,
                       levels: int = 1, tolerance: float = 0.0) -> DataFrame:
    """Standard against Strassen (by default) on the same operands, in one plan."""
    if second is None:
        def second(p: Matrix, q: Matrix) -> Matrix:
            return strassen(p, q, levels=levels)
    return compare_products(first(a, b), second(a, b), tolerance=tolerance)


def _signed(value: Column, index: str, trials: int, seed: int) -> list[Column]:
    """``value`` times the sign that each trial gives to ``index``: a digit of a digest, odd or even."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(index).cast("string")))
    return [F.when(F.ascii(F.substring(digest, t + 1, 1)) % 2 == 1, -value).otherwise(value) for t in range(trials)]


def check_product(a: Matrix, b: Matrix, c: Matrix, *, trials: int = 8, seed: int = 0, tolerance: float = 0.0) -> DataFrame:
    """Whether ``c = a·b``, by comparing ``a(bx)`` with ``cx`` for ``trials`` seeded vectors x of signs.

    Linear in the cells of ``a``, ``b`` and ``c``: no product of matrices is
    formed, so it checks a product of any algorithm where a second one would
    not fit.  A row of ``c`` with a wrong cell agrees in one trial with
    probability 1/2 at most, so in all with ``2^-trials``.  Signs depend on the
    seed and the column index alone, so a retried task repeats them.

    One row: ``trials, n_rows`` (rows with cells on either side),
    ``max_abs_diff`` (largest ``|a(bx) - cx|``), ``n_mismatch`` (rows where a
    trial differs by more than ``tolerance`` times the sum of magnitudes that
    went into that row), ``n_cells`` and ``checksum`` of c's non-zero cells.
    BIGINT operands are compared exactly, in decimals.
    """
    if not 1 <= trials <= MAX_TRIALS:
        raise ValueError(f"trials must be 1 to {MAX_TRIALS}")
    number = "decimal(19,0)" if result_type(a, b) == "bigint" and c.value_type == "bigint" else "double"
    value = F.col(VALUE).cast(number)
    names = [f"x{t}" for t in range(trials)]

    def sums(of: list[Column], size: Column) -> list[Column]:
        return [F.sum(x).alias(n) for x, n in zip(of, names)] + [F.sum(size).alias("size")]

    # Cells are dealt by row before they are summed: sums of every trial, kept per task,
    # would be one wide record per row and task, more of them the more tasks there are.
    bx = b.df.repartition(ROW).groupBy(F.col(ROW).alias("k")).agg(*sums(_signed(value, COL, trials, seed), F.abs(value.cast("double"))))
    if b.n_rows is not None and b.n_rows * (trials + 1) <= DEFAULT_BROADCAST_CELLS:
        bx = F.broadcast(bx)  # a row per row of b: bounded by its shape
    else:
        bx = bx.hint("merge")  # a row per row of b is as long as the operands
    met = a.df.repartition(COL).withColumnRenamed(VALUE, "u").join(bx, F.col(COL) == F.col("k")).repartition(ROW)
    u = F.col("u").cast(number)
    abx = met.groupBy(ROW).agg(*sums([u * F.col(n) for n in names], F.abs(u.cast("double")) * F.col("size")))
    nothing = [F.lit(0).cast("long").alias("cells"), F.lit(0.0).alias("checksum")]
    cx = c.df.repartition(ROW).groupBy(ROW).agg(*sums(_signed(-value, COL, trials, seed), F.abs(value.cast("double"))),
                               F.count_if(F.col(VALUE) != 0).alias("cells"),
                               F.sum(F.col(VALUE).cast("double") * cell_weight()).alias("checksum"))
    both = abx.select("*", *nothing).unionByName(cx)
    rows = both.groupBy(ROW).agg(*[F.sum(n).cast("double").alias(n) for n in names],
                                 *[F.sum(n).alias(n) for n in ("size", "cells", "checksum")])
    worst = F.greatest(*[F.abs(F.col(n)) for n in names]) if trials > 1 else F.abs(F.col(names[0]))
    return rows.agg(
        F.lit(trials).alias("trials"),
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(F.max(worst), F.lit(0.0)).alias("max_abs_diff"),
        F.count_if(worst > F.col("size") * F.lit(tolerance)).alias("n_mismatch"),
        F.coalesce(F.sum("cells"), F.lit(0)).cast("bigint").alias("n_cells"),
        F.coalesce(F.sum("checksum"), F.lit(0.0)).alias("checksum"))
