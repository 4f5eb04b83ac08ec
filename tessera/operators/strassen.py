"""Strassen multiplication as one lazy plan.

Instead of a driver-side recursion, every level is a re-keying of cells:

* **down** — per level, the (up to) four cells that share a position within
  their quadrants meet in one row: ``groupBy(path, row mod h, col mod h)`` with
  one conditional sum per quadrant, one record shuffled per cell.  All seven
  operands are then sums inside that row (coefficient table α, B with β), and
  the product's digit is appended to ``path``.  Level ``l`` shuffles
  ``(7/4)^(l-1)`` records per cell of A: 11.2 in all for four levels, where
  copying a cell to every product that uses it would shuffle ``3^4 = 81``.
* **leaf** — all ``7^L`` products in one join on ``(path, k)``: a single
  batched :func:`multiply` on path-packed coordinates.
* **up** — per level, the seven products of one path prefix meet in one row
  by ``(path div 8, row, col)``, and the four quadrants are sums inside it
  (coefficient table γ), moved to their places.

Shapes may be odd or rectangular: each dimension is padded (as a number,
no cells are added) to a multiple of ``2^L``, and cells outside the true
shape are dropped at the end.  Products of sums can fill in cells whose true
value is 0; ``compact_zeros`` removes them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.coefficients import ALPHA, BETA, PATH_BASE, by_product, by_result
from ..matrix import COL, ROW, VALUE, Matrix, as_matrix
from ..session import shared_dir
from .multiply import multiply, result_type

# The reference's recursion cut-offs (size threshold, depth cap).
STRASSEN_THRESHOLD = 256
MAX_DEPTH = 4


def levels_for(n: int, threshold: int = STRASSEN_THRESHOLD, max_depth: int = MAX_DEPTH) -> int:
    """Levels of halving while the size is above ``threshold``, at most ``max_depth``."""
    if n <= threshold:
        return 0
    return min(max_depth, max(0, math.ceil(math.log2(n / threshold))))


def padded(n: int, levels: int) -> int:
    step = 1 << levels
    return ((n + step - 1) // step) * step


def halves(n: int, levels: int) -> list[int]:
    """Quadrant sizes per level: ``N/2, N/4, …`` for ``N`` = ``n`` padded to ``2^L``."""
    p = padded(n, levels)
    return [p >> l for l in range(1, levels + 1)]


def _by_case(case: Column, cases: list[int]) -> list[Column]:
    """One sum per case: NULL where a group has no such cell."""
    return [F.sum(F.when(case == c, F.col(VALUE))).alias(f"v{c}") for c in cases]


def _combination(terms: list[tuple[int, int]], vt: str) -> Column:
    """``Σ w·v`` over the ``(case, w)`` terms, w = ±1; NULL if none of them has a cell."""
    signed = [F.col(f"v{c}") if w > 0 else -F.col(f"v{c}") for c, w in terms]
    if len(signed) == 1:
        return signed[0]
    zero = F.lit(0).cast(vt)
    total = sum((F.coalesce(x, zero) for x in signed[1:]), F.coalesce(signed[0], zero))
    return F.when(F.coalesce(*signed).isNotNull(), total)


def _exploded(df: DataFrame, keys: list[str], sums: dict[int, list[tuple[int, int]]], name: str, vt: str) -> DataFrame:
    """One row per sum that has a cell: ``keys, name, value``."""
    each = F.array(*[F.struct(F.lit(k).alias(name), _combination(terms, vt).cast(vt).alias(VALUE)) for k, terms in sums.items()])
    return df.select(*keys, F.explode(each).alias("x")).select(*keys, f"x.{name}", f"x.{VALUE}").filter(F.col(VALUE).isNotNull())


def _down(df: DataFrame, table: dict, hr: list[int], hc: list[int], vt: str) -> DataFrame:
    """``(path, row, col, value)`` after one grouping per level; coordinates are local to the deepest quadrant."""
    cur = df.select(F.lit(0).cast("long").alias("path"), ROW, COL, F.col(VALUE).cast(vt).alias(VALUE))
    sums = {p: terms for p, terms in enumerate(by_product(table)) if terms}
    for h_r, h_c in zip(hr, hc):
        q = F.when(F.col(ROW) >= h_r, 2).otherwise(0) + F.when(F.col(COL) >= h_c, 1).otherwise(0)
        cur = cur.select("path", (F.col(ROW) % h_r).cast("int").alias(ROW), (F.col(COL) % h_c).cast("int").alias(COL),
                         q.alias("q"), VALUE)
        met = cur.groupBy("path", ROW, COL).agg(*_by_case(F.col("q"), [0, 1, 2, 3]))
        cur = _exploded(met, ["path", ROW, COL], sums, "p", vt) \
            .select((F.col("path") * PATH_BASE + F.col("p")).alias("path"), ROW, COL, VALUE)
    return cur


def _up(cur: DataFrame, hr: list[int], hc: list[int], vt: str) -> DataFrame:
    """Products ``(path, row, col, value)`` combined level by level, deepest first, into cells of C."""
    sums = {q: terms for q, terms in enumerate(by_result())}
    for h_r, h_c in zip(reversed(hr), reversed(hc)):
        digit = F.col("path").bitwiseAND(F.lit(PATH_BASE - 1))
        cur = cur.select(F.shiftright("path", 3).alias("path"), ROW, COL, digit.alias("p"), VALUE)
        met = cur.groupBy("path", ROW, COL).agg(*_by_case(F.col("p"), list(range(1, PATH_BASE))))
        cur = _exploded(met, ["path", ROW, COL], sums, "q", vt).select(
            "path",
            (F.col(ROW) + F.when(F.col("q") >= 2, h_r).otherwise(0)).cast("int").alias(ROW),
            (F.col(COL) + F.col("q") % 2 * h_c).cast("int").alias(COL), VALUE)
    return cur.select(ROW, COL, VALUE)


def operands(m: Matrix, side: str, levels: int, *,
             drop_zeros: bool = False, dims: tuple[int, int] | None = None) -> DataFrame:
    """The ``7^L`` Strassen operands of one side: ``(path, row, col, value)``.

    ``side`` is ``"A"`` (α) or ``"B"`` (β).  Coordinates are local to the
    leaf block.  ``dims`` overrides the (row, col) sizes used for padding.
    """
    m = as_matrix(m)
    if dims is None:
        m = m.with_shape()
        dims = (m.n_rows, m.n_cols)
    table = ALPHA if side.upper() == "A" else BETA
    vt = m.value_type
    hr, hc = halves(dims[0], levels), halves(dims[1], levels)
    if levels == 0:
        return m.df.select(F.lit(0).cast("long").alias("path"), ROW, COL, VALUE)
    out = _down(m.df, table, hr, hc, vt)
    if drop_zeros:
        out = out.filter(F.col(VALUE) != 0)
    return out


def _pack(path: Column, k: Column) -> Column:
    return F.shiftleft(path.cast("long"), 32).bitwiseOR(k.cast("long"))


def strassen(a: Matrix | DataFrame, b: Matrix | DataFrame, *, levels: int | None = None,
             threshold: int = STRASSEN_THRESHOLD, max_depth: int = MAX_DEPTH,
             compact_zeros: bool = False, cut_lineage: bool = False, **mult_opts) -> Matrix:
    """``A·B`` by Strassen's method with ``levels`` levels (default: from the size rule).

    ``mult_opts`` go to the leaf :func:`multiply` (``skew``, ``broadcast_cells``, …).
    ``cut_lineage`` writes both operand sets with a reliable ``checkpoint()``
    to the shared checkpoint folder before the leaf join, so a lost executor
    during the leaf never sends Spark back through the down step.
    """
    a, b = as_matrix(a).with_shape(), as_matrix(b).with_shape()
    if a.n_cols != b.n_rows:
        raise ValueError(f"inner dimensions differ: {a.shape} · {b.shape}")
    m_, k_, n_ = a.n_rows, a.n_cols, b.n_cols
    if levels is None:
        levels = levels_for(min(m_, k_, n_), threshold, max_depth)
    if levels == 0:
        c = multiply(a, b, **mult_opts)
        return _compact(c) if compact_zeros else c
    vt = result_type(a, b)
    if a.value_type != vt:
        a = a.cast(vt)
    if b.value_type != vt:
        b = b.cast(vt)
    hm, hn = halves(m_, levels), halves(n_, levels)

    # Leaf: the 7^L products are one batched multiply.  Packing the path into
    # both coordinates, A'[(path,i), (path,k)] · B'[(path,k), j] is an ordinary
    # product, so the standard multiply's shape-checked broadcast, spreading
    # and skew handling apply to the leaf as well.
    paths = 7 ** levels
    hk = halves(k_, levels)[-1]
    a_leaf = operands(a, "A", levels, drop_zeros=True, dims=(m_, k_)).select(
        _pack(F.col("path"), F.col(ROW)).alias(ROW), _pack(F.col("path"), F.col(COL)).alias(COL), VALUE)
    b_leaf = operands(b, "B", levels, drop_zeros=True, dims=(k_, n_)).select(
        _pack(F.col("path"), F.col(ROW)).alias(ROW), F.col(COL), VALUE)
    if cut_lineage:
        shared_dir(a_leaf.sparkSession)  # make sure a checkpoint folder is registered
        a_leaf, b_leaf = a_leaf.checkpoint(eager=True), b_leaf.checkpoint(eager=True)
    leaf = multiply(Matrix(a_leaf, paths * hm[-1], paths * hk, unique=True),
                    Matrix(b_leaf, paths * hk, hn[-1], unique=True), **mult_opts)
    leaf_cells = leaf.df.select(F.shiftright(F.col(ROW), 32).alias("path"),
                                F.col(ROW).bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias(ROW), COL, VALUE)
    out = _up(leaf_cells, hm, hn, vt).filter((F.col(ROW) < m_) & (F.col(COL) < n_))
    c = Matrix(out, m_, n_, unique=True)
    return _compact(c) if compact_zeros else c


def _compact(c: Matrix) -> Matrix:
    return c.with_df(c.df.filter(F.col(VALUE) != 0))

