"""Pick a multiplication algorithm from facts about the operands.

The coordinate join forms one record per scalar product, which is right for
sparse operands and wrong for large dense ones; tiles turn the dense inner
loop into numpy products.  The rule needs the density, so it counts cells
(one job per operand) unless the caller passes the counts.

Whatever algorithm runs, :func:`product` returns the same cells: those whose
value is not zero.  BIGINT overflow raises in all of them.
"""

from __future__ import annotations

from ..matrix import Matrix, as_matrix, compact
from .blocked import multiply_blocked, multiply_strassen_tiled
from .multiply import multiply
from .strassen import strassen

# Thresholds of the rule.
DENSE_FRACTION = 0.25      # stored cells / shape above which an operand counts as dense
MIN_TILED_DIM = 512        # below this every dimension is small enough for the join form
DEFAULT_TILE = 512


def choose_algorithm(n_rows: int, n_inner: int, n_cols: int, cells_a: int, cells_b: int, *,
                     tile: int = DEFAULT_TILE) -> str:
    """``"blocked"`` when both operands are dense and the product is large, else ``"standard"``."""
    dens_a = cells_a / max(1, n_rows * n_inner)
    dens_b = cells_b / max(1, n_inner * n_cols)
    big = min(n_rows, n_inner, n_cols) >= min(MIN_TILED_DIM, tile)
    return "blocked" if big and dens_a >= DENSE_FRACTION and dens_b >= DENSE_FRACTION else "standard"


def product(a: Matrix, b: Matrix, *, algorithm: str = "auto", tile: int = DEFAULT_TILE,
            levels: int | None = None, cells: tuple[int, int] | None = None, **opts) -> Matrix:
    """The non-zero cells of ``A·B`` by a named algorithm, or by :func:`choose_algorithm` when ``"auto"``.

    Algorithms: ``standard``, ``strassen``, ``blocked``, ``strassen_tiled``.
    ``opts`` go to the coordinate forms; the tiled forms take none and refuse them.
    """
    a, b = as_matrix(a).with_shape(), as_matrix(b).with_shape()
    if algorithm == "auto":
        ca, cb = cells if cells is not None else (a.df.count(), b.df.count())
        algorithm = "standard" if opts else choose_algorithm(a.n_rows, a.n_cols, b.n_cols, ca, cb, tile=tile)
    if opts and algorithm in ("blocked", "strassen_tiled"):
        raise TypeError(f"{algorithm} takes no {', '.join(sorted(opts))}")
    if algorithm == "standard":
        return compact(multiply(a, b, **opts))
    if algorithm == "strassen":
        return strassen(a, b, levels=levels, **{"compact_zeros": True, **opts})
    if algorithm == "blocked":
        return multiply_blocked(a, b, tile=tile)
    if algorithm == "strassen_tiled":
        return multiply_strassen_tiled(a, b, tile=tile, levels=1 if levels is None else levels)
    raise ValueError(f"unknown algorithm {algorithm!r}")
