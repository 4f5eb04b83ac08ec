"""Split a matrix into four quadrants and merge them back.

The quadrant boundary is ``h = ceil(n / 2)`` (per dimension), so an odd size
splits into quadrants that do not overlap and merge back without duplicate
coordinates.  All four quadrants are filters with a re-base shift: narrow,
and pushed into a Parquet scan when the input is one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..matrix import COL, ROW, VALUE, Matrix

QUADRANTS = (11, 12, 21, 22)


def half(n: int) -> int:
    return (n + 1) // 2


def _quadrant(m: Matrix, hr: int, hc: int, qi: int, qj: int) -> Matrix:
    r, c = F.col(ROW), F.col(COL)
    cond = (r < hr if qi == 0 else r >= hr) & (c < hc if qj == 0 else c >= hc)
    df = m.df.filter(cond).select(
        (r - F.lit(hr * qi)).cast("int").alias(ROW) if qi else r.alias(ROW),
        (c - F.lit(hc * qj)).cast("int").alias(COL) if qj else c.alias(COL),
        F.col(VALUE),
    )
    n_r = hr if qi == 0 else m.n_rows - hr
    n_c = hc if qj == 0 else m.n_cols - hc
    return Matrix(df, n_r, n_c, m.unique)


def split(m: Matrix) -> tuple[Matrix, Matrix, Matrix, Matrix]:
    """(A11, A12, A21, A22), each re-based to the origin."""
    m = m.with_shape()
    hr, hc = half(m.n_rows), half(m.n_cols)
    return tuple(_quadrant(m, hr, hc, qi, qj) for qi in (0, 1) for qj in (0, 1))  # type: ignore[return-value]


def split_tagged(m: Matrix) -> DataFrame:
    """All four quadrants in one table with the quadrant id ``q`` (11, 12, 21, 22).

    A single narrow projection instead of four filtered scans.
    """
    m = m.with_shape()
    hr, hc = half(m.n_rows), half(m.n_cols)
    qi = (F.col(ROW) >= hr).cast("int")
    qj = (F.col(COL) >= hc).cast("int")
    return m.df.select(
        ((qi + 1) * 10 + (qj + 1)).alias("q"),
        (F.col(ROW) - qi * hr).cast("int").alias(ROW),
        (F.col(COL) - qj * hc).cast("int").alias(COL),
        F.col(VALUE),
    )


def placed_by(tagged: DataFrame, q: Column, hr: int, hc: int) -> DataFrame:
    """Inverse of :func:`split_tagged`: cells moved to the places of their quadrants ``q``, one narrow projection."""
    return tagged.select((F.col(ROW) + F.when(q >= 20, hr).otherwise(0)).cast("int").alias(ROW),
                         (F.col(COL) + F.when(q % 10 == 2, hc).otherwise(0)).cast("int").alias(COL), F.col(VALUE))


def merge(c11: Matrix, c12: Matrix, c21: Matrix, c22: Matrix,
          n_rows: int | None = None, n_cols: int | None = None) -> Matrix:
    """Inverse of :func:`split`: shift each quadrant into place and stack (bag union).

    The boundary is the size of ``c11``; the shape defaults to the sum of the
    quadrant shapes.
    """
    hr, hc = c11.n_rows, c11.n_cols
    if hr is None or hc is None:
        raise ValueError("merge needs the shape of the top-left quadrant")
    if n_rows is None and c21.n_rows is not None:
        n_rows = hr + c21.n_rows
    if n_cols is None and c12.n_cols is not None:
        n_cols = hc + c12.n_cols

    def placed(q: Matrix, dr: int, dc: int) -> DataFrame:
        return q.df.select(
            (F.col(ROW) + F.lit(dr)).cast("int").alias(ROW) if dr else F.col(ROW),
            (F.col(COL) + F.lit(dc)).cast("int").alias(COL) if dc else F.col(COL),
            F.col(VALUE),
        )

    out = placed(c11, 0, 0).unionByName(placed(c12, 0, hc)).unionByName(placed(c21, hr, 0)) \
        .unionByName(placed(c22, hr, hc))
    return Matrix(out, n_rows, n_cols, all(q.unique for q in (c11, c12, c21, c22)))
