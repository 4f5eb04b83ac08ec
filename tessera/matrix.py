"""The one data model: a matrix is a DataFrame of coordinate cells.

Every matrix is a table ``(row INT, col INT, value DOUBLE|BIGINT)`` with one
record per stored cell; an absent cell means 0.  The shape is not stored in
the data: it travels beside the DataFrame in :class:`Matrix` as two driver
integers, exactly like the size argument the operators are called with.

Coordinates are unique and never NULL by contract; :func:`validate` checks it
in one pass when a table crosses into the library.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROW, COL, VALUE = "row", "col", "value"

COO_DOUBLE = T.StructType(
    [
        T.StructField(ROW, T.IntegerType(), False),
        T.StructField(COL, T.IntegerType(), False),
        T.StructField(VALUE, T.DoubleType(), False),
    ]
)
COO_BIGINT = T.StructType(
    [
        T.StructField(ROW, T.IntegerType(), False),
        T.StructField(COL, T.IntegerType(), False),
        T.StructField(VALUE, T.LongType(), False),
    ]
)


def coo_schema(value_type: str = "double") -> T.StructType:
    """Schema for a coordinate table with ``double`` or ``bigint`` values."""
    if value_type in ("double", "float64"):
        return COO_DOUBLE
    if value_type in ("bigint", "long", "int64"):
        return COO_BIGINT
    raise ValueError(f"unsupported value type {value_type!r}")


@dataclass(frozen=True)
class Matrix:
    """A coordinate DataFrame plus its shape.

    ``n_rows`` / ``n_cols`` may be ``None`` when unknown; :meth:`with_shape`
    fills them in with one small aggregate (a single-row result).
    ``unique`` records that the producer guarantees one record per
    coordinate (an aggregate, a generator); tables from outside are not
    assumed unique.
    """

    df: DataFrame
    n_rows: int | None = None
    n_cols: int | None = None
    unique: bool = False

    @property
    def value_type(self) -> str:
        dt = self.df.schema[VALUE].dataType
        return "bigint" if isinstance(dt, (T.LongType, T.IntegerType)) else "double"

    @property
    def shape(self) -> tuple[int | None, int | None]:
        return self.n_rows, self.n_cols

    @property
    def max_cells(self) -> int | None:
        """Upper bound on the number of stored cells (unique coordinates)."""
        if self.n_rows is None or self.n_cols is None:
            return None
        return self.n_rows * self.n_cols

    def with_df(self, df: DataFrame) -> "Matrix":
        return replace(self, df=df)

    def with_shape(self) -> "Matrix":
        """Return a copy whose shape is known, computing ``max+1`` if needed."""
        if self.n_rows is not None and self.n_cols is not None:
            return self
        r = self.df.agg(F.max(ROW).alias("r"), F.max(COL).alias("c")).first()
        n_rows = self.n_rows if self.n_rows is not None else (r["r"] + 1 if r["r"] is not None else 0)
        n_cols = self.n_cols if self.n_cols is not None else (r["c"] + 1 if r["c"] is not None else 0)
        return replace(self, n_rows=int(n_rows), n_cols=int(n_cols))

    def cast(self, value_type: str) -> "Matrix":
        """Change the value type (``double`` or ``bigint``); ANSI casts raise on loss."""
        target = coo_schema(value_type)[VALUE].dataType
        return self.with_df(self.df.withColumn(VALUE, F.col(VALUE).cast(target)))


def as_matrix(m: Matrix | DataFrame, n_rows: int | None = None, n_cols: int | None = None) -> Matrix:
    if isinstance(m, Matrix):
        return m
    return Matrix(m.select(ROW, COL, VALUE), n_rows, n_cols)


def required(column: Column, kind: str, name: str) -> Column:
    """``column`` cast to ``kind``; a NULL fails the task that meets it (no extra job)."""
    return F.coalesce(column.cast(kind), F.raise_error(F.lit(f"NULL {name} in a matrix cell")).cast(kind))


def zero_value(value_type: str) -> Column:
    return F.lit(0).cast("bigint") if value_type == "bigint" else F.lit(0.0)


def transpose(m: Matrix) -> Matrix:
    """Aᵀ: swap the two coordinate columns (no shuffle)."""
    df = m.df.select(F.col(COL).alias(ROW), F.col(ROW).alias(COL), F.col(VALUE))
    return Matrix(df, m.n_cols, m.n_rows, m.unique)


def compact(m: Matrix, eps: float = 0.0) -> Matrix:
    """Drop stored cells whose magnitude is at most ``eps`` (explicit zeros by default)."""
    cond = F.col(VALUE) != 0 if eps == 0.0 else F.abs(F.col(VALUE)) > F.lit(eps)
    return m.with_df(m.df.filter(cond))


def cell_count(m: Matrix | DataFrame) -> DataFrame:
    """Number of stored cells, as a one-row DataFrame ``n_cells BIGINT``."""
    return as_matrix(m).df.agg(F.count(F.lit(1)).alias("n_cells"))


def validation_report(m: Matrix | DataFrame) -> DataFrame:
    """One-row report: cells, NULL coordinates, NULL values, duplicated coordinates.

    A single shuffle on ``(row, col)`` with map-side partial counts; only
    counters leave the executors.
    """
    df = as_matrix(m).df
    per_cell = df.groupBy(ROW, COL).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(VALUE).isNull()).alias("null_values"),
    )
    return per_cell.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_cells"),
        F.count_if(F.col(ROW).isNull() | F.col(COL).isNull()).alias("null_coordinates"),
        F.coalesce(F.sum("null_values"), F.lit(0)).cast("bigint").alias("null_values"),
        F.count_if(F.col("n") > 1).alias("duplicate_coordinates"),
    )


class InvalidMatrix(ValueError):
    pass


def validate(m: Matrix | DataFrame, *, check_bounds: bool = True) -> dict:
    """Check the contract; raise :class:`InvalidMatrix` on NULLs, duplicates or out-of-range cells."""
    mat = as_matrix(m)
    rep = validation_report(mat).first().asDict()
    problems = []
    if rep["null_coordinates"]:
        problems.append(f"{rep['null_coordinates']} cells with NULL row/col")
    if rep["null_values"]:
        problems.append(f"{rep['null_values']} NULL values")
    if rep["duplicate_coordinates"]:
        problems.append(f"{rep['duplicate_coordinates']} duplicated coordinates")
    if check_bounds and mat.n_rows is not None and mat.n_cols is not None:
        outside = mat.df.filter(
            (F.col(ROW) < 0) | (F.col(ROW) >= mat.n_rows) | (F.col(COL) < 0) | (F.col(COL) >= mat.n_cols)
        )
        if not outside.isEmpty():
            problems.append(f"cells outside the {mat.n_rows}x{mat.n_cols} shape")
    if problems:
        raise InvalidMatrix("; ".join(problems))
    return rep
