"""Reading and writing coordinate matrices (Parquet), the contract on read, and the path convention."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..matrix import COL, ROW, VALUE, Matrix, coo_schema
from ..operators.quadrants import QUADRANTS, half, placed_by, split_tagged

MANIFEST = "_matrix.json"


@dataclass(frozen=True)
class SizePaths:
    """Where the operands, the product and the run log of one size live."""

    operand_a: str
    operand_b: str
    result: str
    timing: str


def result_path(base: str, order: int) -> str:
    return f"{base.rstrip('/')}/matrices_{order}/strassen_result_{order}"


def paths(base: str, order: int, results: str | None = None) -> SizePaths:
    """``{base}/matrices_{order}/matrix{1,2}.parquet``, ``{results}/matrices_{order}/...``."""
    base = base.rstrip("/")
    res = (results or base).rstrip("/")
    return SizePaths(
        operand_a=f"{base}/matrices_{order}/matrix1.parquet",
        operand_b=f"{base}/matrices_{order}/matrix2.parquet",
        result=result_path(res, order),
        timing=f"{res}/matrices_{order}/timing_{order}",
    )


def _file(spark: SparkSession, path: str):
    """A path and its file system, wherever it is."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small text file, None if there is none."""
    p, fs = _file(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write or replace a small text file."""
    p, fs = _file(spark, path)
    stream = fs.create(p, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _file(spark, path)
    return fs.exists(p)


def guarded(m: Matrix) -> Matrix:
    """``m`` with the contract checked in its own plan: the query that reads a bad cell fails.

    NULLs and coordinates outside the shape are conditions of a filter on the
    scan.  Without a producer's word that coordinates are unique, cells are
    grouped by coordinate and a group of two raises.  No job runs besides the
    query's own.  Cells that the query's own filters skip are not looked at.
    """
    def wrong(message: str) -> F.Column:
        return F.raise_error(F.lit(message)).cast("boolean")

    r, c = F.col(ROW), F.col(COL)
    outside = (r < 0) | (c < 0)
    if m.n_rows is not None:
        outside |= r >= m.n_rows
    if m.n_cols is not None:
        outside |= c >= m.n_cols
    ok = (F.when(r.isNull() | c.isNull(), wrong("a matrix cell has a NULL coordinate"))
          .when(F.col(VALUE).isNull(), wrong("a matrix cell has a NULL value"))
          .when(outside, wrong(f"a matrix cell lies outside the {m.n_rows}x{m.n_cols} shape")).otherwise(F.lit(True)))
    df = m.df.filter(ok)
    if not m.unique:
        met = df.groupBy(ROW, COL).agg(F.first(VALUE).alias(VALUE), F.count(F.lit(1)).alias("n"))
        df = met.filter(F.when(F.col("n") > 1, wrong("a coordinate stands twice in a matrix")).otherwise(F.lit(True))).select(ROW, COL, VALUE)
    return Matrix(df, m.n_rows, m.n_cols, unique=True)


def read_matrix(spark: SparkSession, path: str, *, n_rows: int | None = None, n_cols: int | None = None,
                value_type: str | None = None, check: bool = False) -> Matrix:
    """Lazy scan with the fixed coordinate schema (no inference, no action).

    Filters and projections applied later are pushed into the Parquet scan.
    What the writer left in the manifest (shape, value type, whether
    coordinates are unique) is used where no argument says otherwise.
    ``check`` enforces the contract in the plan, see :func:`guarded`; Parquet
    columns come back nullable whatever was written.
    """
    text = read_text(spark, f"{path.rstrip('/')}/{MANIFEST}")
    known = json.loads(text) if text else {}
    df = spark.read.schema(coo_schema(value_type or known.get("value_type", "double"))).parquet(path)
    m = Matrix(df.select(ROW, COL, VALUE), known.get("n_rows") if n_rows is None else n_rows,
               known.get("n_cols") if n_cols is None else n_cols, known.get("unique", False))
    return guarded(m) if check else m


def write_matrix(m: Matrix | DataFrame, path: str, *, mode: str = "overwrite",
                 compression: str = "snappy", sort_within: bool = True) -> None:
    """Write cells to Parquet, with a manifest of what is known of the matrix.

    ``sort_within`` sorts each output file by (row, col) without a shuffle,
    which tightens the per-row-group min/max statistics that later quadrant
    and tile filters prune on.  Appending drops the manifest's word on
    uniqueness.
    """
    m = m if isinstance(m, Matrix) else Matrix(m)
    df = m.df.select(ROW, COL, VALUE)
    if sort_within:
        df = df.sortWithinPartitions(ROW, COL)
    appended = mode == "append" and exists(df.sparkSession, path)
    df.write.mode(mode).option("compression", compression).parquet(path)
    known = {"n_rows": m.n_rows, "n_cols": m.n_cols, "value_type": m.value_type, "unique": m.unique and not appended}
    write_text(df.sparkSession, f"{path.rstrip('/')}/{MANIFEST}", json.dumps(known))


def roundtrip(spark: SparkSession, m: Matrix, path: str, **write_opts) -> Matrix:
    """Write then re-read a matrix (cuts the lineage; the result is a plain scan)."""
    write_matrix(m, path, **write_opts)
    return read_matrix(spark, path, n_rows=m.n_rows, n_cols=m.n_cols, value_type=m.value_type)


# Quadrant layout: one folder per quadrant, so that a split reads only its own files

def write_quadrants(m: Matrix, path: str, *, mode: str = "overwrite") -> None:
    """Write ``m`` partitioned by quadrant, cells re-based to the quadrant's origin."""
    m = m.with_shape()
    tagged = split_tagged(m).sortWithinPartitions("q", ROW, COL)
    tagged.write.mode(mode).partitionBy("q").parquet(path)
    known = {"n_rows": m.n_rows, "n_cols": m.n_cols, "value_type": m.value_type, "unique": m.unique}
    write_text(m.df.sparkSession, f"{path.rstrip('/')}/{MANIFEST}", json.dumps(known))


def _quadrant_scan(spark: SparkSession, path: str) -> tuple[DataFrame, dict]:
    known = json.loads(read_text(spark, f"{path.rstrip('/')}/{MANIFEST}") or "{}")
    if not known:
        raise ValueError(f"{path} holds no quadrant layout")
    schema = T.StructType([*coo_schema(known["value_type"]).fields, T.StructField("q", T.IntegerType())])
    return spark.read.schema(schema).parquet(path), known


def read_split(spark: SparkSession, path: str) -> tuple[Matrix, Matrix, Matrix, Matrix]:
    """(A11, A12, A21, A22) of a quadrant layout: each scans its own folder only (partition pruning)."""
    df, known = _quadrant_scan(spark, path)
    hr, hc = half(known["n_rows"]), half(known["n_cols"])
    out = []
    for q in QUADRANTS:
        shape = hr if q < 20 else known["n_rows"] - hr, hc if q % 10 == 1 else known["n_cols"] - hc
        out.append(Matrix(df.filter(F.col("q") == q).select(ROW, COL, VALUE), *shape, known["unique"]))
    return tuple(out)  # type: ignore[return-value]


def read_merged(spark: SparkSession, path: str) -> Matrix:
    """The whole matrix of a quadrant layout: one scan, cells moved to their places by the folder they lie in."""
    df, known = _quadrant_scan(spark, path)
    hr, hc = half(known["n_rows"]), half(known["n_cols"])
    return Matrix(placed_by(df, F.col("q"), hr, hc), known["n_rows"], known["n_cols"], known["unique"])


def shape_of(m: Matrix) -> DataFrame:
    """``n_rows``/``n_cols`` as max+1 of the stored coordinates (one-row DataFrame)."""
    return m.df.agg((F.max(ROW) + 1).alias("n_rows"), (F.max(COL) + 1).alias("n_cols"))
