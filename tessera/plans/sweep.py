"""The sweep job: load → multiply → write for each case, with a run log.

For every case the operands are materialised (persisted, counted), the
product is materialised, then written as Parquet; each phase is timed around
a real action.  A case that fails is logged with ``status='failed'`` and the
error text, and the sweep goes on.

A sweep can be killed and started again: a case ends with its record, which
replaces the folder ``run_log/order=N`` after the product is written, so the
log is the manifest of what is done.  Cases with a ``success`` record are not
run again.  The log is a DataFrame with a fixed schema, read from these files.
"""

from __future__ import annotations

import time
import traceback
from dataclasses import dataclass
from datetime import datetime, timezone
from typing import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..matrix import Matrix
from ..operators.choose import product
from ..operators.strassen import STRASSEN_THRESHOLD, MAX_DEPTH, levels_for, strassen
from ..sources.io import exists, result_path, write_matrix

LOG_SCHEMA = T.StructType([
    T.StructField("order", T.LongType(), False),
    T.StructField("matrix_size", T.LongType(), False),
    T.StructField("algorithm", T.StringType(), True),
    T.StructField("threshold", T.LongType(), True),
    T.StructField("levels", T.LongType(), True),
    T.StructField("load_time_seconds", T.DoubleType(), True),
    T.StructField("compute_time_seconds", T.DoubleType(), True),
    T.StructField("write_time_seconds", T.DoubleType(), True),
    T.StructField("total_time_seconds", T.DoubleType(), True),
    T.StructField("n_cells", T.LongType(), True),
    T.StructField("error", T.StringType(), True),
    T.StructField("time_before_error", T.DoubleType(), True),
    T.StructField("timestamp", T.StringType(), False),
    T.StructField("status", T.StringType(), False),
])


@dataclass(frozen=True)
class SweepCase:
    order: int
    matrix_size: int
    load: Callable[[], tuple[Matrix, Matrix]]


def _algorithm(name: str, threshold: int, max_depth: int, tile: int, levels: int | None):
    """A product function for the sweep, and the Strassen levels it uses (None = size rule)."""
    if name == "strassen":
        def run(a: Matrix, b: Matrix) -> Matrix:
            lv = levels if levels is not None else levels_for(min(a.n_rows, a.n_cols, b.n_cols), threshold, max_depth)
            return strassen(a, b, levels=lv)
        return run, levels
    if name in ("standard", "blocked", "strassen_tiled", "auto"):
        fixed = (1 if levels is None else levels) if name == "strassen_tiled" else 0
        return (lambda a, b: product(a, b, algorithm=name, tile=tile, levels=levels)), fixed
    raise ValueError(f"unknown algorithm {name!r}")


def _now() -> str:
    return datetime.now(timezone.utc).isoformat()


def read_log(spark: SparkSession, out_dir: str) -> DataFrame:
    """The run log of a sweep, one record per case that has ended; empty before the first."""
    path = f"{out_dir.rstrip('/')}/run_log"
    if not exists(spark, path):
        return spark.createDataFrame([], LOG_SCHEMA)
    # JSON comes back nullable; the records, one per case, get the log's schema again
    return spark.createDataFrame(spark.read.schema(LOG_SCHEMA).json(path).select(LOG_SCHEMA.names).collect(), LOG_SCHEMA)


def run_sweep(spark: SparkSession, cases: list[SweepCase], out_dir: str, *, algorithm: str = "strassen",
              threshold: int = STRASSEN_THRESHOLD, max_depth: int = MAX_DEPTH, tile: int = 512,
              levels: int | None = None, resume: bool = True,
              timing_path: Callable[[int], str] | None = None) -> DataFrame:
    """Run every case that has not ended well yet; return the run log, read from ``{out_dir}/run_log``.

    ``resume=False`` runs all cases anew.  ``timing_path(order)``, when given,
    also receives each case's record as a one-row JSON dataset (overwritten),
    the per-size timing file layout.
    """
    run, fixed_levels = _algorithm(algorithm, threshold, max_depth, tile, levels)
    done = {r["order"] for r in read_log(spark, out_dir).filter("status = 'success'").select("order").collect()} if resume else set()
    for case in cases:
        if case.order in done:
            continue
        t0 = time.perf_counter()
        held: list[DataFrame] = []
        try:
            a, b = case.load()
            a = a.with_shape()
            b = b.with_shape()
            # both are registered before either is filled: an operand made from the other reads its cells
            for m in (b, a):
                m.df.persist(StorageLevel.MEMORY_AND_DISK)
                held.append(m.df)
            for m in (b, a):
                m.df.count()
            t_load = time.perf_counter() - t0

            t1 = time.perf_counter()
            lv = fixed_levels
            if algorithm == "strassen" and levels is None:
                lv = levels_for(min(a.n_rows, a.n_cols, b.n_cols), threshold, max_depth)
            c = run(a, b)
            c.df.persist(StorageLevel.MEMORY_AND_DISK)
            held.append(c.df)
            n_cells = c.df.count()
            t_compute = time.perf_counter() - t1

            t2 = time.perf_counter()
            write_matrix(c, result_path(out_dir, case.order))
            t_write = time.perf_counter() - t2
            record = (case.order, case.matrix_size, algorithm, threshold, lv, round(t_load, 3),
                      round(t_compute, 3), round(t_write, 3), round(time.perf_counter() - t0, 3),
                      n_cells, None, None, _now(), "success")
        except Exception as e:  # a failed size is recorded and the sweep goes on
            msg = f"{type(e).__name__}: {e}".strip()
            traceback.print_exc()
            record = (case.order, case.matrix_size, None, None, None, None, None, None, None, None,
                      msg, round(time.perf_counter() - t0, 3), _now(), "failed")
        finally:
            for df in held:
                df.unpersist()
        row = spark.createDataFrame([record], LOG_SCHEMA).coalesce(1)
        row.drop("order").write.mode("overwrite").json(f"{out_dir.rstrip('/')}/run_log/order={case.order}")
        if timing_path is not None:
            row.write.mode("overwrite").json(timing_path(case.order))
    return read_log(spark, out_dir)
