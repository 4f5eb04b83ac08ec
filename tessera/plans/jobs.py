"""The two batch jobs of the reference workflow, on the path convention.

``generate``: for each order ``n``, write two ``2^n × 2^n`` operands to
``{base}/matrices_{n}/matrix{1,2}.parquet`` (seeded, reproducible).
``multiply``: sweep the orders — read both operands, multiply, write the
product and the run log under ``{results}``.  Orders that an earlier run has
finished are skipped unless ``--anew`` is given.

    python -m tessera.plans.jobs generate --base DIR --orders 4 5 6
    python -m tessera.plans.jobs multiply --base DIR --results DIR --orders 4 5 6 --algorithm strassen
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from ..operators.strassen import MAX_DEPTH, STRASSEN_THRESHOLD
from ..sources.generate import generate_random, generate_random_int
from ..sources.io import paths, read_matrix, write_matrix
from .sweep import SweepCase, run_sweep


def generate_operands(spark: SparkSession, base: str, orders: list[int], *, seed: int = 42,
                      value_type: str = "double", max_value: int = 100, mode: str = "overwrite",
                      compression: str = "snappy") -> list[str]:
    """Write both operands for every order; returns the written paths."""
    written = []
    for n in orders:
        size = 2 ** n
        p = paths(base, n)
        for k, path in enumerate((p.operand_a, p.operand_b)):
            s = seed * 1_000_003 + n * 2 + k
            m = (generate_random_int(spark, size, seed=s, max_value=max_value) if value_type == "bigint"
                 else generate_random(spark, size, seed=s))
            write_matrix(m, path, mode=mode, compression=compression)
            written.append(path)
    return written


def path_cases(spark: SparkSession, base: str, orders: list[int], *, value_type: str = "double") -> list[SweepCase]:
    """Sweep cases that read ``matrix1``/``matrix2`` of each order (lazy scans)."""
    def loader(n: int):
        def load():
            p = paths(base, n)
            size = 2 ** n
            return (read_matrix(spark, p.operand_a, n_rows=size, n_cols=size, value_type=value_type),
                    read_matrix(spark, p.operand_b, n_rows=size, n_cols=size, value_type=value_type))
        return load
    return [SweepCase(n, 2 ** n, loader(n)) for n in orders]


def multiply_sweep(spark: SparkSession, base: str, results: str, orders: list[int], *,
                   algorithm: str = "strassen", threshold: int = STRASSEN_THRESHOLD, max_depth: int = MAX_DEPTH,
                   tile: int = 512, levels: int | None = None, value_type: str = "double",
                   resume: bool = True) -> DataFrame:
    return run_sweep(spark, path_cases(spark, base, orders, value_type=value_type), results,
                     algorithm=algorithm, threshold=threshold, max_depth=max_depth, tile=tile, levels=levels, resume=resume,
                     timing_path=lambda n: paths(base, n, results).timing)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="tessera.plans.jobs")
    sub = ap.add_subparsers(dest="cmd", required=True)
    g = sub.add_parser("generate")
    g.add_argument("--base", required=True)
    g.add_argument("--orders", type=int, nargs="+", required=True)
    g.add_argument("--seed", type=int, default=42)
    g.add_argument("--value-type", default="double", choices=["double", "bigint"])
    m = sub.add_parser("multiply")
    m.add_argument("--base", required=True)
    m.add_argument("--results", required=True)
    m.add_argument("--orders", type=int, nargs="+", required=True)
    m.add_argument("--algorithm", default="strassen",
                   choices=["standard", "strassen", "blocked", "strassen_tiled", "auto"])
    m.add_argument("--threshold", type=int, default=STRASSEN_THRESHOLD)
    m.add_argument("--max-depth", type=int, default=MAX_DEPTH)
    m.add_argument("--levels", type=int, default=None)
    m.add_argument("--tile", type=int, default=512)
    m.add_argument("--value-type", default="double", choices=["double", "bigint"])
    m.add_argument("--anew", action="store_true")
    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName(f"tessera-{args.cmd}").getOrCreate()
    if args.cmd == "generate":
        for p in generate_operands(spark, args.base, args.orders, seed=args.seed, value_type=args.value_type):
            print(p)
    else:
        log = multiply_sweep(spark, args.base, args.results, args.orders, algorithm=args.algorithm,
                             threshold=args.threshold, max_depth=args.max_depth, tile=args.tile,
                             levels=args.levels, value_type=args.value_type, resume=not args.anew)
        log.show(truncate=False)


if __name__ == "__main__":
    main()
