"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is built and fully executed into Spark's ``noop`` sink (every
row is produced; nothing is shipped to Python).  One warm-up pass primes the
JVM, then each query is timed ``BENCH_REPEATS`` times and the best run is
kept.  Also times dense multiplies of generated BIGINT matrices at the
reference's sizes (n = 256 … 4096) next to the published one-process C
numbers.  Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tessera.operators.blocked import multiply_blocked, multiply_strassen_tiled  # noqa: E402
from tessera.operators.multiply import multiply  # noqa: E402
from tessera.operators.strassen import strassen  # noqa: E402
from tessera.plans.catalogue import QUERIES  # noqa: E402
from tessera.session import build_session  # noqa: E402
from tessera.sources.generate import generate_random_int  # noqa: E402

HEADLINE = [
    "multiply_sparse", "multiply_rect", "gram_embeddings", "multiply_standard", "multiply_integer",
    "multiply_blocked", "multiply_strassen_1", "multiply_strassen_2", "multiply_strassen_tiled",
    "multiply_strassen_odd", "multiply_hot_keys", "add_matrices", "subtract_matrices",
    "split_quadrants", "merge_quadrants", "compare_algorithms", "generate_int", "scan_matrix",
]

# Published one-process C timings (seconds) for standard / Strassen at these sizes.
C_STANDARD = {256: 0.031930, 512: 0.262357, 1024: 2.375312, 2048: 18.679352, 4096: 543.389312}
C_STRASSEN = {256: 0.025925, 512: 0.185067, 1024: 1.308123, 2048: 9.095583, 4096: 64.286988}


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def _time(fn, repeats: int) -> float:
    best = float("inf")
    for _ in range(repeats):
        t = time.perf_counter()
        fn()
        best = min(best, time.perf_counter() - t)
    return best


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    dense_sizes = [int(x) for x in os.environ.get("BENCH_DENSE_SIZES", "256,512,1024,2048,4096").split(",") if x]
    spark = build_session(f"local[{cpus}]", app="tessera-bench")

    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    times: dict[str, float] = {}
    for name in HEADLINE:
        q = QUERIES[name]
        _run(q(spark, sf_dir))  # warm-up
        times[name] = round(_time(lambda: _run(q(spark, sf_dir)), repeats), 3)

    dense: dict[str, float] = {}
    for n in dense_sizes:
        a = generate_random_int(spark, n, seed=1)
        b = generate_random_int(spark, n, seed=2)
        tile = 512 if n >= 2048 else (256 if n >= 512 else 128)
        for label, fn in (("blocked", lambda: multiply_blocked(a, b, tile=tile)),
                          ("standard", lambda: multiply(a, b)),
                          ("strassen_L1", lambda: strassen(a, b, levels=1)),
                          ("strassen_tiled_L1", lambda: multiply_strassen_tiled(a, b, tile=tile, levels=1))):
            if label in ("standard", "strassen_L1") and n > 512:
                continue  # coordinate form at n³ scalar products is not the dense path
            if label == "strassen_tiled_L1" and not 1024 <= n <= 2048:
                continue
            _run(fn().df)
            dense[f"dense_{label}_{n}"] = round(_time(lambda: _run(fn().df), repeats), 3)

    total = round(sum(times.values()), 3)
    out = {
        "metric": "sum_of_headline_query_seconds",
        "value": total,
        "unit": "sec",
        "queries": {**times, **dense},
        "reference_c_seconds": {f"standard_{k}": v for k, v in C_STANDARD.items()}
        | {f"strassen_{k}": v for k, v in C_STRASSEN.items()},
        "sf": sf,
        "cpus": cpus,
    }
    print(json.dumps(out))


if __name__ == "__main__":
    main()
