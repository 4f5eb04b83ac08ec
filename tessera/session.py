"""Session construction for tests/bench, and the shared folder for written tables.

Library operators never change session settings; they only read them.  The
builder below is what ``bench.py`` and the tests use on ``local[N]``.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str = "local[8]", app: str = "tessera", shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    cores = _cores(master)
    conf = {
        "spark.sql.shuffle.partitions": str(shuffle_partitions or max(8, 2 * cores)),
        "spark.default.parallelism": str(max(8, 2 * cores)),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Join outputs here are far larger than their inputs (n³ products from
        # n² cells): keep byte-based coalescing from collapsing small inputs
        # into one or two tasks.
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256KB",
        # Static (estimate-based) broadcast off: broadcasts happen only behind a
        # shape check in the operators, or at runtime when AQE has measured the
        # real shuffle output of a side.
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": os.environ.get("TESSERA_DRIVER_MEMORY", "8g"),
        "spark.sql.files.maxPartitionBytes": "128MB",
    }
    conf.update(extra or {})
    b = SparkSession.builder.master(master).appName(app)
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _cores(master: str) -> int:
    if master.startswith("local[") and master.endswith("]"):
        inner = master[6:-1]
        if inner == "*":
            return os.cpu_count() or 8
        try:
            return int(inner)
        except ValueError:
            return 8
    return 8


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder for written tables: ``spark.checkpoint.dir``.

    It is read from the session.  Only when it is unset in local mode (tests,
    bench) a fresh folder is made under the system temp dir and registered, so
    that ``DataFrame.checkpoint()`` and our written tables land in the same
    place; on a cluster an unset folder is an error.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: on a cluster it must name a shared folder "
                               "(HDFS, object store); a machine-local temporary folder is not used")
        d = tempfile.mkdtemp(prefix="tessera-ckpt-")
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir() or d
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/tessera/{name}-{uuid.uuid4().hex[:12]}"
