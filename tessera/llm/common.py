"""Helpers shared by the corpus operators."""

from __future__ import annotations

import sys
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tessera.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the cluster's shared folder and read it back: lineage ends there,
    and a lost executor costs nothing that was written."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, df: DataFrame) -> None:
    """Delete the files of a table that ``written`` made and nothing reads any more."""
    jvm = spark.sparkContext._jvm
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that the bytes of ``column`` stay near ``limit`` (one row at least)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        col = batch.column(column)
        size = np.frombuffer(col.buffers()[1], dtype=np.int32, count=len(col) + col.offset + 1)[col.offset:] \
            if pa.types.is_string(col.type) or pa.types.is_binary(col.type) else None
        if size is None or int(size[-1]) - int(size[0]) <= limit:
            yield batch
            continue
        at = 0
        while at < batch.num_rows:
            end = int(np.searchsorted(size, int(size[at]) + limit, side="right")) - 1
            end = min(max(end, at + 1), batch.num_rows)
            yield batch.slice(at, end - at)
            at = end


def id_bytes(ids) -> bytes:
    """Token ids as little-endian unsigned 32-bit integers."""
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()
