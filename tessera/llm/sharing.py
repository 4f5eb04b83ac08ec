"""Finding keys that several nodes hold, without gathering a key's rows.

Rows ``(key, node, ...)`` go to the task of their key once, sorted, and are
streamed: a run of equal keys held by one node only is dropped, others pass.
Many pairs ``(key, node)`` go as arrays of a bucket of keys (``packed``).
A key that already has more than ``HOT`` nodes within one map task is known to
be shared there; all its rows but one then go to any task (a salt) and pass
without looking, so a key held by a third of all rows loads no single task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.shingles import mix

HOT = 64
#: What a row knows: nothing, shared (passes), shared (passes and tells the other rows of its key).
PLAIN, KNOWN, TELLS = 0, 1, 2


def flags(key: np.ndarray, node: np.ndarray, hot: int = HOT) -> np.ndarray:
    """Per row of one map task, what it knows of its key."""
    order = np.lexsort((node, key))
    k, n = key[order], node[order]
    first = np.concatenate([[True], k[1:] != k[:-1]]) if len(k) else np.zeros(0, bool)
    new = first | np.concatenate([[True], n[1:] != n[:-1]]) if len(k) else first
    run = np.cumsum(first) - 1
    many = np.bincount(run, new, minlength=run[-1] + 1) > hot if len(k) else np.zeros(0, bool)
    out = np.zeros(len(key), np.int8)
    if many.any():
        out[order] = np.where(many[run], np.where(first, TELLS, KNOWN), PLAIN)
    return out


def flagged(names: list[str], columns: list[np.ndarray]) -> pa.RecordBatch:
    """A batch of a map task's rows (``key`` and ``node`` first) with their flags."""
    flag = flags(columns[0], columns[1])
    return pa.RecordBatch.from_arrays([*(pa.array(c) for c in columns), pa.array(flag.astype(np.int32))], names=[*names, "flag"])


def shared_rows(rows: DataFrame, guest: str | None = None) -> DataFrame:
    """The rows of ``rows(key, node, ..., flag)`` whose key has at least two nodes, without the flag.

    ``guest`` names a column of 0 and 1, left out too: keys all of whose rows are guests are dropped as well,
    unless a map task knows them to be shared.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = [c for c in rows.columns if c not in ("flag", guest)]
    order = [F.col("key"), F.desc("flag"), F.col(guest)] if guest else [F.col("key")]  # so a run's first row tells
    salt = F.when(F.col("flag") == KNOWN, F.xxhash64(*names)).otherwise(F.lit(0))
    dealt = rows.withColumn("salt", salt).repartition(n, "key", "salt").drop("salt").sortWithinPartitions(*order)

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        open_key = None  # of a run that is known to be shared and not yet over
        for b in batches:
            t = pa.Table.from_batches([b])
            if held is not None:
                t = pa.concat_tables([held, t])
                held = None
            if not t.num_rows:
                continue
            key, node, flag = (t.column(c).to_numpy() for c in ("key", "node", "flag"))
            start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            many = (np.minimum.reduceat(node, start) != np.maximum.reduceat(node, start)) | (np.maximum.reduceat(flag, start) > 0)
            if guest:
                dropped = (t.column(guest).to_numpy()[start] > 0) & (flag[start] == 0)
                many &= ~dropped
            if open_key is not None and key[0] == open_key:
                many[0] = True
            size = np.diff(np.concatenate([start, [len(key)]]))
            keep = np.repeat(many, size)
            open_key = key[-1] if many[-1] else None
            if not many[-1]:
                held = t.slice(int(start[-1]), 1 if guest and dropped[-1] else None)
            if keep.any():
                yield from t.select(names).filter(pa.array(keep)).combine_chunks().to_batches()

    return dealt.mapInArrow(stream, rows.select(*names).schema)


#: Buckets of keys per partition: a task takes up the pairs of one at a time.
BUCKETS = 8
packed_schema = "bucket int, keys array<long>, nodes array<long>, flags array<tinyint>"


def packed(key: np.ndarray, node: np.ndarray, partitions: int) -> pa.RecordBatch:
    """A map task's pairs and their flags, a row for each bucket of keys."""
    flag = flags(key, node)
    mixed = mix(np.where(flag == KNOWN, key ^ node, key).view(np.uint64))
    bucket = ((mixed >> np.uint64(32)) * np.uint64(partitions * BUCKETS) >> np.uint64(32)).astype(np.int32)
    order = np.argsort(bucket)
    bucket = bucket[order]
    start = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])[:len(bucket)])
    offsets = pa.array(np.concatenate([start, [len(bucket)]]).astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket[start]), *(pa.ListArray.from_arrays(offsets, pa.array(x[order])) for x in (key, node, flag))],
        names=["bucket", "keys", "nodes", "flags"])


def shared_pairs(rows: DataFrame, partitions: int) -> DataFrame:
    """``key, node`` of the ``packed`` pairs whose key has at least two nodes, no pair twice in a bucket."""
    dealt = rows.repartition(partitions, "bucket").sortWithinPartitions("bucket")

    def shared(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        key, node, flag = (np.concatenate([p.column(c).flatten().to_numpy() for p in parts]) for c in ("keys", "nodes", "flags"))
        order = np.argsort(key)
        key = key[order]
        start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        keep = np.repeat(np.diff(start, append=len(key)) > 1, np.diff(start, append=len(key))) | (flag[order] > 0)
        key, node, flag = key[keep], node[order][keep], flag[order][keep]
        order = np.lexsort((node, key))
        key, node, flag = key[order], node[order], flag[order]
        first = np.concatenate([[True], key[1:] != key[:-1]])[:len(key)]
        new = first | np.concatenate([[True], node[1:] != node[:-1]])[:len(key)]
        run = np.cumsum(first) - 1
        many = (np.bincount(run, new) > 1) | (np.bincount(run, flag) > 0)
        out = many[run] & new if len(key) else first
        return pa.RecordBatch.from_arrays([pa.array(key[out]), pa.array(node[out])], names=["key", "node"])

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in batches:
            if not b.num_rows:
                continue
            bucket = b.column("bucket").to_numpy()
            cut = np.flatnonzero(bucket[1:] != bucket[:-1]) + 1
            for a, e in zip([0, *cut], [*cut, len(bucket)], strict=True):
                if held and held[0].column("bucket")[0].as_py() != bucket[a]:
                    yield shared(held)
                    held = []
                held.append(b.slice(int(a), int(e - a)))
        if held:
            yield shared(held)

    return dealt.mapInArrow(stream, "key long, node long")


class Sieve:
    """A bitmap of fixed size over 64-bit numbers: says which cannot be in a set, never loses one that is.

    ``BITS`` bounds what is collected and broadcast whatever the size of the
    set; a set that fills the bitmap only makes it let more numbers through.
    """

    BITS = 1 << 24

    def __init__(self, members: DataFrame, column: str):
        bit = F.pmod(F.col(column).bitwiseXOR(F.shiftrightunsigned(column, 29)), F.lit(self.BITS))
        words = (members.select(bit.alias("bit")).groupBy(F.shiftright("bit", 6).cast("int").alias("word"))
                 .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits")).collect())
        table = np.zeros(self.BITS // 64, np.int64)
        for r in words:
            table[r.word] = r.bits
        self._table = members.sparkSession.sparkContext.broadcast(table)

    def may_hold(self, x: np.ndarray) -> np.ndarray:
        """Whether each number may be in the set."""
        bit = (x ^ (x.view(np.uint64) >> np.uint64(29)).view(np.int64)) & np.int64(self.BITS - 1)
        return (self._table.value[bit >> 6] >> (bit & 63)) & 1 == 1
