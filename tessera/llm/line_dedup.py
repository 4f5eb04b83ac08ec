"""Fuzzy line deduplication by MinHash.

A line's set holds its distinct nine-character shingles (a shorter line is one
shingle); lines are compared without white space at their ends.  Equal lines
are one node from the start.  A node's signature has ``BANDS * ROWS`` minima:
lines of many distinct shingles deal one hash per shingle out to that many bins
(an empty bin takes the next one's value), lines of fewer take that many hash
functions, and lines near the limit do both, so that similar lines always share
a scheme.  Lines whose signatures agree in one band are candidates (two lines
of similarity 0.8 are missed with probability 2 in 10,000), candidates are
compared exactly (Jaccard of 0.8 or more on the shingles themselves), and
distributed union-find gives the components.  The first line of each component,
by ``(doc_id, line number)``, stays; all others go.

Blank lines stay.  A null text stays null, an empty one empty; a text all of
whose lines go becomes empty.  Rows without ``doc_id`` come last in the order;
rows of the same id are ordered by a hash of their text, and equal rows are
treated alike.  An empty table gives no rows.  Extra columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from tessera.llm.common import slices, table, written
from tessera.llm.components import link_buckets, parity_sketch
from tessera.llm.sharing import Sieve, packed, packed_schema, shared_pairs
from tessera.llm.shingles import mix, signed

SHINGLE = 9
SIMILARITY = 0.8
BANDS, ROWS = 12, 3
#: Lines of at least so many distinct shingles use bins; those up to a quarter more use both schemes.
BINNED = 200
_RNG = np.random.default_rng(11)
_FUNCTIONS = _RNG.integers(0, 1 << 31, BANDS * ROWS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_BAND = _RNG.integers(0, 1 << 63, (BANDS, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPANS = _RNG.integers(0, 1 << 63, SHINGLE.bit_length(), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def lines_of(text: str | None) -> list[str]:
    return text.split("\n") if text else []


def node_of(lines: list[str]) -> np.ndarray:
    """64-bit name of each line without outer white space; 0 for a blank line."""
    return np.array([xxh3_64_intdigest(s) if (s := x.strip()) else 0 for x in lines], np.uint64).view(np.int64)


def _shingle_hashes(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each shingle of all lines, and the number of shingles before each line.

    Lines shorter than a shingle are filled up with NUL, so that every line is cut alike.
    """
    lines = [x if len(x) >= SHINGLE else x.ljust(SHINGLE, "\0") for x in lines]
    points = np.frombuffer("".join(lines).encode("utf-32-le"), np.uint32).astype(np.uint64)
    end = np.cumsum([len(x) for x in lines])
    # spans of 2, 4 and 8 code points, each from two of half the length, and one more point
    span, width = points, 1
    for f in _SPANS[:-1]:
        span = span[:-width] * f + span[width:]
        width *= 2
    span = span[:-1] * _SPANS[-1] + points[width:]
    inside = np.ones(len(points), bool)
    for j in range(1, SHINGLE):
        inside[end - j] = False
    count = np.diff(end, prepend=0) - SHINGLE + 1
    return mix(span[inside[:len(span)]]), np.concatenate([[0], np.cumsum(count)])


def _set_sizes(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Shingles of each line: distinct ones where that is below ``BINNED * 1.25`` and the positions are not.

    A line that repeats itself has far fewer distinct shingles than positions.
    Lines whose positions are below the limit already use the functions, whatever
    repeats; of the others, distinct values of ten bits are a bound from below.
    """
    size = np.diff(at)
    big = np.flatnonzero(size >= BINNED * 1.25)
    some = np.minimum(size[big], 2 * BINNED)  # the first ones are enough for a bound
    place = np.arange(some.sum()) + np.repeat(at[big] - (np.cumsum(some) - some), some)
    seen = np.zeros(len(big) << 10, bool)
    seen[np.repeat(np.arange(len(big)) << 10, some) + (h[place] >> np.uint64(54)).astype(np.int64)] = True
    least = np.count_nonzero(seen.reshape(-1, 1 << 10), axis=1)
    for i in big[least < BINNED * 1.25]:
        size[i] = len(np.unique(h[at[i]:at[i + 1]]))
    return size


def band_keys(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """``(line index, key)`` of all band keys of distinct non-blank lines."""
    h, at = _shingle_hashes(lines)
    count, m = np.diff(at), BANDS * ROWS
    n = _set_sizes(h, at)
    long, short = np.flatnonzero(n >= BINNED), np.flatnonzero(n < BINNED * 1.25)
    out_line, out_key = [], []
    if len(short):
        hs = h[np.repeat(n < BINNED * 1.25, count)]
        cut = np.concatenate([[0], np.cumsum(count[short])[:-1]])
        # 32 bits are enough for minima of few shingles: one half of the functions take the low bits, one the high bits
        halves = hs.astype(np.uint32), (hs >> np.uint64(32)).astype(np.uint32)
        signature = np.stack([np.minimum.reduceat(halves[i % 2] * f, cut) for i, f in enumerate(_FUNCTIONS)], axis=1).astype(np.uint64)
        out_line.append(np.repeat(short, BANDS))
        out_key.append(_keys(signature, 1).ravel())
    if len(long):
        hl = h[np.repeat(n >= BINNED, count)]
        slot = ((hl >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
        slot += np.repeat(np.arange(len(long)) * m, count[long])
        signature = np.full(len(long) * m, np.iinfo(np.uint64).max, np.uint64)
        low = (hl & np.uint64(0xFFFFFFFF)) + np.uint64(1)
        np.minimum.at(signature, slot, low)
        filled = signature != np.iinfo(np.uint64).max
        signature[~filled] = 0
        signature, filled = signature.reshape(-1, m), filled.reshape(-1, m)
        for shift in range(1, m):
            if filled.all():
                break
            source = np.roll(signature, -shift, axis=1) * np.uint64(2 * shift + 1)
            ok = np.roll(filled, -shift, axis=1) & ~filled & (signature == 0)
            signature[ok] = source[ok]
            if (signature != 0).all():
                break
        out_line.append(np.repeat(long, BANDS))
        out_key.append(_keys(signature, 2).ravel())
    if not out_line:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(out_line), signed(np.concatenate(out_key))


def _keys(signature: np.ndarray, scheme: int) -> np.ndarray:
    """One key per band of each signature."""
    parts = mix(signature).reshape(-1, BANDS, ROWS) * _BAND
    return mix(parts.sum(axis=2) + np.uint64(scheme) * _BAND[:, 0])


@lru_cache(maxsize=16)
def _shingles(line: str) -> set[str]:
    return {line[i:i + SHINGLE] for i in range(max(1, len(line) - SHINGLE + 1))}


def similar(a: str, b: str) -> bool:
    """Exact Jaccard of the shingle sets against ``SIMILARITY``."""
    x, y = _shingles(a), _shingles(b)
    if min(len(x), len(y)) < SIMILARITY * max(len(x), len(y)):
        return False
    both = len(x & y)
    return both * 5 >= 4 * (len(x) + len(y) - both)


def _lines(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, line, node`` of every non-blank line."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            cut = [lines_of(t) for t in b.column("text").to_pylist()]
            size = np.array([len(c) for c in cut])
            node = node_of([x for c in cut for x in c])
            line = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            keep = node != 0
            doc = pa.array(np.repeat(np.arange(len(cut)), size)[keep])
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(doc), b.column("text_hash").take(doc), pa.array(line[keep].astype(np.int32)),
                 pa.array(node[keep])], names=["doc_id", "text_hash", "line", "node"])

    return docs.select("doc_id", "text_hash", "text").mapInArrow(run, "doc_id long, text_hash long, line int, node long")


def _distinct(texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """The distinct non-blank lines of the texts, and their nodes."""
    lines = list({s for t in texts for x in lines_of(t) if (s := x.strip())})
    return lines, node_of(lines)


def _candidates(docs: DataFrame) -> DataFrame:
    """``key, node`` of the band keys that at least two lines hold."""

    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, nodes, held = [], [], 0
        seen = np.zeros(1 << 20, np.int64)  # a line at the place of its last bits, until another one takes it
        for b in slices(batches, "text", 1 << 17):
            lines, node = _distinct(b.column("text").to_pylist())
            new = seen[node & (len(seen) - 1)] != node
            lines, node = [x for x, k in zip(lines, new, strict=True) if k], node[new]
            if not lines:
                continue
            seen[node & (len(seen) - 1)] = node
            line, key = band_keys(lines)
            keys.append(key)
            nodes.append(node[line])
            held += len(key)
            if held > 1 << 19:
                yield packed(np.concatenate(keys), np.concatenate(nodes), n)
                keys, nodes, held = [], [], 0
        if keys:
            yield packed(np.concatenate(keys), np.concatenate(nodes), n)

    return shared_pairs(docs.select("text").mapInArrow(run, packed_schema), n)


def _texts(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node, content`` of the given nodes."""
    sieve = Sieve(nodes, "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            lines, node = _distinct(b.column("text").to_pylist())
            ok = sieve.may_hold(node)
            yield pa.RecordBatch.from_arrays([pa.array(node[ok]), pa.array([x for x, k in zip(lines, ok, strict=True) if k], pa.string())],
                                             names=["node", "content"])

    found = docs.select("text").mapInArrow(run, "node long, content string").groupBy("node").agg(F.min("content").alias("content"))
    return found.join(nodes, "node", "left_semi")


def _sketches(texts: DataFrame):
    """``node, n, bits`` of given lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "content", 1 << 17):
            if not b.num_rows:
                continue
            h, at = _shingle_hashes(b.column("content").to_pylist())
            sets = [np.unique(h[x:y]) for x, y in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b.column("node"), pa.array([len(s) for s in sets], pa.int64()), pa.array([parity_sketch(s) for s in sets], pa.binary())],
                names=["node", "n", "bits"])

    def sketches(nodes: DataFrame) -> DataFrame:
        return texts.join(nodes, "node", "left_semi").select("node", "content").mapInArrow(run, "node long, n long, bits binary")

    return sketches


def _verifier(texts: DataFrame):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "y"):
            ok = pa.array([similar(x, y) for x, y in zip(b.column("x").to_pylist(), b.column("y").to_pylist(), strict=True)], pa.bool_())
            yield b.select(["a", "b"]).filter(ok)

    def verify(pairs: DataFrame) -> DataFrame:
        x = texts.select(F.col("node").alias("a"), F.col("content").alias("x"))
        y = texts.select(F.col("node").alias("b"), F.col("content").alias("y"))
        return pairs.join(y, "b").join(x, "a").select("a", "b", "x", "y").mapInArrow(compare, "a long, b long")

    return verify


def repeated_lines(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, lines``: numbers of the lines to go, per document that has any."""
    spark = docs.sparkSession
    rows = written(spark, _lines(docs), "lines")
    members = written(spark, _candidates(docs), "bands")
    nodes = written(spark, members.select("node").distinct(), "nodes")
    texts = written(spark, _texts(docs, nodes), "texts")
    free = F.lit(0).cast("long")  # sizes are not known yet: every pair is a candidate
    roots = link_buckets(members.select("key", "node", free.alias("size"), free.alias("cap")), _verifier(texts), _sketches(texts), 80)
    place = F.struct(F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("d"), F.col("text_hash").alias("t"), F.col("line").alias("l"))
    # a line that stands once and is like no other needs no first place
    count = rows.groupBy("node").agg(F.count("*").alias("n")).join(roots, "node", "left").filter("root is not null or n > 1")
    repeated = rows.join(count.select("node", F.coalesce("root", "node").alias("group")), "node").drop("node")
    repeated = written(spark, repeated, "repeated")
    first = repeated.groupBy("group").agg(F.min(place).alias("first"))
    going = repeated.join(first, "group").filter(place != F.col("first")).select("doc_id", "text_hash", "line")
    return going.distinct().groupBy("doc_id", "text_hash").agg(F.collect_list("line").alias("lines"))


def dedup_lines(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the repeated lines of ``text`` taken out, plus ``n_lines`` and ``n_removed``."""
    docs = docs.select([F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("n_lines", "n_removed")])
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))
    going = repeated_lines(own).select(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_t"), F.col("lines").alias("_l"))
    cut = F.split(F.col(text), "\n", -1)
    here = docs.withColumn("_h", F.xxhash64(text))
    both = here.join(going, F.col("doc_id").cast("long").eqNullSafe(F.col("_d")) & (F.col("_h") == F.col("_t")), "left")
    left = F.filter(cut, lambda _, i: ~F.array_contains("_l", i))
    return both.select(
        *[F.when(F.col("_l").isNull(), F.col(text)).otherwise(F.array_join(left, "\n")).alias(text) if c == text else F.col(f"`{c}`")
          for c in docs.columns],
        F.when(F.length(text) > 0, F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).otherwise(0).cast("long").alias("n_lines"),
        F.coalesce(F.when(F.col("_l").isNotNull(), F.size("_l")), F.lit(0)).cast("long").alias("n_removed"))


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` after the repeated lines went: how many, and the hash of what is left."""
    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(F.col("doc_id").cast("long").alias("doc_id"), "n_lines", "n_removed",
                      F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
