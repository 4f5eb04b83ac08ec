"""Near-duplicate documents: an exact Jaccard self-join on word shingles by parity sketches.

A document's set holds the hashes of its distinct five-word shingles.  Two
documents link when ``100 * |A & B| >= 80 * |A | B|``, that is when their
symmetric difference has at most ``(|A| + |B|) / 9`` elements.

Sketches.  Sizes are split into bands of ratio 1.25, so linked sets lie in one
band or in two that follow.  In a band's sketch every element flips one bit;
the sketch is cut into words, and a word is kept as the XOR of the codes of its
set bits.  One element of the symmetric difference changes at most one word, so
the number of differing words is a lower bound of it.  With at most D
differences, and a set that has more than D words other than zero, at least one
of these words is the same in both sets (pigeonhole): sets are joined on
``(band, word number, word)``.  A set with too few words other than zero also
joins on its zero words.  No link is lost.

Before the sketches, sets that cannot link are put aside: if more than a fifth
of a set's elements occur in no other set, no set shares four fifths with it.
The elements counted for this are those whose hash is below ``COUNTED`` of the
range; they are fewer than all, so the bound only gets weaker.  The sets
left over are counted again among themselves, now all their elements.  With
``u`` elements of its own a set of ``n`` links only with sets of at most
``1.25 n - 2.25 u`` elements, which candidates are held to.  Copies are one class
from the start, ``link_buckets`` compares each class with few others, and the
comparison is exact, on the elements themselves.

The nodes that are joined are sets, not documents: a set's name is its
``cls``.  Only at the end come the ids in.  Rows with the same id are different
documents of one component, so an id that stands at several sets links them.

Null, empty and wordless texts have an empty set and link with nothing.  Rows
without ``doc_id`` take part in nothing and come back with null as component.
An empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import slices, table, written
from tessera.llm.components import connected, link_buckets, parity_sketch
from tessera.llm.sharing import Sieve, flagged, shared_rows
from tessera.llm.shingles import mix, shingle_sets, signed

SHINGLE = 5
PERCENT = 80
#: Share of the hash range whose elements are counted to put sets aside.
COUNTED = 0.5
_BELOW = np.uint64(int(COUNTED * 2**64))
RATIO = 1.25
#: Words beyond D + 1, so that those other than zero exceed D in most sets.
SPARE = 1.15


def set_class(s: np.ndarray) -> int:
    """64-bit name of a set: equal sets have equal names."""
    if not len(s):
        return 0
    return int(signed(mix(mix(s + np.uint64(1)).sum(keepdims=True) + np.uint64(len(s))))[0])


def _documents(docs: DataFrame) -> DataFrame:
    """``doc_id, n, cls`` per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", 1 << 17):
            sets = shingle_sets(b.column("text").to_pylist(), SHINGLE)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array([set_class(s) for s in sets], pa.int64())],
                names=["doc_id", "n", "cls"])

    return docs.mapInArrow(run, "doc_id long, n long, cls long")


def _lonely(docs: DataFrame) -> DataFrame:
    """``cls, lonely``: counted elements of a class that no other class holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", 1 << 17):
            sets = shingle_sets(b.column("text").to_pylist(), SHINGLE)
            cls = np.array([set_class(s) for s in sets], np.int64)
            _, once = np.unique(cls, return_index=True)
            part = [sets[i][sets[i] < _BELOW] for i in once]
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(np.concatenate(part))), pa.array(np.repeat(cls[once], [len(p) for p in part]))],
                names=["element", "cls"])

    elements = docs.filter("doc_id is not null").select("text").mapInArrow(run, "element long, cls long")
    held = elements.groupBy("element").agg(F.min("cls").alias("cls"), F.max("cls").alias("other"))
    return held.filter("cls = other").groupBy("cls").agg(F.count("*").alias("lonely"))


def _sets(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """``cls, n, elements`` of the given ``classes(cls, rep)``, read again from the document ``rep``.

    Texts go to Python and do not come back: a batch of them holds thousands, a batch of sets those of ``slices``.
    """
    sieve = Sieve(classes, "rep")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", 1 << 17):
            b = b.filter(pa.array(sieve.may_hold(b.column("doc_id").to_numpy())))
            if not b.num_rows:
                continue
            sets = shingle_sets(b.column("text").to_pylist(), SHINGLE)
            off = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([set_class(s) for s in sets], pa.int64()), pa.array(np.diff(off).astype(np.int64)),
                 pa.ListArray.from_arrays(off, pa.array(signed(np.concatenate(sets))))], names=["rep", "cls", "n", "elements"])

    built = docs.filter("doc_id is not null").mapInArrow(build, "rep long, cls long, n long, elements array<long>")
    sets = built.join(classes, ["cls", "rep"], "left_semi").select("cls", "n", "elements")
    sets = written(docs.sparkSession, sets, "sets")
    if sets.count() > classes.count():  # rows that repeat an id and its text
        sets = written(docs.sparkSession, sets.dropDuplicates(["cls"]), "sets")
    return sets


def band(n: int) -> int:
    """The band of a size: ``RATIO**band <= n < RATIO**(band + 1)``."""
    k = 0
    while RATIO ** (k + 1) <= n:
        k += 1
    return k


def differences(k: int) -> int:
    """Most elements by which linked sets differ whose smaller one is in band ``k``."""
    top = int(np.ceil(RATIO ** (k + 1))) - 1
    return int((top + RATIO * top) * (100 - PERCENT) / (100 + PERCENT) + 1e-9)


def sketch_keys(s: np.ndarray, k: int) -> np.ndarray:
    """Join keys of a set in the sketch of band ``k``."""
    d = differences(k)
    count = int(np.ceil(SPARE * (d + 1))) + 2
    h = mix(s ^ np.uint64(0x5851F42D4C957F2D))
    number = (h >> np.uint64(32)) * np.uint64(count) >> np.uint64(32)
    order = np.argsort(number, kind="stable")
    sorted_numbers = number[order]
    start = np.flatnonzero(np.concatenate([[True], sorted_numbers[1:] != sorted_numbers[:-1]]))
    word = np.zeros(count, np.uint64)
    word[sorted_numbers[start].astype(np.int64)] = np.bitwise_xor.reduceat(h[order], start)
    used = np.flatnonzero(word)
    if len(used) <= d:
        used = np.arange(count)
    return mix(mix(word[used]) + used.astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D) + np.uint64(k + 1))


def _own(sets: DataFrame) -> DataFrame:
    """``cls, own``: elements of a set that no other of ``sets`` holds."""
    held = (sets.select("cls", F.explode("elements").alias("element"))
            .groupBy("element").agg(F.min("cls").alias("cls"), F.max("cls").alias("other")))
    return held.filter("cls = other").groupBy("cls").agg(F.count("*").alias("own"))


def _members(sets: DataFrame) -> DataFrame:
    """``key, node, size, cap``: the keys that at least two sets hold, one of them in the sketch of its own band.

    Two sets of one band meet in the sketch of that band; where both are guests, in that of the band below,
    they need not meet again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple] = []
        held = 0
        names = ["key", "node", "size", "cap", "guest"]
        for b in batches:
            col = b.column("elements")
            off, flat = col.offsets.to_numpy(), col.values.to_numpy().view(np.uint64)
            for i, (cls, own) in enumerate(zip(b.column("cls").to_pylist(), b.column("own").to_pylist(), strict=True)):
                s = flat[off[i]:off[i + 1]]
                n, k = len(s), band(len(s))
                by = [sketch_keys(s, j) for j in ((k, k - 1) if k else (k,))]
                keys = np.concatenate(by)
                cap = ((100 + PERCENT) * (n - own)) // PERCENT - n  # with 80 percent: 1.25 n - 2.25 own
                parts.append((signed(keys), *(np.full(len(keys), x) for x in (cls, n, cap)), np.repeat([0, 1][:len(by)], [len(x) for x in by])))
                held += len(keys)
                if held > 1 << 18:
                    yield flagged(names, [np.concatenate(x) for x in zip(*parts, strict=True)])
                    parts, held = [], 0
        if parts:
            yield flagged(names, [np.concatenate(x) for x in zip(*parts, strict=True)])

    return shared_rows(sets.select("cls", "own", "elements").mapInArrow(run, "key long, node long, size long, cap long, guest long, flag int"), "guest")


def _sketches(sets: DataFrame):
    """``node, n, bits`` of given sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col = b.column("elements")
            off, flat = col.offsets.to_numpy(), col.values.to_numpy().view(np.uint64)
            bits = [parity_sketch(flat[x:y]) for x, y in zip(off[:-1], off[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("cls"), b.column("n"), pa.array(bits, pa.binary())], names=["node", "n", "bits"])

    def sketches(nodes: DataFrame) -> DataFrame:
        wanted = sets.join(nodes.withColumnRenamed("node", "cls"), "cls", "left_semi")
        return wanted.select("cls", "n", "elements").mapInArrow(run, "node long, n long, bits binary")

    return sketches


def _verifier(sets: DataFrame):
    """Pairs whose sets link."""

    def verify(pairs: DataFrame) -> DataFrame:
        a = sets.select(F.col("cls").alias("a"), F.col("n").alias("na"), F.col("elements").alias("sa"))
        b = sets.select(F.col("cls").alias("b"), F.col("n").alias("nb"), F.col("elements").alias("sb"))
        shared = F.size(F.array_intersect("sa", "sb"))
        return (pairs.join(b, "b").join(a, "a")
                .filter(shared * 100 >= (F.col("na") + F.col("nb") - shared) * PERCENT).select("a", "b"))

    return verify


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` per row of ``docs(doc_id, text)``."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = written(spark, _documents(docs), "documents")
    classes = rows.filter("n > 0 and doc_id is not null").groupBy("cls").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"))
    open_classes = (classes.join(_lonely(docs), "cls", "left")
                    .filter(F.coalesce("lonely", F.lit(0)) * 100 <= F.col("n") * (100 - PERCENT)).select("cls", "rep"))
    open_classes = written(spark, open_classes, "classes")
    sets = _sets(docs, open_classes)
    sets = sets.join(_own(sets), "cls", "left").withColumn("own", F.coalesce("own", F.lit(0)))
    sets = written(spark, sets.filter(F.col("own") * 100 <= F.col("n") * (100 - PERCENT)), "sets")
    roots = link_buckets(written(spark, _members(sets), "members"), _verifier(sets), _sketches(sets), PERCENT)
    several = written(spark, _same_id(rows), "same-id")
    if not several.isEmpty():
        roots = connected(several.unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b"))))
    of_class = classes.join(roots, F.col("cls") == F.col("node"), "left").select("cls", "rep", F.coalesce("root", "cls").alias("root"))
    least = of_class.groupBy("root").agg(F.min("rep").alias("component"))
    of_class = of_class.select("cls", "root").join(least, "root").select("cls", "component")
    return (rows.join(of_class, "cls", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.when(F.col("doc_id").isNotNull(), F.col("component"))).otherwise(F.col("doc_id")).alias("component_id")))


def _same_id(rows: DataFrame) -> DataFrame:
    """``a, b``: classes of one id, each with the smallest of them."""
    held = rows.filter("n > 0 and doc_id is not null").select("doc_id", "cls")
    several = held.groupBy("doc_id").agg(F.min("cls").alias("a"), F.max("cls").alias("last")).filter("a <> last").select("doc_id", "a")
    return held.join(several, "doc_id").filter("cls <> a").select("a", F.col("cls").alias("b")).distinct()


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of ``documents`` at a Jaccard similarity of 0.8 or more on five-word shingles."""
    return near_duplicates(table(spark, sf_dir, "documents"))


OP2_SQL = r"""
WITH RECURSIVE d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + least(5, len(w)) - 1], ' ') AS g
    FROM d, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS t(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
    FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (
    SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 80 * (a.n + b.n - c)),
reach AS (
    SELECT doc_id, doc_id AS other FROM n
    UNION
    SELECT reach.doc_id, e.y FROM reach JOIN e ON e.x = reach.other)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(r.c, d.doc_id) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT doc_id, min(other) AS c FROM reach GROUP BY doc_id) r USING (doc_id)
"""
