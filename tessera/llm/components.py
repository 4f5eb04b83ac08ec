"""Distributed union-find, and linking the members of buckets without all pairs."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import written
from tessera.llm.shingles import mix

#: Members of a bucket outside its main component that a task compares with as many others.
BLOCK = 4096
#: Pairs that a member names in a round; one that has more to name is looked at again.
NAMED = 8
#: Numbers of eight bytes that a task's comparison makes at once, for each of a few arrays of them.
CELLS = 1 << 18


def connected(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges(a, b)``: the smallest node of its component.

    Every node hooks to its smallest neighbour, the hooks are followed to
    their end by doubling, and the edges are drawn anew between the ends,
    until none joins two ends.  All steps are joins on written tables; a hub's
    rows are pre-aggregated by ``min``.
    """
    spark = edges.sparkSession
    edges = edges.select(F.col("a").cast("long"), F.col("b").cast("long"))
    roots = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root"))
        hook = _followed(written(spark, hook, "hooks"))
        roots = hook if roots is None else written(spark, _through(roots, hook), "roots")
        edges = _ends(edges, hook).filter("a <> b").distinct()
        edges = written(spark, edges, "edges")
        if edges.isEmpty():
            return roots


def _through(table: DataFrame, hook: DataFrame) -> DataFrame:
    """``table(node, root)`` with every root replaced by what it hooks to."""
    h = hook.select(F.col("node").alias("h"), F.col("root").alias("to"))
    return table.join(h, table.root == h.h, "left").select("node", F.coalesce("to", "root").alias("root"))


def _ends(edges: DataFrame, hook: DataFrame) -> DataFrame:
    a = hook.select(F.col("node").alias("a"), F.col("root").alias("x"))
    b = hook.select(F.col("node").alias("b"), F.col("root").alias("y"))
    return edges.join(a, "a").join(b, "b").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


def _followed(hook: DataFrame) -> DataFrame:
    """Hooks replaced by the end of their chain."""
    spark = hook.sparkSession
    while True:
        h = hook.select(F.col("node").alias("h"), F.col("root").alias("to"))
        step = hook.join(h, hook.root == h.h, "left").select(
            "node", F.coalesce("to", "root").alias("root"), (F.coalesce("to", "root") != F.col("root")).alias("moved"))
        step = written(spark, step, "steps")
        hook = step.select("node", "root")
        if step.filter("moved").isEmpty():
            return hook


def link_buckets(members: DataFrame, verify: Callable[[DataFrame], DataFrame],
                 sketches: Callable[[DataFrame], DataFrame], percent: int) -> DataFrame:
    """``node, root`` of the components of all verified links between members of a common bucket.

    ``members(key, node, size, cap)``: nodes that share a key are candidates if
    neither's ``size`` is above the other's ``cap``; ``verify(pairs(a, b))``
    returns the candidates that are links (a Jaccard similarity of ``percent``
    or more).  ``sketches(nodes(node))`` returns ``node, n, bits``: each node's
    number of elements and its parity sketch (``parity_sketch``).

    First every member of a bucket is compared with the one that stands in most
    buckets (in a group of copies the one the others come from): one comparison
    a member.  Buckets that are one component then are done.  In the others
    members of different components are compared by their sketches, whose
    Hamming distance is at most the symmetric difference, inside tasks of
    ``BLOCK`` times ``BLOCK`` members; the main component's members, nearly all
    in a large group of copies, are not compared with each other and stand in
    one task for every ``BLOCK`` others, not for every ``BLOCK`` members.  Only
    pairs that the sketches let through leave the task and are verified.  In rounds every member names
    ``NAMED`` of them, the nearest ones.  A bucket whose members had no more to name is done then; the
    others are looked at again, until no round finds a link; what is left then hands out all pairs.
    Every candidate pair is so either compared or in one component.

    ``members`` is read several times; rows that repeat change nothing.
    """
    spark = members.sparkSession
    degree = members.groupBy("node").agg(F.count("*").alias("degree"))
    top = F.max(F.struct("degree", (-F.col("node")).alias("minus"), F.col("size").alias("lead_size"), F.col("cap").alias("lead_cap")))
    lead = (members.join(degree, "node").groupBy("key").agg(top.alias("top"), F.min("size").alias("low"))
            .select("key", (-F.col("top.minus")).alias("lead"), "top.lead_size", "top.lead_cap", "low"))
    now = members.select("key", "node", "size", "cap").join(lead, "key").filter("node <> lead")
    now = written(spark, now, "led")
    # a lead meets many nodes, and always as ``a``
    pairs = now.filter("size <= lead_cap and lead_size <= cap").select(F.col("lead").alias("a"), F.col("node").alias("b")).distinct()
    links = written(spark, verify(pairs).select("a", "b"), "links")
    roots = connected(links)
    now = now.filter("cap >= low").select("key", "node", "size", "cap")
    bits = None
    while True:
        both = now.join(roots, "node", "left").select("key", "node", "size", "cap", F.coalesce("root", "node").alias("root"))
        both = written(spark, both, "open")
        per = both.groupBy("key", "root").agg(F.count("*").alias("m"), F.min("size").alias("low"), F.max("cap").alias("high"))
        main = (per.groupBy("key").agg(F.max_by("root", "m").alias("main"), F.count("*").alias("roots"))
                .filter("roots > 1"))
        # of a bucket's main component only members that may link with one of the others are looked at again
        outside = F.col("root") != F.col("main")
        others = (per.join(main, "key").groupBy("key", "main")
                  .agg(F.min(F.when(outside, F.col("low"))).alias("low"), F.max(F.when(outside, F.col("high"))).alias("high"),
                       F.sum(F.when(outside, F.col("m")).otherwise(0)).alias("few"), F.sum(F.when(outside, 0).otherwise(F.col("m"))).alias("most")))
        both = both.join(others, "key").filter("root <> main or (size <= high and cap >= low)").drop("low", "high")
        both = written(spark, both, "open")
        if both.isEmpty():
            return roots
        if bits is None:
            bits = written(spark, sketches(both.select("node").distinct()), "sketches")
        # how many of the main component are left is asked for large buckets only, which are few
        left = both.filter((F.col("most") > BLOCK) & ~outside).groupBy("key").agg(F.count("*").alias("left"))
        rows = both.join(F.broadcast(left), "key", "left").withColumn("most", F.coalesce("left", "most")).drop("left").join(bits, "node")
        named = written(spark, _across(rows, percent, True), "named")
        again = named.filter("more").select("key").distinct()
        new = written(spark, verify(named.select("a", "b").distinct()).select("a", "b"), "links")
        done, none = again.isEmpty(), new.isEmpty()
        if none and not done:
            new = written(spark, verify(_across(rows.join(again, "key", "left_semi"), percent, False)).select("a", "b"), "links")
            done, none = True, new.isEmpty()
        if not none:
            roots = connected(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(new))
        if done:
            return roots
        now = both.select("key", "node", "size", "cap").join(again, "key", "left_semi")


def parity_sketch(elements: np.ndarray) -> bytes:
    """Each 64-bit element flips one bit of a power of two of them, about four an element."""
    bits = 64
    while bits < 4 * len(elements):
        bits *= 2
    odd = np.bincount((mix(elements + np.uint64(0x632BE59BD9B4E019)) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _folded(sketch: np.ndarray, words: int) -> np.ndarray:
    """The sketch of fewer bits: halves are joined by XOR, as bit numbers are taken modulo a power of two."""
    while len(sketch) > words:
        sketch = sketch[:len(sketch) // 2] ^ sketch[len(sketch) // 2:]
    return sketch


def _dealt(rows: DataFrame) -> DataFrame:
    """A row for each task ``key, x, y`` that a member of a bucket stands in.

    Members outside the main component, ``few`` a bucket, are cut into blocks ``x``, the ``most`` others into
    blocks ``y``.  Task ``x, y`` compares the two, and ``x, 0`` the block ``x`` with itself as well; task
    ``x, -1 - z`` compares blocks ``x`` and ``z`` of the former.
    """
    blocks = {c: F.greatest(F.ceil(F.col(c) / BLOCK), F.lit(1)).cast("int") for c in ("few", "most")}
    minor = F.col("root") != F.col("main")
    own = F.pmod(F.xxhash64("node"), F.when(minor, blocks["few"]).otherwise(blocks["most"])).cast("int")
    rows = rows.withColumn("minor", minor).withColumn("own", own)
    few, most = (F.sequence(F.lit(0), blocks[c] - 1) for c in ("few", "most"))

    def cell(x: F.Column, y: F.Column) -> F.Column:
        return F.struct(x.alias("x"), y.alias("y"))

    with_main = F.transform(most, lambda y: cell(F.col("own"), y))
    others = F.filter(few, lambda z: z != F.col("own"))
    with_few = F.transform(others, lambda z: cell(F.least(F.col("own"), z), -1 - F.greatest(F.col("own"), z)))
    cells = F.when(F.col("minor"), F.concat(with_main, with_few)).otherwise(F.transform(few, lambda x: cell(x, F.col("own"))))
    return rows.withColumn("cell", F.explode(cells)).select(
        "key", "cell.x", "cell.y", "node", "size", "cap", "root", "minor", "n", "bits")


def _compared(t: pa.Table, percent: int, nearest: bool) -> Iterator[pa.RecordBatch]:
    """``a, b, more`` of one task's members that ``_across`` lets through, ``CELLS`` words or pairs of members at a time."""
    node, size, cap, root, minor, count = (t.column(c).to_numpy() for c in ("node", "size", "cap", "root", "minor", "n"))
    if not minor.any():
        return
    sketch = [np.frombuffer(x, np.uint64) for x in t.column("bits").to_pylist()]
    words = min(map(len, sketch))
    bits = np.stack([_folded(x, words) for x in sketch])
    rows_at = max(1, CELLS // bits.size)
    few, again = np.flatnonzero(minor), t.column("y")[0].as_py() > 0  # those of the block met in another task
    for a in range(0, len(few), rows_at):
        i = few[a:a + rows_at]
        apart = np.bitwise_count(bits[i][:, None, :] ^ bits[None, :, :]).sum(axis=2, dtype=np.int64)
        ok = apart * (100 + percent) <= (100 - percent) * (count[i][:, None] + count[None, :])
        ok &= (root[i][:, None] != root[None, :]) & (size[i][:, None] <= cap[None, :]) & (size[None, :] <= cap[i][:, None])
        if again:
            ok &= ~minor[None, :]
        p, q = np.nonzero(ok)
        more = np.zeros(len(p), bool)
        if nearest and len(p):
            order = np.lexsort((apart[p, q] / (count[i[p]] + count[q]), p))
            p, q = p[order], q[order]
            many = np.bincount(p, minlength=len(i))
            keep = np.arange(len(p)) - (np.cumsum(many) - many)[p] < NAMED
            p, q = p[keep], q[keep]
            more = many[p] > NAMED
        if len(p):
            x, y = node[i[p]], node[q]
            pair = np.unique(np.stack([np.minimum(x, y), np.maximum(x, y), more]), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(pair[0]), pa.array(pair[1]), pa.array(pair[2] > 0)], names=["a", "b", "more"])


def _across(rows: DataFrame, percent: int, nearest: bool) -> DataFrame:
    """Distinct ``a, b`` of different roots in a common bucket that the sketches let through; with ``nearest``
    ``key, a, b, more``: at most ``NAMED`` for each node outside its bucket's main root in a task, and whether it had more."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    at = ["key", "x", "y"]
    dealt = _dealt(rows).repartition(n, *at).sortWithinPartitions(*at)

    def found(t: pa.Table) -> Iterator[pa.RecordBatch]:
        for b in _compared(t, percent, nearest):
            key = pa.array(np.full(b.num_rows, t.column("key")[0].as_py()))
            yield pa.RecordBatch.from_arrays([key, *b.columns], names=["key", *b.schema.names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for b in batches:
            t = pa.Table.from_batches([b])
            t = t if held is None else pa.concat_tables([held, t])
            if not t.num_rows:
                continue
            k, x, y = (t.column(c).to_numpy() for c in at)
            start = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1])]))
            for a, e in zip(start[:-1], start[1:], strict=True):
                yield from found(t.slice(int(a), int(e - a)))
            held = t.slice(int(start[-1]))
        if held is not None and held.num_rows:
            yield from found(held)

    pairs = dealt.mapInArrow(run, "key long, a long, b long, more boolean")
    return pairs if nearest else pairs.select("a", "b").distinct()
