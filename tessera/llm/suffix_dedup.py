"""Removing passages that also stand in an earlier document, by sorted suffixes.

A byte goes if a ``LENGTH``-byte string that covers it also starts in a document
with a smaller id.  The suffixes are never sorted all in one place:

1. Every window of ``LENGTH`` bytes is named by its minimizer, the ``GRAM``-byte
   string of smallest hash in it (the leftmost of equals).  Equal windows have
   equal minimizers at equal offsets.  Runs of windows with the same minimizer
   occurrence are one stretch of bytes; ``shared_rows`` drops the stretches whose
   minimizer stands in one text only.
2. The stretches left over are dealt out by minimizer.  Equal stretches within a
   map task are settled there: all but those of the smallest id are covered.
3. Within a minimizer, what stands right of it and (read backwards) left of it
   are sorted as suffixes: multikey quicksort to ``SHALLOW`` bytes, then blind
   tries for the groups whose common prefix is longer.  Two windows are equal if
   they start at the same distance and have common prefixes long enough on both
   sides, so the smallest id of every window follows from the sorted orders.
4. Covered windows are joined to their text once more, which is cut.

Equal texts are one node from the start: a copy with a larger id goes whole, if
it has ``LENGTH`` bytes at all.  Null and empty texts have no bytes.  Rows
without ``doc_id`` come after all others.  Rows of the same id do not cover each
other.  An empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import slices, table, written
from tessera.llm.sharing import Sieve, flagged, shared_rows
from tessera.llm.shingles import prefix_sums, signed, spans_hash

LENGTH = 50
GRAM = 18
#: Depth to which multikey quicksort sorts before blind tries take over.
SHALLOW = 16
_LAST = (1 << 63) - 1


def stretches(texts: list[bytes], length: int = LENGTH, gram: int = GRAM) -> dict[str, np.ndarray]:
    """Runs of windows that share a minimizer occurrence: ``doc`` (index), ``start`` and ``count`` of the
    windows, ``pos`` of the minimizer (both within the text) and its hash ``key``."""
    size = np.array([len(t) for t in texts], np.int64)
    raw = np.frombuffer(b"".join(texts), np.uint8)
    n = len(raw) - length + 1
    none = {k: np.zeros(0, np.int64) for k in ("doc", "start", "count", "pos", "key")}
    if n <= 0:
        return none
    at = np.arange(len(raw) - gram + 1)
    grams = spans_hash(prefix_sums(raw), at, at + gram)
    low = (grams >> np.uint64(32) << np.uint64(32)) | at.astype(np.uint64)
    width, have = length - gram + 1, 1
    while have * 2 <= width:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    low = np.minimum(low[:n], low[width - have:width - have + n]) if have < width else low[:n]
    q = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.cumsum(size) - size
    doc = np.repeat(np.arange(len(texts)), size)[:n]
    p = np.flatnonzero(np.arange(n) + length <= (first + size)[doc])
    if not len(p):
        return none
    d, q = doc[p], q[p]
    new = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (q[1:] != q[:-1])]))
    d, q = d[new], q[new]
    return {"doc": d, "start": p[new] - first[d], "count": np.diff(np.concatenate([new, [len(p)]])),
            "pos": q - first[d], "key": signed(grams[q])}


def _bytes(col: pa.Array) -> list[bytes]:
    return [(t or "").encode() for t in col.to_pylist()]


def _minimizers(docs: DataFrame) -> DataFrame:
    """``key, node, pos`` of minimizers that at least two texts hold; equal texts of a task count once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(0, np.int64)
        parts: list[tuple] = []
        held = 0
        for b in slices(batches, "text", 1 << 19):
            node = b.column("node").to_numpy()
            new = np.zeros(len(node), bool)
            new[np.unique(node, return_index=True)[1]] = True
            new &= ~np.isin(node, seen)
            if not new.any():
                continue
            seen = np.concatenate([seen, node[new]])[-1_000_000:]
            got = stretches(_bytes(b.column("text").filter(pa.array(new))))
            parts.append((got["key"], node[new][got["doc"]], got["pos"].astype(np.int32)))
            held += len(got["key"])
            if held > 1 << 18:
                yield flagged(["key", "node", "pos"], [np.concatenate(x) for x in zip(*parts, strict=True)])
                parts, held = [], 0
        if parts:
            yield flagged(["key", "node", "pos"], [np.concatenate(x) for x in zip(*parts, strict=True)])

    return shared_rows(docs.select("node", "text").mapInArrow(run, "key long, node long, pos int, flag int"))


_WINDOWS = "key long, node long, rep long, start int, count int, left int, data binary, settled boolean"
_FIELDS = [x.split()[0] for x in _WINDOWS.split(", ")]


def _windows(rows: DataFrame) -> DataFrame:
    """The stretches of ``rows(node, rep, text, positions)``; those that an equal one of a smaller id in the
    same task covers are ``settled`` and carry no data."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[tuple, int] = {}  # smallest id per stretch of this task, forgotten when too many
        for b in slices(batches, "text", 1 << 19):
            texts = _bytes(b.column("text"))
            node, rep = b.column("node").to_numpy(), b.column("rep").to_numpy()
            got = stretches(texts)
            where = b.column("positions").to_pylist()
            wanted = np.concatenate([np.array([(i << 32) + x for x in w or ()], np.int64) for i, w in enumerate(where)])
            take = np.isin((got["doc"] << 32) + got["pos"], wanted)
            doc, start, count, pos, key = (got[k][take] for k in ("doc", "start", "count", "pos", "key"))
            data = [texts[d][s:s + c + LENGTH - 1] for d, s, c in zip(doc.tolist(), start.tolist(), count.tolist(), strict=True)]
            left, ids = (pos - start).tolist(), rep[doc].tolist()
            if len(best) > 500_000:
                best.clear()
            names = list(zip(left, data, strict=True))
            for name, i in zip(names, ids, strict=True):
                if best.get(name, _LAST) > i:
                    best[name] = i
            settled = np.array([best.get(name, i) < i for name, i in zip(names, ids, strict=True)], bool)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key), pa.array(node[doc]), pa.array(rep[doc]), pa.array(start.astype(np.int32)),
                 pa.array(count.astype(np.int32)), pa.array(left, pa.int32()),
                 pa.array([None if s else x for s, x in zip(settled, data, strict=True)], pa.binary()), pa.array(settled)],
                names=_FIELDS)

    return rows.mapInArrow(run, _WINDOWS)


class BlindTrie:
    """Inner nodes hold a depth and branch by the byte there; a descent looks at these bytes only,
    and one comparison with the leaf it ends in finds where a string belongs."""

    def __init__(self, strings: list[bytes]):
        self._strings = strings
        self._root = None

    def insert(self, i: int) -> None:
        s = self._strings[i]
        if self._root is None:
            self._root = [i]
            return
        node = self._root
        while isinstance(node, tuple):
            at = s[node[0]] if node[0] < len(s) else -1
            node = node[1][at] if at in node[1] else next(iter(node[1].values()))
        t = self._strings[node[0]]
        common = _common(s, t)
        if common == len(s) == len(t):
            node.append(i)
            return
        parent, edge, node = None, None, self._root
        while isinstance(node, tuple) and node[0] < common:
            parent, edge = node, (s[node[0]] if node[0] < len(s) else -1)
            node = node[1][edge]
        mine, other = (x[common] if common < len(x) else -1 for x in (s, t))
        if isinstance(node, tuple) and node[0] == common:
            node[1][mine] = [i]
            return
        split = (common, {mine: [i], other: node})
        if parent is None:
            self._root = split
        else:
            parent[1][edge] = split

    def walk(self) -> Iterator[tuple[int, int]]:
        """Indices in order, each with the length of the prefix it shares with the one before (-1: first)."""
        todo, depth = [(self._root, -1)], -1
        while todo:
            node, depth = todo.pop()
            if isinstance(node, tuple):
                kids = sorted(node[1].items(), reverse=True)
                todo += [(kid, node[0]) for _, kid in kids[:-1]] + [(kids[-1][1], depth)]
            else:
                for k, i in enumerate(node):
                    yield i, depth if k == 0 else len(self._strings[i])


def _common(s: bytes, t: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(s), len(t))
    if s[:n] == t[:n]:
        return n
    low, high = 0, n
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (mid, high) if s[:mid] == t[:mid] else (low, mid)
    return low


def sort_suffixes(strings: list[bytes], depth: int = 0, shallow: int = SHALLOW) -> list[tuple[int, int]]:
    """``(index, common prefix with the one before)`` in sorted order, by multikey quicksort from
    ``depth`` (up to which all are equal) to ``shallow``, and blind tries from there."""
    out: list[tuple[int, int]] = []
    todo = [(list(range(len(strings))), depth, -1)]
    while todo:
        group, at, before = todo.pop()
        if len(group) == 1:
            out.append((group[0], before))
        elif at >= shallow or len(group) == 2:
            trie = BlindTrie(strings)
            for i in group:
                trie.insert(i)
            out += [(i, before if k == 0 else c) for k, (i, c) in enumerate(trie.walk())]
        else:
            char = {i: strings[i][at] if at < len(strings[i]) else -1 for i in group}
            pivot = char[group[len(group) // 2]]
            parts = [([i for i in group if char[i] < pivot], at), ([i for i in group if char[i] == pivot], at + 1),
                     ([i for i in group if char[i] > pivot], at)]
            if pivot < 0:  # strings that end here are equal
                whole = parts[1][0]
                parts[1] = ([], at)
                out += [(i, before if k == 0 else at) for k, i in enumerate(whole)]
                before = at
            order = []
            for part, d in parts:
                if part:
                    order.append((part, d, before))
                    before = at
            todo += reversed(order)
    return out


def smallest_ids(groups: np.ndarray, ids: np.ndarray, left: np.ndarray, count: np.ndarray, data: list[bytes],
                 length: int = LENGTH, gram: int = GRAM) -> np.ndarray:
    """Per stretch (row) and distance of a window's start from its minimizer (column): the smallest id that
    holds the window, or the largest number where the stretch has no such window.  ``groups`` ascend."""
    right = [d[x:] for d, x in zip(data, left.tolist(), strict=True)]
    behind = [d[:x][::-1] for d, x in zip(data, left.tolist(), strict=True)]
    cut = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1], [True]]))
    orders = []
    for strings, depth in ((right, gram), (behind, 0)):
        order, common = np.empty(len(data), np.int64), np.empty(len(data), np.int64)
        for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
            for k, (i, c) in enumerate(sort_suffixes(strings[a:b], depth, depth + SHALLOW)):
                order[a + k], common[a + k] = a + i, c
        orders.append((order, common))
    distances = length - gram + 1
    out = np.full((len(data), distances), _LAST)
    names = np.empty((2, len(data)), np.int64)
    for x in range(distances):
        valid = np.flatnonzero((left >= x) & (left - x < count))
        if not len(valid):
            continue
        for k, need in ((0, length - x), (1, x)):
            order, common = orders[k]
            names[k][order] = np.cumsum(common < need)
        key = names[0][valid] * (len(data) + 1) + names[1][valid]
        by = np.argsort(key, kind="stable")
        first = np.flatnonzero(np.concatenate([[True], key[by][1:] != key[by][:-1]]))
        low = np.minimum.reduceat(ids[valid][by], first)
        out[valid[by], x] = np.repeat(low, np.diff(np.concatenate([first, [len(by)]])))
    return out


def _covered(windows: DataFrame) -> DataFrame:
    """``node, first, last``: starts of covered windows, as ranges."""
    n = int(windows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salt = F.when(F.col("settled"), F.xxhash64("node", "start")).otherwise(F.lit(0))
    dealt = windows.withColumn("salt", salt).repartition(n, "key", "salt").drop("salt").sortWithinPartitions("key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for b in batches:
            t = pa.Table.from_batches([b])
            done = t.filter(t.column("settled"))
            if done.num_rows:
                start = done.column("start").to_numpy()
                yield _ranges(done.column("node").to_numpy(), start, start + done.column("count").to_numpy() - 1)
            t = t.filter(pc.invert(t.column("settled")))
            t = t if held is None else pa.concat_tables([held, t])
            held = t
            if t.num_rows > 50_000:
                key = t.column("key").to_numpy()
                cut = int(np.searchsorted(key, key[-1]))  # the last key may go on
                if cut:
                    held = t.slice(cut)
                    yield from _settle(t.slice(0, cut))
        if held is not None and held.num_rows:
            yield from _settle(held)

    return dealt.mapInArrow(run, "node long, first int, last int")


def _ranges(node, first, last) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(first, pa.int32()), pa.array(last, pa.int32())],
                                      names=["node", "first", "last"])


def _settle(t: pa.Table) -> Iterator[pa.RecordBatch]:
    """Covered windows among all stretches of some minimizers."""
    key, node, rep, start, count, left = (t.column(c).to_numpy() for c in ("key", "node", "rep", "start", "count", "left"))
    data = t.column("data").to_pylist()
    # equal stretches of a minimizer are one: those of larger ids are covered whole
    names: dict[tuple, int] = {}
    of = np.array([names.setdefault(x, len(names)) for x in zip(key.tolist(), left.tolist(), data, strict=True)])
    low = np.full(len(names), _LAST)
    np.minimum.at(low, of, rep)
    larger = rep > low[of]
    if larger.any():
        yield _ranges(node[larger], start[larger], (start + count - 1)[larger])
    one = np.empty(len(names), np.int64)
    one[of[::-1]] = np.arange(len(of))[::-1]
    k = key[one]
    alone = (np.concatenate([[True], k[1:] != k[:-1]]) & np.concatenate([k[1:] != k[:-1], [True]])) if len(k) else np.zeros(0, bool)
    kinds = np.flatnonzero(~alone)
    if not len(kinds):
        return
    rows = one[kinds]
    least = smallest_ids(key[rows], low[kinds], left[rows], count[rows], [data[i] for i in rows])
    back = np.full(len(names), -1)
    back[kinds] = np.arange(len(kinds))
    mine = np.flatnonzero(~larger & (back[of] >= 0))
    covered = least[back[of[mine]]] < rep[mine][:, None]
    row, x = np.nonzero(covered)
    if not len(row):
        return
    at = start[mine[row]] + left[mine[row]] - x
    order = np.lexsort((at, mine[row]))
    r, at = mine[row][order], at[order]
    new = np.concatenate([[True], (r[1:] != r[:-1]) | (at[1:] != at[:-1] + 1)])
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(at)]]) - 1
    yield _ranges(node[r[first]], at[first], at[last])


def cut(text: bytes, ranges: list[tuple[int, int]], length: int = LENGTH) -> tuple[bytes, int, int]:
    """The bytes left, how many went and in how many runs, given the first and last start of covered windows."""
    runs: list[list[int]] = []
    for a, b in sorted(ranges):
        if runs and a <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], b + length)
        else:
            runs.append([a, b + length])
    at, left = 0, []
    for a, b in runs:
        left.append(text[at:a])
        at = b
    left.append(text[at:])
    kept = b"".join(left)
    return kept, len(text) - len(kept), len(runs)


def repeated_ranges(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``classes(node, rep)`` and ``ranges(node, spans)`` of ``docs(order_id, node, text)``."""
    spark = docs.sparkSession
    classes = written(spark, docs.filter(F.octet_length("text") >= LENGTH).groupBy("node").agg(F.min("order_id").alias("rep")), "classes")
    positions = _minimizers(docs).groupBy("node").agg(F.collect_set("pos").alias("positions"))
    wanted = written(spark, positions.join(classes, "node"), "positions")
    sieve = Sieve(wanted, "rep")

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(sieve.may_hold(b.column("order_id").to_numpy())))

    texts = docs.mapInArrow(sift, docs.schema).withColumnRenamed("node", "own")
    rows = (texts.join(wanted, (texts.order_id == wanted.rep) & (texts.own == wanted.node))
            .select("node", "rep", "text", "positions"))
    covered = _covered(_windows(rows))
    return classes, covered.groupBy("node").agg(F.collect_list(F.struct("first", "last")).alias("spans"))


def _prepared(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``docs(order_id, node, text)``, and ``found(rep, of, spans)`` with a row per class of equal texts."""
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("order_id"),
                       F.xxhash64("text").alias("node"), F.coalesce("text", F.lit("")).alias("text"))
    classes, ranges = repeated_ranges(docs)
    found = classes.join(ranges, "node", "left").select(F.col("rep"), F.col("node").alias("of"), "spans")
    return docs, written(docs.sparkSession, found, "ranges")


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, "text"):
        out = []
        for i, t, first, spans in zip(b.column("order_id").to_pylist(), _bytes(b.column("text")), b.column("rep").to_pylist(),
                                      b.column("spans").to_pylist(), strict=True):
            if first is None and len(t) >= LENGTH:  # a copy
                kept, gone, n = b"", len(t), 1
            else:
                kept, gone, n = cut(t, [(s["first"], s["last"]) for s in spans or ()])
            out.append((None if i == _LAST else i, len(t), gone, n, kept))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)],
                                             names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])


_KEPT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"


def dedup_passages(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept binary`` per row of ``docs(doc_id, text)``."""
    docs, found = _prepared(docs)
    firsts = docs.join(found, (docs.order_id == found.rep) & (docs.node == found.of), "left")
    return firsts.select("order_id", "text", "rep", "spans").mapInArrow(_apply, _KEPT)


def passage_report(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256``: as ``dedup_passages``, moving only texts that are cut.

    Whole and wholly removed texts are answered from their length and hash.
    """
    docs, found = _prepared(docs)
    cut_ones = found.filter("spans is not null")
    sieve = Sieve(cut_ones, "rep")

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(sieve.may_hold(b.column("order_id").to_numpy())))

    texts = docs.mapInArrow(sift, docs.schema)
    cut_rows = (texts.join(cut_ones, (texts.order_id == cut_ones.rep) & (texts.node == cut_ones.of))
                .select("order_id", "text", "rep", "spans").mapInArrow(_apply, _KEPT)
                .select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")))
    brief = docs.select("order_id", "node", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("whole"))
    state = found.select("rep", "of", F.col("spans").isNotNull().alias("is_cut"))
    rest = brief.join(state, (brief.order_id == state.rep) & (brief.node == state.of), "left").filter("is_cut is null or not is_cut")
    copy = F.col("rep").isNull() & (F.col("n_bytes") >= LENGTH)
    rest = rest.select(F.when(F.col("order_id") != _LAST, F.col("order_id")).alias("doc_id"), "n_bytes",
                       F.when(copy, F.col("n_bytes")).otherwise(0).alias("n_removed"),
                       F.when(copy, 1).otherwise(0).cast("long").alias("n_spans"),
                       F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.col("whole")).alias("kept_sha256"))
    return cut_rows.unionByName(rest)


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every text of ``documents``."""
    return passage_report(table(spark, sf_dir, "documents"))
