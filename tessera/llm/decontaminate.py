"""Benchmark decontamination with an Aho-Corasick automaton.

Texts and items are normalised alike: A-Z in lower case, words are runs of
a-z, 0-9 and non-ASCII characters.  The windows of ten consecutive item words
(an item of fewer words is one window) are the patterns of one automaton; each
text is scanned once and the hits are mapped to word numbers and to code point
offsets of the original text.

The automaton is broadcast in blocks of at most ``MAX_PATTERN_CHARS`` pattern
characters: a benchmark beyond that is scanned block by block, each block's
hits being carried along with the text, so no size is out of reach and no task
holds more than one block.

Null or empty texts and texts without words have no words and no hits.  Items
without words have no windows.  An item whose ``item_id`` is null marks words
but is not listed.  Rows repeated in ``documents`` are kept, repeated items
count once per ``item_id``.  An empty table gives no rows, an empty benchmark
no hits.  Extra columns pass through; the added names replace columns of the
same name.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from uuid import uuid4

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import slices, table

WINDOW = 10
#: Pattern characters in one automaton (a node takes some tens of bytes).
MAX_PATTERN_CHARS = 4 << 20

_KEEP = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_WORD = re.compile(rb"[^ ]+")


def words(text: str | None) -> list[bytes]:
    """The normalised words, in UTF-8."""
    return text.encode().translate(_KEEP).split() if text else []


def windows(text: str | None, size: int = WINDOW) -> list[bytes]:
    """The distinct windows of an item, words joined by a space, with a space at both ends."""
    w = words(text)
    if not w:
        return []
    n = min(size, len(w))
    return list({b" " + b" ".join(w[i:i + n]) + b" " for i in range(len(w) - n + 1)})


def window_blocks(items: DataFrame, size: int = WINDOW,
                  max_chars: int = MAX_PATTERN_CHARS) -> Iterator[list[tuple]]:
    """``(window, item ids)`` of ``items(item_id, text)`` in blocks of about ``max_chars`` characters."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", 1 << 20):
            for i, t in zip(b.column("item_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                if got := windows(t, size):
                    yield pa.RecordBatch.from_arrays([pa.array([i] * len(got), pa.string()), pa.array(got, pa.binary())],
                                                     names=["item_id", "win"])

    cuts = (items.select(F.col("item_id").cast("string").alias("item_id"), "text")
            .mapInArrow(cut, "item_id string, win binary")
            .groupBy("win").agg(F.sort_array(F.collect_set("item_id")).alias("items")))
    cuts = cuts.persist()
    chars = cuts.agg(F.sum(F.octet_length("win") + F.size("items") * 8)).first()[0] or 0
    n = -(-chars // max_chars) or 1
    for k in range(n):
        yield [(r.win, tuple(r.items)) for r in cuts.filter(F.pmod(F.xxhash64("win"), F.lit(n)) == k).toLocalIterator()]
    cuts.unpersist()


_AUTOMATA: dict[str, object] = {}


def _automaton(bc) -> ahocorasick.Automaton | None:
    """The worker's automaton for a broadcast block; only the last one used is kept."""
    if bc.id not in _AUTOMATA:
        _AUTOMATA.clear()
        auto = ahocorasick.Automaton()
        for win, items in bc.value:
            auto.add_word(win.decode("latin-1"), (win.count(b" ") - 1, items))
        if len(auto):
            auto.make_automaton()
        _AUTOMATA[bc.id] = auto if len(auto) else None
    return _AUTOMATA[bc.id]


class _Block:
    """A broadcast block with an id that workers can key on, never given twice."""

    def __init__(self, spark: SparkSession, rows: list[tuple]):
        self._bc, self.id = spark.sparkContext.broadcast(rows), uuid4().hex

    @property
    def value(self) -> list[tuple]:
        return self._bc.value


def find(text: str | None, auto) -> tuple[int, list[tuple[int, int]], set]:
    """Number of words, ``[first, end)`` word ranges of the occurrences, and the items they belong to."""
    w = words(text)
    ranges, items = [], set()
    if w and auto is not None:
        flat = (b" " + b" ".join(w) + b" ").decode("latin-1")
        spaces = None
        for end, (n, its) in auto.iter(flat):
            if spaces is None:
                spaces = np.flatnonzero(np.frombuffer(flat.encode("latin-1"), dtype=np.uint8) == 32)
            last = int(np.searchsorted(spaces, end))  # the space after word number last - 1
            ranges.append((last - n, last))
            items.update(its)
    return len(w), ranges, items


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Disjoint sorted ranges covering the same words."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def offsets(text: str, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Code point ``[start, end)`` of word ranges in the original text."""
    raw = text.encode()
    at = [(m.start(), m.end()) for m in _WORD.finditer(raw.translate(_KEEP))]
    point = np.cumsum((np.frombuffer(raw, dtype=np.uint8) & 0xC0) != 0x80)
    start = lambda i: int(point[i]) - 1
    return [(start(at[a][0]), start(at[b - 1][1] - 1) + 1) for a, b in ranges]


HITS = [T.StructField("n_words", T.LongType()),
        T.StructField("hit_words", T.ArrayType(T.ArrayType(T.LongType()))),
        T.StructField("hit_spans", T.ArrayType(T.ArrayType(T.LongType()))),
        T.StructField("hit_items", T.ArrayType(T.StringType()))]


def mark(docs: DataFrame, items: DataFrame, text: str = "text", size: int = WINDOW,
         max_chars: int = MAX_PATTERN_CHARS, keep_text: bool = True) -> DataFrame:
    """``docs`` with ``n_words``, ``hit_words`` (ranges of word numbers), ``hit_spans`` (the same ranges as code
    points of the original text) and ``hit_items`` (sorted item ids)."""
    names = {f.name for f in HITS}
    docs = docs.select([F.col(f"`{c}`") for c in docs.columns if c.lower() not in names])
    fields = docs.schema.fields
    blocks = window_blocks(items, size, max_chars)
    rows = next(blocks)
    k = 0
    while rows is not None:
        after = next(blocks, None)
        block = _Block(docs.sparkSession, rows)
        out = [f for f in fields if keep_text or after is not None or f.name != text]
        docs = docs.mapInArrow(_scan(block, text, [f.name for f in out], k == 0), T.StructType([*out, *HITS]))
        rows, k = after, k + 1
    return docs


def _scan(block: _Block, text: str, keep: list[str], first: bool):
    kinds = [pa.int64(), pa.list_(pa.list_(pa.int64())), pa.list_(pa.list_(pa.int64())), pa.list_(pa.string())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, text):
            auto = _automaton(block)
            texts = b.column(text).to_pylist()
            old_words = b.column("hit_words").to_pylist() if not first else None
            old_items = b.column("hit_items").to_pylist() if not first else None
            cols: tuple[list, ...] = ([], [], [], [])
            for i, t in enumerate(texts):
                n, ranges, items = find(t, auto)
                if not first:
                    ranges += [tuple(r) for r in old_words[i]]
                    items.update(old_items[i])
                ranges = merged(ranges)
                for col, v in zip(cols, (n, ranges, offsets(t, ranges) if ranges else [],
                                         sorted(x for x in items if x is not None)), strict=True):
                    col.append(v)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), *map(pa.array, cols, kinds)],
                                             names=[*keep, *(f.name for f in HITS)])

    return run


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` against all windows of ``benchmark``."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    hits = mark(docs, table(spark, sf_dir, "benchmark"), keep_text=False)
    n_hit = F.aggregate("hit_words", F.lit(0).cast("long"), lambda s, r: s + r[1] - r[0])
    return hits.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "hit_items"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


OP9_SQL = r"""
WITH d AS (
    SELECT doc_id, row_number() OVER () AS u, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents),
b AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark),
win AS (
    SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS s
    FROM b, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS t(i) WHERE len(w) > 0),
dw AS (
    SELECT u, i, n, array_to_string(w[i:i + n - 1], ' ') AS s
    FROM d, (SELECT DISTINCT n FROM win) AS lens, unnest(range(1, len(w) - n + 2)) AS t(i) WHERE len(w) >= n),
hit AS (SELECT u, i, dw.n, item_id FROM dw JOIN win ON win.n = dw.n AND win.s = dw.s),
cov AS (SELECT u, count(DISTINCT p) AS n_hit FROM hit, unnest(range(i, i + n)) AS t(p) GROUP BY u),
its AS (
    SELECT u, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT u, item_id::VARCHAR AS item FROM hit WHERE item_id IS NOT NULL) GROUP BY u)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cov USING (u) LEFT JOIN its USING (u)
"""
