"""Personal data by fixed forms, and by contexts learned from them.

Base spans are e-mail addresses, IPv4 addresses, card and phone numbers by
their regular forms (leftmost, non-overlapping per kind; a match that fails its
check is dropped).  They seed a bootstrap: the one and the two words before a
span are patterns, and other identifier-like tokens are instances of a kind by
their shape (an ``@``; digits with dots; many or fewer digits).  Spark scores
the pattern-instance graph in rounds.  A pattern's confidence is the sum of its
distinct instances' scores over all its occurrences in the corpus, whatever
follows; patterns with ``SUPPORT`` instances and ``CONFIDENCE`` are believed.
An instance's score is ``1 - prod(1 - confidence)`` over the believed patterns
it follows; base instances have 1.  Instances that reach ``ACCEPT`` become
known, seed the next round, and their occurrences are added as spans.

Null and empty texts have no spans.  Rows may repeat; each is answered by
itself.  A null ``doc_id`` is kept.  An empty table gives no rows; extra columns
are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import slices, table, written
from tessera.llm.sharing import Sieve
from tessera.llm.shingles import LOWER, mix, prefix_sums, signed, spans_hash, word_bounds, word_hashes

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
SUPPORT, CONFIDENCE, ACCEPT = 3, 0.5, 0.5

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_HINT = re.compile(r"[0-9@]+")
_STOP = re.compile(r"\s|\Z")
_ONE, _TWO = np.uint64(0xA24BAED4963EE407), np.uint64(0x9FB21C651E98DF25)


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Each ``@`` with the longest run of address characters before it and a domain after it."""
    at, end = text.find("@"), 0
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            end = m.end()
        at = text.find("@", max(at + 1, end))


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind number, end)`` in order."""
    out = []
    if "@" in text:
        out += [(a, 0, b) for a, b in emails(text)]
    if _HINT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
                out.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


def shape(token: str) -> int | None:
    """The kind whose shape an identifier-like token has."""
    digits = sum(c in "0123456789" for c in token)
    if "@" in token[1:-1]:
        return 0
    if digits < 6 or digits + sum(c in "+().-/" for c in token) < len(token):
        return None
    if token.count(".") == 3 and re.fullmatch(r"[0-9.]+", token):
        return 1
    return 2 if digits >= 12 else 3


def instances(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of identifier-like tokens that touch no base span."""
    out, end, k = [], 0, 0
    base = sorted(base)
    far = 0  # largest end of the base spans before k
    for m in _HINT.finditer(text):
        if m.start() < end:
            continue
        start = text.rfind(" ", end, m.start()) + 1 or end
        start = max(start, text.rfind("\n", start, m.start()) + 1)
        stop = _STOP.search(text, m.end()).start()
        end = stop
        while start < stop and text[start] in "\"'([{<,;:|=":
            start += 1
        while stop > start and text[stop - 1] in "\"')]}>.,;:!?|":
            stop -= 1
        kind = shape(text[start:stop]) if start < stop else None
        while k < len(base) and base[k][0] < stop:
            far = max(far, base[k][2])
            k += 1
        if kind is not None and far <= start:
            out.append((start, kind, stop))
    return out


_ITEMS = "array<struct<kind:int,start:int,end:int,base:boolean,value:long,one:long,two:long>>"


def _scan(docs: DataFrame) -> DataFrame:
    """``doc_id, items``: base spans and instances of every text with value and pattern hashes."""
    kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()),
                               ("value", pa.int64()), ("one", pa.int64()), ("two", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            found, texts, places, values = [], [], [], []
            for t in b.column("text").to_pylist():
                base = base_spans(t) if t else []
                other = instances(t, base) if t else []
                found.append([(k, a, e, True) for a, k, e in base] + [(k, a, e, False) for a, k, e in other])
                if found[-1]:
                    texts.append(t)
                    places.append([a for _, a, _, _ in found[-1]])
                values += [re.sub(r"\s", "", t[a:e]) for _, a, e, _ in found[-1]]
            one, two = context_patterns(texts, places)
            value = _text_hashes(values)
            rows, i = [], 0
            for f in found:
                rows.append([{"kind": k, "start": a, "end": e, "base": s, "value": int(value[i + j]), "one": int(one[i + j]),
                              "two": int(two[i + j])} for j, (k, a, e, s) in enumerate(f)])
                i += len(f)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(rows, kind)], names=["doc_id", "items"])

    return docs.mapInArrow(run, f"doc_id long, items {_ITEMS}")


def _text_hashes(values: list[str]) -> np.ndarray:
    h, at = word_hashes(values)
    return signed(h[at[:-1]]) if len(values) else np.zeros(0, np.int64)


def context_patterns(texts: list[str], places: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the word and of the two words before each place of each text (0 where there are none).

    Words are those of ``word_hashes``, of any length and any white space apart; one that a place cuts ends there.
    """
    if not texts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    raw = [t.encode() for t in texts]
    a = np.frombuffer(b"\n".join(raw).translate(LOWER) + b"\n", np.uint8)
    first = np.cumsum([0, *(len(r) + 1 for r in raw[:-1])])
    at = np.concatenate([f + _byte_offsets(r, p) for f, r, p in zip(first, raw, places, strict=True)])
    first = np.repeat(first, [len(p) for p in places])
    start, end = word_bounds(a)
    if not len(start):
        return np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    sums = prefix_sums(a)
    last = np.searchsorted(start, at) - 1
    one, two = np.zeros(len(at), np.uint64), np.zeros(len(at), np.uint64)
    n = last - np.searchsorted(start, first) + 1
    h = spans_hash(sums, start[np.maximum(last, 0)], np.minimum(end[np.maximum(last, 0)], at))
    h2 = spans_hash(sums, start[np.maximum(last - 1, 0)], end[np.maximum(last - 1, 0)])
    one[n >= 1] = one_word(h[n >= 1])
    two[n >= 2] = two_words(h2[n >= 2], h[n >= 2])
    return signed(one), signed(two)


def _byte_offsets(raw: bytes, places: list[int]) -> np.ndarray:
    """Byte offsets of code points of a text."""
    if raw.isascii():
        return np.array(places, np.int64)
    return np.flatnonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)[places]


def one_word(h: np.ndarray) -> np.ndarray:
    return mix(h + _ONE)


def two_words(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(first * _TWO + second)


def pattern_totals(docs: DataFrame, patterns: DataFrame) -> DataFrame:
    """``pattern, total``: occurrences in the corpus of ``patterns(pattern)``, whatever follows."""
    sieve = Sieve(patterns, "pattern")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", 2 << 20):
            h, at = word_hashes(b.column("text").to_pylist())
            own = np.ones(len(h), bool)
            own[at[:-1][at[:-1] < len(h)]] = False  # the first word of a text has none before it
            pairs = two_words(h[:-1], h[1:])[own[1:]] if len(h) else h
            seen = signed(np.concatenate([one_word(h), pairs]))
            pattern, n = np.unique(seen[sieve.may_hold(seen)], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(pattern), pa.array(n)], names=["pattern", "n"])

    counts = docs.select("text").mapInArrow(run, "pattern long, n long").groupBy("pattern").agg(F.sum("n").alias("total"))
    return counts.join(patterns, "pattern", "left_semi")


def bootstrap(edges: DataFrame, totals: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``kind, value`` of the instances that become known.

    ``edges(kind, value, base, pattern)`` are distinct; ``totals(pattern, total)``.
    """
    spark = edges.sparkSession
    edges = written(spark, edges.join(totals, "pattern"), "graph")
    scores = edges.groupBy("kind", "value").agg(F.max(F.col("base").cast("double")).alias("score"))
    for _ in range(rounds):
        known = scores.filter(F.col("score") >= ACCEPT)
        believed = (edges.join(known, ["kind", "value"])
                    .groupBy("kind", "pattern", "total").agg(F.sum("score").alias("mass"), F.count("*").alias("support"))
                    .withColumn("confidence", F.least(F.col("mass") / F.col("total"), F.lit(0.999)))
                    .filter((F.col("support") >= SUPPORT) & (F.col("confidence") >= CONFIDENCE)))
        reached = edges.join(believed.select("kind", "pattern", "confidence"), ["kind", "pattern"], "left")
        doubt = F.sum(F.log(1 - F.coalesce("confidence", F.lit(0.0))))
        scores = written(spark, reached.groupBy("kind", "value").agg(
            F.when(F.max("base"), 1.0).otherwise(1 - F.exp(doubt)).alias("score"), F.max("base").alias("base")), "scores")
    return scores.filter((F.col("score") >= ACCEPT) & ~F.col("base")).select("kind", "value")


def find(docs: DataFrame) -> DataFrame:
    """``doc_id, base, found`` per row of ``docs(doc_id, text)``: arrays of ``kind, start, end``."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = written(spark, _scan(docs).withColumn("row", F.monotonically_increasing_id()), "items")
    items = rows.select("row", F.explode("items").alias("i")).select("row", "i.*")
    edges = (items.select("kind", "value", "base", F.explode(F.array("one", "two")).alias("pattern")).filter("pattern <> 0")
             .groupBy("kind", "value", "pattern").agg(F.max("base").alias("base")))
    edges = written(spark, edges, "edges")
    # whatever has that many instances may be believed in a later round, also if none of them is a base span
    patterns = edges.groupBy("kind", "pattern").agg(F.count("*").alias("n")).filter(F.col("n") >= SUPPORT).select("pattern").distinct()
    patterns = written(spark, patterns, "patterns")
    known = bootstrap(edges, pattern_totals(docs, patterns))
    span = F.struct("start", "kind", "end")
    new = (items.filter("not base").join(known, ["kind", "value"]).groupBy("row").agg(F.collect_list(span).alias("found")))
    base = F.transform(F.filter("items", lambda i: i["base"]), lambda i: F.struct(i["start"], i["kind"], i["end"]))
    return rows.select("row", "doc_id", base.alias("base")).join(new, "row", "left").select(
        "doc_id", F.array_sort("base").alias("base"), F.coalesce("found", F.array().cast("array<struct<start:int,kind:int,end:int>>")).alias("found"))


def _text(spans: F.Column) -> F.Column:
    """``kind:start:end`` joined by commas, by start and then kind."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _of(kind: int):
    """A filter of one parameter: a second one would be the place in the array."""
    return lambda s: s["kind"] == kind


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every text of ``documents``."""
    got = find(table(spark, sf_dir, "documents"))
    counts = [F.size(F.filter("base", _of(k))).cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return got.select("doc_id", *counts, F.sha2(_text(F.col("base")), 256).alias("base_sha256"),
                      _text(F.concat("base", "found")).alias("spans"))
