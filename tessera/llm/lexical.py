"""Ranked lexical search for many queries at once, sharing their common term sets.

Terms are runs of digits, letters and non-ASCII characters, A-Z in lower case.
A document's score for an item sums, over the item's terms with repeats, a
weight by rarity times a saturating count, in whole numbers (see ``weights``
and ``Scorer``).

Items are handled by their distinct texts, in blocks of about ``BLOCK_BYTES``.
For each block an executor mines the term sets that items share: the elements
of an item (a term; its second occurrence is another element, and so on) stand
in order of how many items hold them, neighbours that stand together in several
items become one node, and this repeats until no pair is left that two items
share.  That gives a DAG of sums in which every node is a term set of two items
or more, and an item is the sum of few nodes.  No pairs but neighbours are ever
counted, so mining is linear per round.

Each document is cut into terms once per block; how often it has each query
term is written to a table, Spark counts documents per term from it, and a
second step reads the table in slices: the accumulator of every node is
computed once for all documents of a slice, children first, and combined into
the items' scores.  A task keeps the best ``k`` documents per item; these are
ranked by item and a salt, then by item.

Broadcast are one block's terms and DAG, bounded by the block's size.  A term
table row holds at most the query terms of one document.  Executors read and
write only tables in the shared folder.

Null texts, empty ones and those without terms have no terms: such documents
score nowhere and do not count, such items have no rows.  Rows that share a
``doc_id`` are ranked each by itself; a null ``doc_id`` comes after the others
on equal scores.  Every item row is answered, also those that share an
``item_id`` or text.  Empty tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import discard, slices, table, written

K = 20
#: Bytes of item texts in one block (an item beyond that is a block by itself).
BLOCK_BYTES = 2 << 20
#: Bytes of accumulators that a task holds.
SLICE_BYTES = 48 << 20
#: Bytes of a long text that are cut into terms at a time.
PIECE = 1 << 20
SALTS = 8

_KEEP = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def pieces(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a text, some at a time."""
    raw = (text or "").encode().translate(_KEEP)
    at = 0
    while at < len(raw):
        end = raw.find(b" ", at + PIECE) if at + PIECE < len(raw) else -1
        end = len(raw) if end < 0 else end
        yield raw[at:end].split()
        at = end


# Sharing among items

@dataclass(frozen=True)
class Plan:
    """Sums that serve a block of items.

    Elements ``0 .. len(leaf) - 1`` stand for the terms ``leaf``; node number
    ``len(leaf) + i`` is the sum of nodes ``left[i]`` and ``right[i]``, made in
    round ``rounds``; item ``q`` is the sum of ``parts[ends[q]:ends[q + 1]]``.
    """

    terms: list[bytes]
    leaf: np.ndarray
    left: np.ndarray
    right: np.ndarray
    rounds: np.ndarray
    items: np.ndarray
    parts: np.ndarray
    ends: np.ndarray

    def additions(self) -> int:
        """Sums of two accumulators that the plan makes per document."""
        return len(self.left) + len(self.parts) - len(self.items)


def mine(items: list[tuple[int, list[bytes]]]) -> Plan:
    """The plan for ``(item number, terms)`` of items that have terms."""
    numbers: dict[tuple[bytes, int], int] = {}
    flat, sizes = [], []
    for _, words in items:
        own = [numbers.setdefault((t, j), len(numbers)) for t, n in Counter(words).items() for j in range(n)]
        flat += own
        sizes.append(len(own))
    terms = list(dict.fromkeys(t for t, _ in numbers))
    place = {t: i for i, t in enumerate(terms)}
    leaf = np.array([place[t] for t, _ in numbers], np.int64)
    part, item = np.array(flat, np.int64), np.repeat(np.arange(len(items)), sizes)
    spread = np.random.default_rng(1).integers(1, 1 << 62, len(items))
    left, right, rounds, n = [], [], [], len(numbers)
    while len(part):
        held = np.bincount(part, minlength=n)
        mark = np.zeros(n, np.int64)  # equal for elements that the same items hold
        np.add.at(mark, part, spread[item])
        rank = np.empty(n, np.int64)
        rank[np.lexsort((np.arange(n), mark, -held))] = np.arange(n)
        order = np.lexsort((rank[part], item))
        part, item = part[order], item[order]
        pair, which, count = np.unique(part[:-1] * n + part[1:], return_inverse=True, return_counts=True)
        apart = item[:-1] != item[1:]
        count = np.bincount(which[~apart], minlength=len(pair))
        score = np.where(apart, -1, count[which] * (len(pair) + 1) + which)  # the same for equal pairs, else different
        near = np.concatenate([[-1], score, [-1]])
        chosen = (score > near[:-2]) & (score > near[2:]) & (score >= 2 * (len(pair) + 1))
        taken = np.bincount(which[chosen], minlength=len(pair)) >= 2
        chosen &= taken[which]
        if not chosen.any():
            break
        new = np.full(len(pair), -1)
        new[taken] = n + np.arange(taken.sum())
        left.append(pair[taken] // n)
        right.append(pair[taken] % n)
        rounds.append(np.full(taken.sum(), len(rounds)))
        part[:-1][chosen] = new[which[chosen]]
        keep = ~np.concatenate([[False], chosen])
        part, item, n = part[keep], item[keep], n + int(taken.sum())
    join = lambda xs: np.concatenate([np.zeros(0, np.int64), *xs]).astype(np.int64)
    return Plan(terms, leaf, join(left), join(right), join(rounds), np.array([i for i, _ in items], np.int64), part,
                np.searchsorted(item, np.arange(len(items) + 1)))


# Counting and scoring documents

def weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    """Weight of each term held by ``df`` of ``n_docs`` documents."""
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)


def _counts(shared) -> callable:
    """Rows ``doc_id, n, terms, tfs``: all terms of a document, and the query terms among them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = _numbers(shared)
        for b in slices(batches, "text"):
            n, doc, ids = [], [], []
            for i, t in enumerate(b.column("text").to_pylist()):
                n.append(0)
                for words in pieces(t):
                    n[-1] += len(words)
                    got = np.fromiter(map(number.get, words, repeat(-1)), np.int64, len(words))
                    ids.append(got[got >= 0])
                    doc.append(np.full(len(ids[-1]), i))
            key = np.concatenate([np.zeros(0, np.int64), *doc]) * len(number) + np.concatenate([np.zeros(0, np.int64), *ids])
            key, tf = np.unique(key, return_counts=True)
            ends = np.searchsorted(key, np.arange(len(n) + 1) * len(number)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id"), pa.array(n, pa.int64()),
                pa.ListArray.from_arrays(pa.array(ends), pa.array((key % max(len(number), 1)).astype(np.int32))),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(tf.astype(np.int32)))], names=["doc_id", "n", "terms", "tfs"])

    return run


_NUMBERS: dict[str, dict[bytes, int]] = {}


def _numbers(shared) -> dict[bytes, int]:
    """The worker's term numbers of the block; only the last block's are kept."""
    bc, name = shared
    if name not in _NUMBERS:
        _NUMBERS.clear()
        _NUMBERS[name] = {t: i for i, t in enumerate(bc.value.terms)}
    return _NUMBERS[name]


class Scorer:
    """Scores of slices of documents for all items of a plan."""

    def __init__(self, plan: Plan, weight: np.ndarray, n_docs: int, n_terms: int):
        self.plan, self.weight, self.n_docs, self.n_terms = plan, weight, n_docs, n_terms
        self.nodes = len(plan.leaf) + len(plan.left)
        self.levels = [np.flatnonzero(plan.rounds == r) for r in range(int(plan.rounds.max(initial=-1)) + 1)]
        self.docs = max(1, SLICE_BYTES // (8 * (self.nodes + len(plan.parts) + len(plan.terms) + len(plan.items))))

    def scores(self, n: np.ndarray, ends: np.ndarray, terms: np.ndarray, tfs: np.ndarray) -> np.ndarray:
        """Items by documents; the term counts of document ``i`` are those between its ``ends``."""
        p = self.plan
        doc = np.repeat(np.arange(len(n)), np.diff(ends))
        m = 100 - 25 + (25 * n * self.n_docs) // self.n_terms
        value = np.zeros((len(p.terms), len(n)), np.int64)
        value[terms, doc] = self.weight[terms] * ((1_000_000_000 * tfs) // (1000 * tfs + 12 * m[doc]))
        acc = np.empty((self.nodes, len(n)), np.int64)
        first = len(p.leaf)
        acc[:first] = value[p.leaf]
        for level in self.levels:
            acc[first + level] = acc[p.left[level]] + acc[p.right[level]]
        return np.add.reduceat(acc[p.parts], p.ends[:-1], axis=0)


class Best:
    """The ``k`` best documents per item so far."""

    def __init__(self, n_items: int, k: int):
        self.k, self.least = k, np.ones(n_items, np.int64)  # scores must be above 0
        self.item, self.score, self.doc = (np.zeros(0, np.int64) for _ in range(3))
        self.null = np.zeros(0, bool)

    def add(self, scores: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        item, at = np.nonzero(scores >= self.least[:, None])
        if not len(item):
            return
        item, score = np.concatenate([self.item, item]), np.concatenate([self.score, scores[item, at]])
        doc, null = np.concatenate([self.doc, doc[at]]), np.concatenate([self.null, null[at]])
        order = np.lexsort((doc, null, -score, item))
        item = item[order]
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        order = order[rank < self.k]
        self.least[item[rank == self.k - 1]] = score[order][np.flatnonzero(rank[rank < self.k] == self.k - 1)]
        self.item, self.score, self.doc, self.null = item[rank < self.k], score[order], doc[order], null[order]


def _rank(shared, weight: np.ndarray, n_docs: int, n_terms: int, k: int):
    """Rows ``query, doc_id, score``: the best of each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared[0].value, weight, n_docs, n_terms)
        best = Best(len(scorer.plan.items), k)
        for batch in batches:
            for at in range(0, batch.num_rows, scorer.docs):
                b = batch.slice(at, scorer.docs)
                sizes = [b.column(c) for c in ("terms", "tfs")]
                ends = np.concatenate([[0], np.cumsum(sizes[0].value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
                terms, tfs = (c.flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in sizes)
                doc = b.column("doc_id")
                best.add(scorer.scores(b.column("n").to_numpy(), ends, terms, tfs),
                         doc.fill_null(0).to_numpy(), doc.is_null().to_numpy(zero_copy_only=False))
        yield pa.RecordBatch.from_arrays([pa.array(scorer.plan.items[best.item]), pa.array(best.doc, mask=best.null), pa.array(best.score)],
                                         names=["query", "doc_id", "score"])

    return run


_PLAN = ("block int, terms array<binary>, leaf array<long>, left array<long>, right array<long>, rounds array<long>, "
         "items array<long>, parts array<long>, ends array<long>")


def _plans(queries: DataFrame) -> DataFrame:
    """One plan per block of ``queries(query, text, block)``."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        items = [(q, [w for ws in pieces(t) for w in ws]) for q, t in
                 zip(rows.column("query").to_pylist(), rows.column("text").to_pylist(), strict=True)]
        items = [x for x in items if x[1]]
        p = mine(items)
        numbers = pa.list_(pa.int64())
        return pa.table({"block": pa.array([key[0].as_py()] if items else [], pa.int32()),
                         "terms": pa.array([p.terms] if items else [], pa.list_(pa.binary())),
                         **{c: pa.array([getattr(p, c).tolist()] if items else [], numbers)
                            for c in ("leaf", "left", "right", "rounds", "items", "parts", "ends")}})

    return queries.groupBy("block").applyInArrow(run, _PLAN)


def _best_of_block(docs: DataFrame, plan: Plan, k: int) -> DataFrame:
    """``query, doc_id, score``: the best rows of every task."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(plan), uuid4().hex
    counted = written(spark, docs.mapInArrow(_counts(shared), "doc_id long, n long, terms array<int>, tfs array<int>"), "term-counts")
    total = counted.agg(F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("terms")).first()
    df = np.zeros(len(plan.terms), np.int64)  # as many as the block has terms
    for r in counted.select(F.explode("terms").alias("term")).groupBy("term").count().toLocalIterator():
        df[r["term"]] = r["count"]
    if not total.docs:
        return spark.createDataFrame([], "query long, doc_id long, score long")
    weight = weights(total.docs, df)
    found = written(spark, counted.mapInArrow(_rank(shared, weight, total.docs, total.terms, k), "query long, doc_id long, score long"), "best")
    discard(spark, counted)
    return found


def search(docs: DataFrame, items: DataFrame, k: int = K, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``item_id, rank, doc_id, score`` for ``items(item_id, text)`` against ``docs(doc_id, text)``."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    items = items.select("item_id", "text").filter("text is not null")
    texts = written(spark, items.select("text").distinct().withColumn("query", F.monotonically_increasing_id()), "queries")
    size = texts.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    blocks = max(1, -(-size // block_bytes))
    block = F.pmod(F.xxhash64("query"), F.lit(blocks)).cast("int")
    plans = written(spark, _plans(texts.withColumn("block", block)), "plans")
    found = spark.createDataFrame([], "query long, doc_id long, score long")
    for b in range(blocks):
        for r in plans.filter(F.col("block") == b).collect():  # one block's plan at a time
            plan = Plan(list(map(bytes, r.terms)), *(np.array(r[c], np.int64) for c in ("leaf", "left", "right", "rounds", "items", "parts", "ends")))
            found = found.unionByName(_best_of_block(docs, plan, k))

    def top(*by: str) -> F.Column:
        return F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last()))

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    salted = found.withColumn("salt", F.pmod(F.xxhash64("doc_id", "score"), F.lit(SALTS))).repartition(n, "query", "salt")
    few = salted.withColumn("rank", top("query", "salt")).filter(F.col("rank") <= k).drop("salt")
    ranked = few.withColumn("rank", top("query")).filter(F.col("rank") <= k)
    return ranked.join(items.join(texts, "text").select("item_id", "query"), "query").select("item_id", "rank", "doc_id", "score")


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty best documents for every ``benchmark`` item."""
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP13_SQL = r"""
WITH d AS (
    SELECT row_number() OVER () AS u, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
    FROM documents WHERE text IS NOT NULL),
total AS (SELECT count(*) FILTER (len(w) > 0) AS n, sum(len(w)) AS l FROM d),
tf AS (SELECT u, t, count(*) AS tf FROM (SELECT u, unnest(w) AS t FROM d) GROUP BY u, t),
q AS (
    SELECT row_number() OVER () AS q, item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
    FROM benchmark WHERE text IS NOT NULL),
qt AS (SELECT q, t, count(*) AS c FROM (SELECT q, unnest(w) AS t FROM q) GROUP BY q, t),
weight AS (
    SELECT t, floor(1000 * ln((2 * n + 2) / (2 * df + 1)))::BIGINT AS w
    FROM (SELECT t, count(*) AS df FROM tf GROUP BY t), total),
part AS (
    SELECT u, t, weight.w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * len(d.w)::BIGINT * n) // l::BIGINT))) AS v
    FROM tf JOIN weight USING (t) JOIN d USING (u) CROSS JOIN total),
score AS (SELECT q, u, sum(c * v)::BIGINT AS score FROM qt JOIN part USING (t) GROUP BY q, u),
ranked AS (
    SELECT q, u, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS rank
    FROM score JOIN d USING (u) WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score
FROM ranked JOIN q USING (q) JOIN d USING (u) WHERE rank <= 20
"""
