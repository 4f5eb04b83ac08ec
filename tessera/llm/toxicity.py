"""Toxicity scores by a factorization machine over hashed terms.

A text's terms are its distinct words in lower case and their beginnings of
three to seven letters, hashed to ``2**BITS`` numbers.  The machine has a bias,
a weight and ``FACTORS`` latent numbers per term, so that two terms met in one
text (an insult and whom it is aimed at) count beyond the sum of their weights;
it learns by logistic loss.  The sum over pairs is taken in linear time,
``(|sum v|^2 - sum |v|^2) / 2``.

Its inputs are found on a bounded sample of labelled rows in two ways.  Spark
counts how many toxic and clean texts hold each term: the ``TERMS`` that tell
most by themselves.  A term can also tell only beside another, as common in
clean texts as in toxic ones; so a first machine over all words that stand in
``MIN_TEXTS`` of the sample's texts is fitted, by steps over few texts with
strong decay, and the words whose factors, weighed by their texts, stand out by far are
inputs too, ``PAIRED`` at most.  The final machine is fitted on these inputs.

``SAMPLE`` bounds the labelled rows the model is fitted on (ids with the
smallest hash; an id with several texts gives its smallest one); scoring covers
every whole text.  Labels, language, source and id are never inputs of a score.

Null, empty and wordless texts get the bias's score.  A row of ``labels``
without id or label is left out; an id labelled twice is toxic if one row says
so.  Without labelled rows the score is 0.5 everywhere.  Repeated rows are
scored alike; an empty table gives no rows; extra columns pass through, and
``score`` and ``predicted`` replace columns of that name.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import slices, table

BITS = 22
TERMS = 4096
FACTORS = 4
SAMPLE = 20_000
MIN_TEXTS = 4
#: Words taken for their factors: at most so many, each so many times as strong as the middle one.
PAIRED, STRONG = 256, 20
THRESHOLD = 0.7

_WORDS = re.compile(r"[^\W\d_]+")


def word_term(word: str) -> int:
    """Hashed term of the whole word."""
    return zlib.crc32((word + "$").encode()) >> (32 - BITS)


def word_terms(word: str) -> tuple[int, ...]:
    """Hashed terms of a word."""
    return tuple({zlib.crc32(t.encode()) >> (32 - BITS)
                  for t in (word + "$", *(word[:n] for n in range(3, min(7, len(word)) + 1)))})


def text_words(text: str | None) -> set[str]:
    return set(_WORDS.findall(text.lower())) if text else set()


@dataclass
class Machine:
    """Hashed terms in ascending order, their weights and factors, and the bias."""

    terms: np.ndarray
    weights: np.ndarray
    factors: np.ndarray
    bias: float

    def score(self, inputs: np.ndarray) -> float:
        """Probability for a text with these inputs (indices into ``terms``)."""
        v = self.factors[inputs]
        s = v.sum(axis=0)
        return _sigmoid(self.bias + self.weights[inputs].sum() + 0.5 * float((s * s).sum() - (v * v).sum()))


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def held_out(doc_id: str = "doc_id") -> F.Column:
    """Rows never learned from: crc32 of the id as text leaves 1 on division by 3."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1


def _term_counts(texts: DataFrame) -> DataFrame:
    """``term, toxic, n`` : texts of each label that hold a term, counted in each task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", 2 << 20):
            y = b.column("toxic").to_numpy(zero_copy_only=False)
            sets = [np.array(sorted({h for w in text_words(t) for h in word_terms(w)}), dtype=np.int64)
                    for t in b.column("text").to_pylist()]
            for label in (0, 1):
                got = [s for s, k in zip(sets, y, strict=True) if k == label and len(s)]
                if got:
                    term, n = np.unique(np.concatenate(got), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(term, pa.int32()), pa.array([label] * len(term), pa.int32()),
                                                      pa.array(n, pa.int64())], names=["term", "toxic", "n"])

    return texts.mapInArrow(run, "term int, toxic int, n long").groupBy("term", "toxic").agg(F.sum("n").alias("n"))


def _inputs(texts: DataFrame, terms: np.ndarray) -> DataFrame:
    """``toxic, inputs``: which of the chosen terms each text holds, as bytes of 32-bit numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, tuple[int, ...]] = {}
        for b in slices(batches, "text", 2 << 20):
            rows = [np.array(sorted(active(text_words(t), terms, cache)), ">i4").tobytes() for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("toxic"), pa.array(rows, pa.binary())], names=["toxic", "inputs"])

    return texts.select("toxic", "text").mapInArrow(run, "toxic int, inputs binary")


def active(found: set[str], terms: np.ndarray, cache: dict[str, tuple[int, ...]], limit: int = 500_000) -> set[int]:
    """Indices of the chosen terms among the words' terms; words seen before are looked up."""
    if len(cache) > limit:
        cache.clear()
    new = [w for w in found if w not in cache]
    if new:
        hashed = [word_terms(w) for w in new]
        flat = np.array([h for hs in hashed for h in hs], dtype=np.int64)
        at = np.searchsorted(terms, flat)
        ok = (terms[np.minimum(at, len(terms) - 1)] == flat) if len(terms) else np.zeros(len(flat), bool)
        k = 0
        for w, hs in zip(new, hashed, strict=True):
            n = len(hs)
            cache[w] = tuple(at[k:k + n][ok[k:k + n]].tolist()) if ok[k:k + n].any() else ()
            k += n
    out: set[int] = set()
    for w in found:
        if got := cache[w]:
            out.update(got)
    return out


def _sample_words(texts: DataFrame) -> np.ndarray:
    """Hashed words that stand in ``MIN_TEXTS`` texts of the sample, ascending; there are at most ``2**BITS``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", 2 << 20):
            sets = [np.unique(np.array([word_term(w) for w in text_words(t)], np.int32)) for t in b.column("text").to_pylist()]
            term, n = np.unique(np.concatenate([np.zeros(0, np.int32), *sets]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(term), pa.array(n)], names=["term", "n"])

    counts = texts.select("text").mapInArrow(run, "term int, n long").groupBy("term").agg(F.sum("n").alias("n"))
    return np.sort(counts.filter(F.col("n") >= MIN_TEXTS).select("term").toArrow().column("term").to_numpy()).astype(np.int64)


def _word_inputs(texts: DataFrame, words: np.ndarray) -> list[tuple[np.ndarray, int]]:
    """Per text the places of its words in ``words`` and its label: a bounded sample, as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", 2 << 20):
            rows = []
            for t in b.column("text").to_pylist():
                found = np.array([word_term(w) for w in text_words(t)], np.int64)
                at = np.minimum(np.searchsorted(words, found), len(words) - 1)
                rows.append(np.unique(at[words[at] == found]).astype("<i4").tobytes())
            yield pa.RecordBatch.from_arrays([b.column("toxic"), pa.array(rows, pa.binary())], names=["toxic", "places"])

    got = texts.select("toxic", "text").mapInArrow(run, "toxic int, places binary").orderBy("places", "toxic").collect()
    return [(np.frombuffer(r.places, "<i4"), r.toxic) for r in got]


def paired(rows: list[tuple[np.ndarray, int]], m: int, keep: int = PAIRED, factors: int = FACTORS, epochs: int = 6,
           seed: int = 7, step: int = 256, rate: float = 0.1, decay: float = 0.005) -> np.ndarray:
    """Of ``m`` words those whose factors stand out in a machine over all of them, at most ``keep``.

    Adagrad over ``step`` texts at a time; decay falls on the words of those texts.  With few texts
    there are more epochs, so that about as many steps are made.
    """
    rng = np.random.default_rng(seed)
    y = np.array([r[1] for r in rows], float)
    size = np.array([len(r[0]) for r in rows])
    p = rng.normal(0, 0.02, (m, factors + 1)).astype(np.float32)
    p[:, 0] = 0
    past, bias, bias_past = np.full(p.shape, 1e-6, np.float32), 0.0, 1e-6
    for _ in range(max(epochs, min(40, 100_000 // max(1, len(rows))))):
        order = rng.permutation(len(rows))
        for a in range(0, len(rows), step):
            part = order[a:a + step]
            part = part[size[part] > 0]
            if not len(part):
                continue
            idx = np.concatenate([rows[i][0] for i in part])
            row = np.repeat(np.arange(len(part)), size[part])
            first = np.concatenate([[0], np.cumsum(size[part])[:-1]])
            v = p[idx]
            s = np.add.reduceat(v, first, axis=0)
            out = bias + s[:, 0] + 0.5 * ((s[:, 1:] ** 2).sum(1) - np.add.reduceat((v[:, 1:] ** 2).sum(1), first))
            g = (_sigmoid(out) - y[part]).astype(np.float32)
            grad = g[row][:, None] * np.concatenate([np.ones((len(idx), 1), np.float32), s[row][:, 1:] - v[:, 1:]], axis=1)
            by = np.argsort(idx, kind="stable")
            cut = np.flatnonzero(np.concatenate([[True], idx[by][1:] != idx[by][:-1]]))
            at = idx[by][cut]
            total = np.add.reduceat(grad[by], cut, axis=0) / len(part) + decay * p[at]
            past[at] += total * total
            p[at] -= rate * total / np.sqrt(past[at])
            bias_past += float(g.mean()) ** 2
            bias -= rate * float(g.mean()) / np.sqrt(bias_past)
    texts = np.bincount(np.concatenate([np.zeros(0, np.int64), *(r[0] for r in rows)]).astype(np.int64), minlength=m)
    strength = (p[:, 1:].astype(float) ** 2).sum(1) * texts
    order = np.lexsort((np.arange(m), -strength))[:keep]
    return np.sort(order[strength[order] > STRONG * np.median(strength)])


def learn(texts: DataFrame, terms: int = TERMS, factors: int = FACTORS, epochs: int = 150, seed: int = 7) -> Machine:
    """Fit on ``texts(text, toxic)``, a bounded sample."""
    n = {r.toxic: r.n for r in texts.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    pos, neg = n.get(1, 0), n.get(0, 0)
    empty = Machine(np.zeros(0, np.int64), np.zeros(0), np.zeros((0, factors)), 0.0)
    if not pos or not neg:
        return empty if not pos + neg else Machine(empty.terms, empty.weights, empty.factors, 4.0 if pos else -4.0)
    counts = _term_counts(texts).groupBy("term").pivot("toxic", [0, 1]).agg(F.sum("n")).na.fill(0)
    a, b = F.col("1"), F.col("0")
    expected = (a + b) * (pos / (pos + neg))
    chi = F.pow(a - expected, 2) / expected + F.pow(b - (a + b) + expected, 2) / ((a + b) * (neg / (pos + neg)))
    best = (counts.filter(a + b >= MIN_TEXTS).select("term", chi.alias("chi"))
            .orderBy(F.desc("chi"), "term").limit(terms).collect())
    telling = {r.term for r in best if r.chi > 10.8}  # p < 0.001, one degree of freedom
    words = _sample_words(texts)
    if len(words):
        telling.update(words[paired(_word_inputs(texts, words), len(words))].tolist())
    chosen = np.array(sorted(telling), dtype=np.int64)
    rows = _inputs(texts, chosen).groupBy("inputs", "toxic").agg(F.count("*").alias("n")).orderBy("inputs", "toxic").collect()
    return fit(chosen, [(np.frombuffer(r.inputs, ">i4"), r.toxic, r.n) for r in rows], factors, epochs, seed)


def fit(terms: np.ndarray, rows: list[tuple], factors: int, epochs: int, seed: int,
        rate: float = 0.05, decay: float = 1e-4) -> Machine:
    """Adam on the logistic loss over all rows at once; rows are ``(inputs, label, count)``.

    The inputs of all rows are held once as numbers, and one factor of each at a time.
    """
    rng = np.random.default_rng(seed)
    size = np.array([len(r[0]) for r in rows])
    idx = np.concatenate([np.zeros(0, np.int32), *(np.asarray(r[0], np.int32) for r in rows)])
    row = np.repeat(np.arange(len(rows), dtype=np.int32), size)
    y, c = np.array([r[1] for r in rows], float), np.array([r[2] for r in rows], float)
    c /= c.sum()
    m = len(terms)
    p = {"b": np.zeros(1), "w": np.zeros(m), "v": rng.normal(0, 0.05, (m, factors))}
    first, second = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))

    for step in range(1, epochs + 1):
        s, squares = np.zeros((factors, len(rows))), np.zeros(len(idx))
        for f in range(factors):
            v = p["v"][:, f][idx]
            s[f] = np.bincount(row, v, len(rows))
            squares += v * v
        out = p["b"] + np.bincount(row, p["w"][idx], len(rows)) + 0.5 * ((s * s).sum(0) - np.bincount(row, squares, len(rows)))
        del squares
        g = (_sigmoid(out) - y) * c
        each = g[row]
        grad = {"b": np.array([g.sum()]), "w": np.bincount(idx, each, m) + decay * p["w"], "v": decay * p["v"]}
        for f in range(factors):
            grad["v"][:, f] += np.bincount(idx, each * (s[f][row] - p["v"][:, f][idx]), m)
        for k, x in grad.items():
            first[k] = 0.9 * first[k] + 0.1 * x
            second[k] = 0.999 * second[k] + 0.001 * x * x
            p[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return Machine(terms, p["w"], p["v"], float(p["b"][0]))


def labelled_sample(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> DataFrame:
    """``text, toxic`` of at most ``size`` labelled ids that are not held out."""
    ids = (labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out())
           .groupBy(F.col("doc_id").alias("id")).agg(F.max("toxic").cast("int").alias("toxic"))
           .orderBy(F.xxhash64("id"), "id").limit(size))
    return docs.select("doc_id", "text").join(F.broadcast(ids), F.col("doc_id") == F.col("id")).groupBy("id").agg(
        F.min("text").alias("text"), F.first("toxic").alias("toxic")).select("text", "toxic")


def score(docs: DataFrame, machine: Machine, threshold: float = THRESHOLD, keep_text: bool = True) -> DataFrame:
    """``docs`` with ``score double`` and ``predicted int``."""
    docs = docs.select([F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("score", "predicted")])
    keep = [f for f in docs.schema.fields if keep_text or f.name != "text"]
    schema = T.StructType([*keep, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    shared = docs.sparkSession.sparkContext.broadcast(machine)  # TERMS bounds its size
    names = [f.name for f in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, cache = shared.value, {}
        for b in slices(batches, "text"):
            s = [float(m.score(np.array(sorted(active(text_words(t), m.terms, cache)), dtype=np.int64)))
                 for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(s, pa.float64()),
                                              pa.array([int(x >= threshold) for x in s], pa.int32())],
                                             names=[*names, "score", "predicted"])

    return docs.mapInArrow(run, schema)


def trained(docs: DataFrame, labels: DataFrame) -> Machine:
    """The machine learned from the labelled rows of ``docs``."""
    sample = labelled_sample(docs, labels).persist()
    try:
        return learn(sample)
    finally:
        sample.unpersist()


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents``, scored by what ``labels`` teaches."""
    docs = table(spark, sf_dir, "documents")
    machine = trained(docs, table(spark, sf_dir, "labels"))
    scored = score(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), machine, keep_text=False)
    return scored.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", "predicted")
