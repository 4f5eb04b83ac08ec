"""Token ids as ORC files in document order, and reading them back.

Documents are ranged by ``doc_id`` (the text is what moves), encoded with the
tokenizers library and written one file per range: ORC encodes the integer
lists by run length and bit packing, keeps a row index per
``row_index_stride`` rows and a Bloom filter on ``doc_id``, so a reader splits
files by stripe and skips stripes and row groups by the index.

Each distinct chunk of text (``pretoken``) is encoded by the library once per
worker while it is kept, many new ones as one string; Arrow splits and
numbers a batch's chunks, so that Python meets only the distinct ones.  A text
that holds one of the vocabulary's added tokens goes to the library whole.
Null and empty texts hold only the end id; rows of the same ``doc_id``
are kept, in order of their text; a null ``doc_id`` comes first; an empty table
gives no rows.  Columns other than the id and the text play no part.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import slices, table, written
from tessera.llm.pretoken import ChunkNumbers, apart, unsafe
from tessera.session import scratch_path

def _joined(ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.concatenate([np.zeros(0, np.int32), *ids]), np.array([len(x) for x in ids], np.int64)


class Interned(ChunkNumbers):
    """Ids of text chunks, encoded by the library once while they are kept.

    Chunk number ``i`` has ``ids[start[i]:start[i + 1]]``.
    """

    def __init__(self, vocab: str, limit: int = 1_200_000, limit_chars: int = 32 << 20):
        super().__init__(limit, limit_chars)
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self._tok = Tokenizer.from_file(vocab)
        self._added = [t.content for t in self._tok.get_added_tokens_decoder().values()]
        vocabulary = self._tok.get_vocab(with_added_tokens=False)
        self._size = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)
        for token, i in vocabulary.items():
            self._size[i] = len(token)  # byte-level: a character a byte
        self._ids, self._start = np.zeros(0, np.int32), np.zeros(2, np.int64)

    def _each(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.int32) for e in self._tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _together(self, chunks: list[str], between: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks, encoded as one string with a line feed ``between`` them or nothing, and how many each has by its bytes."""
        text = between.join(chunks)
        if not any(a in text for a in self._added):
            ids = self._each([text])[0]
            reach = np.cumsum(self._size[np.minimum(ids, len(self._size) - 1)])
            size = pc.binary_length(pa.array(chunks, pa.large_string())).to_numpy().astype(np.int64)
            ends = np.cumsum(size + len(between)) - len(between)
            cut = np.searchsorted(reach, ends)  # the last token of each chunk
            first = np.concatenate([[0], cut[:-1] + 1 + len(between)])
            whole = len(reach) > 0 and cut[-1] + 1 == len(ids) and (reach[cut] == ends).all()
            if whole and (not between or (reach[cut[:-1] + 1] == ends[:-1] + 1).all()):
                n = cut + 1 - first
                return ids[np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())], n
        return _joined(self._each(chunks))

    def _learn(self, chunks: list[str]) -> None:
        # without white space at their ends, chunks stay apart when they are joined: a space leads each, or a line feed parts them
        words = apart(chunks)
        kind = np.where(words, 1, 0)
        kind[[i for i in np.flatnonzero(~words).tolist() if chunks[i].strip() == chunks[i]]] = 2
        order = np.argsort(kind, kind="stable")
        other, words, leading = ([chunks[i] for i in np.flatnonzero(kind == k).tolist()] for k in range(3))
        found = [_joined(self._each(other))] if other else []
        for part, between in ((words, ""), (leading, "\n")):
            found += [self._together(part[at:at + 20_000], between) for at in range(0, len(part), 20_000)]
        n = np.zeros(len(chunks), np.int64)
        n[order] = np.concatenate([n for _, n in found])
        flat = np.concatenate([ids for ids, _ in found])
        start = np.zeros(len(chunks), np.int64)
        start[order] = np.cumsum(n[order]) - n[order]
        self._start = np.concatenate([self._start, self._start[-1] + np.cumsum(n)])
        self._ids = np.concatenate([self._ids, flat[np.repeat(start - (np.cumsum(n) - n), n) + np.arange(len(flat))]])
        self._name(chunks)

    def _kept(self, numbers: np.ndarray) -> None:
        n = self._start[numbers + 1] - self._start[numbers]
        end = np.cumsum(n)
        self._ids = self._ids[np.repeat(self._start[numbers] - (end - n), n) + np.arange(end[-1])]
        self._start = np.concatenate([[0], end])

    def _sequences(self, numbers: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
        """Ids per text, whose chunks are ``numbers`` up to its end."""
        n = self._start[numbers + 1] - self._start[numbers]
        total = np.cumsum(n)
        flat = self._ids[np.repeat(self._start[numbers] - (total - n), n) + np.arange(total[-1] if len(total) else 0)]
        at = np.concatenate([[0], np.concatenate([[0], total])[ends]]).tolist()
        return [flat[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids per text (null: none)."""
        self.make_room()
        texts = pc.fill_null(texts, "")
        whole = np.zeros(len(texts), bool)
        for a in self._added:
            whole |= pc.match_substring(texts, a).to_numpy(zero_copy_only=False)
        careful = unsafe(texts) & ~whole
        out: list = [None] * len(texts)

        def put(mask: np.ndarray, found: list[np.ndarray]) -> None:
            for i, ids in zip(np.flatnonzero(mask).tolist(), found, strict=True):
                out[i] = ids

        if whole.any():
            put(whole, self._each(texts.filter(pa.array(whole)).to_pylist()))
        if careful.any():
            put(careful, self._sequences(*self.careful(texts.filter(pa.array(careful)))))
        plain = ~whole & ~careful
        if plain.any():
            put(plain, self._sequences(*self.plain(texts.filter(pa.array(plain)))))
        return out


_KEPT: dict[str, Interned] = {}


def _interned(vocab: str) -> Interned:
    """The worker's chunks of a vocabulary."""
    if vocab not in _KEPT:
        _KEPT[vocab] = Interned(vocab)
    return _KEPT[vocab]


def tokenize(df: DataFrame, vocab: str, end_id: int) -> DataFrame:
    """``doc_id, ids array<int>`` per row of ``df(doc_id, text)``, ``end_id`` appended."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([end_id], np.int32)
        for b in slices(batches, "text", 4 << 20):
            found = _interned(vocab).encode(b.column("text"))
            off = np.concatenate([[0], np.cumsum([len(x) + 1 for x in found])]).astype(np.int32)
            flat = np.concatenate([x for ids in found for x in (ids, end)])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.ListArray.from_arrays(off, pa.array(flat, pa.int32()))],
                                             names=["doc_id", "ids"])

    return df.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, ids array<int>")


def write_tokens(df: DataFrame, path: str, vocab: str, end_id: int = 0, files: int | None = None,
                 stripe_bytes: int = 16 << 20, row_index_stride: int = 1000, bloom_fpp: float = 0.01) -> None:
    """Write ``df(doc_id, text)`` as ORC files whose ranges of ``doc_id`` follow each other by name."""
    n = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.select("doc_id", "text").repartitionByRange(n, F.col("doc_id").asc_nulls_first())
    ranged = ranged.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first())
    (tokenize(ranged, vocab, end_id).write
     .option("orc.compress", "ZLIB").option("orc.stripe.size", stripe_bytes)
     .option("orc.row.index.stride", row_index_stride)
     .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", bloom_fpp)
     .orc(path))


def read_tokens(spark: SparkSession, path: str, ids: list[int] | None = None) -> DataFrame:
    """The written rows; with ``ids`` only those documents, skipping stripes by row index and Bloom filter."""
    df = spark.read.schema("doc_id long, ids array<int>").orc(path)
    return df if ids is None else df.filter(F.col("doc_id").isin(ids))


def positions(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` from the files.

    ``start`` is a running sum in two levels: documents of one file (the files
    are ranges), on top of the totals of the files before it; the window over
    all files holds one row each.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col = b.column("ids")
            off, flat = col.offsets.to_numpy(), col.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
            crc = [zlib.crc32(flat[off[i]:off[i + 1]]) for i in range(len(col))]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("file"), b.column("row"), pa.array(np.diff(off).astype(np.int64)),
                 pa.array(crc, pa.int64())], names=["doc_id", "file", "row", "n_tokens", "ids_crc32"])

    rows = read_tokens(spark, path).select(
        "doc_id", F.regexp_extract(F.input_file_name(), r"part-(\d+)", 1).cast("int").alias("file"),
        F.monotonically_increasing_id().alias("row"), "ids",
    ).mapInArrow(run, "doc_id long, file int, row long, n_tokens long, ids_crc32 long")
    rows = written(spark, rows, "token-rows")
    sums = rows.groupBy("file").agg(F.sum("n_tokens").alias("total"))
    before = F.sum("total").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))
    sums = sums.select("file", F.coalesce(before, F.lit(0)).alias("base"))
    inside = Window.partitionBy("file").orderBy(F.col("doc_id").asc_nulls_first(), "row")
    here = F.sum("n_tokens").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    return (rows.withColumn("here", F.coalesce(here, F.lit(0))).join(sums, "file")
            .select("doc_id", (F.col("base") + F.col("here")).alias("start"), "n_tokens", "ids_crc32"))


def op3_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text of ``documents`` from the ORC files written for it."""
    import public_tokenizers as P

    path = scratch_path(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), path, P.path("byte_bpe_50k.json"), end_id=0)
    return positions(spark, path)
