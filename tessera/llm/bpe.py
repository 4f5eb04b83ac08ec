"""Byte-level BPE encoding and decoding as recursive relational queries.

Each Spark partition runs one in-process DuckDB.  Words are token-position
rows ``(word, position, token)``; a recursive query joins neighbouring tokens
to the merge table, contracts the leftmost pair of minimum rank of every word
(the row left of it and the row itself get a new right neighbour) and stops
when no word has a pair left.  Decoding joins ids to the vocabulary
and aggregates the byte strings in position order.

No merge joins two bytes that stand side by side in no vocabulary entry, so
words are first cut there, and each distinct part goes through the query once.
Parts above ``LONG`` bytes take a second query that contracts several pairs a
step: of the pairs of minimum rank all that do not overlap, left to right, up to
the first whose new token makes a pair of a rank as low with a neighbour.  Until
there the next minimal pair is the next one on the right anyway, so the ids are
those of one by one.

Arrow splits and numbers a batch's chunks (``pretoken``); only the matches of
chunks that the task has not met lately go through the query, whose number per
batch is bounded by the batch's bytes.  What a task keeps of them, two Arrow
arrays and a number per chunk, goes with the task: idle workers hold the
database only.
Null and empty texts have no tokens.  Repeated rows and ids are kept.  Extra
columns pass through untouched; columns of the same name as the added ones are
replaced.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import slices, table
from tessera.llm.pretoken import ChunkNumbers, apart, unsafe

MERGE_SQL = """
WITH RECURSIVE state(word, pos, tok, npos, ntok, done) AS (
    SELECT word, pos, tok, npos, ntok, false FROM start
    UNION ALL
    (WITH best AS (
        SELECT word, min((rank::BIGINT << 32) | pos) AS best, arg_min(npos, (rank::BIGINT << 32) | pos) AS gone
        FROM state JOIN merges m ON m.l = tok AND m.r = ntok WHERE NOT done GROUP BY word)
    SELECT s.word, s.pos,
           CASE WHEN s.pos = best & 4294967295 THEN best >> 32 ELSE s.tok END,
           CASE WHEN s.pos = best & 4294967295 THEN g.npos ELSE s.npos END,
           CASE WHEN s.pos = best & 4294967295 THEN g.ntok
                WHEN s.npos = best & 4294967295 THEN best >> 32 ELSE s.ntok END,
           best IS NULL
    FROM state s LEFT JOIN best b USING (word)
    LEFT JOIN state g ON g.word = s.word AND g.pos = gone AND s.npos = gone
    WHERE NOT s.done AND s.pos IS DISTINCT FROM gone)
)
SELECT word, list(tok ORDER BY pos) AS ids FROM state WHERE done GROUP BY word ORDER BY word
"""

LONG_SQL = """
WITH RECURSIVE state(word, pos, tok, done) AS (
    SELECT word, pos, tok, false FROM start
    UNION ALL
    (WITH cur AS (
        SELECT word, pos, tok, lead(tok) OVER w AS ntok, row_number() OVER w AS k
        FROM state WHERE NOT done WINDOW w AS (PARTITION BY word ORDER BY pos)),
    ranked AS (
        SELECT cur.*, m.rank, min(m.rank) OVER (PARTITION BY cur.word) AS low
        FROM cur LEFT JOIN merges m ON m.l = tok AND m.r = ntok),
    cand AS (
        SELECT *, coalesce(rank = low, false) AS c,
               row_number() OVER (PARTITION BY word, coalesce(rank = low, false) ORDER BY pos) AS j FROM ranked),
    apart AS (
        SELECT *, c AND row_number() OVER (PARTITION BY word, c, k - j ORDER BY pos) % 2 = 1 AS may FROM cand),
    sides AS (
        SELECT *, CASE WHEN lag(may, 2) OVER w THEN low ELSE lag(tok) OVER w END AS before, lead(tok, 2) OVER w AS after
        FROM apart WINDOW w AS (PARTITION BY word ORDER BY pos)),
    first_low AS (
        SELECT s.word, min(k) AS k FROM sides s
        LEFT JOIN merges x ON x.l = before AND x.r = low LEFT JOIN merges y ON y.l = low AND y.r = after
        WHERE may AND (x.rank <= low OR y.rank <= low) GROUP BY s.word),
    hits AS (
        SELECT s.*, may AND s.k <= coalesce(f.k, s.k) AS hit FROM sides s LEFT JOIN first_low f USING (word)),
    gone AS (SELECT *, coalesce(lag(hit) OVER (PARTITION BY word ORDER BY pos), false) AS gone FROM hits)
    SELECT word, pos, CASE WHEN hit THEN low ELSE tok END, low IS NULL FROM gone WHERE NOT gone)
)
SELECT word, list(tok ORDER BY pos) AS ids FROM state WHERE done GROUP BY word ORDER BY word
"""

#: Bytes of a part from which on it takes the second query, and of the parts of one query.
LONG, BLOCK_BYTES = 64, 400_000

DECODE_SQL = """
SELECT doc, string_agg(v.hex, '' ORDER BY pos) AS hex
FROM ids JOIN vocab v USING (tok) GROUP BY doc ORDER BY doc
"""


def read_ranks(path: str) -> dict[bytes, int]:
    """The vocabulary file: base64 token and rank per line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class BpeQueries:
    """One DuckDB database with the merge table and the vocabulary of a rank file."""

    def __init__(self, path: str, pattern: str):
        import duckdb
        import regex

        ranks = read_ranks(path)
        self.find = regex.compile(pattern).findall
        # no folder to spill to: what a query holds is bounded by ``BLOCK_BYTES``
        self._db = duckdb.connect(config={"threads": 1, "memory_limit": "300MB", "temp_directory": ""})
        get = ranks.get
        pairs = [(a, b, r) for t, r in ranks.items() for i in range(1, len(t))
                 if (a := get(t[:i])) is not None and (b := get(t[i:])) is not None]
        left, right, rank = (np.array(x, np.int32) for x in zip(*pairs, strict=True))
        merges = pa.table({"l": left, "r": right, "rank": rank})
        vocab = pa.table({"tok": pa.array(list(ranks.values()), pa.int32()), "hex": pa.array([t.hex() for t in ranks])})
        self._db.register("m", merges)
        self._db.execute("CREATE TABLE merges AS SELECT * FROM m")
        self._db.register("v", vocab)
        self._db.execute("CREATE TABLE vocab AS SELECT * FROM v")
        self._byte = np.array([ranks[bytes([i])] for i in range(256)], dtype=np.int32)
        self._size = np.zeros(max(ranks.values()) + 1, np.int64)  # bytes of a token
        self._size[list(ranks.values())] = [len(t) for t in ranks]
        self._meet = np.zeros((256, 256), bool)  # bytes that stand side by side in an entry
        for t in ranks:
            b = np.frombuffer(t, np.uint8)
            self._meet[b[:-1], b[1:]] = True

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, and where each word's begin (one more entry than words)."""
        size = np.array([len(w) for w in words], np.int64)
        raw = np.frombuffer(b"".join(words), np.uint8)
        if not len(raw):
            return np.zeros(0, np.int32), np.zeros(len(words) + 1, np.int64)
        ends = np.cumsum(size)
        cut = np.zeros(len(raw) + 1, bool)
        cut[0] = True
        cut[ends] = True
        cut[1:-1] |= ~self._meet[raw[:-1], raw[1:]]
        at = np.flatnonzero(cut)
        flat = raw.tobytes()
        parts = [flat[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        distinct = {p: i for i, p in enumerate(dict.fromkeys(parts))}
        ids, off = self._merged(list(distinct))
        use = np.fromiter(map(distinct.__getitem__, parts), np.int64, len(parts))
        n = off[use + 1] - off[use]
        out = ids[np.repeat(off[use] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        return out, np.concatenate([[0], np.cumsum(n)])[np.searchsorted(at, np.concatenate([[0], ends]))]

    def _merged(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all parts, and where each part's begin."""
        size = np.array([len(p) for p in parts], np.int64)
        order = np.argsort(size > LONG, kind="stable")  # short ones first
        n_short = int((size <= LONG).sum())
        blocks = np.cumsum(size[order]) // BLOCK_BYTES
        flat: list[np.ndarray] = []
        count = np.zeros(len(parts), np.int64)
        for members, query in ((order[:n_short], MERGE_SQL), (order[n_short:], LONG_SQL)):
            for block in np.split(members, np.flatnonzero(np.diff(blocks[:n_short] if query is MERGE_SQL else blocks[n_short:])) + 1):
                if len(block):
                    ids, n = self._contracted([parts[i] for i in block], query)
                    flat.append(ids)
                    count[block] = n
        ids = np.concatenate(flat)
        start = np.zeros(len(parts), np.int64)
        start[order] = np.cumsum(count[order]) - count[order]
        n = count
        ids = ids[np.repeat(start - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        return ids, np.concatenate([[0], np.cumsum(n)])

    def _contracted(self, parts: list[bytes], query: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the parts of one query, and how many each has."""
        size = np.array([len(p) for p in parts])
        raw = np.frombuffer(b"".join(parts), dtype=np.uint8)
        pos = (np.arange(len(raw)) - np.repeat(np.cumsum(size) - size, size)).astype(np.int32)
        tok, last = self._byte[raw], pos + 1 == np.repeat(size, size)
        start = pa.table({"word": np.repeat(np.arange(len(parts), dtype=np.int32), size), "pos": pos, "tok": tok,
                          "npos": np.where(last, np.int32(-1), pos + np.int32(1)),
                          "ntok": np.where(last, np.int32(-1), np.roll(tok, -1))})
        self._db.register("start", start)
        got = self._db.sql(query).to_arrow_table()
        ids = got.column("ids").combine_chunks()
        return ids.flatten().to_numpy(zero_copy_only=False).astype(np.int32, copy=False), np.diff(ids.offsets.to_numpy())

    def decode_many(self, ids: np.ndarray, off: np.ndarray, together: int = 400) -> list[bytes]:
        """Bytes of many short sequences, decoded some hundred at a time as one and cut by their tokens' lengths."""
        ends = off[::together].tolist()
        if ends[-1] != off[-1]:
            ends.append(int(off[-1]))
        text = b"".join(self.decode([ids[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]))
        at = np.concatenate([[0], np.cumsum(self._size[ids])])[off].tolist()
        return [text[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]

    def decode(self, ids: list[np.ndarray], block: int = 500_000) -> list[bytes]:
        """Bytes per id sequence, in blocks of about ``block`` tokens."""
        out, at = [b""] * len(ids), 0
        while at < len(ids):
            end, n = at, 0
            while end < len(ids) and (end == at or n + len(ids[end]) <= block):
                n += len(ids[end])
                end += 1
            size = np.array([len(x) for x in ids[at:end]])
            if n:
                first = np.repeat(np.cumsum(size) - size, size)
                self._db.register("ids", pa.table({
                    "doc": np.repeat(np.arange(at, end, dtype=np.int32), size), "pos": np.arange(n) - first,
                    "tok": np.concatenate(ids[at:end]).astype(np.int32)}))
                got = self._db.sql(DECODE_SQL).to_arrow_table()
                text = bytes.fromhex("".join(got.column("hex").to_pylist()))
                place = np.concatenate([[0], np.cumsum(pc.utf8_length(got.column("hex")).to_numpy())]) // 2
                for doc, a, b in zip(got.column("doc").to_pylist(), place[:-1].tolist(), place[1:].tolist(), strict=True):
                    out[doc] = text[a:b]
            at = end
        return out


class Chunks(ChunkNumbers):
    """Ids of text chunks and the bytes they decode to, each regex match of a chunk merged separately.

    A match is a chunk too: matched alone it is itself again.
    """

    def __init__(self, queries: BpeQueries, limit: int = 500_000, limit_chars: int = 16 << 20):
        super().__init__(limit, limit_chars)
        self._queries = queries
        empty = pa.array([b""], pa.binary())
        self._ids, self._bytes = empty, empty

    def _matches(self, chunks: list[str], joined: bool) -> tuple[list[str], np.ndarray]:
        """Matches of all chunks, and how many each has; ``joined`` chunks stay apart in one string."""
        find = self._queries.find
        if joined:
            together = find("".join(chunks))
            end = np.cumsum(np.fromiter(map(len, together), np.int64, len(together)))
            ends = np.cumsum(np.fromiter(map(len, chunks), np.int64, len(chunks)))
            last = np.searchsorted(end, ends)
            if len(end) and end[-1] == ends[-1] and (end[last] == ends).all():
                return together, np.diff(last, prepend=-1)
        found = [find(c) for c in chunks]
        return [m for f in found for m in f], np.array([len(f) for f in found], np.int64)

    def _learn(self, chunks: list[str]) -> None:
        words = apart(chunks)
        found = [(part, *self._matches(part, joined)) for joined in (True, False)
                 if (part := [chunks[i] for i in np.flatnonzero(words == joined).tolist()])]
        new = [m for m in dict.fromkeys(m for _, matches, _ in found for m in matches) if m not in self._number]
        if new:
            ids, off = self._queries.merge([m.encode() for m in new])
            self._append(new, _binary(ids.astype("<u4"), 4 * off), pa.array(self._queries.decode_many(ids, off), pa.binary()))
        for part, matches, n in found:
            several = np.array([c not in self._number for c in part], bool)
            if several.any():
                numbers = np.fromiter(map(self._number.__getitem__, matches), np.int64, len(matches))
                at, ends = pa.array(numbers[np.repeat(several, n)]), np.concatenate([[0], np.cumsum(n[several])])
                self._append([part[i] for i in np.flatnonzero(several).tolist()],
                             _strung(self._ids.take(at), ends), _strung(self._bytes.take(at), ends))

    def _append(self, chunks: list[str], ids: pa.Array, raw: pa.Array) -> None:
        self._ids, self._bytes = pa.concat_arrays([self._ids, ids]), pa.concat_arrays([self._bytes, raw])
        self._name(chunks)

    def _kept(self, numbers: np.ndarray) -> None:
        self._ids, self._bytes = self._ids.take(pa.array(numbers)), self._bytes.take(pa.array(numbers))

    def encode(self, texts: pa.Array) -> tuple[pa.Array, pa.Array]:
        """Id bytes per text (null: none), and the bytes they decode to."""
        self.make_room()
        texts = pc.fill_null(texts, "")
        careful = unsafe(texts)
        parts, rows = [], []
        for mask, cut in ((~careful, self.plain), (careful, self.careful)):
            if mask.any():
                numbers, ends = cut(texts.filter(pa.array(mask)))
                at, ends = pa.array(numbers), np.concatenate([[0], ends])
                parts.append((_strung(self._ids.take(at), ends), _strung(self._bytes.take(at), ends)))
                rows.append(np.flatnonzero(mask))
        if not parts:
            return pa.array([], pa.binary()), pa.array([], pa.binary())
        if len(parts) == 1:
            return parts[0]
        order = pa.array(np.argsort(np.concatenate(rows)))
        return tuple(pa.concat_arrays(list(p)).take(order) for p in zip(*parts, strict=True))


def _binary(values: np.ndarray, off: np.ndarray) -> pa.Array:
    """Byte strings that follow each other in ``values``, from one offset to the next."""
    return pa.Array.from_buffers(pa.binary(), len(off) - 1, [None, pa.py_buffer(off.astype(np.int32)), pa.py_buffer(values.tobytes())])


def _strung(parts: pa.Array, ends: np.ndarray) -> pa.Array:
    """Byte strings joined: those from one of ``ends`` to the next are one."""
    off = np.frombuffer(parts.buffers()[1], np.int32, len(parts) + 1, 4 * parts.offset)
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(off[ends]), parts.buffers()[2]])


_QUERIES: dict[tuple[str, str], BpeQueries] = {}


def _queries(path: str, pattern: str) -> BpeQueries:
    """The worker's database for a vocabulary."""
    if (path, pattern) not in _QUERIES:
        _QUERIES[path, pattern] = BpeQueries(path, pattern)
    return _QUERIES[path, pattern]


def _with(df: DataFrame, extra: list[T.StructField]) -> tuple[DataFrame, T.StructType]:
    """``df`` without columns that clash with the added ones, and the schema with them."""
    names = {f.name.lower() for f in extra}
    df = df.select([F.col(f"`{c}`") for c in df.columns if c.lower() not in names])
    return df, T.StructType([*df.schema.fields, *extra])


def encode(df: DataFrame, vocab: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add ``ids array<int>``: each regex match of ``text`` merged by the ranks in ``vocab``."""
    df, schema = _with(df, [T.StructField(ids, T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Chunks(_queries(vocab, pattern))
        for b in slices(batches, text):
            raw = known.encode(b.column(text))[0].to_pylist()
            off = np.concatenate([[0], np.cumsum([len(r) // 4 for r in raw])]).astype(np.int32)
            arr = pa.ListArray.from_arrays(off, pa.array(np.frombuffer(b"".join(raw), dtype="<i4")))
            yield pa.RecordBatch.from_arrays([*b.columns, arr], names=[*b.schema.names, ids])

    return df.mapInArrow(run, schema)


def decode(df: DataFrame, vocab: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add ``decoded binary``: the bytes of ``ids`` (null: empty)."""
    df, schema = _with(df, [T.StructField(out, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            q = _queries(vocab, pattern)
            rows = [np.array([], dtype=np.int32) if x is None else x for x in _lists(b.column(ids))]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(q.decode(rows), pa.binary())],
                                             names=[*b.schema.names, out])

    return df.mapInArrow(run, schema)


def _lists(col: pa.ListArray) -> list[np.ndarray | None]:
    off, flat = col.offsets.to_numpy(), col.values.to_numpy(zero_copy_only=False)
    null = col.is_null().to_numpy(zero_copy_only=False)
    return [None if null[i] else flat[off[i]:off[i + 1]] for i in range(len(col))]


def round_trip(df: DataFrame, vocab: str, pattern: str, text: str = "text") -> DataFrame:
    """Encode and decode in one pass: ``doc_id, n_tokens, ids_sha256, decoded_sha256, exact``.

    Ids are decoded per distinct match, as each was encoded; ``exact`` says
    whether the bytes they give are the text's own.
    """
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, exact boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Chunks(_queries(vocab, pattern))
        for b in slices(batches, "text"):
            ids, decoded = known.encode(b.column("text"))
            raw, back = ids.to_pylist(), decoded.to_pylist()
            texts = pc.fill_null(b.column("text"), "").cast(pa.binary())
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id"),
                pa.array([len(r) // 4 for r in raw], pa.int64()),
                pa.array([hashlib.sha256(r).hexdigest() for r in raw]),
                pa.array([hashlib.sha256(d).hexdigest() for d in back]),
                pc.equal(decoded, texts),
            ], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "exact"])
        del known
        pa.default_memory_pool().release_unused()

    return df.select(F.col("doc_id").cast("long"), F.col(text).alias("text")).mapInArrow(run, schema)


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents`` encoded and decoded with the 50k vocabulary."""
    import public_tokenizers as P

    return round_trip(table(spark, sf_dir, "documents"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
