"""WARC archives with revisit records, and their capture index by external merge.

``write_archives`` writes a WARC 1.1 record per page: the first page (smallest
id) of every payload is a ``response``, pages with an equal payload become
``revisit`` records that name it.  Spark's text writer writes the files, with
the record separator as line separator, so they may lie on any store that Spark
reaches; each file is one gzip member of about ``ARCHIVE_BYTES``.

``capture_runs`` reads the archives back by ``Content-Length`` and leaves one
locally sorted run of captures per file.  ``merge_runs`` is the external merge:
ranges of (URL key, time, id) are dealt out, and each task merges the k run
pieces of its range with a loser tree, so that the written index is globally
ordered, partition after partition.  A URL captured often spreads over ranges,
as time and id belong to the key.

Null html is an empty payload; a null URL has an empty target and key.  Pages
repeated with the same id and payload are all responses or all revisits; a null
id stays null, and counts as the first page only where no page of that payload has
an id.  An empty table gives an empty index.  Extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import table
from tessera.session import scratch_path

ARCHIVE_BYTES = 16 << 20
MIN_REVISIT_BYTES = 0
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: F.Column) -> F.Column:
    """Upper-case base32 of SHA-1: eight groups of five hex digits give four letters each."""
    digest = F.sha1(payload)
    letters = []
    for g in range(8):
        bits = F.conv(F.substring(digest, 5 * g + 1, 5), 16, 10).cast("int")
        letters += [F.substring(F.lit(BASE32), F.shiftright(bits, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*letters)


def records(pages: DataFrame, min_revisit_bytes: int = MIN_REVISIT_BYTES, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """One WARC record as text per row of ``pages(page_id, url, html)``, dealt out for files of ``archive_bytes``."""
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"),
                         F.coalesce("html", F.lit("")).alias("html"))
    size = F.octet_length("html").cast("long")
    total = pages.agg(F.sum(size + 1000)).first()[0] or 0
    files = max(1, -(-total // archive_bytes))
    full = pages.select("page_id", "url", "html", base32_sha1(F.col("html").cast("binary")).alias("digest"), size.alias("size"))
    keys = full.filter(size >= min_revisit_bytes).groupBy("digest", "page_id").agg(F.count("*").alias("n"))
    first = keys.groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("ids")).filter("ids > 1")
    revisits = (keys.join(first, "digest").filter(~F.col("page_id").eqNullSafe(F.col("first_id")))
                .select("digest", "page_id", "first_id"))
    at = ["name", "digest"]  # a name is never null, so the join keeps to this partitioning
    name = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    a, b = (x.withColumn("name", name).repartition(files, *at).alias(y) for x, y in ((full, "a"), (revisits, "b")))
    both = a.join(b, (F.col("a.name") == F.col("b.name")) & (F.col("a.digest") == F.col("b.digest")), "left")
    is_revisit = F.col("b.first_id").isNotNull()
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    F.col("a.size").cast("string"), F.lit(CRLF + CRLF))
    body = F.when(is_revisit, F.lit("")).otherwise(F.col("a.html"))
    pid = F.coalesce(F.col("a.page_id").cast("string"), F.lit(""))
    url = F.regexp_replace(F.regexp_replace("a.url", "\r", "%0D"), "\n", "%0A")
    date = F.date_format(F.timestamp_seconds(F.coalesce(F.pmod("a.page_id", F.lit(250_000_000_000)), F.lit(0))),
                         "yyyy-MM-dd'T'HH:mm:ss'Z'")
    head = F.concat(
        F.lit(f"WARC/1.1{CRLF}WARC-Type: "), F.when(is_revisit, "revisit").otherwise("response"),
        F.lit(f"{CRLF}WARC-Record-ID: <urn:page:"), pid, F.lit(f">{CRLF}WARC-Date: "), date,
        F.lit(f"{CRLF}WARC-Target-URI: "), url, F.lit(f"{CRLF}WARC-Payload-Digest: sha1:"), F.col("a.digest"),
        F.when(is_revisit, F.concat(F.lit(f"{CRLF}WARC-Profile: {PROFILE}{CRLF}WARC-Refers-To: <urn:page:"),
                                    F.col("b.first_id").cast("string"), F.lit(">"))).otherwise(""),
        F.lit(f"{CRLF}Content-Type: application/http; msgtype=response{CRLF}Content-Length: "),
        (F.octet_length(http) + F.octet_length(body)).cast("string"), F.lit(CRLF + CRLF))
    return both.select(F.concat(head, http, body).alias("value"))


def write_archives(pages: DataFrame, path: str, **options) -> None:
    """Write the records of ``pages`` as gzip WARC files."""
    records(pages, **options).write.option("lineSep", CRLF + CRLF).option("compression", "gzip").text(path)


def _headers(block: bytes) -> dict[str, str]:
    lines = block.decode().split(CRLF)[1:]
    return {k.lower(): v for k, _, v in (x.partition(": ") for x in lines)}


def parse(data: bytes) -> Iterator[tuple[int, dict[str, str], dict[str, str], memoryview]]:
    """Offset, WARC headers, HTTP headers and payload of every record of an unpacked archive."""
    view, at = memoryview(data), 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        head = _headers(data[at:end])
        first, size = end + 4, int(head["content-length"])
        split = data.index(b"\r\n\r\n", first)
        yield at, head, _headers(data[first:split]), view[split + 4:first + size]
        at = first + size + 4


def url_key(url: str) -> str:
    """Host labels from the right, then the path, in lower case and without scheme, ``www.`` and fragment."""
    rest = url.lower().partition("://")[2] or url.lower()
    host, slash, path = rest.partition("#")[0].partition("/")
    host = host.removeprefix("www.").partition(":")[0]
    return ",".join(reversed(host.split("."))) + ")" + slash + path


CAPTURE = ("url_key string, captured string, page_id long, url string, record_type string, payload_digest string, "
           "payload_bytes long, refers_to long, archive string, position long, run int, place int")
_KINDS = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(),
          pa.string(), pa.int64(), pa.int32(), pa.int32()]
_NAMES = [x.split()[0] for x in CAPTURE.split(", ")]


def _key(c: tuple) -> tuple:
    return c[0], c[1], -1 << 63 if c[2] is None else c[2], c[8], c[9]


def _page(urn: str) -> int | None:
    number = urn.strip("<>").rpartition(":")[2]
    return int(number) if number else None


def capture_runs(spark: SparkSession, path: str) -> DataFrame:
    """The captures of every archive below ``path``, sorted within the archive (``run``, ``place``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file, number, data in zip(b.column("file").to_pylist(), b.column("run").to_pylist(), b.column("content"), strict=True):
                raw, found = zlib.decompress(data.as_py(), 31), []
                for at, head, http, payload in parse(raw):
                    kind, url = head["warc-type"], head["warc-target-uri"]
                    digest = head["warc-payload-digest"].removeprefix("sha1:")
                    if kind == "response" and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                        raise ValueError(f"payload of the record at {at} in {file} does not match its digest")
                    size = len(payload) if kind == "response" else int(http["content-length"])
                    refers = _page(head["warc-refers-to"]) if kind == "revisit" else None
                    found.append((url_key(url), head["warc-date"], _page(head["warc-record-id"]), url, kind, digest,
                                  size, refers, file, at))
                found.sort(key=_key)
                rows = [(*c, number, i) for i, c in enumerate(found)]
                cols = list(zip(*rows, strict=True)) or [[]] * len(_NAMES)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, _KINDS, strict=True)], names=_NAMES)

    files = (spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
             .filter(F.col("length") > 0)
             .select(F.regexp_extract("path", r"[^/]+$", 0).alias("file"),
                     F.regexp_extract("path", r"part-(\d+)", 1).cast("int").alias("run"), "content"))
    return files.mapInArrow(run, CAPTURE)


class LoserTree:
    """Merges k sorted iterators of ``(key, value)``: inner nodes hold losers, each step replays one path."""

    _END = None

    def __init__(self, runs: list[Iterator[tuple]]):
        self._runs = runs
        self._k = len(runs)
        self._heads = [next(r, self._END) for r in runs]
        self._losers = [-1] * max(1, self._k)
        for i in range(self._k):
            self._replay(i, building=True)

    def _before(self, a: int, b: int) -> bool:
        x, y = self._heads[a], self._heads[b]
        if x is self._END or y is self._END:
            return y is self._END and (x is not self._END or a < b)
        return (x[0], a) < (y[0], b)

    def _replay(self, winner: int, building: bool = False) -> None:
        node = (winner + self._k) // 2
        while node > 0:
            other = self._losers[node]
            if other < 0 and building:
                self._losers[node] = winner
                return
            if self._before(other, winner):
                self._losers[node], winner = winner, other
            node //= 2
        self._losers[0] = winner

    def __iter__(self) -> Iterator:
        while self._k:
            w = self._losers[0]
            if self._heads[w] is self._END:
                return
            yield self._heads[w][1]
            self._heads[w] = next(self._runs[w], self._END)
            self._replay(w)


def merge_runs(runs: DataFrame, ranges: int) -> DataFrame:
    """All captures in order of URL key, time and id: each partition merges its pieces of the runs."""
    order = [F.col("url_key"), F.col("captured"), F.col("page_id").asc_nulls_first(), F.col("archive"), F.col("position")]
    dealt = runs.repartitionByRange(ranges, *order).sortWithinPartitions("run", "place")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces: dict[int, list[tuple]] = {}
        for b in batches:
            for row in zip(*(b.column(n).to_pylist() for n in _NAMES), strict=True):
                pieces.setdefault(row[10], []).append((_key(row), row))
        out: list[tuple] = []
        for row in LoserTree([iter(p) for p in pieces.values()]):
            out.append(row)
            if len(out) == 20_000:
                yield _batch(out)
                out = []
        if out:
            yield _batch(out)

    return dealt.mapInArrow(merge, CAPTURE)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), _KINDS, strict=True)], names=_NAMES)


def capture_index(spark: SparkSession, archives: str, out: str) -> DataFrame:
    """Write the runs and the merged index of ``archives`` below ``out``; the index, in order of its files."""
    capture_runs(spark, archives).write.parquet(f"{out}/runs")
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    merge_runs(spark.read.schema(CAPTURE).parquet(f"{out}/runs"), ranges).write.parquet(f"{out}/index")
    return spark.read.schema(CAPTURE).parquet(f"{out}/index")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pages`` written as archives, read back and indexed."""
    path = scratch_path(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), f"{path}/archives")
    return capture_index(spark, f"{path}/archives", path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
