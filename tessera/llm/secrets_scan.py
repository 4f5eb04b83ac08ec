"""Secrets by fixed forms, and by structure that decoding confirms.

Base spans are assignments of secret-like names, access key ids and long hex
runs by their regular forms (leftmost, non-overlapping per kind; a match that
fails its length is dropped).  Three more kinds are reported only after
structural confirmation:

* ``key``: a private key.  Base64 (either alphabet, also over wrapped lines) and
  hex runs are decoded and searched for DER: a sequence whose nested lengths add
  up and whose members are those of a PKCS#1, SEC 1, DSA, PKCS#8 or encrypted
  PKCS#8 key; or an OpenSSH key, whose length-prefixed fields must fit.  The span
  ends where the outer length says.  An armor (``BEGIN ... PRIVATE KEY``) is
  reported whole where its body confirms it, or where it declares a cipher and
  holds whole cipher blocks.
* ``token``: a signed token, ``header.payload.signature`` in base64url: the
  header is a JSON object that names an algorithm, the payload a JSON object,
  and the signature has the algorithm's length; or an encrypted one of five
  parts.  It begins where its run of characters does.
* ``wrapped``: a base64 or hex run that decodes to printable text with any of
  the above but a bare hex run in it, however often it is wrapped (each decoding
  is shorter).

Spans of one added kind never overlap: the first, and of those the longest,
stays.  Each text is answered by itself in one narrow pass, in time
proportional to its length but for the keys it holds.  Null and empty texts
have no spans.  Rows may repeat; a null ``doc_id`` is kept; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import slices, table

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "key", "token", "wrapped")
ASSIGN, ACCESS, HEX, KEY, TOKEN, WRAPPED = range(6)

_ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
_NAMES = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
#: Runs that may decode to something: wrapped lines go on where a line is full.
_RUN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+(?:(?:\r?\n|\\n)[A-Za-z0-9+/_-]{4,}+)*+={0,2}")
_HEX_RUN = re.compile(r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{32,}+")
_BREAK = re.compile(r"\r?\n|\\n")
_DOTTED = re.compile(r"(?<![A-Za-z0-9_.-])[A-Za-z0-9_-]++(?:\.[A-Za-z0-9_-]*+){2,}+")
_ARMOR = re.compile(r"-----BEGIN ((?:[A-Z0-9]+ )*)PRIVATE KEY-----")
_CIPHER = re.compile(r"DEK-Info: *([A-Z0-9-]+),")
_PRINTABLE = re.compile(rb"[\t\n\r\x20-\x7E]+")
#: A DER sequence that begins with a small version number or another sequence.
_DER = re.compile(rb"\x30(?:[\x08-\x7F]|\x81.|\x82..|\x83...)(?=\x02\x01[\x00-\x03]|\x30)", re.DOTALL)
_OPENSSH = b"openssh-key-v1\x00"
#: Signature bytes by algorithm of a signed token.
SIGNATURE = {"HS256": 32, "HS384": 48, "HS512": 64, "ES256": 64, "ES256K": 64, "ES384": 96, "ES512": 132, "EdDSA": (64, 114), "none": 0}
#: Characters of the base64 alphabets, as byte classes.
_CLASS = np.zeros(256, bool)
_CLASS[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-")] = True
SHORTEST = 16

Span = tuple[int, int, int]


def _named(raw: bytes) -> bool:
    """Whether a text holds a secret-like name."""
    low = raw.lower()
    return any(n in low for n in _NAMES)


def base_spans(text: str) -> list[Span]:
    """``(start, kind, end)`` of the three fixed forms."""
    out = []
    if _named(text.encode()):
        out += [(m.start(), ASSIGN, m.end()) for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 8]
    if "AKIA" in text:
        out += [(m.start(), ACCESS, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(m.start(), HEX, m.end()) for m in _HEX.finditer(text)]
    return out


# DER and OpenSSH structures

def _header(b: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """Tag, first content byte and end of the element at ``at``, if it fits before ``end``."""
    if at + 2 > end:
        return None
    tag, n = b[at], b[at + 1]
    at += 2
    if n >= 0x80:
        size = n & 0x7F
        if not 1 <= size <= 4 or at + size > end:
            return None
        n = int.from_bytes(b[at:at + size], "big")
        at += size
    return (tag, at, at + n) if at + n <= end else None


def _members(b: bytes, at: int, end: int, limit: int = 16) -> list[tuple[int, int, int]] | None:
    """The elements that fill ``[at, end)``, or None where lengths do not add up."""
    out = []
    while at < end:
        e = _header(b, at, end)
        if e is None or len(out) == limit:
            return None
        out.append(e)
        at = e[2]
    return out


def _algorithm(b: bytes, e: tuple[int, int, int]) -> bool:
    """Whether an element is a sequence that begins with an object id."""
    inner = _members(b, e[1], e[2]) if e[0] == 0x30 else None
    return bool(inner) and inner[0][0] == 0x06 and 3 <= inner[0][2] - inner[0][1] <= 16


def key_der(b: bytes, at: int) -> int | None:
    """End of the DER private key that begins at ``at``."""
    outer = _header(b, at, len(b))
    if outer is None or outer[0] != 0x30:
        return None
    m = _members(b, outer[1], outer[2])
    if not m or len(m) < 2:
        return None
    tags = [e[0] for e in m]
    size = [e[2] - e[1] for e in m]
    version = b[m[0][1]] if tags[0] == 0x02 and size[0] == 1 else None
    rsa = version in (0, 1) and len(m) >= 9 and set(tags[:9]) == {0x02} and size[1] >= 32 and size[3] * 2 > size[1]
    dsa = version == 0 and len(m) == 6 and set(tags) == {0x02} and size[1] >= 32
    ec = version == 1 and tags[1] == 0x04 and 16 <= size[1] <= 80 and set(tags[2:]) <= {0xA0, 0xA1}
    pkcs8 = version in (0, 1) and len(m) >= 3 and _algorithm(b, m[1]) and tags[2] == 0x04 and size[2] >= 16 and set(tags[3:]) <= {0xA0, 0xA1, 0x81}
    sealed = tags == [0x30, 0x04] and _algorithm(b, m[0]) and size[1] >= 32 and size[1] % 8 == 0
    return outer[2] if rsa or dsa or ec or pkcs8 or sealed else None


def key_openssh(b: bytes, at: int) -> int | None:
    """End of the OpenSSH private key that begins at ``at``: every field's length must fit."""
    if not b.startswith(_OPENSSH, at):
        return None
    at += len(_OPENSSH)

    def field() -> bytes | None:
        nonlocal at
        n = int.from_bytes(b[at:at + 4], "big")
        if at + 4 + n > len(b):
            return None
        at += 4 + n
        return b[at - n:at]

    cipher, kdf, options = field(), field(), field()
    if not cipher or not kdf or options is None or at + 4 > len(b):
        return None
    keys = int.from_bytes(b[at:at + 4], "big")
    at += 4
    if not 1 <= keys <= 16 or not all(field() for _ in range(keys)):
        return None
    private = field()
    if not private or len(private) % 8:
        return None
    return at if cipher != b"none" or private[:4] == private[4:8] else None


def _keys(b: bytes, step: int) -> Iterator[tuple[int, int]]:
    """Byte ranges of the private keys in decoded bytes that begin at a multiple of ``step``."""
    done = 0
    starts = sorted([m.start() for m in _DER.finditer(b)] + [m.start() for m in re.finditer(re.escape(_OPENSSH), b)])
    for at in starts:
        if at >= done and at % step == 0:
            end = key_der(b, at) or key_openssh(b, at)
            if end:
                yield at, end
                done = end


# Runs of characters

def _decode64(run: str) -> bytes:
    """Bytes of a base64 run of either alphabet, without its last characters if they make no byte."""
    run = run.rstrip("=").replace("-", "+").replace("_", "/")
    if len(run) % 4 == 1:
        run = run[:-1]
    return binascii.a2b_base64(run + "=" * (-len(run) % 4))


def _text_of(b: bytes) -> str | None:
    return b.decode("ascii") if _PRINTABLE.fullmatch(b) else None


def _runs(text: str) -> Iterator[Span]:
    for m in _RUN.finditer(text):
        raw = m.group()
        parts, breaks = [], [0]  # lines of the run and where each begins in it
        for br in _BREAK.finditer(raw):
            parts.append(raw[breaks[-1]:br.start()])
            breaks.append(br.end())
        parts.append(raw[breaks[-1]:])
        sizes = np.cumsum([len(p) for p in parts])
        joined = "".join(parts).rstrip("=")

        def place(i: int, last: bool = False) -> int:
            """Where character ``i`` of the joined run stands in the text."""
            line = int(np.searchsorted(sizes, i, side="left" if last else "right"))
            return m.start() + breaks[line] + i - (int(sizes[line - 1]) if line else 0)

        for shift in range(4):
            b = _decode64(joined[shift:])
            for start, end in _keys(b, 3):
                first, last = shift + start // 3 * 4, min(len(joined), shift + -(-end // 3) * 4)
                last -= {1: 2, 2: 1, 0: 0}[end % 3] if last == shift + -(-end // 3) * 4 else 0
                stop = place(last, True)
                while end % 3 and text[stop:stop + 1] == "=" and stop < m.end():
                    stop += 1
                yield place(first), KEY, stop
        if _text_of(_decode64(joined)):
            yield from _unwrapped(_decode64(joined), m.start(), m.end())
        elif len(parts) > 1:  # lines that belong to nothing longer
            for part, at in zip(parts, breaks, strict=True):
                yield from _unwrapped(_decode64(part), m.start() + at, m.start() + at + len(part))
    for m in _HEX_RUN.finditer(text):
        raw = m.group()
        for shift in range(2):
            b = bytes.fromhex(raw[shift:len(raw) - (len(raw) - shift) % 2])
            for start, end in _keys(b, 1):
                yield m.start() + shift + 2 * start, KEY, m.start() + shift + 2 * end
        yield from _unwrapped(bytes.fromhex(raw[:len(raw) // 2 * 2]), m.start(), m.end())


def _unwrapped(b: bytes, start: int, end: int) -> Iterator[Span]:
    """The run itself, where it decodes to text that holds a secret."""
    inner = _text_of(b)
    if inner and any(kind != HEX for _, kind, _ in find_spans(inner)):
        yield start, WRAPPED, end


def _object(part: str) -> dict | None:
    """The JSON object in a base64url part."""
    if len(part) % 4 == 1:
        return None
    try:
        got = json.loads(base64.urlsafe_b64decode(part + "=" * (-len(part) % 4)))
    except (ValueError, RecursionError):
        return None
    return got if isinstance(got, dict) else None


def _signed(header: dict, signature: str) -> bool:
    """Whether a signature has the length that the header's algorithm gives it."""
    alg, n = header.get("alg"), len(signature) * 6 // 8
    if not isinstance(alg, str) or len(signature) % 4 == 1:
        return False
    if alg[:2] in ("RS", "PS"):
        return n in (128, 256, 384, 512, 1024)
    want = SIGNATURE.get(alg)
    return n == want if isinstance(want, int) else n in want if want else n >= 16


def _tokens(text: str) -> Iterator[Span]:
    for m in _DOTTED.finditer(text):
        parts = m.group().split(".")
        at, k = m.start(), 0
        while k + 2 < len(parts):
            n = 0
            if parts[k][:2] in ("ey", "ew") and (header := _object(parts[k])) is not None:
                if _object(parts[k + 1]) is not None and _signed(header, parts[k + 2]):
                    n = 3
                elif isinstance(header.get("alg"), str) and isinstance(header.get("enc"), str) and len(parts) - k >= 5 and all(parts[k + 2:k + 5]):
                    n = 5
            size = sum(len(p) + 1 for p in parts[k:k + max(n, 1)])
            if n:
                yield at, TOKEN, at + size - 1
            at, k = at + size, k + max(n, 1)


def _armors(text: str) -> Iterator[Span]:
    for m in _ARMOR.finditer(text):
        foot = f"-----END {m.group(1)}PRIVATE KEY-----"
        following = text.find("-----BEGIN ", m.end())
        end = text.find(foot, m.end(), following if following >= 0 else len(text))
        if end < 0:
            continue
        body = text[m.end():end]
        cipher = _CIPHER.search(body)
        raw = "".join(x for x in re.split(r"\s|\\r|\\n", body) if ":" not in x and "," not in x)  # without the header lines
        if not re.fullmatch(r"[A-Za-z0-9+/]+={0,2}", raw):
            continue
        b = _decode64(raw)
        if cipher:
            confirmed = len(b) >= 16 and len(b) % (16 if "AES" in cipher.group(1) else 8) == 0
        else:
            confirmed = (key_der(b, 0) or key_openssh(b, 0)) == len(b)
        if confirmed:
            yield m.start(), KEY, end + len(foot)


def _apart(spans: list[Span]) -> list[Span]:
    """Of the overlapping spans of one kind the first, and of those the longest."""
    out, end = [], [0] * len(KINDS)
    for start, kind, stop in sorted(spans, key=lambda s: (s[0], -s[2])):
        if start >= end[kind]:
            out.append((start, kind, stop))
            end[kind] = stop
    return out


def find_spans(text: str) -> list[Span]:
    """All spans of a text by start, then kind."""
    added = _apart([*_armors(text), *_runs(text), *_tokens(text)])
    return sorted(base_spans(text) + added)


def _may_hold(texts: list[str | None]) -> np.ndarray:
    """Which texts have a secret-like name or a run that is long enough for anything."""
    raw = [(t or "").encode() for t in texts]
    flat = np.frombuffer(b"\n".join([*raw, b""]), np.uint8)
    edge = np.diff(np.concatenate([[False], _CLASS[flat], [False]]).astype(np.int8))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    row = np.searchsorted(np.cumsum([len(r) + 1 for r in raw]), start[end - start >= SHORTEST], side="right")
    out = np.zeros(len(raw), bool)
    out[row] = True
    return out | np.array([_named(r) for r in raw], bool)


_SPANS = "array<struct<start:int,kind:int,end:int>>"
_ARROW = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))


def find(docs: DataFrame) -> DataFrame:
    """``doc_id, spans`` per row of ``docs(doc_id, text)``, by start and then kind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            texts = b.column("text").to_pylist()
            found = [[dict(zip(("start", "kind", "end"), s, strict=True)) for s in find_spans(t)] if ok else []
                     for t, ok in zip(texts, _may_hold(texts), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(found, _ARROW)], names=["doc_id", "spans"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, f"doc_id long, spans {_SPANS}")


def _text(spans: F.Column) -> F.Column:
    """``kind:start:end`` joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _of(kind: int):
    return lambda s: s["kind"] == kind


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every text of ``documents``."""
    got = find(table(spark, sf_dir, "documents"))
    counts = [F.size(F.filter("spans", _of(k))).cast("long").alias(f"n_{name}") for k, name in enumerate(BASE)]
    base = F.filter("spans", lambda s: s["kind"] < len(BASE))
    return got.select("doc_id", *counts, F.sha2(_text(base), 256).alias("base_sha256"), _text(F.col("spans")).alias("spans"))
