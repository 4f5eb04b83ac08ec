"""Every registered corpus query over one folder of small tables with odd rows, and over empty ones.

Queries with SQL are held against it in DuckDB, the others against plain Python.
"""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers as P
import pytest

import __spark_entry__ as E
from tessera.llm.queries import QUERIES, SQL

TABLES = {
    "documents": "doc_id long, text string, lang string, source string, n_chars long, n_removed string, spans int, rank int, score string",
    "labels": "doc_id long, quality int, toxic int",
    "benchmark": "item_id long, text string",
    "embeddings": "vec_id long, embedding array<float>, label int",
    "pages": "page_id long, url string, html string",
}


def tables():
    rng = random.Random(21)
    words = ["".join(rng.choice("aeiou") + rng.choice("lmnrst") for _ in range(3)) for _ in range(150)]
    private = ["jane.doe+x@mail.example.org", "10.2.33.255", "256.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (569) 555-7279", "+12 34",
               "a@b", "1.2.3.4.5", "token = \"f32ab9ba2834a0d390df92664b1272635dbc0ec6\"", "call +44 20 7946 0958 or mail x@y.co.uk,", "0000 0000 0000 00"]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([0, 4, 14, 25])))) for i in range(12)] + [(12, None)]
    docs = []
    for i in range(150):
        t = [rng.choice(words) for _ in range(rng.randint(0, 70))]
        for _ in range(rng.choice([0, 0, 1, 3])):
            t.insert(rng.randint(0, len(t)), rng.choice(private))
        if i % 9 == 0:
            t.insert(0, "scoundrel")
        if i % 13 == 0:
            t += (items[i % 12][1] or "").upper().split()
        docs.append((i, "".join(w + rng.choice(["  ", " ", " ", " ", "\n"]) for w in t)))
    docs += [(200 + i, docs[i][1]) for i in range(25)] + [(300 + i, docs[i][1] + " tail") for i in range(10)]
    docs += [(400, None), (401, ""), (402, " \n "), (403, " ".join(words) * 40), (404, "é" * 3000), (405, "hello <|endoftext|> world")]
    vecs = [(i, [rng.choice([-1.0, -0.25, 0.5, 1.0]) for _ in range(64)], 0) for i in range(150)]
    vecs += [(200 + i, vecs[i][1], 0) for i in range(20)] + [(300, None, 1), (301, [1.0, None], 1), (302, [float("nan")] * 64, 1)]
    pages = [(i, f"http://h{i % 5}.example/{i % 40}", rng.choice([None, "", "<p>same</p>", f"<p>{i}</p>", "<b>é</b>"])) for i in range(120)]
    rows = [(i, t, rng.choice(["en", None]), None, None if t is None else len(t), "clash", 1, 2, "clash") for i, t in docs]
    return {"documents": rows, "labels": [(i, 1, int(i % 9 == 0)) for i in range(150)] + [(None, 1, 1), (3, 1, None)],
            "benchmark": items, "embeddings": vecs, "pages": pages}


def written(spark, folder, rows):
    for name, schema in TABLES.items():
        spark.createDataFrame(rows[name], schema).repartition(3).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    return written(spark, tmp_path_factory.mktemp("sf"), tables())


@pytest.fixture(scope="module")
def texts():
    return {r[0]: r[1] or "" for r in tables()["documents"]}


def test_entry_registers_all(sf):
    assert set(QUERIES) <= set(E.queries()) and set(SQL) <= set(E.oracle_sql())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, sf, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet/*.parquet')")
    got = QUERIES[name](spark, sf)
    want = con.execute(SQL[name])
    columns = [d[0] for d in want.description]
    assert sorted(columns) == sorted(got.columns)
    assert Counter(map(tuple, got.select(columns).collect())) == Counter(want.fetchall())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables_give_no_rows(spark, tmp_path, name):
    folder = written(spark, tmp_path, {t: [] for t in TABLES})
    assert QUERIES[name](spark, folder).collect() == []


def test_op1_digests_are_of_the_texts_left(spark, sf):
    from tessera.llm import line_dedup

    out = line_dedup.dedup_lines(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")).collect()
    want = {r.doc_id: (r.n_lines, r.n_removed, hashlib.sha256((r.text or "").encode()).hexdigest()) for r in out}
    got = {r.doc_id: (r.n_lines, r.n_removed, r.kept_sha256) for r in QUERIES["op1_line_dedup"](spark, sf).collect()}
    assert got == want and sum(r.n_removed for r in out) > 20


def test_op3_equals_the_library(spark, sf, texts):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    start, want = 0, {}
    for i in sorted(texts):
        ids = [*tok.encode(texts[i], add_special_tokens=False).ids, 0]
        want[i] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert {r.doc_id: tuple(r)[1:4] for r in QUERIES["op3_token_output"](spark, sf).collect()} == want


def plain_private(text):
    """The contract's four forms, as they stand there."""
    def luhn(d):
        return sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(d))) % 10 == 0

    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[ -]", "", m.group())
        if 14 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return sorted(out)


def test_op4_counts_and_digests_of_base_spans(spark, sf, texts):
    kinds = ("email", "ip", "card", "phone")
    totals = Counter()
    for r in QUERIES["op4_pii"](spark, sf).collect():
        base = plain_private(texts[r.doc_id])
        counts = tuple(sum(s[1] == k for s in base) for k in range(4))
        totals.update(dict(enumerate(counts)))
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == counts, texts[r.doc_id]
        said = [f"{kinds[k]}:{a}:{e}" for a, k, e in base]
        assert r.base_sha256 == hashlib.sha256(",".join(said).encode()).hexdigest()
        assert set(said) <= set(r.spans.split(",")) | ({""} if not said else set())
    assert len(set(totals.values())) > 1 and min(totals.values()) > 3


def test_op5_equals_brute_force(spark, sf, texts):
    seen, want = {}, {}
    for i in sorted(texts):
        b = texts[i].encode()
        gone = bytearray(len(b))
        for p in range(len(b) - 49):
            if seen.setdefault(b[p:p + 50], i) < i:
                gone[p:p + 50] = b"\1" * 50
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        runs = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        want[i] = (len(b), len(b) - len(kept), runs, hashlib.sha256(kept).hexdigest())
    assert {r.doc_id: tuple(r)[1:5] for r in QUERIES["op5_suffix_dedup"](spark, sf).collect()} == want


def test_op6_rows(spark, sf, texts):
    rows = QUERIES["op6_toxicity"](spark, sf).collect()
    assert {r.doc_id for r in rows} == set(texts) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    assert all(r.predicted == int(r.doc_id % 9 == 0) for r in rows if r.doc_id < 150)


def test_op8_digests(spark, sf, texts):
    rows = QUERIES["op8_byte_bpe"](spark, sf).collect()
    assert {r.doc_id: r.decoded_sha256 for r in rows} == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in texts.items()}


def test_op10_records(spark, sf):
    first, want = {}, {}
    for i, _, html in tables()["pages"]:
        b = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(b).digest()).decode()
        at = first.setdefault(b, i)
        want[i] = (len(b), digest, "response" if at == i else "revisit", None if at == i else at)
    assert {r.page_id: tuple(r)[1:5] for r in QUERIES["op10_warc"](spark, sf).collect()} == want


def test_op12_rows(spark, sf, texts):
    from tessera.llm import secrets_scan

    for r in QUERIES["op12_secret_scan"](spark, sf).collect():
        spans = secrets_scan.find_spans(texts[r.doc_id])
        assert r.spans == ",".join(f"{secrets_scan.KINDS[k]}:{a}:{e}" for a, k, e in spans)
