"""Tokens, decontamination, personal data, toxicity, top-k and archives on small fixtures."""

import base64
import hashlib
import random
import re
import time
import zlib

import numpy as np
import public_tokenizers as P
import pytest

from tessera.llm import bpe, decontaminate, pii, token_output, topk, toxicity, warc
from tessera.session import scratch_path

SCHEMA = "doc_id long, text string, score string, ids string"
ODD = ["a  b   c \n d\n e\n\n  f  ", "  x", " ", "", "\n \n", "a \n", "don't  'll 12 ３ ²", "a\x1c b \x1c c", "<|endoftext|> x",
       "é" * 3000, "word " * 4000, "naïve café   x", None]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(4)
    more = ["".join(rng.choice("ab é\n\t1.,'#") for _ in range(rng.randint(0, 80))) for _ in range(150)]
    return [(i if i != 7 else None, t, "clash", "clash") for i, t in enumerate(ODD + more + more[:5])]


def test_bpe_equals_tiktoken_and_round_trips(spark, texts):
    import tiktoken

    path = P.path("byte_bpe_50k.tiktoken")
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    got = bpe.round_trip(spark.createDataFrame(texts, SCHEMA), path, P.PATTERN).collect()
    want = []
    for i, t, _, _ in texts:
        raw = np.array(enc.encode_ordinary(t or ""), dtype="<u4").tobytes()
        want.append((i, len(raw) // 4, hashlib.sha256(raw).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest(), True))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_bpe_of_long_matches(spark):
    """Single matches of up to 200,000 letters, with and without repeats, in seconds."""
    import tiktoken

    rng = random.Random(8)
    path = P.path("byte_bpe_50k.tiktoken")
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    words = ["a" * 200_000, "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=200_000)), "aab" * 3000, "the" * 4000, "ab" * 700 + "the" * 50,
             "\u4e2d\u6587\u5b57" * 4000, "=" * 5000, "\n" * 5000, *("".join(rng.choices(a, k=rng.randint(60, 300))) for a in ("ab", "the", "etaoin") * 20)]
    queries = bpe.BpeQueries(path, P.PATTERN)
    start = time.time()
    ids, off = queries.merge([w.encode() for w in words])
    assert time.time() - start < 60
    for w, a, b in zip(words, off[:-1], off[1:], strict=True):
        assert ids[a:b].tolist() == enc.encode_ordinary(w), w[:20]
    assert queries.decode_many(ids, off, 7) == [w.encode() for w in words]
    assert queries.merge([])[1].tolist() == [0] and queries.merge([b"", b"a", b""])[1].tolist() == [0, 0, 1, 1]


def test_bpe_query_rows(spark, texts):
    path = scratch_path(spark, "bpe")
    spark.createDataFrame(texts, SCHEMA).write.parquet(f"{path}/documents.parquet")
    rows = bpe.op8_byte_bpe(spark, path).collect()
    digest = sorted((r.doc_id or -1, r.decoded_sha256) for r in rows)
    assert digest == sorted((i or -1, hashlib.sha256((t or "").encode()).hexdigest()) for i, t, _, _ in texts)


def test_bpe_encode_then_decode_columns(spark, texts):
    path = P.path("byte_bpe_50k.tiktoken")
    df = bpe.encode(spark.createDataFrame(texts[:60], SCHEMA), path, P.PATTERN)
    assert df.columns == ["doc_id", "text", "score", "ids"]
    for r in bpe.decode(df, path, P.PATTERN).collect():
        assert bytes(r.decoded) == (r.text or "").encode()
    assert bpe.encode(spark.createDataFrame([], SCHEMA), path, P.PATTERN).count() == 0


def test_token_files(spark, texts, tmp_path):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))  # as the contract calls it
    token_output.write_tokens(spark.createDataFrame(texts, SCHEMA), str(tmp_path / "t"), P.path("byte_bpe_50k.json"), files=5)
    rows = token_output.positions(spark, str(tmp_path / "t")).collect()
    start = 0
    order = sorted(texts, key=lambda d: (d[0] is not None, d[0] or 0))
    want = []
    for i, t, _, _ in order:
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 0]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, rows), key=lambda r: r[1]) == want
    some = token_output.read_tokens(spark, str(tmp_path / "t"), [3, 5])
    assert {r.doc_id for r in some.collect()} == {3, 5}
    assert "PushedFilters: [In(doc_id" in some._jdf.queryExecution().toString()
    token_output.write_tokens(spark.createDataFrame([], SCHEMA), str(tmp_path / "e"), P.path("byte_bpe_50k.json"))
    assert token_output.positions(spark, str(tmp_path / "e")).count() == 0


def test_chunks_encode_as_whole_texts():
    from tokenizers import Tokenizer

    import pyarrow as pa

    rng = random.Random(12)
    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    pieces = ["a", "word", "é", "'s", "'", " ", "  ", "\n", "\t", "\u00a0", "\u2003", "\x1c", "\x85", "\x0b", "12", "<|endoftext|>", "<|", ".", "don't", "\u4e2d", "x" * 50]
    texts = ["".join(rng.choices(pieces, [3, 3, 1, 1, 1, 9, 1, 1, 1, .3, .3, .2, .2, .2, 1, .2, .3, 1, 1, 1, .2], k=rng.randint(0, 25))) for _ in range(3000)]
    texts += ["hello <|endoftext|> world", "a  <|endoftext|>", " lead", "", "plain words only here " * 300]
    own = token_output.Interned(P.path("byte_bpe_50k.json"), limit=200)  # forgets often
    for at in range(0, len(texts), 500):
        part = texts[at:at + 500]
        for t, ids in zip(part, own.encode(pa.array(part)), strict=True):
            assert ids.tolist() == tok.encode(t, add_special_tokens=False).ids, t
    assert [x.tolist() for x in own.encode(pa.array([None, "hello <|endoftext|> world"], pa.string()))] == [[], [31373, 220, 50256, 995]]


def test_chunks_in_use_are_kept_when_others_are_forgotten():
    import pyarrow as pa

    own = token_output.Interned(P.path("byte_bpe_50k.json"), limit=40)
    for i in range(20):
        own.encode(pa.array(["lead often used words " + " ".join(f"rare{i}x{j}" for j in range(15))]))
        assert {"", "lead", " often", " used", " words"} <= set(own._number) and len(own._number) <= 60


def test_chunks_that_are_known_are_looked_up_once():
    import pyarrow as pa

    class Counted(dict):
        gets = 0

        def get(self, *a):
            self.gets += 1
            return dict.get(self, *a)

    x = token_output.Interned(P.path("byte_bpe_50k.json"))
    x._number = Counted(x._number)
    numbers, ends = x.plain(pa.array(["one two  three", "four \nfive two", "one\u00a0 x"]))
    assert x._number.gets == 8 + 3, x._number.gets  # distinct words, each with a space before it, and the first of each text
    names = list(x._number)
    assert [names[i] for i in numbers[:ends[0]]] == ["one", " two", " ", " three"]
    assert "".join(names[i] for i in numbers) == "one two  threefour \nfive twoone\u00a0 x"


def test_numbers_of_chunks_whose_matches_are_named_before_them():
    import pyarrow as pa

    texts = ["don't stop 12345 now", "a\tb c!! d", "x y"]
    own = bpe.Chunks(bpe._queries(P.path("byte_bpe_50k.tiktoken"), P.PATTERN))
    assert [b.decode() for b in own.encode(pa.array(texts))[1].to_pylist()] == texts


def test_bpe_task_forgets_and_leaves_only_the_database(spark, texts):
    import tiktoken

    import pyarrow as pa

    path = P.path("byte_bpe_50k.tiktoken")
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    known = bpe.Chunks(bpe._queries(path, P.PATTERN), limit=60)  # forgets often
    for at in range(0, len(texts), 20):
        part = [t for _, t, _, _ in texts[at:at + 20]]
        ids, raw = known.encode(pa.array(part, pa.string()))
        assert raw.to_pylist() == [(t or "").encode() for t in part]
        assert [np.frombuffer(x, "<u4").tolist() for x in ids.to_pylist()] == [enc.encode_ordinary(t or "") for t in part]
    assert all(type(q) is bpe.BpeQueries and not any(isinstance(v, dict) for v in vars(q).values()) for q in bpe._QUERIES.values())


def brute_hits(text, items):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
    w, hit, found = cut(text), set(), set()
    for item, t in items:
        v = cut(t)
        n = min(10, len(v))
        wins = {tuple(v[i:i + n]) for i in range(len(v) - n + 1)} if v else set()
        for i in range(len(w) - n + 1):
            if n and tuple(w[i:i + n]) in wins:
                hit.update(range(i, i + n))
                found.add(item)
    return len(w), len(hit), sorted(str(x) for x in found if x is not None)


@pytest.mark.parametrize("max_chars", [decontaminate.MAX_PATTERN_CHARS, 300])
def test_decontamination_equals_brute_force(spark, max_chars):
    rng = random.Random(8)
    items = [(i, " ".join(rng.choice(["A", "b", "Né", "9"]) for _ in range(rng.randint(0, 25)))) for i in range(14)]
    items += [(20, None), (21, "..."), (22, "Solo"), (None, "b A b A b"), (3, "zz top")]
    docs = [(i, "-".join(rng.choice(["a", "b", "né", "9", "q"]) for _ in range(rng.randint(0, 60))), "s", "i") for i in range(60)]
    docs += [(70, None, "", ""), (71, "", "", ""), (72, "say SOLO!", "", ""), (72, "say SOLO!", "", "")]
    out = decontaminate.mark(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(items, "item_id long, text string"), max_chars=max_chars)
    rows = out.collect()
    assert len(rows) == len(docs)
    for r in rows:
        n, hit, found = brute_hits(r.text, items)
        assert (r.n_words, sum(b - a for a, b in r.hit_words), r.hit_items) == (n, hit, found)
        for (a, b), (s, e) in zip(r.hit_words, r.hit_spans, strict=True):
            assert decontaminate.words(r.text[s:e]) == decontaminate.words(r.text)[a:b]


def test_decontamination_against_two_benchmarks_at_the_same_address(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "id", lambda _: 0, raising=False)
    docs = spark.createDataFrame([(i, "first second", "", "") for i in range(8)], SCHEMA).coalesce(1)
    for item, text in ((1, "first"), (2, "second"), (3, "first second")):
        items = spark.createDataFrame([(item, text)], "item_id long, text string")
        assert [r.hit_items for r in decontaminate.mark(docs, items).collect()] == [[str(item)]] * 8


def test_decontamination_of_empty_tables(spark):
    docs, none = spark.createDataFrame([(1, "a b", "", "")], SCHEMA), spark.createDataFrame([], "item_id long, text string")
    assert [r.hit_items for r in decontaminate.mark(docs, none).collect()] == [[]]
    assert decontaminate.mark(docs.limit(0), none).count() == 0


FORMS = [re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
         re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")]


def brute_spans(text):
    out = []
    for k, form in enumerate(FORMS):
        for m in form.finditer(text or ""):
            digits = [c for c in m.group() if c in "0123456789"]
            ok = (k == 0 or (k == 1 and all(int(x) <= 255 for x in m.group().split(".")))
                  or (k == 2 and 14 <= len(digits) <= 19 and pii.luhn("".join(digits))) or (k == 3 and 10 <= len(digits) <= 15))
            if ok:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_base_spans_equal_the_plain_forms():
    rng = random.Random(1)
    for _ in range(5000):
        t = "".join(rng.choice("a1.@+ -(2%9é\n") for _ in range(rng.randint(0, 60)))
        t += rng.choice(["", "4111 1111-11111111", "+1 (017) 555-1234", "1.2.3.4.5.6.7.8", "a@b.c%x@y.z"]) + t
        assert pii.base_spans(t) == brute_spans(t), t
    assert pii.base_spans("1" * 200_000 + "." * 50_000 + "a" * 200_000 + "@") == []


def test_bootstrap_finds_unseen_numbers_in_learned_contexts(spark):
    rows = [(i, f"please reach me at desk line +1 (212) 555-{1000 + i} soon", "", "") for i in range(6)]
    rows += [(10, "please reach me at desk line 555-9876 soon", "", ""), (11, "the total was 555-9876x12 and 1234567 pieces", "", ""),
             (12, None, "", ""), (13, "", "", ""), (13, "", "", "")]
    got = {r.doc_id: r for r in pii.find(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(len(got[i].base) == 1 and not got[i].found for i in range(6))
    s = got[10].found[0]
    assert (rows[6][1][s.start:s.end], s.kind) == ("555-9876", 3)
    assert not got[11].base and not got[11].found and not got[12].base
    assert pii.find(spark.createDataFrame([], SCHEMA)).count() == 0


def test_bootstrap_learns_contexts_from_what_it_found(spark):
    rows = [(i, f"please reach me at desk line +1 (212) 555-{1000 + i} soon", "", "") for i in range(6)]
    rows += [(10 + i, f"please reach me at desk line 555-987{i} soon", "", "") for i in range(3)]
    rows += [(20 + i, f"office hours, ext: 555-987{i} at noon", "", "") for i in range(3)]
    rows += [(30, "ask for ext: 444-1234 tonight", "", ""), (31, "a crate of 7654321 nails", "", "")]
    got = {r.doc_id: r for r in pii.find(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all([(s.kind, t[s.start:s.end]) for s in got[i].found] == [(3, t.split()[-2])] for i, t, _, _ in rows if 10 <= i < 20)
    # no base span ever stands after 'ext:'
    assert [(s.kind, s.start, s.end) for s in got[30].found] == [(3, 13, 21)]
    assert not got[31].base and not got[31].found


def test_contexts_are_whole_words_however_far(spark):
    link, gap, nbsp = "https://example.org/" + "x" * 150, " " * 150, "desk\u00a0line"
    rows, n = [], 0
    for before in (link, f"Line{gap}", f"é {nbsp}"):
        rows += [(n + i, f"note {before} +1 (212) 555-{1000 + i} soon", "", "") for i in range(6)]
        rows.append((n + 6, f"note {before} 555-9{n:03d} soon", "", ""))
        n += 10
    got = {r.doc_id: r for r in pii.find(spark.createDataFrame(rows, SCHEMA)).collect()}
    for i, t, _, _ in rows:
        assert [t[s.start:s.end] for s in got[i].found] == ([t.split()[-2]] if i % 10 == 6 else [])


def test_context_patterns_equal_the_words_before():
    rng = random.Random(3)
    texts = ["".join(rng.choice("aB é\n\t") for _ in range(rng.randint(1, 40))) for _ in range(300)]
    places = [sorted(rng.sample(range(len(t)), min(3, len(t)))) for t in texts]
    one, two = pii.context_patterns(texts, places)
    cut = [t[:p] for t, ps in zip(texts, places, strict=True) for p in ps]
    h, at = pii.word_hashes(cut)
    for k, (x, y) in enumerate(zip(at[:-1], at[1:], strict=True)):
        assert one[k] == (pii.signed(pii.one_word(h[y - 1:y]))[0] if y > x else 0)
        assert two[k] == (pii.signed(pii.two_words(h[y - 2:y - 1], h[y - 1:y]))[0] if y > x + 1 else 0)


def test_toxicity_held_out(spark):
    rng = random.Random(2)
    plain = ["".join(rng.choice("aeiou") + rng.choice("lmnrst") for _ in range(3)) for _ in range(200)]
    rows, labels = [], []
    for i in range(900):
        w = [rng.choice(plain) for _ in range(30)]
        kind = rng.randrange(4)
        # an insult alone or a group alone is clean, both together are toxic
        w[3:3] = [["idiot"], ["martians"], ["idiot", "martians"], []][kind]
        rows.append((i, " ".join(w), "clash", ""))
        labels.append((i, 1, int(kind == 2)))
    docs, lab = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([*labels, (None, 1, 1), (5000, 1, None)], "doc_id long, quality int, toxic int")
    machine = toxicity.trained(docs, lab)
    out = toxicity.score(docs, machine)
    assert out.columns == ["doc_id", "text", "ids", "score", "predicted"]
    y = {i: t for i, _, t in labels}
    held = [r for r in out.withColumn("h", toxicity.held_out()).collect() if r.h]
    assert len(held) > 200 and all(0 <= r.score <= 1 for r in held)
    assert sum(r.predicted == y[r.doc_id] for r in held) >= 0.98 * len(held)
    odd = toxicity.score(spark.createDataFrame([(1, None, "", ""), (2, "", "", ""), (3, "!!", "", "")], SCHEMA), machine).collect()
    assert len({r.score for r in odd}) == 1
    none = toxicity.trained(docs, lab.limit(0))
    assert {r.score for r in toxicity.score(docs, none).collect()} == {0.5}


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(6)
    x = np.round(rng.normal(size=(700, 8)), 1)
    rows = [(i, [float(v) for v in x[i % 650]], 0) for i in range(700)]
    rows += [(5001, None, 0), (5002, [], 0), (5003, [1.0] * 7 + [None], 0), (5004, [float("nan")] * 8, 0),
             (5005, [float("inf")] * 8, 0), (5006, [1.0], 0), (None, [9.0] * 8, 0)]
    df = topk.integer_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int"))
    q = df.filter("vec_id % 50 = 0").selectExpr("vec_id AS query_id", "v AS q")
    v = np.floor(1024 * x[np.arange(700) % 650]).astype(np.int64)
    want = []
    for i in range(0, 700, 50):
        s = v @ v[i]
        best = sorted((j for j in range(700) if j != i), key=lambda j: (-s[j], j))[:10]
        want += [(i, r + 1, j, int(s[j])) for r, j in enumerate(best)]
    assert sorted(map(tuple, topk.top_k(df, q, shard_rows=100, query_block=4).collect())) == want
    assert topk.top_k(df.limit(0), q.limit(0)).count() == 0
    few = topk.top_k(df.filter("vec_id < 4"), q.filter("query_id = 0")).collect()
    assert [r.rank for r in few] == [1, 2, 3]


def test_archives_round_trip(spark, tmp_path):
    rng = random.Random(7)
    html = [None, "", "<p>x</p>", "é\r\n\r\nWARC/1.1\r\nbody", "long " * 30_000] + ["".join(rng.choice("abc\r\n") for _ in range(40)) for _ in range(20)]
    pages = [(i, f"http://www.Ex{i % 3}.org/p?{i % 5}#f", html[i * 7 % len(html)], 1) for i in range(120)]
    pages += [(None, None, "<p>x</p>", 1), (500, "bad\r\nurl", "only once", 1)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, payload_bytes int")
    warc.write_archives(df, str(tmp_path / "a"), archive_bytes=100_000)
    index = warc.capture_index(spark, str(tmp_path / "a"), str(tmp_path / "i"))
    first = {}
    for i, _, h, _ in pages:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    got = {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in index.collect()}
    for i, _, h, _ in pages:
        raw = (h or "").encode()
        kind = ("response", None) if first[h or ""] == i else ("revisit", first[h or ""])
        assert got[i] == (len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), *kind)
    rows = spark.read.schema(warc.CAPTURE).parquet(*sorted(map(str, (tmp_path / "i" / "index").glob("part-*")))).collect()
    assert len(rows) == len(pages)
    warc.write_archives(df.limit(0), str(tmp_path / "e"))
    assert warc.capture_index(spark, str(tmp_path / "e"), str(tmp_path / "ei")).count() == 0


def test_merge_is_globally_ordered(spark, tmp_path):
    df = spark.createDataFrame([(i, f"http://h{i * 37 % 11}.org/{i * 53 % 17}", f"x{i}") for i in range(300)], "page_id long, url string, html string")
    warc.write_archives(df, str(tmp_path / "a"), archive_bytes=20_000)
    runs = warc.capture_runs(spark, str(tmp_path / "a"))
    assert runs.select("run").distinct().count() > 3
    rows = warc.merge_runs(runs, 4).collect()
    keys = [(r.url_key, r.captured, r.page_id) for r in rows]
    assert len(keys) == 300 and keys == sorted(keys)


def test_loser_tree_merges_any_number_of_runs():
    rng = random.Random(3)
    for k in range(9):
        runs = [sorted((rng.randint(0, 9), j) for j in range(rng.randint(0, 6))) for _ in range(k)]
        got = list(warc.LoserTree([iter([(x[0], x) for x in r]) for r in runs]))
        assert [x[0] for x in got] == sorted(x[0] for r in runs for x in r)


def test_minimum_revisit_size(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")], "page_id long, url string, html string")
    warc.write_archives(df, str(tmp_path / "a"), min_revisit_bytes=3)
    got = {r.page_id: r.record_type for r in warc.capture_runs(spark, str(tmp_path / "a")).collect()}
    assert got == {1: "response", 2: "response", 3: "response", 4: "revisit"}
