"""Line dedup, n-gram join and passage removal against brute force on small fixtures."""

import hashlib
import random

import pytest

from tessera.llm import line_dedup, ngram_join, suffix_dedup
from tessera.llm.components import connected

SCHEMA = "doc_id long, text string, n_removed string, lang string"


def words(rng, n):
    return [rng.choice("abcdefghijklmnop") * rng.randint(1, 5) + str(rng.randint(0, 40)) for _ in range(n)]


@pytest.fixture(scope="module")
def docs():
    rng = random.Random(5)
    base = [words(rng, rng.randint(3, 80)) for _ in range(12)]
    rows = [(None, "no id at all"), (900, None), (901, ""), (902, " \n \t"), (903, "One two"), (904, "one  two"), (905, "one two three")]
    for i in range(90):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 6])):
            w[rng.randrange(len(w))] = rng.choice("xyz") * 3
        if rng.random() < 0.3:
            w = w + words(rng, rng.randint(1, 6))
        text = " ".join(w)
        if rng.random() < 0.5 and len(w) > 6:
            text = " ".join(w[:5]) + "\n" + " ".join(w[5:])
        rows.append((i * 3 % 91 + 10 * (i // 45), text))
    rows.append((7000, "long " + " ".join(words(rng, 6000))))
    rows.append((7001, rows[-1][1] + " end"))
    seen = {}
    for i, t in rows:
        seen.setdefault(i, t)  # ids are unique here; repeated rows have their own test
    return [(i, t, "clash", "en") for i, t in seen.items()]


def groups(pairs, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def shingles(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        lower = lower.replace(c, " ")
    w = [x for x in lower.split(" ") if x]
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_ngram_join_equals_brute_force(spark, docs):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(spark.createDataFrame(docs, SCHEMA)).collect()}
    sets = {i: shingles(t) for i, t, _, _ in docs if i is not None}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    root = groups(links, sets)
    assert len(links) > 20
    assert got.pop(None) == (1, None)
    assert got == {i: (len(s), root[i]) for i, s in sets.items()}


def test_ngram_join_repeated_rows_and_empty_table(spark):
    rows = [(5, "a b c d e f", "", ""), (5, "a b c d e f", "", ""), (3, "A b c d e f", "", "")]
    assert [r.component_id for r in ngram_join.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()] == [3, 3, 3]
    assert ngram_join.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def one_component_per_id(rows):
    """Brute force over rows: an id's rows are different documents of one component."""
    sets = [(i, shingles(t)) for i, t in rows]
    ids = sorted({i for i, s in sets if s})
    links = [(a, b) for x, (a, s) in enumerate(sets) for b, t in sets[:x] if s and t and 100 * len(s & t) >= 80 * len(s | t)]
    root = groups(links, ids)
    return sorted((i, len(s), root[i] if s else i) for i, s in sets)


def test_ngram_join_of_an_id_with_two_texts(spark):
    """Each text of id 5 is 0.85 similar to that of another id: all four are one component."""
    first, second = [f"a{k}" for k in range(100)], [f"b{k}" for k in range(100)]
    rows = [(1, first), (2, second), (5, [*first[:92], *(f"c{k}" for k in range(8))]), (5, [*second[:92], *(f"d{k}" for k in range(8))])]
    rows = [(i, " ".join(w)) for i, w in rows] + [(1, ""), (9, "other words here")]
    got = ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(tuple(r) for r in got) == one_component_per_id(rows)
    assert {r.component_id for r in got if r.doc_id in (2, 5)} == {1}


def test_ngram_join_of_random_tables_with_repeated_ids(spark):
    rng = random.Random(31)
    base = [words(rng, rng.randint(4, 60)) for _ in range(8)]
    rows = []
    for _ in range(70):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2])):
            w[rng.randrange(len(w))] = rng.choice("xyz") * 3
        rows.append((rng.randint(0, 45), " ".join(w)))
    rows += rows[:10]
    got = ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(tuple(r) for r in got) == one_component_per_id(rows)


def test_texts_of_the_join_do_not_come_back_from_python(spark, docs, monkeypatch):
    plans, real = [], ngram_join.written

    def noted(session, df, name):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return real(session, df, name)

    monkeypatch.setattr(ngram_join, "written", noted)
    ngram_join.near_duplicates(spark.createDataFrame(docs, SCHEMA)).collect()
    maps = [line for plan in plans for line in plan.splitlines() if "MapInArrow" in line]
    assert len(maps) >= 3
    assert not [line for line in maps if "text#" in line.rpartition("[")[2]], maps


def test_sketch_keys_share_a_word_for_every_linked_pair():
    import numpy as np

    rng = np.random.default_rng(2)
    for n in [*range(1, 60), 200, 1000]:
        s = rng.integers(0, 1 << 63, n).astype(np.uint64)
        for _ in range(3):
            drop = int(rng.integers(0, n // 5 + 1))
            t = s[rng.permutation(n)[:n - drop]]
            room = int(len(t) / 0.8) - n  # elements of its own that keep the similarity at 0.8
            t = np.unique(np.concatenate([t, rng.integers(0, 1 << 63, max(0, room)).astype(np.uint64)]))
            both, union = len(np.intersect1d(s, t)), len(np.union1d(s, t))
            if 100 * both < 80 * union or not len(t):
                continue
            low = min(ngram_join.band(n), ngram_join.band(len(t)))
            assert max(ngram_join.band(n), ngram_join.band(len(t))) <= low + 1
            assert set(ngram_join.sketch_keys(s, low).tolist()) & set(ngram_join.sketch_keys(t, low).tolist())


def test_components_of_paths_and_stars(spark):
    rng = random.Random(1)
    ids = rng.sample(range(10_000), 300)
    edges = list(zip(ids[:150], ids[1:150], strict=False)) + [(ids[150], x) for x in ids[151:250]] + [(ids[260], ids[261])]
    got = {r.node: r.root for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == groups(edges, {x for e in edges for x in e})


def test_line_dedup_equals_brute_force(spark, docs):
    out = line_dedup.dedup_lines(spark.createDataFrame(docs, SCHEMA))
    assert out.columns == ["doc_id", "text", "lang", "n_lines", "n_removed"]
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in out.collect()}
    first = {}
    order = sorted(docs, key=lambda d: (d[0] is None, d[0] or 0))
    for i, t, _, _ in order:
        for k, line in enumerate((t or "").split("\n")):
            if line.strip():
                first.setdefault(line.strip(), (i is None, i or 0, k))
    lines = list(first)
    links = [(i, j) for j in range(len(lines)) for i in range(j) if line_dedup.similar(lines[i], lines[j])]
    root = groups(links, range(len(lines)))
    keep = {}
    for i, line in enumerate(lines):
        keep[root[i]] = min(keep.get(root[i], first[line]), first[line])
    where = {line: keep[root[i]] for i, line in enumerate(lines)}
    for i, t, _, _ in docs:
        if not t:
            assert got[i] == (t, 0, 0)
            continue
        cut = t.split("\n")
        left = [x for k, x in enumerate(cut) if not x.strip() or where[x.strip()] == (i is None, i or 0, k)]
        assert got[i] == ("\n".join(left), len(cut), len(cut) - len(left))


def test_line_dedup_of_similar_and_repeated_lines(spark):
    long = "the quick brown fox jumps over the lazy dog and runs away from all of the others " * 6
    rows = [(2, f"{long}\nalone", "", ""), (1, f"start\n{long[:-3]}xyz\n\nstart", "", ""), (3, "alone", "", ""), (3, "alone", "", "")]
    got = sorted((r.doc_id, r.text) for r in line_dedup.dedup_lines(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == [(1, f"start\n{long[:-3]}xyz\n"), (2, "alone"), (3, ""), (3, "")]
    assert line_dedup.dedup_lines(spark.createDataFrame([], SCHEMA)).count() == 0


def lines_left(spark, lines):
    """The lines that stay of documents of one line each, and those that brute force keeps."""
    left = line_dedup.dedup_lines(spark.createDataFrame([(i, x, "", "") for i, x in enumerate(lines)], SCHEMA)).filter("n_removed = 0")
    root = groups([(i, j) for j in range(len(lines)) for i in range(j) if line_dedup.similar(lines[i], lines[j])], range(len(lines)))
    return sorted(r.doc_id for r in left.collect()), sorted({min(j for j in root if root[j] == root[i]) for i in root})


def test_line_dedup_of_rules_and_refrains_of_different_length(spark):
    refrain = "row, row, row your boat gently down the stream, "
    lines = ["-" * 40, "-" * 120, "Ha " * 6, "Ha " * 40, refrain * 2, refrain + "and home", refrain * 4, "=" * 30, "=-" * 15, "=" * 100]
    got, want = lines_left(spark, lines)
    assert got == want == [0, 2, 4, 5, 7, 8]


def test_line_dedup_of_phrases_repeated_any_number_of_times(spark):
    rng = random.Random(5)
    phrases = ["".join(rng.choice("abcdefgh ") for _ in range(n)) + "." for n in (99, 40, 180, 230, 300)]
    lines = ["-" * 180, "-" * 300, "-" * 2000, *(p * k for p in phrases for k in (2, 3, 10))]
    got, want = lines_left(spark, lines)
    assert got == want == [0, 3, 6, 9, 12, 15]


def test_both_signature_schemes_agree_on_equal_shingle_sets():
    import numpy as np

    a = "".join(random.Random(3).choice("abcdefgh ") for _ in range(230))
    line, key = line_dedup.band_keys([a, a + a[:0], "short line", "short line"])
    sets = [set(key[line == i].tolist()) for i in range(4)]
    assert sets[0] == sets[1] and sets[2] == sets[3] and not sets[0] & sets[2]
    assert len(sets[0]) == 2 * line_dedup.BANDS and isinstance(key, np.ndarray)


def brute_passages(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    holders = {}
    for i, t, *_ in order:
        b = (t or "").encode()
        for p in range(len(b) - 49):
            holders.setdefault(b[p:p + 50], []).append((i is None, i or 0))
    out = {}
    for i, t, *_ in order:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - 49):
            if holders[b[p:p + 50]][0] < (i is None, i or 0):
                gone[p:p + 50] = b"\1" * 50
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        runs = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out[i] = (len(b), len(b) - len(kept), runs, hashlib.sha256(kept).hexdigest())
    return out


def test_passages_equal_brute_force(spark, docs):
    rng = random.Random(9)
    shared = ["".join(rng.choice("abc é") for _ in range(n)) for n in (50, 51, 70, 130, 400)]
    rows = list(docs)
    for i in range(60):
        text = "".join(rng.choice("abcdefgh ij") for _ in range(rng.randint(0, 120)))
        for _ in range(rng.randint(0, 3)):
            s = rng.choice(shared)
            a = rng.randint(0, 20)
            text += s[a:len(s) - rng.randint(0, 20)] + "".join(rng.choice("klmnop") for _ in range(rng.randint(0, 30)))
        rows.append((20_000 + i, text, "", ""))
    rows += [(30_000, "ab" * 400, "", ""), (30_001, "ab" * 90 + "x", "", ""), (30_002, "a" * 49, "", ""), (30_003, "a" * 49, "", "")]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest())
           for r in suffix_dedup.dedup_passages(spark.createDataFrame(rows, SCHEMA)).collect()}
    want = brute_passages(rows)
    assert sum(w[1] for w in want.values()) > 5000
    assert got == want
    brief = suffix_dedup.passage_report(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.doc_id: tuple(r)[1:] for r in brief} == want and len(brief) == len(rows)


def test_passages_of_repeated_rows_and_empty_table(spark):
    text = "x" * 30 + "the same passage of more than fifty bytes stands here"
    rows = [(1, text, "", ""), (1, text, "", ""), (2, text, "", "")]
    got = sorted((r.doc_id, r.n_removed) for r in suffix_dedup.dedup_passages(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == [(1, 0), (1, 0), (2, len(text))]
    assert suffix_dedup.dedup_passages(spark.createDataFrame([], SCHEMA)).count() == 0


def test_suffix_sorting_gives_order_and_common_prefixes():
    rng = random.Random(3)
    for _ in range(400):
        strings = [b"zz" + bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 24))) for _ in range(rng.randint(1, 9))]
        order = suffix_dedup.sort_suffixes(strings, 2, 6)
        assert [strings[i] for i, _ in order] == sorted(strings)
        for (i, _), (j, c) in zip(order, order[1:], strict=False):
            assert c == suffix_dedup._common(strings[i], strings[j])


def test_a_large_bucket_is_dealt_by_its_members_outside_the_main_component(spark, monkeypatch):
    import numpy as np

    from tessera.llm import components

    monkeypatch.setattr(components, "BLOCK", 16)
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    sets = [np.unique(np.concatenate([base[rng.random(60) > 0.06], rng.integers(0, 1 << 63, 2, dtype=np.uint64)])) for _ in range(400)]

    def rows(few):  # the last ``few`` stand outside the main component, two a root
        data = [(1, i, len(s), 1000, 0 if i < 400 - few else 400 + i // 2, 0, few, 400 - few, len(s), bytearray(components.parity_sketch(s)))
                for i, s in enumerate(sets)]
        return spark.createDataFrame(data, "key long, node long, size long, cap long, root long, main long, few long, most long, n long, bits binary")

    assert components._dealt(rows(6)).count() == 394 + 6 * 25  # every member stood in 25 tasks before
    for few in (6, 40):
        root = [0 if i < 400 - few else 400 + i // 2 for i in range(400)]
        bits = [np.unpackbits(np.frombuffer(components.parity_sketch(s), np.uint8)) for s in sets]
        want = {(a, b) for b in range(400 - few, 400) for a in range(b) if root[a] != root[b]
                and np.count_nonzero(bits[a] != bits[b]) * 180 <= 20 * (len(sets[a]) + len(sets[b]))}
        got = [(r.a, r.b) for r in components._across(rows(few), 80, False).collect()]
        assert len(got) == len(set(got)) and set(got) == want and len(want) > 100
        nearest = {(r.a, r.b) for r in components._across(rows(few), 80, True).collect()}
        assert nearest <= want and {x for p in want for x in p if x >= 400 - few} == {x for p in nearest for x in p if x >= 400 - few}


def test_comparing_a_block_holds_few_pairs_at_once():
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    from tessera.llm import components

    n = 4096
    rng = np.random.default_rng(2)
    bits = [x.tobytes() for x in rng.integers(0, 1 << 62, n)]
    bits[9] = bits[7]
    t = pa.table({"y": np.zeros(n, np.int32), "node": np.arange(n), "size": np.full(n, 9), "cap": np.full(n, 9), "root": np.arange(n),
                  "minor": np.ones(n, bool), "n": np.full(n, 9), "bits": pa.array(bits, pa.binary())})
    tracemalloc.start()
    try:
        found = [(a, b) for p in components._compared(t, 80, False) for a, b in zip(p["a"].to_pylist(), p["b"].to_pylist(), strict=True)]
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert (7, 9) in found
    assert most < 32 << 20, most


def test_near_copies_are_settled_in_one_round_of_sketches(spark, monkeypatch):
    import numpy as np

    from tessera.llm import components

    names, real = [], components.written

    def noted(session, df, name):
        names.append(name)
        return real(session, df, name)

    monkeypatch.setattr(components, "written", noted)
    rng = np.random.default_rng(8)
    sets = {}
    for i in range(0, 40, 2):  # twenty pairs of near copies in one bucket
        sets[i] = rng.integers(0, 1 << 62, 60).astype(np.uint64)
        sets[i + 1] = sets[i][2:]

    def verify(pairs):
        return pairs.filter("a - a % 2 = b - b % 2")

    def sketches(nodes):
        data = [(r.node, len(sets[r.node]), bytearray(components.parity_sketch(sets[r.node]))) for r in nodes.collect()]
        return spark.createDataFrame(data, "node long, n long, bits binary")

    members = spark.createDataFrame([(1, i, 0, 0) for i in range(40)], "key long, node long, size long, cap long")
    got = {r.node: r.root for r in components.link_buckets(members, verify, sketches, 80).collect()}
    assert got == {i: i - i % 2 for i in range(40)}
    assert names.count("links") == 2, names  # of the leads and of one round; a round without a link and one of all pairs followed before


def test_members_with_more_to_name_than_a_round_takes(spark, monkeypatch):
    import numpy as np

    from tessera.llm import components

    monkeypatch.setattr(components, "NAMED", 1)
    monkeypatch.setattr(components, "BLOCK", 16)
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 62, 120)
    sets = {i: frozenset(base[(np.arange(120) * 7 + i * (2 + i % 3)) % 120 < 92].tolist()) for i in range(150)}

    def similarity(a, b):
        return 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])

    def verify(pairs):
        found = [(r.a, r.b) for r in pairs.collect() if similarity(r.a, r.b)]
        return spark.createDataFrame(found, "a long, b long")

    def sketches(nodes):
        data = [(r.node, len(sets[r.node]), bytearray(components.parity_sketch(np.array(sorted(sets[r.node]), np.uint64)))) for r in nodes.collect()]
        return spark.createDataFrame(data, "node long, n long, bits binary")

    members = spark.createDataFrame([(1, i, 0, 0) for i in range(150)] * 2, "key long, node long, size long, cap long")
    got = {r.node: r.root for r in components.link_buckets(members, verify, sketches, 80).collect()}
    root = list(range(150))
    for _ in range(150):
        for a in range(150):
            for b in range(a):
                if similarity(a, b):
                    root[a] = root[b] = min(root[a], root[b])
    assert {i: got.get(i, i) for i in range(150)} == dict(enumerate(root))


def test_shared_pairs_are_those_of_keys_with_two_nodes(spark):
    import numpy as np

    from tessera.llm import sharing

    rng = np.random.default_rng(6)
    key, node = rng.integers(-3000, 3000, 9000), rng.integers(0, 1 << 40, 9000)
    key[:500], node[300:500] = 7, node[:200]  # a key of many nodes, some of them twice
    key[500:520] = node[500:520] = 9  # and one of a single node
    rows = spark.createDataFrame([(int(k), int(n)) for k, n in zip(key, node, strict=True)], "key long, node long").repartition(5)

    def run(batches):
        for b in batches:
            if b.num_rows:
                yield sharing.packed(*(b.column(c).to_numpy() for c in ("key", "node")), 4)

    packed = rows.mapInArrow(run, sharing.packed_schema)
    assert packed.count() <= 5 * 4 * sharing.BUCKETS  # a row for each pair before
    held = {}
    for k, n in zip(key.tolist(), node.tolist(), strict=True):
        held.setdefault(k, set()).add(n)
    got = [(r.key, r.node) for r in sharing.shared_pairs(packed, 4).collect()]
    assert set(got) == {(k, n) for k, ns in held.items() if len(ns) > 1 for n in ns}
    assert len(got) < len(set(got)) + 50



def test_sets_of_one_band_do_not_meet_again_in_the_band_below(spark):
    import numpy as np

    from tessera.llm.shingles import signed

    rng = np.random.default_rng(9)
    base = rng.integers(0, 1 << 62, 110).astype(np.uint64)
    sizes = [110] * 6  # all in one band

    def rows(sizes):
        data = [(i, 0, signed(np.sort(np.concatenate([base[:n - 1], np.array([i], np.uint64)]))).tolist()) for i, n in enumerate(sizes)]
        return ngram_join._members(spark.createDataFrame(data, "cls long, own long, elements array<long>")).collect()

    k = ngram_join.band(110)
    below = {int(x) for i in range(6) for x in signed(ngram_join.sketch_keys(np.sort(np.concatenate([base[:109], np.array([i], np.uint64)])), k - 1))}
    got = rows(sizes)
    assert got and not [r for r in got if r.key in below]  # half of the rows before
    lower = next(n for n in range(110, 0, -1) if ngram_join.band(n) < k)
    mixed = rows([*sizes, lower])  # with a set of the band below they meet there
    assert {r.node for r in mixed if r.key in {x.key for x in mixed if x.node == 6}} == set(range(7))
