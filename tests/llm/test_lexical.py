"""Ranked search: plans expand to their items, shared sums equal plain sums, rows equal the SQL and plain loops."""

import math
import random
from collections import Counter

import duckdb
import numpy as np
import pytest

from tessera.llm import lexical as L
from tessera.session import scratch_path


def terms(text):
    return [w for ws in L.pieces(text) for w in ws]


def expand(plan, node):
    n = len(plan.leaf)
    return [plan.terms[plan.leaf[node]]] if node < n else expand(plan, plan.left[node - n]) + expand(plan, plan.right[node - n])


def plain(docs, items, k=L.K):
    cut = [(i, terms(t)) for i, t in docs if t is not None]
    n_docs, n_terms = sum(bool(w) for _, w in cut), sum(len(w) for _, w in cut)
    df = Counter(t for _, w in cut for t in set(w))
    tf = [Counter(w) for _, w in cut]
    out = []
    for item, text in items:
        words = terms(text)
        scored = []
        for (i, w), count in zip(cut, tf, strict=True):
            if w:
                m = 75 + 25 * len(w) * n_docs // n_terms
                s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * count[t] // (1000 * count[t] + 12 * m))
                        for t in words if count[t])
                if s > 0:
                    scored.append((-s, i is None, i or 0, i))
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:k])]
    return out


def some_texts(n, seed, vocabulary=60):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)] + ["Été", "né", "x2", "ÇA"]
    return [" ".join(r.choices(words, [1 / (i + 1) for i in range(len(words))], k=r.randint(0, 40))) for _ in range(n)]


def key(rows):
    return sorted(((i is None, i or 0), r, (d is None, d or 0), s) for i, r, d, s in rows)


def test_terms():
    assert terms("Ab-c9_É é\x00x\x7fÀb A b") == [w.encode() for w in ("ab", "c9", "É", "é", "x", "Àb", "a b")]
    assert terms(None) == terms("") == terms(" .,\n") == []
    long = "Word, " * 500_000
    assert len(list(L.pieces(long))) > 1 and Counter(terms(long)) == {b"word": 500_000}
    assert terms("a" * 3_000_000) == [b"a" * 3_000_000]


@pytest.mark.parametrize("seed", range(4))
def test_plans_expand_to_their_items_and_share(seed):
    items = [(i, terms(t)) for i, t in enumerate(some_texts(80, seed)) if terms(t)]
    plan = L.mine(items)
    for q, (_, words) in enumerate(items):
        got = [t for x in plan.parts[plan.ends[q]:plan.ends[q + 1]] for t in expand(plan, x)]
        assert sorted(got) == sorted(words)
    assert plan.additions() < 0.7 * sum(len(w) - 1 for _, w in items)
    holders = [set(expand(plan, len(plan.leaf) + i)) for i in range(len(plan.left))]
    assert all(sum(h <= set(w) for _, w in items) >= 2 for h in holders)
    assert (plan.left < len(plan.leaf) + np.searchsorted(plan.rounds, plan.rounds)).all()  # children come in earlier rounds


def test_equal_items_cost_one():
    plan = L.mine([(i, [b"t%d" % j for j in range(64)]) for i in range(50)])
    assert plan.additions() == 63 and len(plan.parts) == 50
    assert L.mine([]).parts.tolist() == []


def run(spark, docs, items, **opts):
    d = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, rank int, query string")
    q = spark.createDataFrame([(i, t, 5) for i, t in items], "item_id long, text string, doc_id int")
    return [tuple(r) for r in L.search(d, q, **opts).collect()]


def test_equals_plain_loops_with_odd_rows(spark):
    docs = list(enumerate(some_texts(120, 1)))
    docs += docs[:30] + [(500 + i, t) for i, t in docs[30:60]] + [(None, docs[3][1]), (None, docs[4][1]), (900, None), (901, ""), (902, "... !"), (903, "w1 " * 30_000)]
    items = list(enumerate(some_texts(25, 2))) + [(3, "w1 w1 w2"), (3, "w1 w1 w2"), (None, "w5 né"), (77, None), (78, ""), (79, "nowhere to be seen"), (80, "w3")]
    want = key(plain(docs, items))
    assert key(run(spark, docs, items)) == want
    assert key(run(spark, docs, items, block_bytes=400)) == want  # several blocks


def test_small_slices_change_nothing():
    items = list(enumerate(some_texts(30, 6)))
    plan = L.mine([(i, terms(t)) for i, t in items if terms(t)])
    best = {}
    for size in (1, 7, 1000):
        b = L.Best(len(plan.items), 5)
        scores = np.random.default_rng(3).integers(0, 12, (len(plan.items), 200))
        for at in range(0, 200, size):
            ids = np.arange(200)[::-1][at:at + size].copy()
            b.add(scores[:, at:at + size], ids, np.zeros(len(ids), bool))
        best[size] = list(zip(b.item.tolist(), b.score.tolist(), b.doc.tolist(), strict=True))
    assert best[1] == best[7] == best[1000]
    want = [(i, int(s), int(d)) for i in range(len(plan.items)) for s, d in sorted(((s, d) for s, d in zip(scores[i], range(199, -1, -1)) if s), key=lambda x: (-x[0], x[1]))[:5]]
    assert best[1] == want


def test_empty_tables(spark):
    some = [(1, "w1 w2")]
    assert run(spark, [], some) == run(spark, some, []) == run(spark, [(1, None), (2, "?")], some) == run(spark, some, [(1, None)]) == []


def test_query_equals_sql(spark):
    path = scratch_path(spark, "ranked")
    docs = list(enumerate(some_texts(300, 8, 400))) + [(None, "w1 w2"), (7, None), (8, "")]
    items = list(enumerate(some_texts(40, 9, 400))) + [(41, None), (41, "w9")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}/{t}.parquet/*.parquet')")
    got = L.op13_ranked_search(spark, path)
    want = con.execute(L.OP13_SQL).fetchall()
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert key(map(tuple, got.collect())) == key(want) == key(plain(docs, items))
