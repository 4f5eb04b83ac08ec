"""The factorization machine: pairs that neither word tells alone, plain loops, odd rows, query rows."""

import math
import random
import zlib

import numpy as np

from tessera.llm import toxicity as T
from tessera.session import scratch_path

SCHEMA = "doc_id long, text string, score string, predicted string"


def neutral(rng, n=200):
    return ["".join(rng.choice("aeiou") + rng.choice("lmnrst") for _ in range(3)) for _ in range(n)]


def held_out(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


def test_words_that_tell_only_in_pairs(spark):
    """Toxic if exactly one of two words stands in a text: neither is more common in toxic texts."""
    rng = random.Random(11)
    plain, rows, labels = neutral(rng, 300), [], []
    for i in range(3000):
        one, two = rng.random() < 0.5, rng.random() < 0.5
        w = [rng.choice(plain) for _ in range(12)] + ["gorble"] * one + ["vintash"] * two
        rng.shuffle(w)
        rows.append((i, " ".join(w), None, None))
        labels.append((i, 1, int(one != two)))
    docs, lab = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = T.score(docs, T.trained(docs, lab)).collect()
    y = {i: t for i, _, t in labels}
    held = [r for r in got if held_out(r.doc_id)]
    assert len(held) > 900 and sum((r.score >= 0.5) == y[r.doc_id] for r in held) >= 0.9 * len(held)


def plain_output(machine, inputs):
    out = machine.bias + sum(machine.weights[i] for i in inputs)
    for x, i in enumerate(inputs):
        for j in inputs[:x]:
            out += sum(a * b for a, b in zip(machine.factors[i], machine.factors[j], strict=True))
    return out


def test_score_is_the_sum_over_pairs():
    rng = np.random.default_rng(3)
    m = T.Machine(np.arange(9), rng.normal(size=9), rng.normal(size=(9, 4)), 0.3)
    for n in range(10):
        at = np.sort(rng.choice(9, n, replace=False))
        assert math.isclose(m.score(at), 1 / (1 + math.exp(-plain_output(m, at.tolist()))), rel_tol=1e-9)


def test_fit_takes_the_steps_of_plain_loops():
    rng = np.random.default_rng(5)
    rows = [(sorted(rng.choice(6, rng.integers(0, 5), replace=False).tolist()), int(rng.integers(0, 2)), int(rng.integers(1, 4))) for _ in range(25)]
    got = T.fit(np.arange(6), rows, factors=3, epochs=4, seed=2)
    start = np.random.default_rng(2)
    p = {"b": np.zeros(1), "w": np.zeros(6), "v": start.normal(0, 0.05, (6, 3))}
    one, two = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))
    total = sum(c for _, _, c in rows)
    for step in range(1, 5):
        grad = {k: np.zeros_like(x) for k, x in p.items()}
        m = T.Machine(np.arange(6), p["w"], p["v"], float(p["b"][0]))
        for inputs, y, c in rows:
            g = (1 / (1 + math.exp(-plain_output(m, inputs))) - y) * c / total
            grad["b"] += g
            for i in inputs:
                grad["w"][i] += g
                for j in inputs:
                    if j != i:
                        grad["v"][i] += g * p["v"][j]
        for k in p:
            grad[k] += 1e-4 * p[k] if k != "b" else 0
            one[k], two[k] = 0.9 * one[k] + 0.1 * grad[k], 0.999 * two[k] + 0.001 * grad[k] ** 2
            p[k] = p[k] - 0.05 * (one[k] / (1 - 0.9**step)) / (np.sqrt(two[k] / (1 - 0.999**step)) + 1e-8)
    np.testing.assert_allclose(got.weights, p["w"], rtol=1e-6, atol=1e-9)
    np.testing.assert_allclose(got.factors, p["v"], rtol=1e-6, atol=1e-9)
    assert math.isclose(got.bias, p["b"][0], rel_tol=1e-6, abs_tol=1e-9)


def test_repeated_ids_long_texts_and_empty_tables(spark):
    rng = random.Random(4)
    plain = neutral(rng)
    rows = [(i, " ".join(rng.choices(plain, k=20) + ["zorbag"] * (i % 2)), "clash", None) for i in range(300)]
    labels = [(i, 1, i % 2) for i in range(300)]
    rows += [(2, rows[2][1], None, None)] * 50 + [(2, "another text", None, None), (None, "zorbag", None, None), (700, None, None, None), (701, "", None, None)]
    rows.append((702, "zorbag " + " ".join(plain) * 3000, None, None))
    docs, lab = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert T.labelled_sample(docs, lab).count() <= 300  # one text an id, whatever the rows
    got = T.score(docs, T.trained(docs, lab)).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id == 2 and r.text != "another text"}) == 1
    assert sum(r.predicted == r.doc_id % 2 for r in got if r.doc_id is not None and r.doc_id < 300 and r.text != "another text") >= 340
    assert next(r.predicted for r in got if r.doc_id is None) == 1
    none = spark.createDataFrame([], SCHEMA)
    assert T.score(none, T.trained(none, lab)).collect() == []


def test_query_rows(spark):
    rng = random.Random(6)
    plain = neutral(rng)
    rows = [(i, " ".join(rng.choices(plain, k=15) + ["zorbag"] * (i % 3 == 0)), "en", "web") for i in range(240)] + [(None, "x", None, None), (241, None, None, None)]
    path = scratch_path(spark, "toxic")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, 0, int(i % 3 == 0)) for i in range(240)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    got = T.op6_toxicity(spark, path)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = got.collect()
    assert len(rows) == 242 and {r.held_out for r in rows if r.doc_id is None} == {False}
    for r in rows:
        assert r.predicted == int(r.score >= 0.7)
        if r.doc_id is not None:
            assert r.held_out == held_out(r.doc_id)
    known = [r for r in rows if r.doc_id is not None and r.doc_id < 240]
    assert all(r.predicted == int(r.doc_id % 3 == 0) for r in known)


def test_fit_holds_the_inputs_of_its_rows_few_times():
    import tracemalloc

    rng = np.random.default_rng(1)
    rows = [(np.sort(rng.choice(500, 100, replace=False)).astype(np.int32), i % 2, 1) for i in range(4000)]
    tracemalloc.start()
    try:
        T.fit(np.arange(500), rows, factors=4, epochs=2, seed=2)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert most < 400_000 * 56, most  # 120 bytes an input before, and more for the numbers of the rows themselves
