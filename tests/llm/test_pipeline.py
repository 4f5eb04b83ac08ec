"""The pipeline's stages one by one against plain Python on a small table."""

import random

import corpus_pipeline
import pytest
from tessera.llm import decontaminate, line_dedup

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    out = tmp_path_factory.mktemp("corpus")
    rng = random.Random(12)
    words = ["".join(rng.choice("aeiou") + rng.choice("lmnrst") for _ in range(4)) for _ in range(400)]
    rows, labels = [], []
    for i in range(240):
        w = [rng.choice(words) for _ in range(40)]
        if i % 6 == 0:
            w[5] = "scoundrel"
        rows.append((i, " ".join(w[:20]) + "\n" + " ".join(w[20:]), "en", "s", 0))
        labels.append((i, 1, int(i % 6 == 0)))
    rows.append((300, rows[1][1], "en", "s", 0))
    rows.append((301, rows[2][1] + " tail", "en", "s", 0))
    question = " ".join(rng.choice(words) for _ in range(14))
    rows += [(302, "before " + question.upper() + " after", "en", "s", 0), (303, None, None, None, None), (304, "", "en", "s", 0)]
    rows = [(i, t, a, b, None if t is None else len(t)) for i, t, a, b, _ in rows]
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{out}/labels.parquet")
    spark.createDataFrame([(1, question)], "item_id long, text string").write.parquet(f"{out}/benchmark.parquet")
    return str(out)


def test_stages_do_what_they_say(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "line_dedup", "ngram_join", "decontamination", "byte_bpe"]
    kept = {}
    for name in list(stages)[:-1]:
        out = stages[name](spark, docs, sf_dir)
        assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes)
        kept[name] = {r.doc_id: r.text for r in out.collect()}
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = spark.createDataFrame(out.collect(), out.schema)
        if name == "toxicity":
            assert set(before) - set(kept[name]) == {i for i in range(0, 240, 6)}
        if name == "line_dedup":
            assert set(kept[name]) == set(before) and kept[name][300] == "" and kept[name][1] == before[1]
            assert line_dedup.similar(before[301].split("\n")[1], before[2].split("\n")[1]) and kept[name][301] == ""
        if name == "ngram_join":
            assert set(before) == set(kept[name])  # what was left of the copies is empty, and empty texts link with nothing
        if name == "decontamination":
            assert set(before) - set(kept[name]) == {302}
    last = stages["byte_bpe"](spark, docs, sf_dir).collect()
    assert {r.doc_id for r in last} == set(kept["decontamination"]) and all(r.exact for r in last)


def test_ngram_stage_keeps_one_of_each_group(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = {r.doc_id for r in corpus_pipeline.ngram_join_stage(spark, docs, sf_dir).collect()}
    assert {r.doc_id for r in docs.collect()} - out == {300, 301}


def test_run_equals_its_stages(spark, sf_dir):
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert len(rows) == 245 - 40 - 1 and {303, 304} <= {r.doc_id for r in rows}
    assert not decontaminate.words(None)
