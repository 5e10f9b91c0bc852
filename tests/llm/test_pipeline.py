import re

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from test_pii import plain_spans
from test_simhash import slow_copies
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from varloom.llm import decontam, langid, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def short_training(monkeypatch):
    """The stages' effects do not hang on a well-trained network."""
    monkeypatch.setattr(langid, "EPOCHS", 2)
    monkeypatch.setattr(langid, "DOCS_PER_LANG", 60)


def test_stages_follow_each_other_as_brute_force_says(spark, tmp_path):
    """Each stage against a plain version of it on what its predecessor kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = docs.columns
    kept = {}
    for number, (name, stage) in enumerate(pipeline.STAGES):
        before = {r.doc_id: r for r in docs.collect()}
        out = stage(spark, docs, SF)
        out.write.parquet(f"{tmp_path}/{number}")
        docs = spark.read.parquet(f"{tmp_path}/{number}")
        kept[name] = (before, {r.doc_id: r for r in docs.collect()})
        if number < len(pipeline.STAGES) - 1:
            assert docs.columns == names
        assert docs.count() == len(kept[name][1])
    before, after = kept["language"]
    assert all(any(c.isalpha() for c in r.text or "") for r in after.values())
    assert all(not any(c.isalpha() for c in before[k].text or "") for k in before.keys() - after.keys())
    before, after = kept["near_duplicates"]
    found = slow_copies({k: r.text for k, r in before.items()})
    assert set(after) == {k for k in before if found[k] == k}
    before, after = kept["decontamination"]
    items = [decontam.shingles(decontam.words_of(r.text)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for k, r in before.items():
        grams = decontam.shingles(decontam.words_of(r.text))
        assert (k in after) == all(decontam.share(i, grams) < decontam.OVERLAP for i in items)
    before, after = kept["personal_data"]
    assert set(before) == set(after)
    for k, r in after.items():
        assert plain_spans(r.text) == [] and r.n_chars == len(r.text)
        if not plain_spans(before[k].text):
            assert r == before[k]
        else:
            assert re.search(r"\[(EMAIL|IP|CARD|PHONE)\]", r.text)
    before, after = kept["encoding"]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for k, r in after.items():
        assert r.ids == library.encode(before[k].text, add_special_tokens=False).ids and r.round_trip
    run = pipeline.run(spark, SF)
    assert {r.doc_id: r for r in run.collect()} == after
    assert set(queries.QUERIES) >= {"op1_bpe", "op10_language"}


def test_nulls_clashing_names_and_no_rows(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "some words a.b@c.de here", None, None, 99), (None, "more words", "en", "s", 1), (3, "some words a.b@c.de here", None, None, 99)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    clash = docs
    for name in ("spans", "base", "leaks", "score", "lang_pred", "bits", "component_id", "fingerprint", "ids"):
        clash = clash.withColumn(name, F.lit(1))
    for start in (docs, clash, docs.limit(0)):
        out = start
        for number, (_, stage) in enumerate(pipeline.STAGES):
            out = stage(spark, out, SF)
            if number < 4:
                assert out.columns == start.columns
        got = out.select("doc_id", "round_trip").collect()
        if not start.isEmpty():
            assert sorted(got, key=repr) == sorted([(None, True), (3, True)], key=repr)
        else:
            assert got == []


def test_masking_takes_one_python_worker_a_task(spark):
    """Each Python step of a task holds a worker, and all of them live on for the encoding."""
    docs = spark.createDataFrame([(1, "mail a.b@c.de"), (2, None)], "doc_id long, text string")
    masked = pipeline.mask(spark, docs, SF)
    plan = masked._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"ArrowEvalPython \[", plan)) == 1, plan
    assert {r.doc_id: r.text for r in masked.collect()} == {1: "mail [EMAIL]", 2: None}


def test_least_score_follows_the_number_of_languages():
    assert pipeline.least_score(1) == 0 and abs(pipeline.least_score(4) - 0.3) < 1e-12
    assert all(1 / n < pipeline.least_score(n) < 1 / n + 1 / 15 for n in (2, 3, 10, 1000))
