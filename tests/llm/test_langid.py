import numpy as np
import pytest
from pyspark.sql import functions as F

from varloom.llm import langid, queries
from varloom.llm.common import held_out

SF = "/root/testdata/sf0.01"


def test_gradients_match_differences():
    rng = np.random.default_rng(1)
    net = langid.new_network(["a", "b", "c"], 2)
    x, y = rng.integers(97, 123, (4, 20)).astype(np.uint8), np.array([0, 1, 2, 1])

    def loss():
        return -np.log(langid.probabilities(net, x)[np.arange(4), y]).mean()

    for w, g in zip(net.weights(), langid.gradients(net, x, y), strict=True):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        kept = w[at].copy()
        w[at] = kept + 1e-2
        up = loss()
        w[at] = kept - 1e-2
        down = loss()
        w[at] = kept
        assert abs((up - down) / 2e-2 - g[at]) < 0.05 * max(1, abs(g[at]))


def test_held_out_accuracy(spark):
    truth = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = queries.op10_language(spark, SF).join(truth, "doc_id")
    assert rows.count() == truth.count()
    assert rows.filter("score < 0 or score > 1 or lang_pred is null").count() == 0
    got = rows.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert got >= 0.97


def test_whole_text_counts():
    net = langid.new_network(["a"], 1)
    assert langid.windows_of(b"x" * 513).shape == (3, 256)
    assert langid.windows_of(b"").shape == (1, 256)
    assert np.allclose(langid.probabilities(net, langid.windows_of(b"abc")), 1)


def test_nulls_no_letters_no_rows_and_clashing_names(spark):
    rows = [(1, None, "en", 1), (2, "", "en", 1), (3, "12 34 !", "en", 1), (4, "word", "en", 1), (4, "word", "en", 1), (5, "Wort", None, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    net = langid.learn(df)
    assert net.languages == ["en"]
    got = {(r.doc_id, r.lang_pred, r.score) for r in langid.identify(df, net).collect()}
    assert got == {(1, "und", 0.0), (2, "und", 0.0), (3, "und", 0.0), (4, "en", 1.0), (5, "en", 1.0)}
    assert langid.learn(df.limit(0)) is None and langid.learn(df.filter("lang is null")) is None
    assert {r.lang_pred for r in langid.identify(df, None).collect()} == {"und"}
    assert langid.identify(df.limit(0), net).collect() == []


def test_held_out_rows_are_never_learned_from(spark):
    df = spark.range(1000).withColumnRenamed("id", "doc_id").withColumn("h", held_out())
    share = df.filter("h").count()
    assert 150 < share < 250
    assert spark.createDataFrame([(None,)], "doc_id long").select(held_out().alias("h")).first().h


def test_every_language_is_learned_from_a_bounded_sample(spark, monkeypatch):
    given = []
    monkeypatch.setattr(langid, "DOCS_IN_ALL", 500)
    monkeypatch.setattr(langid, "train", lambda x, y, languages: given.append((x, y)) or languages)
    rows = [(i, f"text {i} of words", f"l{i % 230:03}") for i in range(1150)]
    names = langid.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert names == [f"l{i:03}" for i in range(230)]
    x, y = given[0]
    assert len(x) == 460 and np.bincount(y).tolist() == [2] * 230


def test_more_values_than_documents_learned_from_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(langid, "DOCS_IN_ALL", 3)
    df = spark.createDataFrame([(i, "some words", f"l{i}") for i in range(4)], "doc_id long, text string, lang string")
    with pytest.raises(ValueError, match="languages"):
        langid.learn(df)
