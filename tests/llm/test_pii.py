import hashlib
import random
import re

import numpy as np
import pytest

from varloom.llm import pii, queries

SF = "/root/testdata/sf0.001"
FORMS = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
]


def plain_spans(text):
    out = []
    for k, form in enumerate(FORMS):
        for m in re.finditer(form, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if k == 1 and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if k == 2 and not (13 <= len(digits) <= 19 and pii.luhn(digits)):
                continue
            if k == 3 and not 9 <= len(digits) <= 15:
                continue
            out.append((k, m.start(), m.end()))
    return out


def test_detectors_equal_the_patterns():
    rng = random.Random(2)
    parts = ["1", "23", "456", ".", "-", " ", "+", "(", ")", "@", "a.b", "x", "4111111111111111", ".com", "é", "\n", "0007"]
    for _ in range(5000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 30)))
        assert pii.base_spans(text) == plain_spans(text)


@pytest.mark.parametrize("run", ["1" * 50_000, "a" * 50_000 + "@", "+1" * 30_000, "1." * 30_000, "a@" * 30_000])
def test_long_runs_take_linear_time(run):
    found = pii.base_spans(run)
    assert found == sorted(found)
    pii.graph_of(run, found)


@pytest.fixture(scope="module")
def field(spark):
    return pii.learn(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_repeats_in_another_form_are_added(field):
    text = "call +1 (017) 555-7713 now or 017 555 7713 later, or 018 555 7714; 4111 1111 1111 1112 no"
    base = pii.base_spans(text)
    assert pii.all_spans(field, text, base) == sorted([*base, (3, 30, 42)])


def test_messages_give_exact_marginals_on_trees(field):
    rng = np.random.default_rng(4)
    n = 4
    g = pii.Graph([(i, i) for i in range(n)], np.array([-1, 2, -1, -1]), rng.random((n, 12)), np.array([[0, 1, 0], [1, 2, 1], [2, 3, 2]]))
    f = pii.Field(rng.normal(size=(12, 5)), (p := rng.normal(size=(3, 5, 5))) + p.swapaxes(1, 2))
    want = np.zeros((n, 5))
    for y in np.ndindex(*[5] * n):
        if y[1] == 2:
            s = sum(g.features[i] @ f.unary[:, y[i]] for i in (0, 2, 3)) + sum(f.pair[k, y[a], y[b]] for a, b, k in g.edges)
            for i in range(n):
                want[i, y[i]] += np.exp(s)
    want /= want.sum(1, keepdims=True)
    assert np.abs(pii.marginals(f, g) - want).max() < 1e-3


def test_query_keeps_every_detected_span(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op9_pii(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = plain_spans(texts[r.doc_id])
        named = [f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in base]
        assert r.base_sha256 == hashlib.sha256(",".join(named).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for x, _, _ in base) for k in range(4)]
        assert set(named) <= set(filter(None, r.spans.split(",")))


def test_nulls_empties_no_rows_and_clashing_names(spark, field):
    df = spark.createDataFrame([(1, None, 7), (2, "", 8), (3, "é a.b@c.de 1.2.3.4!", 9)], "doc_id long, text string, spans long")
    found = pii.find(df, field).withColumn("masked", pii.redact("text", "spans")).orderBy("doc_id").collect()
    assert [r.masked for r in found] == [None, "", "é [EMAIL] [IP]!"]
    assert [len(r.base) for r in found] == [0, 0, 2]
    assert pii.find(df.limit(0), pii.learn(df.limit(0))).collect() == []


def test_overlapping_spans_are_masked_once(spark):
    df = spark.createDataFrame(
        [("x 12345 y", [("card", 2, 5), ("phone", 4, 7)])], "text string, s array<struct<kind:string,begin:long,stop:long>>"
    )
    assert df.select(pii.redact("text", "s").alias("m")).first().m == "x [CARD] y"


def test_detecting_redacts_as_the_two_steps_do(spark, field):
    texts = [None, "", "no data", "a.b@c.de, 1.2.3.4 and 1.2.3.4", "é +1 (017) 555-7713 😀 x@y.z", "@" * 50]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts * 3)], "doc_id long, text string")
    one = df.withColumn("p", pii.detected(field, redacted=True)).select("doc_id", "p.*")
    two = pii.find(df, field).select("doc_id", "base", "spans", pii.redact("text", "spans").alias("redacted"))
    assert one.orderBy("doc_id").collect() == two.orderBy("doc_id").collect()


@pytest.mark.parametrize("gap", [" or ", " some words between them" * 6])
@pytest.mark.parametrize("detected_at", [0, 150, 300])
def test_hundreds_of_repeats_are_all_added(field, gap, detected_at):
    parts = ["017 555 7713"] * 300
    parts.insert(detected_at, "+1 (017) 555-7713")
    text = f"{gap} call ".join(parts)
    found = pii.all_spans(field, text, pii.base_spans(text))
    assert len([x for x in found if x[0] == 3]) == 301
    other = f"{gap} call ".join(["018 555 7714"] * 300)
    assert pii.all_spans(field, other, pii.base_spans(other)) == []


def test_ties_of_repeats_are_few_and_short():
    text = " and then ".join(["+1 (017) 555-7713", *["017 555 7713", "(017) 555 7713"] * 100])
    g = pii.graph_of(text, pii.base_spans(text))
    ties = g.edges[g.edges[:, 2] > 0]
    assert len(ties) <= 2 * len(g.spans) and set(ties[ties[:, 0] == 0, 1].tolist()) == set(range(1, 201))


def test_nodes_learned_from_are_bounded_in_all(spark, monkeypatch):
    """Copies of one text count once, and graphs are taken only while they fit."""
    seen = []
    monkeypatch.setattr(pii, "fit", seen.extend)
    monkeypatch.setattr(pii, "NODES_IN_ALL", 50)
    texts = [(f"call +49 30 555{i:04} or 030 555{i:04} at 10.0.0.{i % 250}",) for i in range(200)]
    pii.learn(spark.createDataFrame(texts + texts[:1] * 500, "text string"))
    assert 0 < sum(len(g.spans) for g in seen) <= 50
    assert len({tuple(map(tuple, g.features.tolist())) + tuple(g.spans) for g in seen}) >= 1 and len(seen) > 5
