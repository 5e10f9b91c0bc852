import pytest
from pyspark.sql import functions as F

from varloom.llm import decontam, queries

SF = "/root/testdata/sf0.001"


def slow_leaks(texts, items):
    out = set()
    for key, text in texts.items():
        grams = decontam.shingles(decontam.words_of(text or ""))
        for item, wanted in items.items():
            if wanted and decontam.share(wanted, grams) >= decontam.OVERLAP:
                out.add((key, item))
    return out


def test_query_equals_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    items = {r.item_id: decontam.shingles(decontam.words_of(r.text)) for r in bench}
    got = {(r.doc_id, r.item_id) for r in queries.op2_decontamination(spark, SF).collect()}
    want = slow_leaks(texts, items)
    assert want and got == want


def test_retrieval_finds_every_item_above_the_threshold():
    rows = [(i, "", [(f"w{(i * 7 + k * k) % 40}", 0.1 + 0.01 * k) for k in range(8)]) for i in range(60)]
    rows = [(i, t, list(dict(ws).items())) for i, t, ws in rows]
    vocabulary = {f"w{k}": k for k in range(40)}
    index = decontam.build(rows, vocabulary, 64)
    import numpy as np

    for seed in range(30):
        terms = np.unique(np.random.default_rng(seed).integers(0, 40, 25))
        names = {f"w{t}" for t in terms}
        want = {i: sum(w for n, w in ws if n in names) for i, _, ws in rows}
        got = dict(decontam.wand(index, terms, np.arange(len(rows) // decontam.BLOCK + 1), 0.6))
        assert set(got) == {i for i, s in want.items() if s >= 0.6 - 1e-9}
        assert all(abs(got[i] - want[i]) < 1e-9 for i in got)


QUESTION = "which of the many old rivers in the northern valley still carries boats during the long dry summer months"
ANSWER = "only the broad eastern branch does so"


@pytest.fixture
def bench(spark):
    rows = [(1, f"{QUESTION}? {ANSWER}."), (2, None), (3, "..."), (4, "short item here"), (4, "short item here")]
    return spark.createDataFrame(rows, "item_id long, text string")


def leaks(spark, bench, text):
    df = spark.createDataFrame([(1, text, 9)], "doc_id long, text string, leaks long")
    return {x.item_id for x in decontam.find_leaks(df, bench).first().leaks}


def test_where_an_item_lies_does_not_matter(spark, bench):
    item = f"{QUESTION}? {ANSWER}."
    for before in (0, 40, 63, 64, 100, 1000):
        assert leaks(spark, bench, "other words " * before + item.upper() + " and more" * 50) == {1}
    assert leaks(spark, bench, item.replace("does so", "does thus")) == {1}
    assert leaks(spark, bench, "a short item here too") == {4}


def test_parts_and_clean_texts_stay(spark, bench):
    assert leaks(spark, bench, QUESTION[:60]) == set()
    assert leaks(spark, bench, " ".join(reversed(f"{QUESTION} {ANSWER}".split()))) == set()
    assert leaks(spark, bench, "") == set() and leaks(spark, bench, None) == set()


def test_items_of_any_length_and_several_passes(spark, monkeypatch):
    long = " ".join(f"term{i % 977}x{i}" for i in range(1500))
    bench = spark.createDataFrame([(1, long), (2, f"{QUESTION}? {ANSWER}.")], "item_id long, text string")
    monkeypatch.setattr(decontam, "PASS_BYTES", 200)
    assert leaks(spark, bench, "intro " * 70 + long + " end. " + QUESTION + " " + ANSWER) == {1, 2}


def test_no_rows_on_either_side(spark, bench):
    df = spark.createDataFrame([(1, "text")], "doc_id long, text string")
    assert decontam.find_leaks(df, bench.limit(0)).select(F.size("leaks")).first()[0] == 0
    assert decontam.find_leaks(df.limit(0), bench).collect() == []


def test_many_items_and_a_long_text_in_bounded_memory():
    """Sums of spans and blocks are held in pieces: 20,000 items, then a text of 20 MB."""
    import tracemalloc

    rows = []
    for i in range(20_000):
        words = [f"w{(i * 31 + k * k * 7 + i // 3000 * k) % 3000}" for k in range(12)] + [f"own{i}", "common"]
        rows.append((i, " ".join(words), [(w, 1 / len(set(words))) for w in sorted(set(words))]))
    vocabulary = {t: n for n, t in enumerate(sorted({t for r in rows for t, _ in r[2]}))}
    index = decontam.build(rows, vocabulary, 64)
    texts = ["common other " * 300 + rows[7][1], "", rows[19_999][1], "nothing common here " * 200]
    long = "common w1 filler " * 1_200_000 + rows[1234][1] + " tail" * 100
    tracemalloc.start()
    got = decontam.search([index], vocabulary, texts)
    assert tracemalloc.get_traced_memory()[1] < 150 << 20
    assert [{x[0] for x in g} for g in got] == [{7}, set(), {19_999}, set()]
    tracemalloc.reset_peak()
    small = decontam.build(rows[:2000], vocabulary, 64)
    assert {x[0] for x in decontam.search([small], vocabulary, [long])[0]} == {1234}
    assert tracemalloc.get_traced_memory()[1] < 250 << 20
    tracemalloc.stop()
