import random

import pytest
from pyspark.sql import functions as F

from varloom.llm import linededup, queries
from varloom.llm.linededup import LineRuns, drop_repeated, line_table

SF = "/root/testdata/sf0.001"
BLANK = " \t\n\x0b\x0c\r"


def key_of(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(BLANK))


def brute(texts, least=10, length=1):
    lines = [(t or "").split("\n") for t in texts]
    seen = {}
    for found in lines:
        for key in {key_of(x) for x in found}:
            seen[key] = seen.get(key, 0) + 1
    gone = {k for k, n in seen.items() if n >= least and len(k) >= length}
    out = []
    for found in lines:
        kept = [x for x in found if key_of(x) not in gone]
        out.append((len(found), len(found) - len(kept), "\n".join(kept)))
    return out


def results(df):
    return sorted(((r.doc_id, (r.n_lines, r.n_dropped, r.kept)) for r in df.collect()), key=repr)


@pytest.mark.parametrize(("least", "length", "batches", "fanout"), [(10, 1, 6, 3), (3, 4, 5, 2), (2, 1, 1, 2)])
def test_equals_brute_force(spark, least, length, batches, fanout):
    rng = random.Random(5)
    pool = ["Common Line", "  common line\t", "ümlaut ÄÖ", "ÜMLAUT äö", "", " ", "abc", "ABC ", "x", "\x1cabc", "long " * 30]
    texts = [None, "", "\n", "\n\n", "\r\nabc\r\n"]
    texts += ["\n".join(rng.choice([*pool, f"own {rng.random()}"]) for _ in range(rng.randrange(9))) for _ in range(80)]
    texts += [texts[20]] * 3
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(7)
    got = results(drop_repeated(df, least_documents=least, least_length=length, batches=batches, fanout=fanout))
    assert got == sorted(enumerate(brute(texts, least, length)), key=repr)


def test_clashing_names_repeated_rows_null_keys_long_texts_and_no_rows(spark, monkeypatch):
    monkeypatch.setattr(linededup, "BROADCAST_TEXTS", 0)
    long = "\n".join(["again"] * 50_000 + [f"line {i}" for i in range(100_000)])
    texts = [long, "again\nand again", "again\nand again", None, *["Again"] * 8]
    rows = [(None if i == 1 else i, t, 1, 2, 3, "k", 4) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ta int, batch int, at int, kept string, n_lines int")
    out = drop_repeated(df)
    assert out.columns == ["doc_id", "text", "ta", "batch", "at", "n_lines", "n_dropped", "kept"]
    assert results(out) == sorted(zip([0, None, *range(2, 12)], brute(texts), strict=True), key=repr)
    assert {(r.ta, r.batch, r["at"]) for r in out.select("ta", "batch", "at").collect()} == {(1, 2, 3)}
    assert drop_repeated(df.limit(0)).collect() == []


def test_runs_are_merged_by_level_and_found_again(spark, tmp_path):
    """Seven batches with three runs a level: one run of level 1 twice, one batch of level 0."""
    runs = LineRuns(spark, str(tmp_path), settled=4, fanout=3)
    texts = [f"a\nb{i}\nc{i % 2}" for i in range(7)]
    for text in texts:
        runs.add(line_table(spark.createDataFrame([(text,)], "text string")))
    assert sorted(runs.tables) == [(0, 6, 6), (1, 0, 2), (1, 3, 5)]
    again = LineRuns(spark, str(tmp_path), settled=4, fanout=3)
    assert sorted(again.tables) == sorted(runs.tables) and again.batches() == 7
    want = line_table(spark.createDataFrame([("a\nc0",)], "text string")).select("ha", "hb")
    assert again.frequent().exceptAll(want).isEmpty() and want.exceptAll(again.frequent()).isEmpty()
    with pytest.raises(ValueError):
        again.frequent(5)
    again.close()
    runs.close()


def test_settled_keys_are_not_counted_again_and_runs_are_not_shuffled(spark, tmp_path):
    runs = LineRuns(spark, str(tmp_path), settled=2, fanout=9)
    lines = line_table(spark.createDataFrame([("a\nb",), ("a",)], "text string"))
    runs.add(lines)
    runs.add(lines)
    assert runs.frequent().count() == 2
    second = spark.read.parquet(f"{tmp_path}/level0-1-1-{runs.buckets}")
    assert second.count() == 1  # "b" only: "a" was in two documents of the first batch
    counts = lines.groupBy("ha", "hb").agg(F.count("*").alias("n"))
    plan = runs.unsettled(counts)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("SortMergeJoin") == 2
    runs.close()


def test_a_run_of_a_job_that_died_does_not_count(spark, tmp_path):
    runs = LineRuns(spark, str(tmp_path), settled=1)
    runs.add(line_table(spark.createDataFrame([("a",)], "text string")))
    (tmp_path / f"level0-1-1-{runs.buckets}").mkdir()
    assert LineRuns(spark, str(tmp_path), settled=1).batches() == 1
    runs.close()


def test_query_on_whole_table(spark):
    rows = {r.doc_id: r for r in queries.op11_line_dedup(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    for r, (n, dropped, _) in zip(docs, brute([r.text for r in docs]), strict=True):
        assert (rows[r.doc_id].n_lines, rows[r.doc_id].n_dropped) == (n, dropped)
