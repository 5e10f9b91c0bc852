import math

import numpy as np
import pytest

from varloom.llm import queries, topk

SF = "/root/testdata/sf0.001"


def slow(rows, k=20, every=20):
    """(query, rank, candidate, score) over (key, vector) rows by plain products."""
    good = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, (i, v) in enumerate(good):
        if i % every == 0:
            scores = [(-sum(a * b for a, b in zip(v, w, strict=False)), j) for c, (j, w) in enumerate(good) if c != q]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def got(df):
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in df.collect())


def test_query_equals_plain_products(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert got(queries.op7_topk(spark, SF)) == slow(rows)


@pytest.mark.parametrize("group,block", [(8192, 4096), (16, 7)])
def test_ties_repeats_nulls_and_many_groups(spark, monkeypatch, group, block):
    monkeypatch.setattr(topk, "GROUP_ROWS", group)
    monkeypatch.setattr(topk, "QUERY_ROWS", block)
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(0, 0.3, 6)]) for i in range(200)]
    rows += [(i, [0.5, 0.25, 0.0, 0.0, 0.0, 0.0]) for i in range(200, 330)]
    rows += [(40, rows[40][1]), (220, [0.5, 0.25, 0.0, 0.0, 0.0, 0.0]), (500, [9.0]), (520, []), (540, [0.0] * 6)]
    rows += [(600, None), (620, [1.0, None]), (640, [float("nan")]), (660, [float("inf")]), (None, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    single = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    assert got(topk.top_k(df, "id % 20 = 0", k=7)) == slow(single, 7)


def test_fewer_candidates_than_k_and_no_rows(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5])], "vec_id long, embedding array<float>")
    assert got(topk.top_k(df, "id % 20 = 0")) == [(0, 1, 1, 2048)]
    assert got(topk.top_k(df.limit(0), "id % 20 = 0")) == []
    assert got(topk.top_k(df.filter("vec_id = 1"), "id % 20 = 0")) == []
