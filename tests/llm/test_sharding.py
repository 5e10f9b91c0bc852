import zlib
from collections import Counter

import numpy as np
import pytest

from varloom.llm import queries, sharding

SF = "/root/testdata/sf0.001"


def whole(rows, shards):
    counts = Counter(r.shard for r in rows)
    assert set(counts) <= set(range(shards))
    assert not rows or max(counts.values()) - min(counts.get(s, 0) for s in range(shards)) <= 1
    for s, n in counts.items():
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(n))


def test_query(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op8_sharding(spark, SF).collect()
    whole(rows, 40)
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    assert all(r["size"] == len(texts[r.doc_id].encode()) + 16 for r in rows)
    assert all(r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) and r.law == "rows" for r in rows)
    assert all(r.grown_shard is None for r in rows)


@pytest.mark.parametrize("target_rows", [1_000_000, 7])
def test_shards_of_several_targets(spark, target_rows):
    df = spark.range(0, 503, 1, 6).withColumnRenamed("id", "slot").selectExpr("slot AS n", "1L AS slot", "'x' AS shard")
    rows = sharding.shuffle(df, 5, seed=3, target_rows=target_rows).collect()
    whole(rows, 5)
    assert sorted(r.n for r in rows) == list(range(503))
    again = sharding.shuffle(df, 5, seed=3, target_rows=target_rows).collect()
    assert {(r.n, r.shard, r.slot) for r in again} == {(r.n, r.shard, r.slot) for r in rows}


def test_fewer_rows_than_shards_nulls_and_no_rows(spark):
    df = spark.createDataFrame([(None,), (None,), (1,)], "n long")
    rows = sharding.shuffle(df, 10).collect()
    assert sorted((r.shard, r.slot) for r in rows) == [(0, 0), (1, 0), (2, 0)]
    assert sharding.shuffle(df.limit(0), 10).collect() == []


def test_matrix_has_its_margins_whoever_asks():
    held = [5, 0, 17, 3, 40, 1]
    before = np.concatenate([[0], np.cumsum(held)])
    targets = sharding.sizes(66, 4)
    matrix = np.stack([sharding.matrix_row(9, before, targets, p) for p in range(6)])
    assert matrix.sum(1).tolist() == held and matrix.sum(0).tolist() == targets.tolist()


def test_every_placement_is_equally_likely():
    """Chi-square of the counts sent by the first of three partitions, against their exact law."""
    before, targets = np.array([0, 3, 5, 8]), np.array([4, 4])
    seen = Counter(int(sharding.matrix_row(seed, before, targets, 0)[0]) for seed in range(4000))
    want = {k: 4000 * p for k, p in zip(range(4), np.array([4, 24, 24, 4]) / 56, strict=True)}
    assert sum((seen[k] - w) ** 2 / w for k, w in want.items()) < 16.3


def test_counts_beyond_numpys_limit():
    rng = np.random.default_rng(1)
    good, bad, draws = 3_000_000_000, 1_000_000_000, 1_000
    got = [sharding.hypergeometric(rng, good, bad, draws) for _ in range(400)]
    assert abs(np.mean(got) - 750) < 3 and 9 < np.std(got) < 19
    row = sharding.split(rng, np.array([good, 0, bad]), 500)
    assert row.sum() == 500 and row[1] == 0


def test_texts_themselves_are_dealt(spark, monkeypatch):
    dealt, shuffle = [], sharding.shuffle
    monkeypatch.setattr(sharding, "shuffle", lambda df, *a, **k: dealt.append(shuffle(df, *a, **k)) or dealt[-1])
    digests = {(r.doc_id, r.text_crc32, r.shard, r.slot) for r in queries.op8_sharding(spark, SF).collect()}
    assert dealt[0].columns == ["doc_id", "text", "shard", "slot"]
    assert {(r.doc_id, zlib.crc32((r.text or "").encode()), r.shard, r.slot) for r in dealt[0].collect()} == digests


def test_targets_are_bounded_by_bytes(spark):
    of_shard = sharding.sizes(1000, 4)
    assert sharding.targets_of(of_shard, 10_000, 1000, 10_000).tolist() == [1] * 4
    assert sharding.targets_of(of_shard, 10_000_000, 1000, 500_000).tolist() == [5] * 4
    assert sharding.targets_of(of_shard, 10_000, 100, 10_000).tolist() == [3] * 4
    assert sharding.targets_of(sharding.sizes(2, 4), 10_000_000, 1000, 10).tolist() == [1] * 4
    df = spark.range(0, 200, 1, 4).selectExpr("id AS n", "repeat('x', 1000) AS text")
    found = sharding.shuffle(df, 2, target_bytes=20_000)
    rows = found.collect()
    whole(rows, 2)
    assert sorted(r.n for r in rows) == list(range(200)) and all(len(r.text) == 1000 for r in rows)


def test_columns_of_its_own_names_and_places_within_large_shards(spark):
    """Own column names stay apart, and over seeds a row lands in each place of its shard alike."""
    df = spark.range(0, 60, 1, 3).selectExpr("id AS n", "id * 2 AS _to_", "id * 3 AS _part_", "id * 5 AS _at_", "7L AS _bytes_")
    landed = Counter()
    for seed in range(12):
        rows = sharding.shuffle(df, 2, seed=seed, target_rows=10).collect()
        whole(rows, 2)
        assert all((r._to_, r._part_, r._at_, r._bytes_) == (2 * r.n, 3 * r.n, 5 * r.n, 7) for r in rows)
        landed.update((r.n // 20, r.shard * 3 + r.slot // 10) for r in rows)
    # 20 rows of each input partition, six tenths of the places, twelve seeds: 40 expected.
    assert sum((landed[p, t] - 40) ** 2 / 40 for p in range(3) for t in range(6)) < 35
