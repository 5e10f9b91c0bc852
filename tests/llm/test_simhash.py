import re

import numpy as np
import pytest
import xxhash

from varloom.llm import queries, simhash

SF = "/root/testdata/sf0.001"


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    grams = [" ".join(words)] if len(words) < 3 else [" ".join(words[i : i + 3]) for i in range(len(words) - 2)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def slow_components(prints, radius=2):
    """{key: smallest key reachable} over a dict of fingerprints."""
    keys = sorted(prints)
    parent = {k: k for k in keys}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {k: root(k) for k in keys}


def near_values(count, seed):
    """Random values with chains of neighbours one to three bits apart."""
    rng = np.random.default_rng(seed)
    out = [int(x) for x in rng.integers(0, 1 << 63, count // 2)]
    while len(out) < count:
        value = out[rng.integers(len(out))]
        for bit in rng.choice(64, rng.integers(1, 4), replace=False):
            value ^= 1 << int(bit)
        out.append(value)
    return out


def test_fingerprints():
    assert simhash.fingerprint("") == simhash.fingerprint(" \t\n") == 0
    for text in ["One", "one Two", "A b c", "É é x y  z\x0bw", "a b c a b c a b c", "x " * 70000]:
        assert simhash.fingerprint(text) == slow_fingerprint(text)


@pytest.mark.parametrize("shard_rows", [100_000, 20])
def test_links_are_exact_over_any_number_of_shards(spark, monkeypatch, shard_rows):
    monkeypatch.setattr(simhash, "SHARD_ROWS", shard_rows)
    values = sorted(set(near_values(400, shard_rows)))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    df = spark.createDataFrame([(v,) for v in signed], "bits long")
    got = {r.bits: r.low for r in simhash.components(simhash.links(df)).collect()}
    want = slow_components(dict(zip(signed, values, strict=True)))
    groups = {}
    for v in signed:
        groups.setdefault(want[v], []).append(v)
    assert {v: min(g) for g in groups.values() for v in g if v != min(g)} == got


def test_long_chains_become_one_component(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(200)], "bits long, low long")
    assert {(r.bits, r.low) for r in simhash.components(edges).collect()} == {(i, 0) for i in range(1, 201)}


def test_query_equals_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    prints = {k: slow_fingerprint(t) for k, t in texts.items()}
    want = slow_components(prints)
    rows = queries.op5_simhash(spark, SF).collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in rows} == {
        (k, f"{prints[k]:016x}", want[k]) for k in texts
    }
    assert len(rows) == len(texts)


def test_nulls_repeats_and_clashing_columns(spark):
    rows = [(5, "a b c d", 1), (4, "a b c d", 2), (9, None, 3), (8, "", 4), (9, None, 3), (None, "q r s t u", 5), (7, "z", 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id long")
    got = sorted(((r.doc_id, r.component_id) for r in simhash.near_duplicates(df).collect()), key=repr)
    assert got == sorted([(5, 4), (4, 4), (9, 8), (8, 8), (9, 8), (None, None), (7, 7)], key=repr)
    kept = simhash.one_of_each(df)
    assert kept.columns == df.columns
    assert sorted(r.component_id for r in kept.collect()) == [2, 4, 5, 6]
    repeated = df.filter("doc_id = 5").unionAll(df.filter("doc_id = 5"))
    assert simhash.one_of_each(repeated).count() == 1
    empty = df.limit(0)
    assert simhash.near_duplicates(empty).collect() == [] and simhash.one_of_each(empty).collect() == []


def five_words(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def slow_copies(texts):
    """{key: smallest key reachable} by pairs of Jaccard similarity of at least 0.8."""
    sets = {k: five_words(t) for k, t in texts.items()}
    low = {k: k for k in texts}
    keys = sorted(texts)
    for a in keys:
        for b in keys:
            if a < b and low[a] != low[b] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                x, y = sorted((low[a], low[b]))
                low = {k: x if v == y else v for k, v in low.items()}
    return low


@pytest.mark.parametrize("first_round", [8, 1])
def test_near_copies_equal_brute_force_jaccard(spark, monkeypatch, first_round):
    monkeypatch.setattr(simhash, "FIRST_ROUND", first_round)
    rng = np.random.default_rng(4)
    texts = {}
    for group in range(12):
        words = [f"w{x}" for x in rng.integers(0, 3000, 120)]
        for copy in range(6 if group else 40):
            changed = list(words)
            for at in rng.choice(120, copy % 6, replace=False):
                changed[at] = f"c{rng.integers(1000)}"
            texts[group * 100 + copy] = " ".join(changed)
    texts |= {9000: "One two", 9001: "one  TWO", 9002: "one", 9003: texts[0], 9004: texts[100] + " end"}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    want = slow_copies(texts)
    got = {r.doc_id: r.component_id for r in simhash.similar_groups(df).collect()}
    assert got == want
    prints = slow_components({k: slow_fingerprint(t) for k, t in texts.items()})
    assert any(prints[k] == k != want[k] for k in texts)
    kept = simhash.one_of_each(df, groups=simhash.similar_groups)
    assert {r.doc_id for r in kept.collect()} == set(want.values())


@pytest.mark.parametrize("many", [100, 400])
def test_a_common_part_makes_no_pairs(spark, monkeypatch, many):
    """60 common words and 16 of one's own: candidates by band, but none shares a rare shingle."""
    seen = []
    real = simhash.stored
    monkeypatch.setattr(simhash, "stored", lambda df, label: seen.append((label, real(df, label))) or seen[-1][1])
    common = " ".join(f"c{i}" for i in range(60))
    # 9 own words leave them just below a similarity of 0.8, where half of the rarest are common.
    texts = {k: common + " " + " ".join(f"o{k}x{i}" for i in range(16 if k % 2 else 9)) for k in range(many)}
    texts |= {k + many: texts[k] + " more" for k in range(20)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in simhash.similar_groups(df).collect()}
    assert got == {k: k % many for k in texts}
    assert sum(made.count() for label, made in seen if label == "pairs") <= 60
    assert next(made.count() for label, made in seen if label == "candidates") > many


def test_a_huge_group_and_null_texts(spark):
    """400 copies changed at one of 200 places each, beside nulls, which are copies of the empty text."""
    words = [f"w{i}" for i in range(200)]
    texts = {k: " ".join([*words[:k % 200], f"new{k}", *words[k % 200 + 1 :]]) for k in range(400)}
    rows = [*texts.items(), (900, None), (901, ""), (902, " "), (None, "alone in here"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in simhash.similar_groups(df).collect()), key=repr)
    want = [(k, 0) for k in texts] + [(900, 900), (901, 900), (902, 900), (None, None), (None, 900)]
    assert got == sorted(want, key=repr)


def test_fingerprints_name_candidates_of_near_copies(spark, monkeypatch):
    """Copies of close fingerprints are met without any MinHash band, and still compared exactly."""
    monkeypatch.setattr(simhash, "sharing_a_band", lambda rows: rows.select("node").limit(0))
    words = [f"w{i}" for i in range(400)]
    texts = {k: " ".join([*words, f"end{k}"]) for k in range(4)}
    # Its repeated part of an odd number of shingles decides the fingerprint, but half are its own.
    line = " ".join(f"r{i}" for i in range(41))
    texts |= {10 + k: " ".join([line] * 300 + [f"o{k}x{i}" for i in range(40)]) for k in range(2)}
    texts |= {20: "far from all the others"}
    df = spark.createDataFrame([*texts.items(), (30, None), (31, "")], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in simhash.similar_groups(df).collect()}
    assert got == slow_copies(texts) | {30: 30, 31: 30} and len(set(got.values())) == 5
    prints = slow_components({k: slow_fingerprint(t) for k, t in texts.items()})
    assert [prints[k] for k in (1, 2, 3, 11)] == [0, 0, 0, 10]


def test_groups_start_no_tables_from_python(spark, monkeypatch):
    """Rows handed over by Python bring a second set of workers to every executor."""
    texts = ["one two three four five six seven"] * 2 + ["quite another text of some more words"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    monkeypatch.setattr(type(spark), "createDataFrame", None)
    got = {r.doc_id: r.component_id for r in simhash.similar_groups(df).collect()}
    assert got == {0: 0, 1: 0, 2: 2}
