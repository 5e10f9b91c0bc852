import random
import re
from collections import Counter

import numpy as np
import pytest

from varloom.llm import collocations
from varloom.llm.collocations import Trie

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute(rows, least=100, top=2000, percent=100):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for i in range(len(words)):
                for m in range(1, 6):
                    if i + m <= len(words):
                        f[lang, tuple(words[i : i + m])] += 1
    found = {k: v for k, v in f.items() if v >= least and len(k[1]) > 1}
    inside = {}
    for (lang, w), a in found.items():
        for m in range(2, len(w)):
            for s in range(len(w) - m + 1):
                key = lang, w[s : s + m]
                inside[key] = max(inside.get(key, 0), a)
    out = []
    for (lang, w), a in found.items():
        if 100 * inside.get((lang, w), -1) >= percent * a:
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        out.append((lang, " ".join(w), a, f[lang, w[:k]], f[lang, w[k:]], n[lang], score))
    ranked = []
    for lang in {r[0] for r in out}:
        rows = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))[:top]
        ranked += [(lang, i, *r[1:]) for i, r in enumerate(rows, 1)]
    return sorted(ranked)


def result(df, **options):
    out = collocations.collocations(df, **options)
    assert out.columns == COLUMNS
    return sorted(tuple(r) for r in out.collect())


@pytest.mark.parametrize(("least", "top", "percent"), [(4, 2000, 100), (2, 7, 60)])
def test_equals_brute_force(spark, monkeypatch, least, top, percent):
    monkeypatch.setattr(collocations, "ROOM", 150)
    rng = random.Random(2)
    pool = ["The", "the", "of", "a", "Änd", "änd", "x\x1cy", "ß", "1", "deep", "sea"]
    fixed = ["deep sea of the", "a of a of a", "one two three four five six", "Over, and\tover again"]
    rows = [(None, None), ("en", ""), ("en", "w" * 5000), ("de", ", . ;!")]
    for _ in range(120):
        words = [rng.choice([*pool, rng.choice(fixed), f"r{rng.randrange(60)}"]) for _ in range(rng.randrange(30))]
        rows.append((rng.choice(["en", "en", "de", None]), rng.choice([" ", "\t", "  "]).join(words) + rng.choice([".", "\r\n", "", "?"])))
    rows += rows[10:20]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    assert result(df, least=least, top=top, percent=percent) == brute(rows, least, top, percent)


def test_clashing_names_and_no_rows(spark):
    rows = [("en", "new york city. " * 3, 1, 2), (None, "New York", 1, 2)]
    df = spark.createDataFrame(rows, "lang string, text string, word int, n int")
    assert result(df, least=3) == brute([r[:2] for r in rows], 3)
    assert result(df.limit(0)) == [] and result(df, least=50) == []


def test_products_beyond_64_bits(spark):
    a, total, left, right = 9_000_000_000_123, 99_000_000_000_007, 9_000_000_000_223, 91_000_000_000_001
    df = spark.createDataFrame([(a, total, left, right)], "a long, total long, l long, r long")
    assert df.selectExpr(f"{collocations.SCORE} AS s").first().s == 1000 * a * total // (left * right)


def test_trie_bursts_spills_whole_subtrees_and_loses_nothing():
    rng = np.random.default_rng(1)
    trie, want, got = Trie(room=500, burst=8), Counter(), Counter()

    def spilled(share):
        before = set(trie.root)
        paths, counts = trie.spill(share)
        assert {p[0] for p in paths} == before - set(trie.root)
        for ids, n in collocations.runs_of(paths, counts):
            rows = [tuple(r) for r in ids.tolist()]
            assert rows == sorted(set(rows))
            for row, count in zip(rows, n.tolist(), strict=True):
                got[tuple(x for x in row if x)] += count

    for _ in range(200):
        paths = [tuple(rng.integers(1, 9, rng.integers(2, 6)).tolist()) for _ in range(100)]
        trie.add_all(paths)
        for path in paths:
            for length in range(2, len(path) + 1):
                want[path[:length]] += 1
        while trie.size > trie.room:
            spilled(0.5)
    assert any(tree[1] for tree in trie.root.values())
    spilled(1.0)
    assert got == want and trie.size == 0 and not trie.root


def test_shared_ids_draw_another_seed(spark, monkeypatch):
    real = collocations.word_id
    monkeypatch.setattr(collocations, "word_id", lambda lang, word, seed: 7 if seed == 0 and word != b"c" else real(lang, word, seed))
    words = spark.createDataFrame([("en", "a", 9), ("en", "b", 1), ("en", "c", 9)], "lang string, word string, n long")
    made, seed = collocations.numbered(words, 5)
    assert seed == 1 and made.select("id").distinct().count() == 3


def test_only_frequent_windows_leave_the_tasks(spark, monkeypatch):
    monkeypatch.setattr(collocations, "PAIRS_HELD", 500)
    monkeypatch.setattr(collocations, "RUN_IDS", 16)
    rng = random.Random(3)
    rows = [("en", " ".join(rng.choice("abcdefgh") for _ in range(40)) + rng.choice([". x", "", " one two three four"])) for _ in range(200)]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(6)
    least = 40
    want, pairs = Counter(), Counter()
    for _, text in rows:
        for piece in text.split("."):
            words = piece.split()
            for m in range(2, 6):
                for i in range(len(words) - m + 1):
                    (pairs if m == 2 else want)[tuple(words[i : i + m])] += 1
    made, seed = collocations.numbered(collocations.word_counts(df), least)
    names = {r.id: r.word for r in made.collect()}
    known = collocations.bit_table(made.filter(f"n >= {least}"), "id")
    counted = collocations.pair_counts(df, seed, known, "text", "lang").collect()
    frequent = {w: n for w, n in pairs.items() if n >= least}
    assert {(names[r.w1], names[r.w2]): r.n for r in counted if r.n >= least} == frequent
    kept = spark.createDataFrame([r for r in counted if r.n >= least], "w1 long, w2 long, n long")
    paired = collocations.bit_table(collocations.with_pair_hash(kept), "pair")
    runs = collocations.frequent_runs(df, seed, known, paired, "text", "lang").cache()
    assert runs.count() > 20 and all(r.ids[-1] == 0 and len(r.ids) <= 60 for r in runs.collect())
    table = collocations.window_table(runs, least)
    got = {tuple(names[w] for w in r[:5] if w): r.n for r in collocations.phrase_counts(runs, table).collect()}
    # Every pair is frequent and hardly any longer window is: before, all of them were sent.
    assert len(want) > 10_000 and got == {w: n for w, n in want.items() if n >= least} and len(got) == 3


def test_runs_keep_words_in_two_frequent_pairs():
    table = np.zeros(collocations.TABLE_BITS // 8, np.uint8)
    for left, right in [(1, 2), (2, 3), (3, 4), (5, 6), (6, 7), (8, 9)]:
        place = int(collocations.pair_hash(np.array([left]), np.array([right]))[0]) % collocations.TABLE_BITS
        table[place >> 3] |= 1 << (place & 7)
    runs = lambda *ids: collocations.runs_in(list(ids), table).tolist()
    assert runs() == runs(1, 2) == runs(1, 2, 0, 3, 4, 0) == runs(8, 9, 8, 9) == []
    assert runs(1, 2, 3, 4) == [1, 2, 3, 4, 0]
    assert runs(9, 1, 2, 3, 5, 6, 7, 0, 8, 9, 0, 2, 3, 4, 0) == [1, 2, 3, 0, 5, 6, 7, 0, 2, 3, 4, 0]
