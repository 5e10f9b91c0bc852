import hashlib
import re
import zlib

import numpy as np
import pytest

from varloom.llm import periodic, queries

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words, least=6, exponent=4):
    """Every diagonal walked from end to end; a period with a smaller one below it does not count."""
    n, out = len(words), []
    for q in range(1, n // exponent + 1):
        i = 0
        while i < n - q:
            start = i
            while i < n - q and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            if i > start and length >= max(least, exponent * q):
                part = words[start : start + length]
                if all(any(part[j] != part[j + d] for j in range(length - d)) for d in range(1, q)):
                    out.append((start, length, q))
            i += i == start
    return sorted(out, key=lambda r: (r[0], r[2]))


def described(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    digests = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, kept)]
    return (len(runs), *(best or (None,) * 3), None if best is None else 1000 * best[1] // best[2], *digests)


def random_words(rng, size):
    words = []
    while len(words) < size:
        unit = [f"w{x}" for x in rng.integers(0, rng.integers(1, 5), rng.integers(1, 14))]
        words += (unit * 9)[: rng.integers(1, len(unit) * 9)]
        words += [f"x{rng.integers(3)}"] * int(rng.integers(0, 2))
    return words


def test_runs_equal_brute_force():
    rng = np.random.default_rng(3)
    import pyarrow as pa

    texts = [" ".join(random_words(rng, rng.integers(0, 120))) for _ in range(300)]
    got = periodic._described(pa.array(texts), 6, 4)
    assert [r for r, _ in got] == [brute(t.split()) for t in texts]
    for least, exponent in ((5, 3), (1, 5)):
        got = periodic._described(pa.array(texts[:60]), least, exponent)
        assert [r for r, _ in got] == [brute(t.split(), least, exponent) for t in texts[:60]]


def test_edges_of_runs_and_periods():
    import pyarrow as pa

    cases = ["a " * 5, "a " * 6, "a b " * 3, "a b " * 4, "a b c " * 4, "z " + "a b c " * 4 + "a b z", "a b a b a b c a b a b a b c " * 4, None, "", " \n\t"]
    got = periodic._described(pa.array(cases, pa.string()), 6, 4)
    assert [r for r, _ in got] == [brute((c or "").split()) for c in cases]
    assert got[5] == ([(1, 14, 3)], "z a b c z")
    with pytest.raises(ValueError):
        periodic.find_runs(np.arange(3), np.zeros(3, np.int64), 6, 2)


def test_long_texts_take_no_pairs_of_copies():
    """A line repeated 100,000 times and a period of 50,000 words: linear work, one run each."""
    import pyarrow as pa

    unit = " ".join(f"u{i}" for i in range(50_000))
    got = periodic._described(pa.array(["one line again " * 100_000, " ".join([unit] * 4)]), 6, 4)
    assert [r for r, _ in got] == [[(0, 300_000, 3)], [(0, 200_000, 50_000)]]


def test_clashing_names_repeated_rows_nulls_and_no_rows(spark):
    rows = [(1, "a " * 7, 5, "r"), (1, "a " * 7, 5, "r"), (None, None, 6, "r")]
    df = spark.createDataFrame(rows, "doc_id long, text string, start int, runs string")
    out = periodic.with_runs(df)
    assert out.columns == ["doc_id", "text", *periodic.MADE]
    got = sorted(out.select("doc_id", "n_runs", "start", "collapsed").collect(), key=repr)
    assert [tuple(r) for r in got] == [(1, 1, 0, "a"), (1, 1, 0, "a"), (None, 0, None, "")]
    assert periodic.with_runs(df.limit(0)).collect() == []


def test_query_equals_brute_force(spark):
    got = {r.doc_id: tuple(r)[1:] for r in queries.op13_periodic(spark, SF).collect()}
    looping = 0
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        words, h = WORD.findall(r.text or ""), zlib.crc32(str(r.doc_id).encode())
        if h % 10 == 0 and words:
            n, g = len(words), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
        if len(words) < 3000:
            assert got[r.doc_id] == described(words, brute(words)), r.doc_id
            looping += h % 10 == 0
    assert looping > 5
