"""Periodic runs of words: stretches that repeat a pattern at least four times.

Seed and extend along diagonals, one lag being one diagonal. A run of period q overlaps its own
copy shifted by q in at least max(length, exponent * q) - q words. Periods are taken in classes
[Q, 2Q); the least overlap guaranteed in a class is the k of its k-grams. These are indexed by
exact names (pairs of names of shorter grams, numbered anew), and consecutive occurrences of a
k-gram in the same document whose distance lies in the class are the seeds. As k is at least
the period, the next occurrence of a run's k-gram is exactly one period away, so consecutive
occurrences are enough and no other pair is listed. A table of the furthest word covered on
each lag leaves out seeds inside a stretch already extended. A class without a repeated k-gram
ends the search: longer grams cannot repeat either.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varloom.llm.common import fields, free_names, per_batch, texts_of

LEAST_LENGTH = 6
LEAST_EXPONENT = 4
#: Words, as in the ASCII white space that parts them.
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _named(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """One number for each distinct pair; the arrays hold numbers below 2**31."""
    return np.unique((first.astype(np.int64) << 32) | second, return_inverse=True)[1]


def _shifted(names: np.ndarray, by: int) -> np.ndarray:
    """Names of the grams that start ``by`` words later; past the end, numbers used once each."""
    ends = int(names.max()) + 1 + np.arange(by)
    return np.concatenate([names[by:], ends[: min(by, len(names))]])


def grams(names: np.ndarray, doubled: int, rest: int) -> np.ndarray:
    """Names of the grams of ``doubled + rest`` words from those of ``doubled``, rest <= doubled.

    Two overlapping grams of ``doubled`` words say what the whole gram is.
    """
    return _named(names, _shifted(names, rest))


def extended(words: np.ndarray, left: int, right: int) -> tuple[int, int]:
    """The longest stretch [a, b) around words[left] and words[right] on whose diagonal words agree."""
    lag, most = right - left, len(words)

    def reach(step: int) -> int:
        done, size = 0, 16
        while True:
            if step > 0:
                x = words[left + done : min(left + done + size, most - lag)]
                y = words[right + done : right + done + size][: len(x)]
            else:
                x = words[max(0, left - done - size) : left - done][::-1]
                y = words[max(lag, right - done - size) : right - done][::-1]
            differ = np.flatnonzero(x != y)
            if len(differ):
                return done + int(differ[0])
            done += len(x)
            if len(x) < size:
                return done
            size *= 2

    return left - reach(-1), left + reach(1)


def repeated_stretches(words: np.ndarray, document: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, stretch of each): words inside k-grams whose hash repeats in their document.

    A run lies whole in one stretch, as each of its words is in a k-gram that repeats; a
    collision of hashes only keeps words that need not be kept.
    """
    n = len(words) - k + 1
    if n < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    hashed = document[:n].astype(np.uint64)
    for i in range(k):
        hashed = (hashed ^ (hashed >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + words[i : i + n].astype(np.uint64)
    order = np.argsort(hashed)
    ranked = hashed[order]
    same = ranked[1:] == ranked[:-1]
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(words) + 1, np.int64)
    covered[:n] += twice
    covered[k : k + n] -= twice
    positions = np.flatnonzero(np.cumsum(covered[:-1]))
    return positions, np.cumsum(np.diff(positions, prepend=-2) > 1)


def find_runs(
    words: np.ndarray, document: np.ndarray, least_length: int = LEAST_LENGTH, exponent: int = LEAST_EXPONENT
) -> list[tuple[int, int, int]]:
    """(start, length, period) of all maximal runs, by start and then period.

    ``words`` are numbers of words, documents one after the other and parted by a number used
    once; ``document`` says where each word belongs. The overlap guaranteed must not shrink
    from one class to the next, and must be no shorter than the period.
    """
    if exponent < 3 or least_length >= 2 * exponent:
        raise ValueError("needs an exponent of at least 3 and a length below twice the exponent")
    where, document = repeated_stretches(words, document, max(least_length, exponent) - 1)
    if not len(where):
        return []
    # Stretches side by side, parted by numbers used once.
    gaps = np.flatnonzero(np.diff(document)) + 1
    names = np.insert(np.unique(words[where], return_inverse=True)[1], gaps, -1)
    names[names < 0] = len(where) + np.arange(len(gaps))
    where, document = np.insert(where, gaps, -1), np.insert(document, gaps, 0)
    words, held = names, 1
    found: list[tuple[int, int, int]] = []
    period = 1
    while True:
        k = max(least_length, exponent * period) - period
        while 2 * held <= k:
            names, held = grams(names, held, held), 2 * held
        of_k = grams(names, held, k - held) if k > held else names
        order = np.argsort(of_k, kind="stable")
        again = (of_k[order[1:]] == of_k[order[:-1]]) & (document[order[1:]] == document[order[:-1]])
        if not again.any():
            break
        left, right = order[:-1][again], order[1:][again]
        lag = right - left
        seed = (lag >= period) & (lag < 2 * period)
        left, lag = left[seed], lag[seed]
        by_lag = np.lexsort((left, lag))
        left, lag = left[by_lag], lag[by_lag]
        # The seed one word further on the same lag lies in the same stretch.
        follows = np.zeros(len(left), bool)
        follows[1:] = (lag[1:] == lag[:-1]) & (left[1:] == left[:-1] + 1)
        covered: dict[int, int] = {}
        for at, q in zip(left[~follows].tolist(), lag[~follows].tolist(), strict=True):
            if at < covered.get(q, -1):
                continue
            start, end = extended(words, at, at + q)
            covered[q] = end
            length = end - start + q
            if length >= max(least_length, exponent * q):
                found.append((int(where[start]), length, q))
        period *= 2
    return sorted(found, key=lambda r: (r[0], r[2]))


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of greatest exact length/period; ties go to the smallest start, then period."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def _described(batch: pa.Array, least_length: int, exponent: int) -> list[tuple[list, str]]:
    """Runs and collapsed words of each text, found in one search over all texts of a piece."""
    texts = [WORD.findall(t) for t in texts_of(batch)]
    numbers: dict[str, int] = {}
    flat: list[int] = []
    firsts = []
    for words in texts:
        firsts.append(len(flat))
        flat.extend([numbers.setdefault(w, len(numbers)) for w in words])
        flat.append(-1)
    ids = np.array(flat, np.int64)
    breaks = np.flatnonzero(ids < 0)
    ids[breaks] = len(numbers) + np.arange(len(breaks))
    document = np.zeros(len(ids), np.int64)
    document[np.array(firsts[1:], np.int64)] = 1
    runs: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    document = np.cumsum(document)
    for start, length, period in find_runs(ids, document, least_length, exponent):
        doc = int(document[start])
        runs[doc].append((start - firsts[doc], length, period))
    out = []
    for words, found in zip(texts, runs, strict=True):
        if found:
            kept = np.ones(len(words), bool)
            for start, length, period in found:
                kept[start + period : start + length] = False
            words = [w for w, k in zip(words, kept.tolist(), strict=True) if k]
        out.append((found, " ".join(words)))
    return out


def with_runs(
    df: DataFrame, text: str = "text", least_length: int = LEAST_LENGTH, exponent: int = LEAST_EXPONENT
) -> DataFrame:
    """``df`` with its texts' periodic runs and the words left when each keeps one period.

    Adds ``n_runs``; ``start``, ``length``, ``period`` and ``exponent_milli`` of the strongest
    run, null without any; ``runs``, all of them by start and period; ``collapsed``, the words
    without those that lie in a run behind its first period, joined by one space. Words are
    numbered from 0. Null and empty texts have no words. Repeated rows get the same results;
    columns of the same names are replaced.
    """

    def start():
        def work(batch: pa.Array) -> pa.Array:
            got = _described(batch, least_length, exponent)
            ends = np.cumsum([0, *(len(r) for r, _ in got)]).astype(np.int32)
            flat = np.array([x for r, _ in got for x in r], np.int32).reshape(-1, 3)
            parts = [pa.array(np.ascontiguousarray(flat[:, i])) for i in range(3)]
            run = pa.StructArray.from_arrays(parts, ["start", "length", "period"])
            best = [strongest(r) for r, _ in got]
            of_best = [pa.array([None if b is None else b[i] for b in best], pa.int64()) for i in range(3)]
            milli = pa.array([None if b is None else 1000 * b[1] // b[2] for b in best], pa.int64())
            n_runs = pa.array(np.diff(ends).astype(np.int64))
            collapsed = pa.array([c for _, c in got], pa.string())
            lists = pa.ListArray.from_arrays(pa.array(ends), run)
            arrays = [n_runs, *of_best, milli, lists, collapsed]
            return pa.StructArray.from_arrays(arrays, [*MADE])

        return work

    returns = (
        "n_runs long, start long, length long, period long, exponent_milli long, "
        "runs array<struct<start:int,length:int,period:int>>, collapsed string"
    )
    packed = free_names(df, "packed")[0]
    return fields(df.withColumn(packed, per_batch(start, returns)(F.col(f"`{text}`"))), packed, list(MADE))


#: Columns that ``with_runs`` adds.
MADE = ("n_runs", "start", "length", "period", "exponent_milli", "runs", "collapsed")


def turned(words: list[str], g: int) -> list[str]:
    """The words, repeating from word g % n on with a period that ``g`` chooses."""
    n = len(words)
    a = g % n
    period = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % period] for i in range(a, n)]


def looped(key: str, text: str) -> Column:
    """Texts of which some are made to repeat: a fixture for runs at any scale, told by the key.

    With h = crc32 of the key in decimal and g = h // 10, where h is divisible by 10 each word
    from a = g % n on becomes word a + (i - a) % p, p = 1 + (n - a) // (3 + g % 8), of the n
    words. Other texts stay, null as empty; a null key counts as the empty text.
    """

    def start():
        def work(batch: pa.Array) -> pa.Array:
            out = []
            for value, g in zip(batch.field(0), batch.field(1).to_pylist(), strict=True):
                words = WORD.findall(value.as_py()) if value.is_valid else []
                out.append(" ".join(turned(words, g)) if words else None)
            return pa.array(out, pa.string())

        return work

    whole = F.coalesce(F.col(text), F.lit(""))
    h = F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")))
    # Only texts to be turned are sent to Python.
    sent = F.struct(F.when(h % 10 == 0, whole).alias("t"), F.floor(h / 10).alias("g"))
    return F.coalesce(per_batch(start, "string")(sent), whole)
