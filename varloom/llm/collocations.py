"""Collocations: word sequences that occur together more often than their parts suggest.

Phrases are counted in tries of bounded size, one per task. A path is the window of up to five
words that starts at a word; a phrase's count is the sum over the paths it begins. A trie's
upper levels are nodes by word id; below hang hash containers from the rest of a path to its
count, and a container that grows over a bound bursts into a node with containers of its own.
A full trie spills its largest subtrees whole, as runs of phrases sorted by prefix; Spark
partitions the runs by prefix, the whole phrase being the prefix, and merges counts there. So
a word that opens a third of all phrases spreads over all partitions, and each task sends at
most one row per phrase and spill.

Words are counted first, then pairs of frequent words. Runs of three words or more in which
every pair is frequent are stored, since no phrase is more frequent than its parts. Over these
runs, occurrences of windows of three to five words are summed by a place of their hash; tries
then hold only windows whose place is frequent. What is frequent is told by a bit table of fixed
size, which may say yes too often but never no, so counts are exact and memory is bounded at
any vocabulary. Word ids are 64-bit hashes, drawn anew with another seed
while any frequent word shares its id with another word.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from varloom.llm.common import give_back, slices, stored

LEAST = 100
LONGEST = 5
TOP = 2000
UNKNOWN = "und"
#: Lower case of A-Z, ends of a piece as line feeds, tabs as spaces.
PLAIN = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 9 + b" "
)
#: Paths a task holds before it spills, entries a container bursts at, and pairs held at once.
ROOM = 400_000
BURST = 1024
PAIRS_HELD = 4_000_000
#: Words whose ids a task remembers.
REMEMBERED = 400_000
#: Bits of the tables of frequent words, pairs and longer windows, in buckets of a bitmap each.
#: A place within a bucket fits 16 bits.
TABLE_BITS = 1 << 25
BUCKET_BITS = 1 << 15
#: Ids after which a stored row of runs ends with its run, and such rows worked on at once.
RUN_IDS = 256
RUN_ROWS = 1024
#: Rows of an Arrow batch of pairs.
BATCH_ROWS = 1 << 16
#: A language's phrases are ranked in so many parts first.
RANK_PARTS = 64
SEEDS = 16
#: Exact while a product has at most 38 digits; more is an error, never a wrong number.
SCORE = (
    "CAST(1000 AS DECIMAL(4,0)) * CAST(a AS DECIMAL(19,0)) * CAST(total AS DECIMAL(19,0)) "
    "div (CAST(l AS DECIMAL(19,0)) * CAST(r AS DECIMAL(19,0)))"
)
IDS = ["w1", "w2", "w3", "w4", "w5"]


class Trie:
    """Counts of paths of word ids, about ``room`` of them held; ``spill`` gives some up."""

    def __init__(self, room: int = ROOM, burst: int = BURST):
        self.room, self.burst = room, burst
        # A subtree is [entries, burst, children]: counts by the rest of the path, or, once
        # burst, containers of the same kind by the next word.
        self.root: dict[int, list] = {}
        self.size = 0

    def add_all(self, paths: Iterable[tuple[int, ...]]) -> None:
        """Counts paths of at least two words."""
        root, burst, added = self.root, self.burst, 0
        for path in paths:
            top = root.get(path[0])
            if top is None:
                top = root[path[0]] = [0, False, {}]
            held, rest = top[2], path[1:]
            if top[1]:
                held = held.setdefault(path[1], {})
                rest = path[2:]
            before = held.get(rest)
            if before is not None:
                held[rest] = before + 1
                continue
            held[rest] = 1
            added += 1
            top[0] += 1
            if not top[1] and len(held) > burst:
                top[1], top[2] = True, self._parted(held)
        self.size += added

    @staticmethod
    def _parted(held: dict[tuple[int, ...], int]) -> dict[int, dict]:
        parts: dict[int, dict] = {}
        for rest, n in held.items():
            parts.setdefault(rest[0], {})[rest[1:]] = n
        return parts

    def spill(self, share: float = 0.5) -> tuple[list[tuple[int, ...]], list[int]]:
        """Paths and counts of the largest subtrees, removed until ``share`` of the entries is gone."""
        wanted, paths, counts = share * self.size, [], []
        for first in sorted(self.root, key=lambda w: -self.root[w][0]):
            if wanted <= 0:
                break
            entries, parted, held = self.root.pop(first)
            wanted -= entries
            self.size -= entries
            for step, below in held.items() if parted else [(None, held)]:
                start = (first,) if step is None else (first, step)
                paths += [start + rest for rest in below]
                counts += below.values()
        return paths, counts


def runs_of(
    paths: list[tuple[int, ...]], counts: list[int], shortest: int = 2
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, counts) of all phrases of ``shortest`` words or more that the paths begin with, sorted by prefix.

    One matrix for each length; ids beyond a phrase's length are 0.
    """
    if not paths:
        return
    sizes = np.fromiter(map(len, paths), np.int64, len(paths))
    table = np.zeros((len(paths), LONGEST), np.int64)
    table[np.arange(LONGEST)[None] < sizes[:, None]] = np.fromiter(chain.from_iterable(paths), np.int64, int(sizes.sum()))
    order = np.lexsort(table.T[::-1])
    table, sizes, n = table[order], sizes[order], np.array(counts, np.int64)[order]
    for length in range(shortest, LONGEST + 1):
        long = sizes >= length
        part, of_part = table[long, :length], n[long]
        if not len(part):
            return
        first = np.flatnonzero(np.append(True, (part[1:] != part[:-1]).any(1)))
        ids = np.zeros((len(first), LONGEST), np.int64)
        ids[:, :length] = part[first]
        yield ids, np.add.reduceat(of_part, first)


def pieces(text: str) -> list[list[bytes]]:
    """Words of each piece, A-Z lower-cased."""
    return [p.split() for p in text.encode().translate(PLAIN).split(b"\n")]


def pair_hash(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """48 bits of two numbers: two pairs may share them, which only makes both count as frequent.

    Longer windows are hashed word by word, the hash of a window's start on the left.
    """
    mixed = left.astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9)
    mixed = (mixed ^ (mixed >> np.uint64(29))) + right.astype(np.uint64)
    mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return (mixed >> np.uint64(16)).astype(np.int64)


def bit_table(df: DataFrame, column: str) -> np.ndarray:
    """Bytes of a table in which the places of ``df``'s hashes are set; ``TABLE_BITS`` in all."""
    place = F.pmod(F.col(column), F.lit(TABLE_BITS))
    maps = df.groupBy((place / BUCKET_BITS).cast("int").alias("bucket")).agg(
        F.bitmap_construct_agg(place % BUCKET_BITS).alias("bits")
    )
    return _joined(maps)


def _joined(maps: DataFrame) -> np.ndarray:
    """The table of (bucket, bits) rows."""
    table = np.zeros(TABLE_BITS // 8, np.uint8)
    size = BUCKET_BITS // 8
    for row in maps.collect():  # at most TABLE_BITS in all, whatever the input
        table[row.bucket * size : row.bucket * size + len(row.bits)] = np.frombuffer(row.bits, np.uint8)
    return table


def holds(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    places = hashes % TABLE_BITS
    return (table[places >> 3] >> (places & 7).astype(np.uint8)) & 1 == 1


def word_id(language: str, word: bytes, seed: int) -> int:
    """A positive number of a language's word; 0 stands for none."""
    return (xxhash.xxh64_intdigest(language.encode() + b"\0" + word, seed) >> 1) or 1


def _parts(text: str, lang: str) -> list[Column]:
    return [F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text")]


def word_counts(df: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, word, n) over all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Counter] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for language, words in seen.items():
                keys = sorted(words)
                arrays = [pa.array([language] * len(keys), pa.string()), pa.array(keys, pa.binary()).cast(pa.string())]
                counts = pa.array([words[k] for k in keys], pa.int64())
                yield pa.RecordBatch.from_arrays([*arrays, counts], ["lang", "word", "n"])
            seen.clear()

        for batch in batches:
            languages = iter(batch.column(0).to_pylist())
            for piece in slices(batch.column(1)):
                for value, language in zip(piece, languages, strict=False):
                    seen.setdefault(language, Counter()).update(value.as_py().encode().translate(PLAIN).split())
                if sum(map(len, seen.values())) > ROOM:
                    yield from out()
        yield from out()
        give_back()

    local = df.select(*_parts(text, lang)).mapInArrow(count, "lang string, word string, n long")
    return local.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def with_ids(words: DataFrame, seed: int) -> DataFrame:
    """Adds ``id``, the number of a word under ``seed``."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            ids = pa.array([word_id(a, b.encode(), seed) for a, b in pairs], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, ids], ["lang", "word", "n", "id"])

    return words.select("lang", "word", "n").mapInArrow(number, "lang string, word string, n long, id long")


def numbered(words: DataFrame, least: int) -> tuple[DataFrame, int]:
    """Words with ids under the first seed for which no frequent word shares its id with another."""
    for seed in range(SEEDS):
        made = with_ids(words, seed)
        shared = made.groupBy("id").agg(F.count(F.lit(1)).alias("words"), F.max("n").alias("n"))
        if shared.filter((F.col("words") > 1) & (F.col("n") >= least)).isEmpty():
            return made, seed
    raise RuntimeError(f"no seed below {SEEDS} tells all frequent words apart")


class Ids(dict):
    """Numbers of one language's words, 0 for those not in the table of frequent ones."""

    def __init__(self, language: str, seed: int, table: np.ndarray):
        self.language, self.seed, self.table = language, seed, table

    def __missing__(self, word: bytes) -> int:
        number = word_id(self.language, word, self.seed)
        place = number % TABLE_BITS
        found = self[word] = number if self.table[place >> 3] >> (place & 7) & 1 else 0
        return found


def sequences(batches: Iterator[pa.RecordBatch], seed: int, table: np.ndarray) -> Iterator[list[int]]:
    """Word ids of (lang, text) rows, some texts at a time; 0 for other words and between pieces."""
    known: dict[str, Ids] = {}
    for batch in batches:
        languages = iter(batch.column(0).to_pylist())
        for piece in slices(batch.column(1)):
            out: list[int] = []
            for value, language in zip(piece, languages, strict=False):
                ids = known.get(language)
                if ids is None:
                    ids = known[language] = Ids(language, seed, table)
                for words in pieces(value.as_py()):
                    out += [ids[w] for w in words]
                    out.append(0)
            if sum(map(len, known.values())) > REMEMBERED:
                known.clear()
            yield out


def pair_counts(df: DataFrame, seed: int, words: np.ndarray, text: str, lang: str) -> DataFrame:
    """(w1, w2, n): how often pairs of frequent words occur."""
    tables = df.sparkSession.sparkContext.broadcast(words)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lefts, rights, size = [], [], 0

        def out() -> Iterator[pa.RecordBatch]:
            left, right = np.concatenate(lefts), np.concatenate(rights)
            lefts.clear()
            rights.clear()
            # Half of each id brings equal pairs together; the rare pair that lies between is a row more.
            order = left & ~0xFFFFFFFF
            order |= right & 0xFFFFFFFF
            order = np.argsort(order)
            left, right = left[order], right[order]
            del order
            changes = (left[1:] != left[:-1]) | (right[1:] != right[:-1])
            first = np.flatnonzero(np.append(len(left) > 0, changes))
            n = np.diff(np.append(first, len(left)))
            for at in range(0, len(first), BATCH_ROWS):
                some = first[at : at + BATCH_ROWS]
                columns = [left[some], right[some], n[at : at + BATCH_ROWS]]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], [*IDS[:2], "n"])

        for sequence in sequences(batches, seed, tables.value):
            ids = np.array(sequence, np.int64)
            at = np.flatnonzero((ids[:-1] != 0) & (ids[1:] != 0))
            lefts.append(ids[at])
            rights.append(ids[at + 1])
            size += len(at)
            if size > PAIRS_HELD:
                yield from out()
                size = 0
        if size:
            yield from out()
        give_back()

    local = df.select(*_parts(text, lang)).mapInArrow(count, "w1 long, w2 long, n long")
    return local.groupBy(*IDS[:2]).agg(F.sum("n").alias("n"))


def with_pair_hash(pairs: DataFrame) -> DataFrame:
    """``pair``, the hash of each row's ``w1`` and ``w2``."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = pair_hash(*(batch.column(i).to_numpy(zero_copy_only=False) for i in range(2)))
            yield pa.RecordBatch.from_arrays([pa.array(hashes)], ["pair"])

    return pairs.select(*IDS[:2]).mapInArrow(number, "pair long")


def frequent_runs(
    df: DataFrame, seed: int, words: np.ndarray, pairs: np.ndarray, text: str, lang: str
) -> DataFrame:
    """(ids): word ids of all runs of three words or more whose pairs are in the table, a 0 after each run."""
    tables = df.sparkSession.sparkContext.broadcast((words, pairs))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, paired = tables.value
        for sequence in sequences(batches, seed, known):
            ids = runs_in(sequence, paired)
            if len(ids):
                ends = np.flatnonzero(ids == 0) + 1
                ends = ends[np.append(ends[:-1] // RUN_IDS != ends[1:] // RUN_IDS, True)]
                rows = pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays([rows], ["ids"])
        give_back()

    return df.select(*_parts(text, lang)).mapInArrow(cut, "ids array<long>")


def runs_in(sequence: list[int], pairs: np.ndarray) -> np.ndarray:
    """Ids of a sequence's runs of at least three words joined by pairs of the table, a 0 after each run."""
    ids = np.array(sequence, np.int64)
    if len(ids) < 3:
        return ids[:0]
    joined = (ids[:-1] != 0) & (ids[1:] != 0)
    at = np.flatnonzero(joined)
    joined[at] = holds(pairs, pair_hash(ids[at], ids[at + 1]))
    triple = joined[:-1] & joined[1:]
    kept = np.zeros(len(ids), bool)
    for shift in range(3):
        kept[shift : shift + len(triple)] |= triple
    at = np.flatnonzero(kept)
    last = ~np.append(joined, False)[at]
    out = np.zeros(len(at) + int(last.sum()), np.int64)
    out[np.arange(len(at)) + np.cumsum(last) - last] = ids[at]
    return out


def held_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """Ids of stored runs, some rows at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, RUN_ROWS):
            yield batch.column(0).slice(at, RUN_ROWS).flatten().to_numpy(zero_copy_only=False)


def starts_of(ids: np.ndarray, table: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, starts, hashes) of the windows of three to five words within runs.

    With a table, only of windows that are in it, as are all shorter ones of the same start.
    """
    at = np.flatnonzero((ids[:-1] != 0) & (ids[1:] != 0))
    hashes = pair_hash(ids[at], ids[at + 1])
    for length in range(3, LONGEST + 1):
        more = ids[at + length - 1] != 0  # a run ends with 0, so there is an id
        at = at[more]
        hashes = pair_hash(hashes[more], ids[at + length - 1])
        if table is not None:
            more = holds(table, hashes)
            at, hashes = at[more], hashes[more]
        yield length, at, hashes


def window_table(runs: DataFrame, least: int) -> np.ndarray:
    """Bytes of a table in which the places are set whose windows of three to five words make ``least`` together.

    A task sends its sums as (bucket, places, n), one row for each bucket it met and each
    ``PAIRS_HELD`` windows; a bucket's rows meet in one group, each place at most once in a row.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def out() -> pa.RecordBatch:
            places, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            buckets, first = np.unique(places // BUCKET_BITS, return_index=True)
            inner = np.split((places % BUCKET_BITS).astype(np.uint16), first[1:])
            sums = np.split(n.astype(np.int64), first[1:])
            arrays = [pa.array(buckets.astype(np.int32)), *(pa.array([x.tobytes() for x in c], pa.binary()) for c in (inner, sums))]
            return pa.RecordBatch.from_arrays(arrays, ["bucket", "places", "n"])

        for ids in held_runs(batches):
            for _, _, hashes in starts_of(ids):
                held.append(hashes % TABLE_BITS)
                size += len(hashes)
            if size > PAIRS_HELD:
                yield out()
                size = 0
        if size:
            yield out()
        give_back()

    def add(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKET_BITS, np.int64)
        for batch in batches:
            for places, n in zip(batch.column("places"), batch.column("n"), strict=True):
                total[np.frombuffer(places.as_buffer(), np.uint16)] += np.frombuffer(n.as_buffer(), np.int64)
        bits = np.packbits(total >= least, bitorder="little")
        if bits.any():
            yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([bits.tobytes()], pa.binary())], ["bucket", "bits"])

    local = runs.mapInArrow(count, "bucket int, places binary, n binary")
    return _joined(local.groupBy("bucket").applyInArrow(add, "bucket int, bits binary"))


def phrase_counts(runs: DataFrame, frequent: np.ndarray) -> DataFrame:
    """(w1 .. w5, n): counts of phrases of 3 to 5 words that are in the table with all they begin with."""
    table = runs.sparkSession.sparkContext.broadcast(frequent)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie()

        def rows(share: float) -> Iterator[pa.RecordBatch]:
            for ids, n in runs_of(*trie.spill(share), 3):
                columns = [pa.array(np.ascontiguousarray(ids[:, i])) for i in range(LONGEST)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(n)], [*IDS, "n"])

        for ids in held_runs(batches):
            trie.add_all(windows(ids, table.value))
            while trie.size > trie.room:
                yield from rows(0.5)
        yield from rows(1.0)
        give_back()

    local = runs.mapInArrow(count, ", ".join(f"{i} long" for i in [*IDS, "n"]))
    return local.groupBy(*IDS).agg(F.sum("n").alias("n"))


def windows(ids: np.ndarray, frequent: np.ndarray) -> Iterator[tuple[int, ...]]:
    """From each word of the runs the words up to the fifth, or to the first window that is not in the table."""
    sizes = np.zeros(len(ids), np.int64)
    for length, at, _ in starts_of(ids, frequent):
        sizes[at] = length
    starts = np.flatnonzero(sizes)
    sequence = ids.tolist()
    for start, stop in zip(starts.tolist(), (starts + sizes[starts]).tolist(), strict=True):
        yield tuple(sequence[start:stop])


def _array(of: Column, size: Column) -> Column:
    return F.slice(of, F.lit(1), size)


def scored(phrases: DataFrame, words: DataFrame, percent: int = 100) -> DataFrame:
    """Candidates not inside an equally frequent one, with their lowest-scoring cut: lang, phrase, a, l, r, n, score.

    ``phrases`` (ids, a) holds every frequent phrase of at least two words, ``words`` (lang, word, n, id)
    every frequent word, with ``total``, its language's occurrences.
    """
    parts = phrases.unionByName(words.select(F.array("id").alias("ids"), F.col("n").alias("a")))
    cut = phrases.select("ids", "a", F.explode(F.sequence(F.lit(1), F.size("ids") - 1)).alias("k")).select(
        "ids", "a", "k", _array(F.col("ids"), F.col("k")).alias("left"),
        F.slice("ids", F.col("k") + 1, F.size("ids") - F.col("k")).alias("right"),
    )
    left = parts.select(F.col("ids").alias("left"), F.col("a").alias("l"))
    right = parts.select(F.col("ids").alias("right"), F.col("a").alias("r"))
    totals = words.select(F.col("id"), "lang", "total")
    cut = cut.join(left, "left").join(right, "right").join(totals, F.col("ids")[0] == F.col("id"))
    cut = cut.withColumn("score", F.expr(SCORE))
    best = cut.groupBy("ids").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("b"), F.first("a").alias("a"),
        F.first("lang").alias("lang"), F.first("total").alias("n"),
    )
    inner = F.expr(
        "flatten(transform(sequence(2, size(ids) - 1), m -> "
        "transform(sequence(1, size(ids) - m + 1), s -> slice(ids, s, m))))"
    )
    longer = phrases.filter(F.size("ids") > 2).select(F.explode(inner).alias("ids"), F.col("a").alias("longer"))
    longer = longer.groupBy("ids").agg(F.max("longer").alias("longer"))
    kept = best.join(longer, "ids", "left").filter(
        F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * percent)
    )
    spelled = kept.select("ids", F.posexplode("ids").alias("at", "id")).join(words.select("id", "word"), "id")
    spelled = spelled.groupBy("ids").agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("w"))
    spelled = spelled.select("ids", F.array_join(F.col("w.word"), " ").alias("phrase"))
    return kept.join(spelled, "ids").select("lang", "phrase", "a", "b.l", "b.r", "n", "b.score")


def best_of(found: DataFrame, top: int = TOP) -> DataFrame:
    """Each language's first ``top`` rows by score, then count, then phrase, with their ``rank``.

    Ranked in parts first, so that a language's phrases never meet in one task as a whole.
    """
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    first = F.row_number().over(Window.partitionBy("lang", part).orderBy(*order))
    few = found.withColumn("rank", first).filter(F.col("rank") <= top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    return few.withColumn("rank", rank).filter(F.col("rank") <= top)


def collocations(
    df: DataFrame,
    text: str = "text",
    lang: str = "lang",
    least: int = LEAST,
    top: int = TOP,
    percent: int = 100,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's strongest phrases of 2 to 5 words.

    Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends, and those into
    words at spaces and tabs; null texts are empty, a null language is ``und``, and only the
    two named columns are read. A phrase counts with every occurrence within a piece, ``a`` in
    all, and is a candidate at ``least``. Its score is the smallest, over the places where it
    can be cut in two, of floor(1000 * a * n / (l * r)), with ``l`` and ``r`` the counts of the
    parts and ``n`` the words of the language. Candidates inside a longer candidate that has
    at least ``percent`` percent of their occurrences are left out. Repeated rows count each; a
    table without rows or without candidates gives none.
    """
    counts = stored(word_counts(df, text, lang), "words")
    every, seed = numbered(counts, least)
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    words = every.filter(F.col("n") >= least).join(totals, "lang")
    words = stored(words.select("lang", "word", "n", "id", "total"), "frequent-words")
    known = bit_table(words, "id")
    pairs = stored(pair_counts(df, seed, known, text, lang).filter(F.col("n") >= least), "pairs")
    paired = bit_table(with_pair_hash(pairs), "pair")
    runs = stored(frequent_runs(df, seed, known, paired, text, lang), "runs")
    made = phrase_counts(runs, window_table(runs, least)).filter(F.col("n") >= least)
    ids = F.filter(F.array(*IDS), lambda w: w != 0)
    longer = made.select(ids.alias("ids"), F.col("n").alias("a"))
    phrases = pairs.select(F.array(*IDS[:2]).alias("ids"), F.col("n").alias("a")).unionByName(longer)
    phrases = stored(phrases, "phrases")
    found = stored(scored(phrases, words, percent), "scored-phrases")
    ranked = best_of(found, top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
