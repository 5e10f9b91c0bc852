"""Benchmark decontamination: BM25 retrieval of test items by every passage, then overlap.

Test items are indexed, documents are the queries: each passage asks for all items scoring
above a threshold. Scores are shares of what an item scores against itself, so that one
threshold fits items of any length. Retrieved items are confirmed by their word shingles.
"""

from __future__ import annotations

import pickle
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from varloom.llm.common import per_batch, stored, texts_of

K1, B = 1.2, 0.75
#: Share of an item's own score that a passage must reach, then shingle overlap.
THRESHOLD = 0.6
OVERLAP = 0.8
SHINGLE = 5
#: Items per block of the index.
BLOCK = 4
#: Text bytes of the items searched for in one pass; more items take more passes.
PASS_BYTES = 16 << 20
#: Sums of a span and a block, and words (or characters cut into words), held at once.
CELLS = 1 << 20
PIECE_WORDS = 1 << 16

WORD = re.compile(r"\w+")
NO_WORD = re.compile(r"\W")
SENTENCE_END = re.compile(r"[.!?]\s+")


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def shingles(words: list | array) -> set[tuple]:
    """Five-word shingles; fewer words make one shingle, no words none."""
    if len(words) < SHINGLE:
        return {tuple(words)} if words else set()
    return set(zip(*[words[i:] for i in range(SHINGLE)], strict=False))


def question_and_answer(text: str) -> tuple[str, str]:
    """The last sentence is the answer, what precedes it the question; one sentence is both."""
    ends = [m.end() for m in SENTENCE_END.finditer(text.strip())]
    text = text.strip()
    return (text[: ends[-1]], text[ends[-1] :]) if ends and words_of(text[ends[-1] :]) else (text, text)


def share(part: set, whole: set | list) -> float:
    return sum(p in whole for p in part) / len(part) if part else 1.0


@dataclass
class Items:
    """Index of the items of one length class, numbered in blocks of ``BLOCK``.

    ``span`` is the most words an item has; passages are two spans long and start every
    span, so each occurrence lies wholly in one. Block maxima are kept by term:
    ``block_start[t]:block_start[t+1]`` within ``pairs``, ``block`` and ``block_top``; the
    postings of such a pair of term and block are ``post_start[j]:post_start[j+1]`` within
    ``item`` and ``weight``. ``parts`` are the numbers of the words of an item, of its question
    and of its answer.
    """

    span: int
    ids: list
    item: np.ndarray
    weight: np.ndarray
    pairs: np.ndarray
    post_start: np.ndarray
    block_start: np.ndarray
    block: np.ndarray
    block_top: np.ndarray
    parts: list[tuple[array, array, array]]


def length_class(words: int) -> int:
    return max(64, 1 << (words - 1).bit_length())


def build(rows: list, vocabulary: dict[str, int], span: int) -> Items:
    """``rows``: (id, text, [(term, weight)]) of one class."""
    item = np.repeat(np.arange(len(rows)), [len(r[2]) for r in rows])
    terms = np.fromiter((vocabulary[t] for r in rows for t, _ in r[2]), np.int64, len(item))
    weight = np.fromiter((w for r in rows for _, w in r[2]), np.float64, len(item))
    order = np.lexsort((item, terms))
    item, terms, weight = item[order], terms[order], weight[order]
    pairs, post_start, where = np.unique(
        terms * (len(rows) // BLOCK + 1) + item // BLOCK, return_index=True, return_inverse=True
    )
    block_top = np.zeros(len(pairs))
    np.maximum.at(block_top, where, weight)
    block_terms, block = np.divmod(pairs, len(rows) // BLOCK + 1)
    block_start = np.searchsorted(block_terms, np.arange(len(vocabulary) + 1))
    post_start = np.append(post_start, len(terms))
    numbers = lambda text: array("i", ids_of(text, vocabulary).tolist())
    parts = [tuple(map(numbers, (r[1], *question_and_answer(r[1])))) for r in rows]
    return Items(span, [r[0] for r in rows], item, weight, pairs, post_start, block_start, block, block_top, parts)


def wand(index: Items, terms: np.ndarray, blocks: np.ndarray, threshold: float) -> list[tuple[int, float]]:
    """Items of ``blocks`` that ``terms`` score ``threshold`` or more: (item, score).

    A block is left out if its maxima of these terms cannot reach the threshold together.
    Within a block, term cursors move in item order, and the pivot is the first item at
    which the maxima of the terms up to it can reach the threshold; items before it are
    passed over without being scored.
    """
    found = []
    for block in blocks.tolist():
        wanted = terms * (len(index.ids) // BLOCK + 1) + block
        at = np.minimum(np.searchsorted(index.pairs, wanted), len(index.pairs) - 1)
        at = at[index.pairs[at] == wanted]
        tops = index.block_top[at]
        if tops.sum() < threshold - 1e-9:
            continue
        ranges = [range(index.post_start[j], index.post_start[j + 1]) for j in at.tolist()]
        cursors = [[index.item[r[0]], r[0], r[-1], top] for r, top in zip(ranges, tops.tolist(), strict=True)]
        while cursors:
            cursors.sort(key=lambda c: c[0])
            reach, pivot = 0.0, None
            for c in cursors:
                reach += c[3]
                if reach >= threshold - 1e-9:
                    pivot = c[0]
                    break
            if pivot is None:
                break
            if cursors[0][0] == pivot:
                score = sum(float(index.weight[c[1]]) for c in cursors if c[0] == pivot)
                if score >= threshold - 1e-9:
                    found.append((int(pivot), score))
                past = pivot + 1
            else:
                past = pivot
            for c in cursors:
                while c[1] <= c[2] and index.item[c[1]] < past:
                    c[1] += 1
                if c[1] <= c[2]:
                    c[0] = index.item[c[1]]
            cursors = [c for c in cursors if c[1] <= c[2]]
    return found


def reach_of(index: Items, span: np.ndarray, ids: np.ndarray, spans: int) -> np.ndarray:
    """Sums of block maxima, spans by blocks, of the known terms that occur in each span.

    A common term has a maximum in most blocks, so maxima are added up some at a time.
    """
    known = ids >= 0
    size = len(index.block_start)
    span, term = np.divmod(np.unique(span[known] * size + ids[known]), size)
    width = index.block_start[term + 1] - index.block_start[term]
    ends = np.cumsum(width)
    blocks = len(index.ids) // BLOCK + 1
    reach = np.zeros(spans * blocks)
    at = 0
    while at < len(term):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CELLS, "right")))
        w = width[at:to]
        place = np.repeat(index.block_start[term[at:to]] - np.concatenate([[0], np.cumsum(w)[:-1]]), w) + np.arange(w.sum())
        cell = np.repeat(span[at:to], w) * blocks + index.block[place]
        reach += np.bincount(cell, index.block_top[place], len(reach))
        at = to
    return reach.reshape(spans, blocks)


def candidates(index: Items, ids: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """(document, first word, blocks) of the passages whose block maxima can reach the threshold.

    Maxima are summed per span; a passage, being two spans, is bounded by their sum.
    ``bounds`` are the documents' first words within ``ids``. Spans are taken in pieces, each
    with the span behind it, so what is held depends neither on the texts nor on the items.
    """
    spans = np.maximum(1, -(-np.diff(bounds) // index.span))
    doc = np.repeat(np.arange(len(spans)), spans)
    first = np.cumsum(spans) - spans
    begin = bounds[doc] + (np.arange(len(doc)) - first[doc]) * index.span
    stop = np.minimum(begin + index.span, bounds[doc + 1])
    step = max(1, min(CELLS // (len(index.ids) // BLOCK + 1), PIECE_WORDS // index.span))
    for s in range(0, len(doc), step):
        e = min(s + step + 1, len(doc))
        span = np.repeat(np.arange(e - s), stop[s:e] - begin[s:e])
        reach = reach_of(index, span, ids[begin[s] : stop[e - 1]], e - s)
        follows = np.append(doc[s + 1 : e] == doc[s : e - 1], False)
        both = reach + np.where(follows[:, None], np.roll(reach, -1, 0), 0)
        hits = both[:step] >= THRESHOLD - 1e-9
        for i in np.flatnonzero(hits.any(1)).tolist():
            yield int(doc[s + i]), int(begin[s + i]), np.flatnonzero(hits[i])


def ids_of(text: str, vocabulary: dict[str, int]) -> np.ndarray:
    """Numbers of a text's words, -1 for words of no item. Words are made some at a time."""
    text, at, out = text.lower(), 0, [np.empty(0, np.int32)]
    while at < len(text):
        end = NO_WORD.search(text, min(len(text), at + PIECE_WORDS))
        to = end.start() if end else len(text)
        words = WORD.findall(text, at, to)
        out.append(np.fromiter(map(vocabulary.get, words, repeat(-1)), np.int32, len(words)))
        at = to
    return np.concatenate(out)


def search(indexes: list[Items], vocabulary: dict[str, int], texts: list[str]) -> list[list[tuple]]:
    """Per text: (id, score, overlap, question_overlap, answer_overlap) of the items it leaks."""
    lists = [ids_of(t, vocabulary) for t in texts]
    bounds = np.concatenate([[0], np.cumsum([len(w) for w in lists], dtype=np.int64)])
    ids = np.concatenate(lists) if len(lists) > 1 else lists[0]
    del lists
    found: list[dict] = [{} for _ in texts]
    for index in indexes:
        for d, begin, blocks in candidates(index, ids, bounds):
            passage = ids[begin : min(begin + 2 * index.span, int(bounds[d + 1]))]
            terms = np.unique(passage)
            hits = wand(index, terms[terms >= 0], blocks, THRESHOLD)
            if not hits:
                continue
            passage = passage.tolist()
            grams, present = shingles(passage), set(passage)
            for i, score in hits:
                whole, question = map(shingles, index.parts[i][:2])
                answer = set(index.parts[i][2])
                for part in (whole, question):
                    short = next(iter(part)) if len(part) == 1 else ()
                    if 0 < len(short) < SHINGLE:
                        grams = grams | set(zip(*[passage[k:] for k in range(len(short))], strict=False))
                o, q, a = share(whole, grams), share(question, grams), share(answer, present)
                if o >= OVERLAP or (q >= OVERLAP and a >= OVERLAP):
                    known = found[d].get((index.span, i))
                    if known is None or (o, score) > (known[2], known[1]):
                        found[d][index.span, i] = (index.ids[i], score, o, q, a)
    return [list(f.values()) for f in found]


def impacts(items: DataFrame, key: str, text: str) -> DataFrame:
    """(row, id, text, term, weight): BM25 weights over all items, as shares of the item's own sum."""
    start = lambda: lambda batch: pa.array([words_of(t) for t in texts_of(batch)], pa.list_(pa.string()))
    rows = items.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("id"), F.col(text).alias("text"))
    rows = stored(rows.filter("text is not null").withColumn("words", per_batch(start, "array<string>")(F.col("text"))), "items")
    rows = rows.filter(F.size("words") > 0).withColumn("length", F.size("words"))
    total = rows.agg(F.count("*").alias("n"), F.avg("length").alias("mean")).first()
    tf = rows.select("row", "length", F.explode("words").alias("term")).groupBy("row", "length", "term").count()
    df = tf.groupBy("term").agg(F.count("*").alias("df"))
    idf = F.log(1 + (F.lit(float(total.n)) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    norm = F.col("count") + K1 * (1 - B + B * F.col("length") / F.lit(total["mean"] or 1.0))
    raw = tf.join(df, "term").select("row", "term", (idf * F.col("count") * (K1 + 1) / norm).alias("w"))
    lists = raw.groupBy("row").agg(F.collect_list(F.struct("term", "w")).alias("terms"), F.sum("w").alias("self"))
    return rows.select("row", "id", "text", "length").join(lists, "row")


def find_leaks(
    df: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    key: str = "item_id",
    item_text: str = "text",
    into: str = "leaks",
) -> DataFrame:
    """Adds ``into``: the test items each text repeats, an array of structs, empty if none.

    An item counts as leaked if a passage reaches ``THRESHOLD`` of its score and then holds
    ``OVERLAP`` of its five-word shingles, or of its question's shingles and its answer's
    words. Null texts, items without a word and an empty benchmark leak nothing. Repeated
    items are found each. A column of that name is replaced.
    """
    kind = benchmark.schema[key].dataType
    made = StructType(
        [StructField("item_id", kind)]
        + [StructField(n, DoubleType()) for n in ("score", "overlap", "question_overlap", "answer_overlap")]
    )
    weighted = stored(impacts(benchmark, key, item_text), "impacts")
    size = weighted.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = -(-size // PASS_BYTES)
    found = []
    for number in range(passes):
        part = weighted.filter(F.pmod(F.xxhash64("row"), F.lit(passes)) == number)
        found.append(_leaks_of_pass(df, part.orderBy("row").toArrow(), text, made))
    empty = F.array().cast(ArrayType(made))
    return df.withColumn(into, F.concat(*found) if found else empty)


def _leaks_of_pass(df: DataFrame, items: pa.Table, text: str, made: StructType):
    # Columns, not rows: a pass has a few million terms, most of them repeated.
    flat = items["terms"].combine_chunks().flatten()
    coded = pc.dictionary_encode(flat.field("term"))
    names = coded.dictionary.to_pylist()
    vocabulary = {t: i for i, t in enumerate(names)}
    codes, weights = coded.indices.to_numpy(), flat.field("w").to_numpy()
    ends = np.cumsum(pc.list_value_length(items["terms"]).to_numpy())
    ids, texts = items["id"].to_pylist(), items["text"]
    classes: dict[int, list] = {}
    for i, (length, own) in enumerate(zip(items["length"].to_pylist(), items["self"].to_pylist(), strict=True)):
        at = slice(ends[i - 1] if i else 0, ends[i])
        terms = [(names[c], w) for c, w in zip(codes[at].tolist(), (weights[at] / own).tolist(), strict=True)]
        classes.setdefault(length_class(length), []).append((ids[i], texts[i].as_py(), terms))
    indexes = [build(rs, vocabulary, span) for span, rs in sorted(classes.items())]
    # As bytes that carry their classes along: executors need no copy of this package.
    shared = df.sparkSession.sparkContext.broadcast(cloudpickle.dumps((indexes, vocabulary)))
    kind = pa.list_(to_arrow_type(made))
    names = made.names

    def start():
        indexes, vocabulary = pickle.loads(shared.value)

        def work(batch: pa.Array) -> pa.Array:
            out = search(indexes, vocabulary, texts_of(batch))
            return pa.array([[dict(zip(names, x, strict=True)) for x in xs] for xs in out], kind)

        return work

    return per_batch(start, ArrayType(made))(F.col(text))
