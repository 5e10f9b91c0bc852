"""Quality scores from histogram gradient-boosted trees over document statistics."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varloom.llm.common import per_batch, texts_of, unit_hash

#: Labelled documents learned from, at most.
TRAIN_ROWS = 20_000
TREES = 60
DEPTH = 4
BINS = 64
RATE = 0.15
RIDGE = 1.0

ASCII = np.arange(128, dtype=np.uint8)
#: Byte classes counted per text: upper case, lower case, digits, spaces, line ends, high bytes,
#: sentence marks, bars, other marks.
CLASSES = np.zeros((256, 9))
for _b in range(256):
    _c = chr(_b)
    CLASSES[_b] = [
        "A" <= _c <= "Z", "a" <= _c <= "z", "0" <= _c <= "9", _c in " \t", _c in "\r\n", _b > 127,
        _c in ".,;:?'\"", _c == "|", 32 < _b < 127 and not _c.isalnum() and _c not in ".,;:?'\"|",
    ]
STATISTICS = 9 + 10


def statistics(text: str) -> list[float]:
    """Numbers that describe a text's form; an empty text has zeros."""
    data = np.frombuffer(text.encode(), np.uint8)
    if not len(data):
        return [0.0] * STATISTICS
    classes = np.bincount(data, minlength=256) @ CLASSES / len(data)
    words = text.split()
    n = max(1, len(words))
    counts = Counter(words)
    lines = [line for line in text.split("\n") if line.strip()]
    ends = sum(line.rstrip()[-1] in ".!?" for line in lines)
    return [
        *classes.tolist(),
        float(np.log1p(len(data))),
        float(np.log1p(len(words))),
        len("".join(counts)) / max(1, len(counts)),
        len(counts) / n,
        max(counts.values(), default=0) / n,
        sum(map(eq, words, words[1:])) / n,
        len(set(zip(words, words[1:], strict=False))) / n,
        len(set(lines)) / max(1, len(lines)),
        ends / max(1, len(lines)),
        sum(not w[-1].isalnum() for w in words) / n,
    ]


@dataclass
class Trees:
    """Complete trees of one depth, as flat arrays with a row per tree.

    Node i of a tree has children 2i+1 and 2i+2; rows above the threshold go right.
    """

    start: float
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row, all trees at once."""
        if not len(self.leaf):
            return np.full(len(x), 1 / (1 + np.exp(-self.start)))
        trees = np.arange(len(self.feature))
        node = np.zeros((len(x), len(trees)), np.int64)
        rows = np.arange(len(x))[:, None]
        for _ in range(DEPTH):
            node = 2 * node + 1 + (x[rows, self.feature[trees, node]] > self.threshold[trees, node])
        total = self.start + self.leaf[trees, node - (2**DEPTH - 1)].sum(1)
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray) -> Trees:
    """Logistic boosting. Without rows the score is 0.5, with one label it is close to that label."""
    none = np.zeros((0, 2**DEPTH - 1))
    if not len(y):
        return Trees(0.0, none.astype(int), none, np.zeros((0, 2**DEPTH)))
    rate = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    start = float(np.log(rate / (1 - rate)))
    if y.min() == y.max():
        return Trees(start, none.astype(int), none, np.zeros((0, 2**DEPTH)))
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(c, v) for c, v in zip(cuts, x.T, strict=True)])
    feature, threshold, leaf = [], [], []
    total = np.full(len(y), start)
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-total))
        g, h = p - y, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        names, limits = [], []
        for depth in range(DEPTH):
            width = 2**depth
            best = np.zeros(width)
            name, cut = np.zeros(width, np.int64), np.full(width, BINS)
            for f, b in enumerate(binned):
                cell = node * BINS + b
                left = np.stack([np.bincount(cell, w, width * BINS) for w in (g, h)]).reshape(2, width, BINS).cumsum(2)
                whole = left[:, :, -1:]
                right = whole - left
                gain = (
                    left[0] ** 2 / (left[1] + RIDGE) + right[0] ** 2 / (right[1] + RIDGE)
                    - whole[0] ** 2 / (whole[1] + RIDGE)
                )
                at = gain.argmax(1)
                value = gain[np.arange(width), at]
                better = value > best + 1e-9
                best[better], name[better], cut[better] = value[better], f, at[better]
            for f, c in zip(name.tolist(), cut.tolist(), strict=True):
                names.append(f)
                limits.append(cuts[f][c] if c < len(cuts[f]) else np.inf)
            node = 2 * node + (binned[name[node], np.arange(len(y))] > cut[node])
        sums = [np.bincount(node, w, 2**DEPTH) for w in (g, h)]
        value = -RATE * sums[0] / (sums[1] + RIDGE)
        total += value[node]
        feature.append(names)
        threshold.append(limits)
        leaf.append(value)
    return Trees(start, np.array(feature), np.array(threshold), np.array(leaf))


def statistics_of(text: str) -> Column:
    def start():
        return lambda batch: pa.array([statistics(t) for t in texts_of(batch)], pa.list_(pa.float64()))

    return per_batch(start, "array<double>")(F.col(text))


def learn(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality"
) -> Trees:
    """Trees fitted on at most ``TRAIN_ROWS`` labelled documents, those of smallest hash.

    ``labels`` holds rows to learn from only. Rows without a key or label are passed over;
    repeated rows count each. Only the sample's statistics reach the driver.
    """
    known = labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull())
    known = known.select(F.col(key).alias("_k_"), F.col(label).cast("double").alias("_y_"))
    total = known.count()
    if not total:
        return fit(np.zeros((0, STATISTICS)), np.zeros(0))
    hashed = known.withColumn("_u_", unit_hash("_k_", 23)).filter(F.col("_u_") < 1.1 * TRAIN_ROWS / total)
    few = hashed.orderBy("_u_", "_k_", "_y_").limit(TRAIN_ROWS).select("_k_", "_y_")
    joined = docs.select(F.col(key).alias("_k_"), F.col(text).alias("_t_")).join(F.broadcast(few), "_k_")
    got = joined.select("_k_", "_y_", statistics_of("_t_").alias("_x_")).collect()
    got.sort(key=lambda r: (r["_k_"], r["_y_"], r["_x_"]))
    x = np.array([r["_x_"] for r in got]).reshape(-1, STATISTICS)
    return fit(x, np.array([r["_y_"] for r in got]))


def score(trees: Trees, text: str = "text") -> Column:
    """The quality score of a text, 0 to 1; null texts count as empty."""

    def start():
        def work(batch: pa.Array) -> pa.Array:
            x = np.array([statistics(t) for t in texts_of(batch)]).reshape(-1, STATISTICS)
            return pa.array(trees.scores(x))

        return work

    return per_batch(start, "double")(F.col(text))
