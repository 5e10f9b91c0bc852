"""Language identification by a small byte convolutional network, trained in numpy.

The network reads fixed windows of bytes: an embedding per byte, filters of several widths,
the largest response of each filter in the window, and a softmax over the languages.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from varloom.llm.common import fields, per_batch, stored, texts_of, unit_hash

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBEDDING = 8
#: Documents learned from per language and in all languages, and windows from each.
DOCS_PER_LANG = 400
DOCS_IN_ALL = 80_000
WINDOWS_PER_DOC = 3
EPOCHS = 10
UNDETERMINED = "und"


@dataclass
class Network:
    languages: list[str]
    embedding: np.ndarray
    filters: list[np.ndarray]
    offsets: list[np.ndarray]
    dense: np.ndarray
    bias: np.ndarray

    def weights(self) -> list[np.ndarray]:
        return [self.embedding, *self.filters, *self.offsets, self.dense, self.bias]


def windows_of(data: bytes, size: int = WINDOW) -> np.ndarray:
    """All bytes in rows of ``size``, zeros after the end."""
    count = max(1, -(-len(data) // size))
    rows = np.zeros(count * size, np.uint8)
    rows[: len(data)] = np.frombuffer(data, np.uint8)
    return rows.reshape(count, size)


def new_network(languages: list[str], seed: int) -> Network:
    rng = np.random.default_rng(seed)
    small = lambda *shape: rng.normal(0, (2 / shape[0]) ** 0.5, shape).astype(np.float32)
    return Network(
        languages,
        rng.normal(0, 0.5, (256, EMBEDDING)).astype(np.float32),
        [small(w * EMBEDDING, FILTERS) for w in WIDTHS],
        [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
        small(len(WIDTHS) * FILTERS, len(languages)),
        np.zeros(len(languages), np.float32),
    )


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def gradients(net: Network, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """Cross-entropy gradients of one batch, in the order of ``Network.weights``."""
    n, length = x.shape
    embedded = net.embedding[x]
    pooled, seen = [], []
    for w, kernel, offset in zip(WIDTHS, net.filters, net.offsets, strict=True):
        spans = np.lib.stride_tricks.sliding_window_view(embedded, w, 1).swapaxes(2, 3)
        spans = np.ascontiguousarray(spans).reshape(n, length - w + 1, -1)
        response = spans @ kernel
        best = response.argmax(1)
        value = np.take_along_axis(response, best[:, None], 1)[:, 0] + offset
        pooled.append(np.maximum(value, 0))
        seen.append((spans, best, value > 0))
    hidden = np.concatenate(pooled, 1)
    error = softmax(hidden @ net.dense + net.bias)
    error[np.arange(n), y] -= 1
    error /= n
    back = error @ net.dense.T
    d_embedding = np.zeros_like(net.embedding)
    d_filters, d_offsets = [], []
    for i, (w, (spans, best, alive)) in enumerate(zip(WIDTHS, seen, strict=True)):
        g = back[:, i * FILTERS : (i + 1) * FILTERS] * alive
        chosen = spans[np.arange(n)[:, None], best]
        d_filters.append(np.einsum("nfk,nf->kf", chosen, g))
        d_offsets.append(g.sum(0))
        d_span = g[:, :, None] * net.filters[i].T[None]
        for k in range(w):
            where = np.take_along_axis(x, best + k, 1)
            np.add.at(d_embedding, where, d_span[:, :, k * EMBEDDING : (k + 1) * EMBEDDING])
    return [d_embedding, *d_filters, *d_offsets, hidden.T @ error, error.sum(0)]


def train(x: np.ndarray, y: np.ndarray, languages: list[str], seed: int = 7) -> Network:
    """Adam over shuffled batches; the same rows in the same order give the same network."""
    net, rng = new_network(languages, seed), np.random.default_rng(seed)
    first = [np.zeros_like(w) for w in net.weights()]
    second = [np.zeros_like(w) for w in net.weights()]
    step = 0
    for epoch in range(EPOCHS):
        rate = 0.01 * (1 - epoch / EPOCHS) + 0.001
        order = rng.permutation(len(x))
        for at in range(0, len(x), 64):
            rows = order[at : at + 64]
            step += 1
            for w, g, m, v in zip(net.weights(), gradients(net, x[rows], y[rows]), first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-7)
    return net


def probabilities(net: Network, x: np.ndarray) -> np.ndarray:
    """Softmax per window. Rows are taken in small blocks, so memory does not grow.

    All widths run as one product: a narrower filter has zeros for the bytes it does not
    read, and positions where it would leave the window are left out of its maximum.
    """
    widest, length = max(WIDTHS), x.shape[1]
    kernel = np.zeros((widest * EMBEDDING, len(WIDTHS) * FILTERS), np.float32)
    for i, (w, filters) in enumerate(zip(WIDTHS, net.filters, strict=True)):
        kernel[: w * EMBEDDING, i * FILTERS : (i + 1) * FILTERS] = filters
    offset = np.concatenate(net.offsets)
    out = np.empty((len(x), len(net.languages)), np.float32)
    for at in range(0, len(x), 32):
        rows = np.pad(x[at : at + 32], ((0, 0), (0, widest - 1)))
        spans = np.lib.stride_tricks.sliding_window_view(net.embedding.take(rows, 0), widest, 1).swapaxes(2, 3)
        response = (np.ascontiguousarray(spans).reshape(-1, widest * EMBEDDING) @ kernel).reshape(len(rows), length, -1)
        for i, w in enumerate(WIDTHS):
            response[:, length - w + 1 :, i * FILTERS : (i + 1) * FILTERS] = -np.inf
        out[at : at + 32] = softmax(np.maximum(response.max(1) + offset, 0) @ net.dense + net.bias)
    return out


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> Network | None:
    """A network from rows of known language; None if there is none.

    Every language is learned, from at most ``DOCS_PER_LANG`` documents or an equal share of
    ``DOCS_IN_ALL``: those of smallest hash, with ``WINDOWS_PER_DOC`` windows each; only
    these windows reach the driver. More than ``DOCS_IN_ALL`` languages are an error.
    """
    rows = labelled.select(F.col(key).alias("k"), F.col(lang).alias("l"), F.col(text).alias("t"))
    rows = rows.filter("l is not null and t is not null and t != ''")
    counts = stored(rows.groupBy("l").agg(F.count("*").alias("n")), "languages")
    languages = sorted(r.l for r in counts.select("l").limit(DOCS_IN_ALL + 1).collect())
    if len(languages) > DOCS_IN_ALL:
        raise ValueError(f"more than {DOCS_IN_ALL} values of {lang!r}: not a column of languages")
    if not languages:
        return None
    most = min(DOCS_PER_LANG, DOCS_IN_ALL // len(languages))
    share = counts.select("l", ((2.0 * most + 20.0) / F.col("n")).alias("share"))
    cut = per_batch(_cutter, "array<binary>")
    few = (
        rows.withColumn("u", unit_hash("k", 11))
        .join(F.broadcast(share), "l")
        .filter(F.col("u") < F.col("share"))
        .withColumn("r", F.row_number().over(Window.partitionBy("l").orderBy("u", "k", F.xxhash64("t"))))
        .filter(F.col("r") <= most)
        .select("l", "r", F.posexplode(cut("t")).alias("p", "w"))
    )
    got = sorted(few.collect(), key=lambda r: (r.r, r.l, r.p))
    number = {l: i for i, l in enumerate(languages)}
    x = np.array([np.frombuffer(r.w, np.uint8) for r in got])
    y = np.array([number[r.l] for r in got])
    return train(x, y, languages)


def _cutter():
    def cut(batch: pa.Array) -> pa.Array:
        out = []
        for text in texts_of(batch):
            rows = windows_of(text.encode())
            where = np.unique(np.linspace(0, len(rows) - 1, WINDOWS_PER_DOC).astype(int))
            out.append([rows[i].tobytes() for i in where])
        return pa.array(out, pa.list_(pa.binary()))

    return cut


def language(net: Network | None, text: str = "text") -> Column:
    """struct(lang_pred, score): the likeliest language over all windows of the text.

    Window probabilities are averaged by the bytes in the window. Null or empty texts, texts
    without a letter, and every text if nothing was learned get ``und`` and score 0.
    """

    def start():
        def work(batch: pa.Array) -> pa.Array:
            texts = texts_of(batch)
            langs, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
            pending, size = [], 0
            for i, t in enumerate(texts):
                if net and has_letter(t):
                    rows = windows_of(data := t.encode())
                    pending.append((i, rows, len(data)))
                    size += len(rows)
                if pending and (size > 4096 or i == len(texts) - 1):
                    settle(pending, langs, scores)
                    pending, size = [], 0
            if pending:
                settle(pending, langs, scores)
            return pa.StructArray.from_arrays([pa.array(langs), pa.array(scores)], ["lang_pred", "score"])

        def settle(pending, langs, scores) -> None:
            p = probabilities(net, np.concatenate([rows for _, rows, _ in pending]))
            at = 0
            for i, rows, length in pending:
                weight = np.full(len(rows), WINDOW)
                weight[-1] = length - WINDOW * (len(rows) - 1)
                mean = weight @ p[at : at + len(rows)] / length
                at += len(rows)
                langs[i], scores[i] = net.languages[int(mean.argmax())], min(1.0, float(mean.max()))

        return work

    return per_batch(start, "lang_pred string, score double")(F.col(text))


def identify(df: DataFrame, net: Network | None, text: str = "text") -> DataFrame:
    """Adds ``lang_pred`` and ``score``, see ``language``. Columns of these names are replaced."""
    return fields(df.withColumn("_lang_", language(net, text)), "_lang_", ["lang_pred", "score"])
