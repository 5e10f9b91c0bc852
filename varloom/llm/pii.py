"""Personal data: fixed detectors, and a skip-chain conditional random field that adds to them.

Detectors find emails, addresses, cards and phones by form. Number- and address-like chunks
that no detector takes are the open nodes of a graph per document. Neighbouring nodes share
potentials, and so do distant nodes of equal or similar content (the same digits, the same
last digits). Loopy message passing then carries a detected kind to chunks that repeat it in
another form; what it is sure of is added, and no detected span is lost.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varloom.llm.common import fields, per_batch, stored, unit_hash

KINDS = ("email", "ip", "card", "phone")
#: Label 0 is "no personal data"; kind k has label k + 1.
LABELS = len(KINDS) + 1
#: Documents, nodes of each, and nodes in all that the field is fitted on.
TRAIN_DOCS = 10_000
TRAIN_NODES = 200
NODES_IN_ALL = 40_000
#: Marginal probability from which an open node becomes a span.
SURE = 0.9
#: Message passing ends when no message changes by more than this, or after so many rounds.
SETTLED = 1e-4
ROUNDS = 200
#: Characters between two nodes that still count as neighbours.
NEAR = 80

# The forms of the four kinds.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
ADDRESS = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

CHUNK = re.compile(r"(?<![\w+(.@-])[+(]?[0-9](?:[0-9\x20().\-]*[0-9])?(?![\w@])")
MAIL_LIKE = re.compile(r"[^\s@]+@[^\s@]+")
NOTHING = re.compile(r"[0-9@]")


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Found from each @ outwards, so that long runs of letters are read once."""
    out, past, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > past and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            out.append((start, domain.end()))
        past = domain.end() if domain else at + 1
        at = text.find("@", past)
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) of all detected spans, by kind, then start."""
    if not NOTHING.search(text):
        return []
    out = [(0, s, e) for s, e in emails(text)]
    for m in ADDRESS.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((1, m.start(), m.end()))
    for m in CARD.finditer(text):
        digits = digits_of(m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end()))
    for m in PHONE.finditer(text):
        if 9 <= len(digits_of(m[0])) <= 15:
            out.append((3, m.start(), m.end()))
    return out


@dataclass
class Graph:
    """Nodes of one document in order: spans, fixed labels (-1: open), features, and edges.

    ``edges`` holds (first node, second node, kind of edge): 0 neighbours, 1 equal content,
    2 similar content. Each node is tied to the first detected node of its content, or to the
    first node of all and to the first detected one of similar content, so evidence is one
    edge away however often a value repeats, and n repeats add at most 2 n edges.
    """

    spans: list[tuple[int, int]]
    label: np.ndarray
    features: np.ndarray
    edges: np.ndarray


def features_of(chunk: str, digits: str) -> list[float]:
    n = len(digits)
    return [
        1.0, "@" in chunk, chunk.count(".") == 3, chunk.startswith("+"), "(" in chunk, "-" in chunk, " " in chunk,
        n < 9, 9 <= n <= 12, 13 <= n <= 19, n > 19, 13 <= n <= 19 and luhn(digits),
    ]


def graph_of(text: str, base: list[tuple[int, int, int]]) -> Graph | None:
    """The document's graph, or None without open nodes, where nothing can be added."""
    taken = sorted((s, e, k) for k, s, e in base)
    merged: list[tuple[int, int, int]] = []
    for s, e, k in taken:
        if not merged or s >= merged[-1][1]:
            merged.append((s, e, k))
    covered, reach = [], 0
    for s, e, _ in taken:
        covered.append((s, e))
        reach = max(reach, e)
    free, at = [], 0
    for m in sorted([*MAIL_LIKE.finditer(text), *CHUNK.finditer(text)], key=lambda m: (m.start(), m.end())):
        s, e = m.span()
        if "@" not in m[0] and not 7 <= len(digits_of(m[0])) <= 24:
            continue
        while at < len(covered) and covered[at][1] <= s:
            at += 1
        hit = any(cs < e and ce > s for cs, ce in covered[max(0, at - 1) : at + 4])
        if not hit and (not free or s >= free[-1][1]):
            free.append((s, e))
    if not free:
        return None
    nodes = sorted([(s, e, k + 1) for s, e, k in merged] + [(s, e, -1) for s, e in free])
    edges, rows, keys, tails = [], [], [], []
    for s, e, _ in nodes:
        chunk = text[s:e]
        digits = digits_of(chunk)
        rows.append(features_of(chunk, digits))
        keys.append(chunk.lower() if "@" in chunk else digits)
        tails.append(chunk.lower().split("@")[0] if "@" in chunk else digits[-7:])
    equal, similar = {}, {}
    known_equal, known_similar = {}, {}
    for i, (_, _, label) in enumerate(nodes):
        for hubs, name in ((equal, keys[i]), (similar, tails[i])):
            hubs.setdefault(name, i)
        if label >= 0:
            known_equal.setdefault(keys[i], i)
            known_similar.setdefault(tails[i], i)
    for i, (key, tail) in enumerate(zip(keys, tails, strict=True)):
        if i and nodes[i][0] - nodes[i - 1][1] <= NEAR:
            edges.append((i - 1, i, 0))
        hub = known_equal.get(key, equal[key])
        if hub != i:
            edges.append((min(hub, i), max(hub, i), 1))
        if key not in known_equal or hub == i:
            other = known_similar.get(tail, similar[tail])
            if other != i and keys[other] != key and (tail in known_similar or hub == i):
                edges.append((min(other, i), max(other, i), 2))
    return Graph(
        [(s, e) for s, e, _ in nodes],
        np.array([k for _, _, k in nodes]),
        np.array(rows, float),
        np.array(edges, np.int64).reshape(-1, 3),
    )


@dataclass
class Field:
    """Log potentials: per feature and label, and per kind of edge between two labels."""

    unary: np.ndarray
    pair: np.ndarray


def marginals(field: Field, g: Graph) -> np.ndarray:
    """Label probabilities per node by damped sum-product message passing; fixed nodes are clamped."""
    local = g.features @ field.unary
    fixed = g.label >= 0
    local[fixed] = -1e6  # beyond what the messages of any number of repeats add up to
    local[np.flatnonzero(fixed), g.label[fixed]] = 0.0
    if not len(g.edges):
        e = np.exp(local - local.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)
    source = np.concatenate([g.edges[:, 0], g.edges[:, 1]])
    target = np.concatenate([g.edges[:, 1], g.edges[:, 0]])
    potential = np.concatenate([field.pair[g.edges[:, 2]]] * 2)
    opposite = np.roll(np.arange(len(source)), len(g.edges))
    message = np.zeros((len(source), LABELS))
    for _ in range(ROUNDS):
        belief = local.copy()
        np.add.at(belief, target, message)
        sent = (belief[source] - message[opposite])[:, :, None] + potential
        top = sent.max(1)
        fresh = top + np.log(np.exp(sent - top[:, None]).sum(1))
        change = 0.5 * (fresh - fresh.max(1, keepdims=True) - message)
        message = message + change
        if np.abs(change).max() < SETTLED:
            break
    belief = local.copy()
    np.add.at(belief, target, message)
    e = np.exp(belief - belief.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def taught(g: Graph) -> np.ndarray:
    """Labels to learn: detected kinds, and for an open node that of a node of equal content."""
    label = g.label.copy()
    for a, b, kind in g.edges.tolist() + g.edges[::-1].tolist():
        if kind:
            if label[b] < 0 <= label[a]:
                label[b] = label[a]
            elif label[a] < 0 <= label[b]:
                label[a] = label[b]
    return np.maximum(label, 0)


def fit(graphs: list[Graph], seed: int = 5) -> Field:
    """Pseudo-likelihood: each node given its features and its neighbours' labels.

    Features of half the nodes are hidden at random in each step, so that equal content
    alone must explain their labels. Each node also comes as a copy of unknown form, known
    only by one edge of equal and one of similar content: the texts hold few such repeats.
    """
    width = 12
    if not graphs:
        return Field(np.zeros((width, LABELS)), np.zeros((3, LABELS, LABELS)))
    rng = np.random.default_rng(seed)
    x, around, y = [], [], []
    for g in graphs:
        label = taught(g)
        near = np.zeros((len(label), 3, LABELS))
        for a, b, kind in g.edges.tolist():
            near[a, kind, label[b]] += 1
            near[b, kind, label[a]] += 1
        # A value that repeats often has one node with many edges; two of a sort tell as much.
        near = np.minimum(near, 2)
        x.append(g.features)
        around.append(near.reshape(len(label), -1))
        y.append(label)
        for kind in (1, 2):
            copies = np.zeros((len(label), 3, LABELS))
            copies[np.arange(len(label)), kind, label] = 1
            x.append(np.eye(1, width).repeat(len(label), 0))
            around.append(copies.reshape(len(label), -1))
            y.append(label)
    x, around, y = np.concatenate(x), np.concatenate(around), np.concatenate(y)
    w = np.zeros((width + 3 * LABELS, LABELS))
    for _ in range(300):
        shown = x * (rng.random((len(x), 1)) < 0.5)
        z = np.concatenate([shown, around], 1)
        p = np.exp((s := z @ w) - s.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        p[np.arange(len(y)), y] -= 1
        w -= 1.0 * (z.T @ p / len(y) + 1e-4 * w)
    pair = w[width:].reshape(3, LABELS, LABELS)
    return Field(w[:width], (pair + pair.swapaxes(1, 2)) / 2)


def all_spans(field: Field, text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Detected spans and those the field adds, by kind, then start.

    Only chunks that repeat something are added; form alone is the detectors' matter.
    """
    if not NOTHING.search(text):
        return base
    g = graph_of(text, base)
    if g is None:
        return base
    p = marginals(field, g)
    repeats = set(g.edges[g.edges[:, 2] > 0, :2].ravel().tolist())
    added = [
        (int(p[i].argmax()) - 1, *g.spans[i])
        for i in np.flatnonzero(g.label < 0).tolist()
        if i in repeats and p[i].argmax() and p[i].max() >= SURE
    ]
    return sorted(base + added)


def learn(df: DataFrame, text: str = "text") -> Field:
    """The field, fitted on a sample of about ``TRAIN_DOCS`` documents chosen by their hash.

    Detected spans are the only labels. Graphs of different texts with a number or @ reach
    the driver, with at most ``TRAIN_NODES`` nodes each and ``NODES_IN_ALL`` together: those
    of smallest hash. No documents: a field that adds nothing.
    """
    total = df.count()
    if not total:
        return fit([])
    kind = "array<struct<s:int,e:int,y:int,x:array<double>,a:array<int>,b:array<int>,k:array<int>>>"

    def start():
        def work(batch: pa.Array) -> pa.Array:
            out = []
            for t in batch.to_pylist():
                rows = []
                for g in [graph_of(t, base_spans(t))] if t and NOTHING.search(t) else []:
                    if g is None:
                        continue
                    for i in range(min(len(g.spans), TRAIN_NODES)):
                        ends = g.edges[(g.edges[:, 1] == i) & (g.edges[:, 0] < TRAIN_NODES)]
                        rows.append(
                            dict(s=g.spans[i][0], e=g.spans[i][1], y=int(g.label[i]), x=g.features[i].tolist(),
                                 a=ends[:, 0].tolist(), b=ends[:, 1].tolist(), k=ends[:, 2].tolist())
                        )
                out.append(rows)
            return pa.array(out, pa.list_(pa.struct([
                ("s", pa.int32()), ("e", pa.int32()), ("y", pa.int32()), ("x", pa.list_(pa.float64())),
                ("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32())), ("k", pa.list_(pa.int32())),
            ])))

        return work

    sample = df.select(F.col(text).alias("t")).withColumn("u", unit_hash("t", 17))
    sample = sample.filter((F.col("u") < TRAIN_DOCS / total) & F.col("t").rlike("[0-9@]")).dropDuplicates(["u"])
    made = stored(sample.select("u", per_batch(start, kind)("t").alias("g")).filter(F.size("g") > 0), "graphs")
    nodes = made.select("u", F.size("g").alias("n")).orderBy("u").limit(2 * TRAIN_DOCS).collect()
    fits = np.cumsum([r.n for r in nodes]) <= NODES_IN_ALL
    last = nodes[int(fits.sum()) - 1].u if fits.any() else -1.0
    graphs = []
    for row in made.filter(F.col("u") <= last).collect():
        edges = [(a, b, k) for n in row.g for a, b, k in zip(n.a, n.b, n.k, strict=True)]
        graphs.append(
            Graph(
                [(n.s, n.e) for n in row.g],
                np.array([n.y for n in row.g]),
                np.array([n.x for n in row.g]),
                np.array(edges, np.int64).reshape(-1, 3),
            )
        )
    graphs.sort(key=lambda g: (g.spans, g.label.tolist()))
    return fit(graphs)


def detected(field: Field, text: str = "text", redacted: bool = False) -> Column:
    """struct(base, spans): arrays of (kind, begin, stop), in code points, stop exclusive.

    ``base`` holds what the detectors find, ``spans`` that and what the field adds. Null and
    empty texts have none. ``redacted`` adds the text as ``redact`` leaves it with ``spans``, in
    the same pass: a second function would send the texts again, to a second Python worker of
    each task.
    """
    one = pa.list_(pa.struct([("kind", pa.string()), ("begin", pa.int64()), ("stop", pa.int64())]))

    def start():
        def named(spans):
            return [{"kind": KINDS[k], "begin": s, "stop": e} for k, s, e in spans]

        def work(batch: pa.Array) -> pa.Array:
            base, spans, texts = [], [], []
            for value in batch:
                t = value.as_py()
                found = base_spans(t or "")
                base.append(named(found))
                spans.append(named(all_spans(field, t or "", found)))
                if redacted:
                    texts.append(without(t, spans[-1]))
            columns = {"base": pa.array(base, one), "spans": pa.array(spans, one)}
            if redacted:
                columns["redacted"] = pa.array(texts, pa.string())
            return pa.StructArray.from_arrays(list(columns.values()), list(columns))

        return work

    kind = "array<struct<kind:string,begin:long,stop:long>>"
    return per_batch(start, f"base {kind}, spans {kind}" + ", redacted string" * redacted)(F.col(text))


def find(df: DataFrame, field: Field, text: str = "text") -> DataFrame:
    """Adds ``base`` and ``spans``, see ``detected``. Columns of these names are replaced."""
    return fields(df.withColumn("_pii_", detected(field, text)), "_pii_", ["base", "spans"])


def count_of(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def written(spans: str) -> Column:
    """Spans as text: kind:start:end, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["begin"].cast("string"), s["stop"].cast("string"))), ","
    )


def without(t: str | None, found: list) -> str | None:
    """One text as ``redact`` leaves it."""
    if t is None or not found:
        return t
    out, at, reach = [], 0, -1
    for s in sorted(found, key=lambda s: (s["begin"], -s["stop"])):
        if s["begin"] >= reach:
            out.append(t[max(at, 0) : s["begin"]])
            out.append(f"[{s['kind'].upper()}]")
        reach = max(reach, s["stop"])
        at = reach
    return "".join([*out, t[at:]])


def redact(text: str, spans: str) -> Column:
    """The text with each span, or run of overlapping spans, replaced by its kind in brackets.

    Overlaps show the kind of the span that starts first. Null texts stay null.
    """

    def start():
        def work(batch: pa.Array) -> pa.Array:
            rows = zip(batch.field(0).to_pylist(), batch.field(1).to_pylist(), strict=True)
            return pa.array([without(t, found) for t, found in rows], pa.string())

        return work

    return per_batch(start, "string")(F.struct(F.col(text), F.col(spans)))
