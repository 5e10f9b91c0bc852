"""SimHash near-duplicates: exact pairs of close fingerprints through vantage-point trees.

A routing tree over a bounded sample cuts the fingerprints into shards by their Hamming
distance to vantage points. Each fingerprint has one home shard, and visits every shard
of lower number that its search ball reaches across a boundary: of two close fingerprints
in different shards, the one in the higher shard meets the other. A shard is searched with
a tree of its own. Linked fingerprints are then joined into components with tables of edges.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from varloom.llm.common import fields, per_batch, stored

SEED = 42
#: Near copies by ``similar_groups``: words of a shingle, and the least Jaccard similarity as a fraction.
COPY_WORDS = 5
COPY_SHARE = (4, 5)
#: MinHash bands and rows of each: a pair at exactly 0.8 shares no band once in 8 million.
BANDS, BAND_ROWS = 40, 5
#: Sets with a shingle that are compared, on average, with all its others in the first round.
FIRST_ROUND = 8
#: Nodes that are sent to all executors at most.
BROADCAST_NODES = 2_000_000
WORDS = 3
RADIUS = 2
#: Fingerprints the routing tree is drawn from, and the number a shard should hold.
ROUTING_SAMPLE = 8192
SHARD_ROWS = 40_000
LEAF = 32

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: str, words: int = WORDS, seed: int = SEED) -> int:
    """64 bits, each set if it is set in over half the shingle hashes.

    A-Z become lower case; words are runs without ASCII white space; fewer words than a
    shingle has make one shingle, no word at all gives 0.
    """
    tokens = text.encode().translate(LOWER).split()
    if not tokens:
        return 0
    if len(tokens) < words:
        grams = [b" ".join(tokens)]
    else:
        grams = map(b" ".join, zip(*[tokens[i:] for i in range(words)], strict=False))
    digest = xxhash.xxh64_digest
    hashes = np.frombuffer(b"".join([digest(g, seed) for g in grams]), np.uint8).reshape(-1, 8)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        ones += np.unpackbits(hashes[at : at + (1 << 16)], axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big")


def with_fingerprint(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``bits``, the fingerprint as a signed 64-bit number; null texts count as empty."""

    def start():
        def work(batch: pa.Array) -> pa.Array:
            got = [fingerprint(t.as_py() or "") for t in batch]
            return pa.array(np.array(got, np.uint64).view(np.int64))

        return work

    return df.withColumn("bits", per_batch(start, "long")(F.col(text)))


class Tree:
    """A vantage-point tree over distinct 64-bit values, as nested tuples.

    Inner nodes are (vantage point, boundary, inside, outside): inside holds the points at
    distance up to the boundary. Leaves are arrays of positions in ``points``.
    """

    def __init__(self, points: np.ndarray, leaf: int, seed: int = 3):
        self.points = points
        self.rng = np.random.default_rng(seed)
        self.root = self._grow(np.arange(len(points)), leaf)

    def _grow(self, rows: np.ndarray, leaf: int):
        if len(rows) <= leaf:
            return rows
        vantage = self.points[rows[self.rng.integers(len(rows))]]
        far = np.bitwise_count(self.points[rows] ^ vantage)
        boundary = int(np.partition(far, len(far) // 2)[len(far) // 2])
        if not (far > boundary).any():
            boundary -= 1
        inside = far <= boundary
        return vantage, boundary, self._grow(rows[inside], leaf), self._grow(rows[~inside], leaf)


def reaching(node, values: np.ndarray, rows: np.ndarray, radius: int) -> Iterator[tuple[object, np.ndarray]]:
    """(leaf, rows whose ball of ``radius`` meets the leaf); branches are pruned by triangle bounds."""
    stack = [(node, rows)]
    while stack:
        node, rows = stack.pop()
        if not len(rows):
            continue
        if not isinstance(node, tuple):
            yield node, rows
            continue
        vantage, boundary, inside, outside = node
        far = np.bitwise_count(values[rows] ^ vantage).astype(np.int16)
        stack.append((inside, rows[far <= boundary + radius]))
        stack.append((outside, rows[far > boundary - radius]))


def shard_groups(points: np.ndarray, asking: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Groups within one shard: (values, smallest value of the group), only for linked values.

    ``points`` live in the shard, ``asking`` are visitors from other shards; pairs of two
    visitors are left to the shards where one of them lives. Pairs are merged leaf by leaf
    and never listed as a whole.
    """
    values = np.concatenate([points, asking])
    parent = np.arange(len(values))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    tree = Tree(points, LEAF)
    for leaf, rows in reaching(tree.root, values, np.arange(len(values)), radius):
        for at in range(0, len(rows), 4096):
            some = rows[at : at + 4096]
            near = np.bitwise_count(values[some][:, None] ^ points[leaf][None]) <= radius
            near &= some[:, None] > leaf[None]
            left, right = np.nonzero(near)
            for a, b in zip(some[left].tolist(), leaf[right].tolist(), strict=True):
                a, b = root(a), root(b)
                if a != b:
                    parent[max(a, b)] = min(a, b)
    roots = np.array([root(i) for i in range(len(values))], np.int64)
    sizes = np.bincount(roots, minlength=len(values))
    linked = np.flatnonzero(sizes[roots] > 1)
    lowest = np.full(len(values), np.iinfo(np.int64).max)
    signed = values.view(np.int64)
    np.minimum.at(lowest, roots[linked], signed[linked])
    return signed[linked], lowest[roots[linked]]


def routing_tree(distinct: DataFrame, radius: int) -> tuple[object, int]:
    """A tree whose leaves are shard numbers, and their count.

    Drawn from at most ``ROUTING_SAMPLE`` fingerprints of smallest hash; it only places
    boundaries, so links are exact whatever it looks like.
    """
    total = distinct.count()
    if total <= SHARD_ROWS:
        return 0, 1
    hashed = distinct.select("bits", F.xxhash64("bits", F.lit(5)).alias("h"))
    share = min(1.0, 1.2 * ROUTING_SAMPLE / total)
    few = hashed.filter(F.pmod("h", F.lit(1 << 20)) < int(share * (1 << 20)) + 1).limit(2 * ROUTING_SAMPLE)
    sample = np.array(sorted(r.bits for r in few.select("bits").collect()), np.int64).view(np.uint64)
    shards = min(ROUTING_SAMPLE // 8, -(-total // SHARD_ROWS))
    tree = Tree(sample, -(-len(sample) // shards))
    numbers = iter(range(1 << 30))

    def numbered(node):
        if not isinstance(node, tuple):
            return next(numbers)
        return node[0], node[1], numbered(node[2]), numbered(node[3])

    root = numbered(tree.root)
    return root, next(numbers)


def links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(bits, low): each linked fingerprint with the lowest of its group in some shard.

    Two fingerprints are connected through these rows exactly if a chain of pairs within
    ``radius`` bits connects them.
    """
    root, shards = routing_tree(distinct, radius)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            signed = batch.column(0).to_numpy()
            values = signed.view(np.uint64)
            everything = np.arange(len(values))
            home = np.full(len(values), -1)
            for shard, rows in reaching(root, values, everything, 0):
                home[rows] = shard
            for shard, rows in reaching(root, values, everything, radius):
                rows = rows[home[rows] >= shard]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(rows), shard, np.int32)),
                        pa.array(signed[rows]),
                        pa.array(home[rows] == shard),
                    ],
                    ["shard", "bits", "lives"],
                )

    def search(key: tuple[Any, ...], shard: pd.DataFrame) -> pd.DataFrame:
        lives = shard["lives"].to_numpy()
        values = shard["bits"].to_numpy().view(np.uint64)
        bits, low = shard_groups(np.sort(values[lives]), np.sort(values[~lives]), radius)
        return pd.DataFrame({"bits": bits, "low": low})

    routed = distinct.select("bits").mapInArrow(route, "shard int, bits long, lives boolean")
    if shards > 1:
        routed = routed.repartition(min(shards, 2000), "shard")
    return routed.groupBy("shard").applyInPandas(search, "bits long, low long")


def components(edges: DataFrame) -> DataFrame:
    """(bits, low): each node of ``edges`` with the lowest node it is connected to.

    Alternates two steps until nothing changes: every node sends the lowest neighbour to its
    higher neighbours, then to its lower ones. Each round is a stored table; the driver sees
    one count.
    """
    edges = stored(edges.filter("bits != low").distinct(), "links")
    while True:
        both = edges.select(F.col("bits").alias("u"), F.col("low").alias("v")).union(
            edges.select(F.col("low").alias("u"), F.col("bits").alias("v"))
        )
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(lowest, "u").select(F.col("v").alias("bits"), F.col("m").alias("low"))
        large = large.filter("bits != low").distinct()
        down = large.groupBy("bits").agg(F.min("low").alias("m"))
        small = large.join(down, "bits")
        small = small.select("bits", F.col("m").alias("low")).union(
            small.filter("low != m").select(F.col("low").alias("bits"), F.col("m").alias("low"))
        )
        after = stored(small.distinct(), "links")
        if after.count() == edges.count() and after.exceptAll(edges).isEmpty():
            return after
        edges = after


def with_low(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Adds ``low`` to rows of distinct ``bits``: the lowest fingerprint each is connected to, itself included."""
    low = components(links(distinct, radius))
    rest = [c for c in distinct.columns if c != "bits"]
    return distinct.join(low, "bits", "left").select("bits", *rest, F.coalesce("low", "bits").alias("low"))


def near_duplicates(
    df: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS
) -> DataFrame:
    """(key, fingerprint, component_id) for every row of ``df``.

    Fingerprints are linked at ``radius`` or fewer differing bits; the component is the
    smallest key reachable. Rows of equal texts share a fingerprint, and so a component.
    Null texts count as empty, whose fingerprint is zero and links like any other. Rows with
    a null key take part; a component of such rows alone has a null identifier.
    """
    rows = stored(with_fingerprint(df.select(F.col(key), F.col(text))).select(key, "bits"), "fingerprints")
    lowest = stored(rows.groupBy("bits").agg(F.min(key).alias("first")), "distinct-fingerprints")
    named = with_low(lowest, radius)
    ids = named.groupBy("low").agg(F.min("first").alias("component_id"))
    by_bits = named.join(ids, "low").select("bits", "component_id")
    return rows.join(by_bits, "bits", "left").select(
        key, F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id"
    )


def shingle_set(text: str, words: int = COPY_WORDS) -> np.ndarray:
    """Sorted distinct hashes of the shingles, words as in ``fingerprint``; empty without a word."""
    tokens = text.encode().translate(LOWER).split()
    if not tokens:
        return np.zeros(0, np.uint64)
    if len(tokens) < words:
        grams = [b" ".join(tokens)]
    else:
        grams = map(b" ".join, zip(*[tokens[i:] for i in range(words)], strict=False))
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(g, SEED) for g in grams], np.uint64))


def node_of(shingles: np.ndarray) -> int:
    """A number for the set itself: texts of equal sets are one node."""
    return xxhash.xxh64_intdigest(shingles.tobytes(), SEED)


def bands_of(shingles: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """One hash per band of the smallest values under ``BAND_ROWS`` orders each."""
    least = np.full(len(factors), np.iinfo(np.uint64).max)
    for at in range(0, len(shingles), 1024):
        some = shingles[at : at + 1024, None] * factors[None, :]
        np.minimum(least, (some ^ (some >> np.uint64(29))).min(0), out=least)
    rows = least.reshape(BANDS, BAND_ROWS)
    return np.array([xxhash.xxh64_intdigest(r.tobytes(), i) for i, r in enumerate(rows)], np.uint64)


def _with_node(text: str, extra: str):
    """struct(node, bands, bits) or struct(node, shingles) of a text; null counts as empty."""

    def start():
        factors = np.random.default_rng(9).integers(1, 1 << 63, BANDS * BAND_ROWS, np.uint64) * np.uint64(2) + np.uint64(1)

        def work(batch: pa.Array) -> pa.Array:
            nodes, lists, prints = [], [], []
            for value in batch:
                whole = value.as_py() or ""
                shingles = shingle_set(whole)
                nodes.append(node_of(shingles))
                lists.append((bands_of(shingles, factors) if extra == "bands" else shingles).view(np.int64))
                if extra == "bands":
                    prints.append(fingerprint(whole))
            ends = np.cumsum([0, *map(len, lists)]).astype(np.int32)
            flat = np.concatenate([np.zeros(0, np.int64), *lists])
            columns = [pa.array(np.array(nodes, np.uint64).view(np.int64)), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))]
            if extra == "bands":
                return pa.StructArray.from_arrays([*columns, pa.array(np.array(prints, np.uint64).view(np.int64))], ["node", extra, "bits"])
            return pa.StructArray.from_arrays(columns, ["node", extra])

        return work

    return per_batch(start, f"node long, {extra} array<long>" + (", bits long" if extra == "bands" else ""))(F.col(text))


def close_by_fingerprint(rows: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(node) of ``rows`` (node, bits) whose SimHash component, as of ``near_duplicates``, holds other nodes too.

    A node comes once for each of its fingerprints: texts of one set may repeat its shingles
    unequally often.
    """
    prints = rows.groupBy("bits").agg(F.min("node").alias("x"), F.max("node").alias("y"))
    named = stored(with_low(stored(prints, "distinct-fingerprints"), radius), "fingerprint-groups")
    several = named.groupBy("low").agg(F.min("x").alias("x"), F.max("y").alias("y")).filter("x != y").select("low")
    return rows.join(named.join(several, "low").select("bits"), "bits").select("node")


def sharing_a_band(rows: DataFrame) -> DataFrame:
    """(node) of ``rows`` (node, bands) that share a MinHash band with other nodes, once for each such band."""
    bands = rows.select("node", F.explode("bands").alias("band"))
    # Bands of one node only are told by their least and greatest node.
    shared = bands.groupBy("band").agg(F.min("node").alias("x"), F.max("node").alias("y")).filter("x != y").select("band")
    return bands.join(shared, "band").select("node")


def rare_shingles(sets: DataFrame) -> DataFrame:
    """(token, node, size, n, at): the rarest shingles of each set that others have too, and in how many sets.

    Two sets as similar as ``COPY_SHARE`` share one of their ``size - ceil(share * size) + 1``
    rarest shingles, in any order that all sets agree on; ``at`` is a shingle's place in that
    order. Shingles that no other set has come first and join nothing; a set with so many of
    them has no partner, and no row here.
    """
    part, whole = COPY_SHARE
    tokens = sets.select("node", F.size("shingles").alias("size"), F.explode("shingles").alias("token"))
    common = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    held = tokens.join(common, "token").groupBy("node", "size").agg(F.sort_array(F.collect_list(F.struct("n", "token"))).alias("t"))
    held = held.withColumn("own", F.col("size") - F.size("t"))
    room = F.expr(f"cast(size - (size * {part} + {whole - 1}) div {whole} + 1 as int)") - F.col("own")
    some = F.posexplode(F.slice("t", F.lit(1), F.greatest(F.lit(0), room))).alias("at", "t")
    each = held.select("node", "size", "own", some)
    return each.select("t.token", "node", "size", "t.n", (F.col("own") + F.col("at")).alias("at"))


def similar_groups(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, component_id) for every row of ``df``, as ``near_duplicates`` but by what the texts share.

    Texts are linked if the Jaccard similarity of their five-word shingles is at least 0.8.
    Candidates are the sets that SimHash puts into one component, as ``near_duplicates`` does,
    and those further apart in bits that share a MinHash band: a fifth of the shingles changes
    some ten bits, which is beyond what the trees can search. Pairs of candidates that share one
    of their rarest shingles are compared by their whole sets. Of many sets with a shingle some are
    compared with all others, four times as many each round, until those left are connected
    or every pair has been compared; pairs already connected are spared.
    """
    rows = df.select(F.col(key), _with_node(text, "bands").alias("_n_"))
    rows = stored(rows.select(key, "_n_.*"), "shingled")
    candidates = stored(close_by_fingerprint(rows).union(sharing_a_band(rows)).distinct(), "candidates")
    nodes = F.broadcast(candidates) if candidates.count() <= BROADCAST_NODES else candidates
    sets = df.select(_with_node(text, "shingles").alias("_n_")).select("_n_.*").join(nodes, "node")
    sets = stored(sets.groupBy("node").agg(F.first("shingles").alias("shingles")), "shingle-sets")
    # A set's turn in any bucket of n sets is its fixed number times n.
    turn = F.pmod(F.xxhash64("node", F.lit(3)), F.lit(1 << 30)) / float(1 << 30) * F.col("n")
    buckets = stored(rare_shingles(sets).withColumn("turn", turn), "rare-shingles")
    part, whole = COPY_SHARE
    # Of no rows; from a list of Python it would start workers of its own on every executor.
    low = df.sparkSession.range(0).select(F.col("id").alias("bits"), F.col("id").alias("low"))
    done, now = 0, FIRST_ROUND
    # First, each set meets others by one shingle only: copies of a large group share many, and
    # would meet once for each of them.
    one = buckets.groupBy("node").agg(F.max(F.struct(-F.col("at"), "token", "n", "size", "at", "turn")).alias("o")).select("node", "o.token", "o.n", "o.size", "o.at", "o.turn")
    few = True
    while True:
        labelled = (one if few else buckets).join(low.withColumnRenamed("bits", "node"), "node", "left")
        labelled = labelled.withColumn("low", F.coalesce("low", "node"))
        apart = labelled.groupBy("token").agg(F.min("low").alias("x"), F.max("low").alias("y")).filter("x != y").select("token")
        labelled = stored(labelled.join(apart, "token"), "apart")
        some = labelled.filter((F.col("turn") >= done) & (F.col("turn") < now))
        # Behind the first shingle that both have, in the order, neither can share more than it still holds.
        pairs = some.alias("x").join(labelled.alias("y"), "token").filter(
            "(y.turn, y.node) > (x.turn, x.node) AND y.low != x.low "
            f"AND least(x.size - x.at, y.size - y.at) * {part + whole} >= (x.size + y.size) * {part}"
        )
        pairs = stored(pairs.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct(), "pairs")
        if not pairs.isEmpty():
            x = sets.select(F.col("node").alias("b"), F.col("shingles").alias("of_b"))
            y = sets.select(F.col("node").alias("a"), F.col("shingles").alias("of_a"))
            both = F.size(F.array_intersect("of_a", "of_b"))
            near = both * (part + whole) >= (F.size("of_a") + F.size("of_b")) * part
            found = pairs.join(x, "b").join(y, "a").filter(near).select(
                F.greatest("a", "b").alias("bits"), F.least("a", "b").alias("low")
            )
            low = components(low.union(found))
        if few:
            few = False
            continue
        if labelled.filter(F.col("n") > now).isEmpty():
            break
        done, now = now, 4 * now
    first = rows.groupBy("node").agg(F.min(key).alias("first"))
    named = first.join(low.withColumnRenamed("bits", "node"), "node", "left")
    named = stored(named.select("node", "first", F.coalesce("low", "node").alias("low")), "named")
    ids = named.groupBy("low").agg(F.min("first").alias("component_id"))
    return rows.join(named.join(ids, "low").select("node", "component_id"), "node", "left").select(key, "component_id")


def one_of_each(
    df: DataFrame, key: str = "doc_id", text: str = "text", groups: Callable[..., DataFrame] = near_duplicates
) -> DataFrame:
    """Rows of ``df`` without near-duplicates: the row of smallest key of each component stays.

    ``groups`` finds the components: ``near_duplicates`` or ``similar_groups``.
    Repeated rows of that key count as copies: one of them stays. Components of rows without
    a key keep all their rows, since nothing tells which is which.
    """
    found = stored(groups(df, key, text).select(key, "component_id"), "components")
    kept = found.filter(F.col(key) == F.col("component_id")).groupBy(key).agg(F.count("*").alias("_n_"))
    kept = stored(kept, "kept")
    nulls = df.filter(F.col(key).isNull())
    # At scale both sides are shuffled; asking for it keeps small inputs to the same plan,
    # and building from the keys spares a sort of the texts.
    stay = df.join(kept.hint("shuffle_hash"), key)
    again = stay.filter("_n_ > 1").drop("_n_")
    once = stay.filter("_n_ = 1").drop("_n_")
    if not kept.filter("_n_ > 1").isEmpty():
        once = once.unionByName(again.dropDuplicates([key]))
    if not found.filter(F.col(key).isNull() & F.col("component_id").isNull()).isEmpty():
        once = once.unionByName(nulls)
    return once.select(*[F.col(f"`{c}`") for c in df.columns])
