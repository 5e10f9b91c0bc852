"""Exact top-k inner products over vectors sorted by length.

Vectors are turned by the eigenvectors of their second moments (the right singular vectors),
so that a few leading coordinates carry most of a product. Candidates lie in groups of
descending length. A query stops at the first group too short to reach its k-th best score;
within a group the leading coordinates give a partial product, and what the rest can add is
bounded by Cauchy-Schwarz. Only candidates that pass the bound are multiplied in full.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from varloom.llm.common import stored

#: Rows a group of candidates and a block of queries aim at.
GROUP_ROWS = 8192
QUERY_ROWS = 4096
#: Share of the summed squares that the leading coordinates hold.
LEADING = 0.8
TILE = 1024

PACKED = "block int, longest double, rows int, ids binary, own binary, values binary"


def prepared(df: DataFrame, key: str, vector: str, scale: float) -> DataFrame:
    """(id, row, v, size): usable vectors, each component turned into floor(scale * x).

    Rows with a null key or vector, or with a null or non-finite component, take no part.
    ``row`` tells rows of equal keys apart.
    """
    x = F.col(vector).cast("array<double>")
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))
    good = df.select(F.col(key).alias("id"), x.alias("v")).filter("id is not null and v is not null")
    good = good.filter(F.forall("v", finite))
    good = good.select("id", F.transform("v", lambda c: F.floor(c * scale).cast("double")).alias("v"))
    good = good.withColumn("size", F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, c: s + c * c)))
    return stored(good.withColumn("row", F.monotonically_increasing_id()), "vectors")


def matrix(vectors: pa.Array | list, width: int) -> np.ndarray:
    """Rows of equal width; shorter vectors are filled up with zeros."""
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors.to_pylist() if isinstance(vectors, pa.Array) else vectors):
        out[i, : len(v)] = v
    return out


def rotation(vectors: DataFrame, width: int) -> tuple[np.ndarray, int]:
    """Eigenvectors of the summed outer products, largest first, and how many count as leading.

    Each task sends one width-by-width table; these are summed by cell on the cluster.
    """

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for b in batches:
            m = matrix(b.column(0), width)
            total += m.T @ m
        cell = np.arange(width * width)
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(total.ravel())], ["cell", "x"])

    cells = vectors.select("v").mapInArrow(moments, "cell long, x double").groupBy("cell").agg(F.sum("x").alias("x"))
    gram = np.zeros(width * width)
    for r in cells.collect():
        gram[r.cell] = r.x
    strength, turn = np.linalg.eigh(gram.reshape(width, width))
    strength, turn = strength[::-1].clip(0), turn[:, ::-1]
    share = np.cumsum(strength) / max(strength.sum(), 1e-300)
    return np.ascontiguousarray(turn), min(width, int(np.searchsorted(share, LEADING)) + 1)


def packed(vectors: DataFrame, width: int) -> DataFrame:
    """One row per block: identifiers, row numbers and vectors in descending length."""

    def pack(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("size", "descending"), ("id", "ascending"), ("row", "ascending")])
        m = matrix(rows.column("v").combine_chunks(), width)
        return pa.table(
            {
                "block": pa.array([key[0].as_py()], pa.int32()),
                "longest": [float(rows.column("size")[0].as_py())],
                "rows": pa.array([len(rows)], pa.int32()),
                "ids": [rows.column("id").to_numpy().astype(np.int64).tobytes()],
                "own": [rows.column("row").to_numpy().astype(np.int64).tobytes()],
                "values": [m.tobytes()],
            }
        )

    return vectors.select("block", "id", "row", "size", "v").groupBy("block").applyInArrow(pack, PACKED)


def blocks_by_length(vectors: DataFrame, target: int) -> DataFrame:
    """Adds ``block``: number 0 has the longest vectors; blocks hold about ``target`` rows.

    Cuts are quantiles of the length. Where many rows share a length the range between two
    cuts can hold far more, and is dealt into several blocks by hash.
    """
    total = vectors.count()
    parts = max(1, min(10_000, total // target))
    levels = [i / parts for i in range(1, parts)]
    cuts = sorted(set(vectors.agg(F.percentile_approx("size", levels, 100_000)).first()[0])) if levels else []
    bound = F.lit(cuts) if cuts else F.array().cast("array<double>")
    ranged = vectors.withColumn("range", F.size(F.filter(bound, lambda c: c > F.col("size"))))
    counts = {r["range"]: r["count"] for r in ranged.groupBy("range").count().collect()}
    start, table = 0, {}
    for r in sorted(counts):
        pieces = max(1, round(counts[r] / target))
        table[r] = (start, pieces)
        start += pieces
    if not table:
        return vectors.withColumn("block", F.lit(0))
    first = F.create_map(*[F.lit(v) for r, (s, _) in table.items() for v in (r, s)])[F.col("range")]
    pieces = F.create_map(*[F.lit(v) for r, (_, p) in table.items() for v in (r, p)])[F.col("range")]
    return ranged.withColumn("block", (first + F.pmod(F.xxhash64("row"), pieces)).cast("int"))


def best(
    q: np.ndarray, q_own: np.ndarray, floor: np.ndarray, c: np.ndarray, ids: np.ndarray, own: np.ndarray,
    turn: np.ndarray, leading: int, k: int,
) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """Per query the candidate ids and scores of its best k in ``c``, and the raised floors.

    ``c`` is in descending length. ``floor`` holds scores that k candidates are known to
    reach; only scores at or above it are returned.
    """
    q_turned, c_turned = q @ turn, c @ turn
    q_rest = np.sqrt((q_turned[:, leading:] ** 2).sum(1))
    c_rest = np.sqrt((c_turned[:, leading:] ** 2).sum(1))
    q_size, c_size = np.sqrt((q**2).sum(1)), np.sqrt((c**2).sum(1))
    slack = 1e-6 * (1 + q_size * c_size.max(initial=0))
    floor = floor.copy()
    got_ids: list[np.ndarray] = [np.empty(0, np.int64) for _ in q]
    got_scores: list[np.ndarray] = [np.empty(0) for _ in q]
    for at in range(0, len(c), TILE):
        tile = slice(at, at + TILE)
        active = np.flatnonzero(q_size * c_size[at] + slack >= floor)
        if not len(active):
            break
        reach = q_turned[active, :leading] @ c_turned[tile, :leading].T
        reach += q_rest[active, None] * c_rest[None, tile]
        passed = (reach + slack[active, None] >= floor[active, None]) & (own[None, tile] != q_own[active, None])
        for j, i in enumerate(active.tolist()):
            hits = np.flatnonzero(passed[j]) + at
            if not len(hits):
                continue
            scores = c[hits] @ q[i]
            keep = scores >= floor[i]
            s = np.concatenate([got_scores[i], scores[keep]])
            d = np.concatenate([got_ids[i], ids[hits[keep]]])
            order = np.lexsort((d, -s))[:k]
            got_scores[i], got_ids[i] = s[order], d[order]
            if len(order) == k:
                floor[i] = max(floor[i], s[order[-1]])
    return got_ids, got_scores, floor


def unpack(row) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, own = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["own"], np.int64)
    return ids, own, np.frombuffer(row["values"]).reshape(len(ids), -1)


def top_k(
    df: DataFrame, queries: str, k: int = 20, key: str = "vec_id", vector: str = "embedding", scale: float = 64.0
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k highest scores, ties to the smaller key.

    ``queries`` is a condition on ``id``; candidates are all usable rows but the query's own
    row. Repeated rows are candidates each, and queries each. Fewer candidates than k give
    fewer rows. Vectors of unequal width are filled up with zeros.
    """
    vectors = prepared(df, key, vector, scale)
    width = max(1, vectors.agg(F.max(F.size("v"))).first()[0] or 1)
    turn, leading = rotation(vectors, width)
    groups = stored(packed(blocks_by_length(vectors, GROUP_ROWS), width), "candidates")
    asked = vectors.filter(queries)
    pieces = max(1, -(-asked.count() // QUERY_ROWS))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("row", F.lit(3)), F.lit(pieces)).cast("int"))
    spark = df.sparkSession
    # The longest group, of bounded size, gives every query a first floor.
    head = groups.orderBy("block").limit(1).collect()
    shared = spark.sparkContext.broadcast((unpack(head[0]) if head else None, turn, leading))

    def first_floor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        longest, turn, leading = shared.value
        for b in batches:
            floors = []
            for row in b.to_pylist():
                _, q_own, q = unpack(row)
                floor = np.full(len(q), -np.inf)
                if longest:
                    ids, own, c = longest
                    floor = best(q, q_own, floor, c, ids, own, turn, leading, k)[2]
                floors.append(floor.tobytes())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(floors, pa.binary())], [*b.schema.names, "floors"])

    asking = stored(packed(asked, width).mapInArrow(first_floor, f"{PACKED}, floors binary"), "queries")
    lengths = [r["longest"] for r in groups.orderBy("block").select("longest").collect()]

    def reached(row: dict) -> int:
        """Groups to visit: those long enough for some query of the block."""
        _, _, q = unpack(row)
        size, floor = np.sqrt((q**2).sum(1)), np.frombuffer(row["floors"])
        most = (size[:, None] * np.array(lengths)[None] + 1e-6 * (1 + size[:, None]) >= floor[:, None]).any(0)
        return int(np.flatnonzero(most).max(initial=-1)) + 1

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts = pa.array([list(range(reached(r))) for r in b.to_pylist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column("block"), counts], ["asking", "groups"])

    pairs = asking.mapInArrow(visits, "asking int, groups array<int>").select("asking", F.explode("groups").alias("group"))
    left = asking.select(
        F.col("block").alias("asking"), F.col("ids").alias("q_ids"), F.col("own").alias("q_own"),
        F.col("values").alias("q_values"), "floors",
    )
    met = pairs.join(left, "asking").join(groups.withColumnRenamed("block", "group"), "group")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, turn, leading = shared.value
        for b in batches:
            for row in b.to_pylist():
                ids, own, c = unpack(row)
                q_ids, q_own, q = unpack({"ids": row["q_ids"], "own": row["q_own"], "values": row["q_values"]})
                found, scores, _ = best(q, q_own, np.frombuffer(row["floors"]), c, ids, own, turn, leading, k)
                sizes = [len(f) for f in found]
                yield pa.RecordBatch.from_pandas(
                    pd.DataFrame(
                        {
                            "query_id": np.repeat(q_ids, sizes),
                            "q_row": np.repeat(q_own, sizes),
                            "vec_id": np.concatenate(found) if found else np.empty(0, np.int64),
                            "score": (np.concatenate(scores) if scores else np.empty(0)).astype(np.int64),
                        }
                    ),
                    preserve_index=False,
                )

    wide = met.select("group", "ids", "own", "values", "q_ids", "q_own", "q_values", "floors")
    scored = wide.mapInArrow(search, "query_id long, q_row long, vec_id long, score long")
    order = Window.partitionBy("q_row").orderBy(F.desc("score"), "vec_id")
    ranked = scored.withColumn("rank", F.row_number().over(order).cast("int")).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
