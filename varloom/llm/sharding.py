"""Uniform shuffles into shards of exact sizes, without any task seeing all rows.

How many rows go from each partition to each shard is a random matrix with fixed row and
column sums, drawn from its exact (hypergeometric) law. Given the matrix, each partition
deals its rows out in random order. A large shard is several targets side by side: each row
takes one at random, as the leading part of a random key would say; rows are exchanged, and
each target puts what it got in random order. Every order of all rows is then equally likely,
shards have exact sizes, and what a task draws depends on its rows and the number of shards.

The matrix is never built: its rows are the leaves of a tree of partitions, in which each
node splits its column counts between two halves. A task draws only the nodes above its own
partition, with seeds that every task shares.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from varloom.llm.common import free_names, stored

#: Rows a target holds on average at most, and bytes at the mean size of a row; a shard is
#: as many targets as it needs, side by side.
TARGET_ROWS = 200_000
TARGET_BYTES = 64 << 20
#: Tasks that the exchange has at most; targets beyond them are settled one after another.
MOST_TASKS = 20_000


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """Good ones among ``draws`` from ``good + bad``; numpy's limit on counts does not apply.

    Beyond that limit the law is inverted outwards from its mode.
    """
    if good + bad < 1_000_000_000:
        return int(rng.hypergeometric(good, bad, draws)) if draws and good else 0
    low, high = max(0, draws - bad), min(draws, good)
    log_choose = lambda n, k: math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)
    mode = min(high, max(low, (draws + 1) * (good + 1) // (good + bad + 2)))
    at_mode = math.exp(log_choose(good, mode) + log_choose(bad, draws - mode) - log_choose(good + bad, draws))
    u = rng.random() - at_mode
    up, down, p_up, p_down = mode, mode, at_mode, at_mode
    while u > 0 and (up < high or down > low):
        if up < high:
            p_up *= (good - up) * (draws - up) / ((up + 1) * (bad - draws + up + 1))
            up += 1
            u -= p_up
            if u <= 0:
                return up
        if down > low:
            p_down *= down * (bad - draws + down) / ((good - down + 1) * (draws - down + 1))
            down -= 1
            u -= p_down
            if u <= 0:
                return down
    return mode


def split(rng: np.random.Generator, counts: np.ndarray, draws: int) -> np.ndarray:
    """How many of each kind are among ``draws`` rows taken from ``counts`` of each kind."""
    total = int(counts.sum())
    if total < 1_000_000_000:
        return rng.multivariate_hypergeometric(counts, draws, method="marginals")
    out = np.zeros_like(counts)
    for i, n in enumerate(counts.tolist()):
        total -= n
        out[i] = hypergeometric(rng, n, total, draws)
        draws -= int(out[i])
    return out


def matrix_row(seed: int, before: np.ndarray, shards: np.ndarray, partition: int) -> np.ndarray:
    """Rows that ``partition`` sends to each shard. ``before``: rows ahead of each partition, then all."""
    low, high, counts = 0, len(before) - 1, shards
    while high - low > 1:
        middle = (low + high) // 2
        left = split(np.random.default_rng([seed, low, high]), counts, int(before[middle] - before[low]))
        if partition < middle:
            high, counts = middle, left
        else:
            low, counts = middle, counts - left
    return counts


def sizes(rows: int, parts: int) -> np.ndarray:
    """Sizes at most one apart that sum to ``rows``."""
    return np.full(parts, rows // parts, np.int64) + (np.arange(parts) < rows % parts)


def targets_of(of_shard: np.ndarray, size: int, target_rows: int, target_bytes: int) -> np.ndarray:
    """Targets that each shard needs, where all rows together have ``size`` bytes."""
    rows = max(1, int(of_shard.sum()))
    by_bytes = [-(-n * size // (rows * target_bytes)) for n in of_shard.tolist()]
    return np.clip(np.maximum(-(-of_shard // target_rows), by_bytes), 1, np.maximum(1, of_shard))


def shuffle(
    df: DataFrame, shards: int, seed: int = 0, target_rows: int = TARGET_ROWS, target_bytes: int = TARGET_BYTES
) -> DataFrame:
    """``df`` with ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0 within its shard).

    Shard sizes are at most one row apart. The order is uniformly random over all rows,
    equal ones included, and is fixed by ``seed`` and by how the input is partitioned. The
    input is stored once, so repeated tasks see the same rows in the same places. Columns
    named ``shard`` or ``slot`` are replaced; an empty table stays empty.
    """
    kept = df.select(*[F.col(f"`{c}`") for c in df.columns if c not in ("shard", "slot")])
    part_, at_, bytes_, to_ = free_names(kept, "_part_", "_at_", "_bytes_", "_to_")
    extended = lambda *names: StructType(
        [*kept.schema.fields, *[StructField(n, LongType() if n != "shard" else IntegerType()) for n in names]]
    )

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for b in batches:
            each = -(-b.nbytes // max(1, len(b)))
            places = [np.full(len(b), part), np.arange(at, at + len(b)), np.full(len(b), each)]
            at += len(b)
            names = [*b.schema.names, part_, at_, bytes_]
            yield pa.RecordBatch.from_arrays([*b.columns, *map(pa.array, places)], names)

    numbered = stored(kept.mapInArrow(number, extended(part_, at_, bytes_)), "numbered")
    totals = numbered.groupBy(part_).agg(F.count("*").alias("n"), F.sum(bytes_).alias("size")).collect()
    held, size = {r[part_]: r["n"] for r in totals}, sum(r["size"] for r in totals)
    place_of = {p: i for i, p in enumerate(sorted(held))}
    before = np.concatenate([[0], np.cumsum([held[p] for p in place_of])]).astype(np.int64)
    of_shard = sizes(int(before[-1]), shards)
    blocks = targets_of(of_shard, size, target_rows, target_bytes)
    first = np.cumsum(blocks) - blocks

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dealt: dict[int, np.ndarray] = {}
        for b in batches:
            part, at = b.column(part_).to_numpy(), b.column(at_).to_numpy()
            target = np.empty(len(b), np.int64)
            for p in np.unique(part).tolist():
                if p not in dealt:
                    i = place_of[p]
                    rng = np.random.default_rng([seed, i])
                    shard = rng.permutation(np.repeat(np.arange(shards), matrix_row(seed, before, of_shard, i)))
                    dealt[p] = first[shard] + (rng.random(len(shard)) * blocks[shard]).astype(np.int64)
                target[part == p] = dealt[p][at[part == p]]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(target)], [*b.schema.names, to_])

    # Targets are drawn from seeds, so the places alone tell how many rows each will get.
    places = StructType([StructField(n, LongType()) for n in (part_, at_, to_)])
    got = numbered.select(part_, at_).mapInArrow(deal, places).groupBy(to_).count().collect()
    filled = np.zeros(int(blocks.sum()), np.int64)
    filled[[r[to_] for r in got]] = [r["count"] for r in got]
    shard_of = np.repeat(np.arange(shards), blocks)
    slot_of = np.cumsum(filled) - filled - (np.cumsum(of_shard) - of_shard)[shard_of]
    plan = df.sparkSession.sparkContext.broadcast((shard_of, slot_of))

    def settle(key: tuple, rows: pa.Table) -> pa.Table:
        shard_of, slot_of = plan.value
        to = key[0].as_py()
        order = rows.sort_by([(part_, "ascending"), (at_, "ascending")]).drop_columns([part_, at_, to_])
        slot = slot_of[to] + np.random.default_rng([seed, to, 1]).permutation(len(order))
        return order.append_column("shard", pa.array(np.full(len(order), shard_of[to], np.int32))).append_column(
            "slot", pa.array(slot)
        )

    dealt = numbered.drop(bytes_).mapInArrow(deal, extended(part_, at_, to_))
    spread = dealt.repartition(min(len(filled), MOST_TASKS), to_)
    return spread.groupBy(to_).applyInArrow(settle, extended("shard", "slot"))
