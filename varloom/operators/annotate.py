"""Annotating sample variants by key.

The sample is the preserved, usually small, side of a left join, and Spark cannot
broadcast a preserved side. Joining directly would therefore shuffle the whole
annotation table. Instead the annotation table is cut down where it is scanned, and only
what is left takes part in the join. How is chosen by size:

* an annotation table that Spark itself would broadcast is simply joined;
* a sample much smaller than the annotation table cuts it by position ranges, where both
  position columns are among the keys, and then by its exact keys, broadcast only while
  their measured bytes stay under a bound;
* beyond that bound, or with a sample as large as the annotation table, both sides are
  shuffled, where adaptive execution splits hot keys of the sample.

The cuts are taken from keys that are stored once, and the join uses the sample itself. A
sample that is another table each time it is read, such as one with an unordered limit,
must be stored by the caller, or its rows may be cut off. Where both sides are shuffled,
sample rows with a null in their key are read apart and never move.

A key that the annotation table repeats very often cannot be split in a left join. Such keys
are counted first and joined apart: their annotations are dealt to parts, and the few sample
rows of these keys are repeated for each part. A table that is annotated from often is stored
in buckets of its key, so that only the sample moves.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varloom.operators.lookup import annotated_only
from varloom.operators.sinks import fixed
from varloom.schema import KEY_COLUMNS
from varloom.session import new_folder

REDUCTIONS = ("auto", "keys", "none")
# Most bytes of sample keys that may be broadcast; measured, since alleles can be long.
MAX_BROADCAST_BYTES = 128 << 20
ROW_OVERHEAD = 64
# Key columns whose ranges can cut the annotation table where it is scanned.
POSITION_COLUMNS = ("chrom", "start")
# A cut pays off only if the annotation table is this many times the sample.
WORTHWHILE_RATIO = 4
MAX_LISTED_CHROMS = 200
# A key with at least this many annotations is joined in parts of about as many.
HEAVY_ROWS = 1_000_000
BUCKETS = 200

# Columns of the clinical source and the prefix of its frequency columns.
CLINICAL_COLUMNS = ("clnsig", "clndn", "clnrevstat", "clnvc", "mc")
FREQUENCY_PATTERN = "af_.*"


def stored_keys(sample: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The sample's distinct keys without nulls, written below the shared folder."""
    wanted = sample.select(*keys).na.drop().distinct()
    path = new_folder(sample.sparkSession, "sample-keys")
    wanted.write.parquet(path)
    return sample.sparkSession.read.schema(wanted.schema).parquet(path)


def sample_extent(stored: DataFrame, keys: Sequence[str] = KEY_COLUMNS) -> tuple[int, list[tuple] | None]:
    """(bytes of all keys, position range per chromosome) of stored keys.

    The ranges are None where the position is not part of the keys, or there are too many
    chromosomes or contigs to list.
    """
    weight = sum((F.octet_length(F.col(k).cast("string")) for k in keys), F.lit(ROW_OVERHEAD))
    total = F.coalesce(F.sum(weight), F.lit(0)).alias("bytes")
    if not set(POSITION_COLUMNS) <= set(keys):
        return stored.agg(total).first().bytes, None
    chrom, start = POSITION_COLUMNS
    per_chrom = stored.groupBy(chrom).agg(total, F.min(start).alias("low"), F.max(start).alias("high"))
    found = per_chrom.limit(MAX_LISTED_CHROMS + 1).collect()
    if len(found) <= MAX_LISTED_CHROMS:
        return sum(r.bytes for r in found), [(r[chrom], r.low, r.high) for r in found]
    return stored.agg(total).first().bytes, None


def near_sample(annotation: DataFrame, ranges: list[tuple] | None) -> DataFrame:
    """Rows within the sample's position range of their chromosome (a pushed filter)."""
    if ranges is None:
        return annotation
    chrom, start = (F.col(c) for c in POSITION_COLUMNS)
    near = F.lit(False)
    for name, low, high in ranges:
        near = near | ((chrom == name) & start.between(low, high))
    return annotation.filter(near)


def estimated_bytes(df: DataFrame) -> int:
    """The size Spark's own planner assumes for a table, from file sizes; runs no job."""
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size))


def broadcast_threshold(df: DataFrame) -> int:
    """Spark's own bound in bytes, whatever unit it is written in; 0 where it never broadcasts."""
    text = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")
    if text.startswith("-"):
        return 0
    return int(df.sparkSession._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text))


def reduce_annotation(
    annotation: DataFrame,
    sample: DataFrame,
    keys: Sequence[str] = KEY_COLUMNS,
    reduction: str = "auto",
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Annotation rows that can match the sample.

    Keys above ``max_bytes`` are never broadcast, also not with ``reduction="keys"``.
    """
    if reduction not in REDUCTIONS:
        raise ValueError(f"reduction must be one of {REDUCTIONS}, not {reduction!r}")
    size = estimated_bytes(annotation)
    if reduction == "none" or (reduction == "auto" and size <= broadcast_threshold(annotation)):
        return annotation
    wanted = stored_keys(sample, keys)
    weight, ranges = sample_extent(wanted, keys)
    near = near_sample(annotation, ranges)
    if weight > max_bytes or (reduction == "auto" and weight * WORTHWHILE_RATIO > size):
        return near
    return near.join(F.broadcast(wanted), list(keys), "left_semi")


def one_per_key(annotation: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One annotation per key: the least by its columns, combined before the shuffle."""
    picked = annotation.groupBy(*keys).agg(F.min(F.struct(*columns)).alias("_a"))
    return picked.select(*keys, *[F.col("_a").getField(c).alias(c) for c in columns])


def heavy_keys(annotation: DataFrame, keys: Sequence[str], heavy_rows: int) -> DataFrame:
    """(keys, _parts): keys of at least ``heavy_rows`` rows, and into how many parts they go.

    Counted with partial sums before anything moves, and stored.
    """
    counted = annotation.select(*keys).na.drop().groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    parts = F.ceil(F.col("_rows") / heavy_rows).cast("bigint")
    return fixed(counted.filter(F.col("_rows") >= heavy_rows).select(*keys, parts.alias("_parts")), "heavy-keys")


def join_in_parts(
    sample: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    heavy_rows: int,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """The left join of ``annotate``, with the annotations of heavy keys dealt to parts.

    A heavy key has annotations by its definition, so its sample rows need no outer join.
    The dealt rows are stored, as a second run of a task might deal them otherwise.
    """
    heavy = heavy_keys(right, keys, heavy_rows)
    weight = sum((F.octet_length(F.col(k).cast("string")) for k in keys), F.lit(ROW_OVERHEAD))
    size = heavy.agg(F.sum(weight)).first()[0]
    if size is None:
        return sample.join(right, list(keys), "left").select(*sample.columns, *columns)
    listed = F.broadcast(heavy) if size <= max_bytes else heavy
    named = listed.select(*keys)
    light = sample.join(named, list(keys), "left_anti").join(
        right.join(named, list(keys), "left_anti"), list(keys), "left"
    )
    part = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col("_parts")).alias("_part")
    dealt = fixed(right.join(listed, list(keys)).select(*keys, *columns, part), "dealt-annotations")
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_parts") - 1)).alias("_part")
    repeated = sample.join(listed, list(keys)).select(*sample.columns, every)
    met = repeated.join(dealt, [*keys, "_part"])
    wanted = [*sample.columns, *columns]
    return light.select(*wanted).unionByName(met.select(*wanted))


def annotate(
    sample: DataFrame,
    annotation: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str] = KEY_COLUMNS,
    reduction: str = "auto",
    dedupe_keys: bool = False,
    max_bytes: int = MAX_BROADCAST_BYTES,
    heavy_rows: int | None = None,
) -> DataFrame:
    """Every sample row with the annotation columns of its key, null where none.

    Several annotations of a key give several rows, unless ``dedupe_keys``. A null in a
    key matches nothing. Keys of ``heavy_rows`` annotations or more are joined in parts;
    without a number that is ``HEAVY_ROWS`` where Spark would shuffle the annotation, and
    with 0 no key is counted.
    """
    right = annotation.select(*keys, *columns)
    right = reduce_annotation(right, sample, keys, reduction, max_bytes)
    shuffled = estimated_bytes(right) > broadcast_threshold(right)
    if dedupe_keys:
        right = one_per_key(right, keys, columns)
    whole = rest = sample
    if shuffled:
        # Rows without a whole key match nothing; shuffled by key, all would meet in one task.
        is_whole = functools.reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
        whole, rest = sample.filter(is_whole), sample.filter(~is_whole)
    if not dedupe_keys and (heavy_rows or (heavy_rows is None and shuffled)):
        met = join_in_parts(whole, right, keys, columns, heavy_rows or HEAVY_ROWS, max_bytes)
    else:
        met = whole.join(right, list(keys), "left").select(*sample.columns, *columns)
    if not shuffled:
        return met
    nothing = [F.lit(None).cast(right.schema[c].dataType).alias(c) for c in columns]
    return met.union(rest.select(*sample.columns, *nothing))


def store_in_buckets(
    annotation: DataFrame,
    name: str,
    path: str | None = None,
    keys: Sequence[str] = KEY_COLUMNS,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Store an annotation table as the catalogue's table ``name``, in sorted buckets of its key.

    Joins by exactly these keys then move the sample only, to as many tasks as there are
    buckets. Rows are dealt by key before the write, so that a bucket is one file or few;
    adaptive execution cuts a bucket that a hot key makes large.
    """
    dealt = annotation.hint("rebalance", buckets, *[F.col(k) for k in keys])
    writer = dealt.write.bucketBy(buckets, *keys).sortBy(*keys).mode("overwrite")
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return annotation.sparkSession.table(name)


def columns_like(table: DataFrame, pattern: str) -> list[str]:
    """Columns whose whole name matches a pattern, in any case."""
    return [c for c in table.columns if re.fullmatch(pattern, c, re.IGNORECASE)]


def annotate_clinical(
    sample: DataFrame, clinical: DataFrame, significant_only: bool = False, **options
) -> DataFrame:
    """Annotate with the clinical columns present; optionally keep annotated rows only."""
    columns = [c for c in clinical.columns if c.lower() in CLINICAL_COLUMNS]
    joined = annotate(sample, clinical, columns, **options)
    return annotated_only(joined, "clnsig") if significant_only else joined


def annotate_frequencies(
    sample: DataFrame, table: DataFrame, pattern: str = FREQUENCY_PATTERN, **options
) -> DataFrame:
    """Annotate with every allele-frequency column."""
    return annotate(sample, table, columns_like(table, pattern), **options)
