"""Splitting a variant table by type, with allele lists expanded to rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varloom.functions.alleles import allele_count, allele_rows
from varloom.functions.paths import folder_value
from varloom.operators.reencode import check_footers
from varloom.operators.sinks import finished, fixed, last_run, latest, mark_finished, save
from varloom.schema import (
    ALLELE_SEP,
    EXPLODE_TYPES,
    LIST_COL,
    SOURCE_COL,
    TYPE_COL,
)
from varloom.sources.columnar import scan_split
from varloom.sources.files import delete_tree
from varloom.sources.listing import collect_parquet

LAYOUTS = ("rebalance", "range", "direct")
# A source that was split, and what its input was like then.
SOURCES_DONE = f"{SOURCE_COL} string, stamp string, held boolean, run bigint"


def variant_types(variants: DataFrame, type_col: str = TYPE_COL) -> DataFrame:
    """Distinct variant types."""
    return variants.select(type_col).distinct()


def variant_type_counts(variants: DataFrame, type_col: str = TYPE_COL) -> DataFrame:
    return variants.groupBy(type_col).agg(F.count(F.lit(1)).alias("n"))


def of_type(variants: DataFrame, variant_type: str, type_col: str = TYPE_COL) -> DataFrame:
    return variants.filter(F.col(type_col) == F.lit(variant_type))


def explode_alleles(
    variants: DataFrame,
    explode_types: Sequence[str] | None = EXPLODE_TYPES,
    list_col: str = LIST_COL,
    type_col: str = TYPE_COL,
    sep: str = ALLELE_SEP,
) -> DataFrame:
    """One row per allele for the given types; other rows, and null lists, stay as they are.

    ``explode_types=None`` expands every type, ``()`` none. It is one narrow pass: no
    scan per type and no shuffle.
    """
    if explode_types is not None and not explode_types:
        return variants
    alleles = allele_rows(F.col(list_col), F.col(type_col), explode_types, sep)
    before = variants.columns[: variants.columns.index(list_col)]
    after = variants.columns[len(before) + 1 :]
    return variants.select(*before, F.explode_outer(alleles).alias(list_col), *after)


def exploded_rows(
    variants: DataFrame,
    explode_types: Sequence[str] = EXPLODE_TYPES,
    list_col: str = LIST_COL,
    type_col: str = TYPE_COL,
    sep: str = ALLELE_SEP,
) -> DataFrame:
    """Rows before the split and the rows it must produce, counted without exploding."""
    grows = F.coalesce(F.col(type_col).isin(*explode_types), F.lit(False))
    rows = F.when(grows, allele_count(F.col(list_col), sep)).otherwise(F.lit(1))
    return variants.agg(
        F.count(F.lit(1)).alias("rows_in"), F.coalesce(F.sum(rows), F.lit(0)).alias("rows_out")
    )


def laid_out(
    variants: DataFrame,
    layout: str,
    partition_columns: Sequence[str],
    sort_columns: Sequence[str] = ("chrom", "start"),
) -> DataFrame:
    """Arrange rows for a partitioned write.

    * ``rebalance`` - one shuffle on the partition columns that adaptive execution cuts
      at the advisory size, so a type holding most rows still spreads over many tasks.
    * ``range`` - range partitioning on partition columns and position: files cover
      disjoint position ranges, which makes range scans skip files.
    * ``direct`` - no shuffle; each scan task writes its own rows. For large input
      splits, where every task has enough rows of each type.
    """
    order = [c for c in (*partition_columns, *sort_columns) if c in variants.columns]
    if layout == "rebalance":
        variants = variants.hint("rebalance", *[F.col(c) for c in partition_columns])
    elif layout == "range":
        variants = variants.repartitionByRange(*order)
    elif layout != "direct":
        raise ValueError(f"layout must be one of {LAYOUTS}, not {layout!r}")
    return variants.sortWithinPartitions(*order)


def split_by_type(
    spark: SparkSession,
    variants: DataFrame,
    out: str,
    explode_types: Sequence[str] | None = EXPLODE_TYPES,
    type_col: str = TYPE_COL,
    source_col: str = SOURCE_COL,
    list_col: str = LIST_COL,
    sep: str = ALLELE_SEP,
    layout: str = "rebalance",
    overwrite: bool = False,
    profile: str = "default",
    stamps: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Write a table split by type and source; returns (table, splits manifest).

    The input is scanned once however many types it holds. Sources that the output holds
    already are left as they are, unless ``overwrite``; new ones are added. ``stamps``
    (source, stamp) says what each source's input is like: a source of another stamp is
    split again in place of its old rows. A table without a source column has nothing to
    tell it from an earlier one, so it is an error where the output holds something.
    """
    missing = [c for c in (type_col, list_col) if c not in variants.columns]
    if missing:
        raise ValueError(f"columns {missing} not in the table; have {variants.columns}")
    columns = (type_col, source_col)
    records, run = None if overwrite else finished(spark, out, SOURCES_DONE), 1
    done = None if records is None else latest(records, SOURCE_COL)
    if source_col not in variants.columns:
        if done is not None:
            raise FileExistsError(f"{out} holds a table, and this one has no column {source_col!r}")
        variants = variants.withColumn(source_col, F.lit("all"))
    present = variants.select(F.col(source_col).alias(SOURCE_COL)).distinct()
    if stamps is not None:
        present = present.join(stamps.select(SOURCE_COL, "stamp"), SOURCE_COL, "left")
    else:
        present = present.withColumn("stamp", F.lit(None).cast("string"))
    if done is not None:
        same = (present[SOURCE_COL].eqNullSafe(done[SOURCE_COL])) & present["stamp"].eqNullSafe(done["stamp"])
        same = same & F.coalesce(done["held"], F.lit(True))
        present = present.join(done, same, "left_anti")
    pending = fixed(present, "pending-sources")
    if done is not None:
        if pending.isEmpty():
            table = scan_split(spark, out, columns)
            return table, split_manifest(spark, out, type_col, source_col)
        wanted = pending.select(F.col(SOURCE_COL).alias("_source"))
        variants = variants.join(wanted, F.col(source_col).eqNullSafe(F.col("_source")), "left_semi")
        run = last_run(records) + 2
        forget_sources(spark, out, pending, done, run - 1, type_col, source_col)
    rows = explode_alleles(variants, explode_types, list_col, type_col, sep)
    mode = "overwrite" if done is None else "partitions"
    save(spark, laid_out(rows, layout, columns), out, mode=mode, partition_by=columns, profile=profile)
    mark_finished(pending.select(SOURCE_COL, "stamp", F.lit(True).alias("held")), out, run)
    table = scan_split(spark, out, columns, written=rows.schema if done is None else None)
    return table, split_manifest(spark, out, type_col, source_col)


def forget_sources(
    spark: SparkSession, out: str, pending: DataFrame, done: DataFrame, run: int, type_col: str, source_col: str
) -> None:
    """Remove the folders of sources whose input has changed, one at a time.

    Records first that they are no longer held, so that a job that dies afterwards splits
    them anew whatever their input is like then.
    """
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    name = lambda value: "__HIVE_DEFAULT_PARTITION__" if value is None else escape(value)
    known = done.select(F.col(SOURCE_COL).alias("_known"))
    changed = pending.join(known, pending[SOURCE_COL].eqNullSafe(known["_known"]), "left_semi").select(SOURCE_COL)
    if changed.isEmpty():
        return
    mark_finished(changed.select(SOURCE_COL, F.lit(None).cast("string").alias("stamp"), F.lit(False).alias("held")), out, run)
    kinds = scan_split(spark, out, (type_col, source_col)).select(type_col, source_col).distinct()
    for row in kinds.join(changed, kinds[source_col].eqNullSafe(changed[SOURCE_COL]), "left_semi").toLocalIterator():
        delete_tree(spark, f"{out}/{type_col}={name(row[0])}/{source_col}={name(row[1])}")


def split_manifest(
    spark: SparkSession, out: str, type_col: str = TYPE_COL, source_col: str = SOURCE_COL
) -> DataFrame:
    """Files of a split table: variant_type, source, path, size, rows.

    From a listing of its folder and from what the files' footers say; no row is read.
    """
    files = collect_parquet(spark, out).select("path", "size")
    counted = check_footers(files).select("path", "rows")
    return files.join(counted, "path").select(
        folder_value(F.col("path"), type_col).alias("variant_type"),
        folder_value(F.col("path"), source_col).alias("source"),
        "path",
        "size",
        "rows",
    )


def merge_catalogues(manifests: Sequence[DataFrame]) -> DataFrame:
    """Union of splits manifests: the paths of every type, one row per path.

    Kept long on purpose. A list per type would gather most of the files of a data set
    in one row, as one type usually dominates.
    """
    merged = manifests[0]
    for other in manifests[1:]:
        merged = merged.unionByName(other)
    return merged


def catalogue_summary(splits: DataFrame) -> DataFrame:
    """Files, bytes and rows per variant type."""
    return splits.groupBy("variant_type").agg(
        F.count(F.lit(1)).alias("num_files"),
        F.sum("size").alias("total_size"),
        F.sum("rows").alias("total_rows"),
    )


