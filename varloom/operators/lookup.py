"""Queries over prepared tables: range scans, text matching, identifier lookup."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varloom.functions.lookup import in_range, text_match
from varloom.operators.sinks import fixed
from varloom.schema import SOURCE_COL, TYPE_COL
from varloom.sources.columnar import scan_split
from varloom.sources.files import file_system
from varloom.sources.listing import collect_parquet

# An IN list above this length is joined instead of being written into the plan.
MAX_LISTED_IDS = 1000
# Most files that a scan is given by name; a range that meets more of them scans the table.
MAX_NAMED_FILES = 10_000
BOUNDS_SCHEMA = "path string, chrom_low string, chrom_high string, start_low bigint, start_high bigint"


def range_scan(
    variants: DataFrame,
    low: int,
    high: int,
    chrom: str | None = None,
    limit: int | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Variants whose position lies between two bounds, both included.

    Chromosome and bounds reach the reader as pushed filters. With a limit the lowest
    positions are returned, chosen per task before anything moves.
    """
    rows = variants.filter(in_range(F.col("chrom"), F.col("start"), chrom, low, high))
    if limit is not None:
        order = [c for c in ("chrom", "start", "ref", "alt", "id") if c in variants.columns]
        rows = rows.orderBy(*order).limit(limit)
    return rows.select(*columns) if columns else rows


def read_bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task body: rows (path) -> the least and greatest chrom and start of each row group.

    Null where the footer does not tell.
    """
    import pyarrow.parquet as pq

    names = [part.split()[0] for part in BOUNDS_SCHEMA.split(", ")]
    kinds = [pa.string()] * 3 + [pa.int64()] * 2
    for batch in batches:
        found: list[list] = [[] for _ in names]
        for path in batch.column("path").to_pylist():
            fs, inner = file_system(path)
            with fs.open_input_file(inner) as stream:
                footer = pq.read_metadata(stream)
            for g in range(footer.num_row_groups):
                group = footer.row_group(g)
                told = {}
                for c in range(group.num_columns):
                    column = group.column(c)
                    if column.path_in_schema in ("chrom", "start"):
                        known = column.statistics
                        if known is not None and known.has_min_max:
                            told[column.path_in_schema] = (known.min, known.max)
                row = (path, *told.get("chrom", (None, None)), *told.get("start", (None, None)))
                for values, value in zip(found, row, strict=True):
                    values.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(found, kinds, strict=True)], names=names)


def file_bounds(spark: SparkSession, root: str) -> DataFrame:
    """Bounds of every row group of the Parquet files below a folder, read from footers and stored."""
    return fixed(collect_parquet(spark, root).select("path").mapInArrow(read_bounds, BOUNDS_SCHEMA), "file-bounds")


def overlapping_files(bounds: DataFrame, low: int, high: int, chrom: str | None = None) -> DataFrame:
    """(path) of the files with a row group that may hold a variant of the range."""
    outside = (F.col("start_high") < low) | (F.col("start_low") > high)
    if chrom is not None:
        outside = outside | (F.col("chrom_low") > chrom) | (F.col("chrom_high") < chrom)
    return bounds.filter(~F.coalesce(outside, F.lit(False))).select("path").distinct()


def range_scan_files(
    spark: SparkSession,
    root: str,
    bounds: DataFrame,
    low: int,
    high: int,
    chrom: str | None = None,
    limit: int | None = None,
    columns: Sequence[str] | None = None,
    partition_columns: Sequence[str] = (TYPE_COL, SOURCE_COL),
    max_files: int = MAX_NAMED_FILES,
) -> DataFrame:
    """``range_scan`` of a split table that opens only files whose ``file_bounds`` meet the range.

    The rows are those of a scan of the whole table, which is what a range meeting more
    than ``max_files`` files gets. Bounds are of the files as they were: read them anew
    after the table was written to.
    """
    table = scan_split(spark, root, partition_columns)
    paths = [r.path for r in overlapping_files(bounds, low, high, chrom).limit(max_files + 1).collect()]
    if not paths:
        table = table.filter(F.lit(False))
    elif len(paths) <= max_files:
        literal = [re.sub(r"([\\*?\[\]{}])", r"\\\1", p) for p in paths]
        table = spark.read.schema(table.schema).option("basePath", root).parquet(*literal)
    return range_scan(table, low, high, chrom, limit, columns)


def match_text(
    variants: DataFrame,
    column: str,
    needle: str,
    regex: bool = False,
    columns: Sequence[str] | None = None,
    limit: int | None = None,
    order_by: Sequence[str] = ("chrom", "start", "ref", "alt"),
) -> DataFrame:
    """Rows whose text holds ``needle``, literally or as a regular expression."""
    rows = variants.filter(text_match(F.col(column), needle, regex))
    if limit is not None:
        rows = rows.orderBy(*[c for c in order_by if c in variants.columns]).limit(limit)
    return rows.select(*columns) if columns else rows


def annotated_only(variants: DataFrame, column: str) -> DataFrame:
    """Rows carrying an annotation."""
    return variants.filter(F.col(column).isNotNull())


def lookup_ids(
    variants: DataFrame, ids: DataFrame | Sequence[str], id_col: str = "id"
) -> DataFrame:
    """Rows whose identifier is among ``ids`` (a list, or a one-column table).

    A short list becomes a filter of the scan. Anything longer is a semi join, where
    Spark broadcasts the identifiers only while their size stays under its threshold
    and shuffles both sides beyond it.
    """
    if not isinstance(ids, DataFrame):
        listed = list(dict.fromkeys(ids))
        if len(listed) <= MAX_LISTED_IDS:
            return variants.filter(F.col(id_col).isin(listed))
        ids = variants.sparkSession.createDataFrame([(i,) for i in listed], f"{id_col} string")
    keys = ids.select(F.col(ids.columns[0]).alias(id_col))
    return variants.join(keys, id_col, "left_semi").select(*variants.columns)
