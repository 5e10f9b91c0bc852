"""Rewriting tables in a smaller encoding, one table or a whole tree at a time."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varloom.functions import paths as P
from varloom.operators.sinks import fixed, is_reusable, save
from varloom.schema import SOURCE_COL
from varloom.sources.columnar import scan, scan_split
from varloom.sources.files import file_system, is_directory, modified_ms, qualified
from varloom.sources.listing import collect_parquet, list_files

FOOTER_SCHEMA = "path string, rows bigint, problem string"


def ordered(df: DataFrame, columns: Sequence[str] = ("chrom", "start")) -> DataFrame:
    """Order rows inside each task: neighbours alike encode smaller and give each row
    group a narrow position range. No shuffle."""
    present = [c for c in columns if c in df.columns]
    return df.sortWithinPartitions(*present) if present else df


def reencode(
    spark: SparkSession,
    table: str,
    out: str | None = None,
    profile: str = "compact",
    batch_size: int | None = None,
    file_format: str = "parquet",
    overwrite: bool = False,
) -> str:
    """Rewrite one table; a finished output not older than the table is reused.

    The default output names the profile, and the format if it is not Parquet.
    ``batch_size`` bounds the rows of a Parquet row group, by default at 100,000; ORC has
    no such bound.
    """
    if file_format != "parquet" and batch_size is not None:
        raise ValueError(f"batch_size needs Parquet, not {file_format}")
    ending = f".{profile}" + ("" if file_format == "parquet" else f".{file_format}")
    target = out or P.plain_path(table).removesuffix(".parquet") + ending
    if not overwrite and is_reusable(spark, target, table):
        return target
    save(
        spark,
        ordered(scan(spark, table)),
        target,
        mode="overwrite",
        profile=profile,
        file_format=file_format,
        batch_size=batch_size or (100_000 if file_format == "parquet" else None),
    )
    return target


def read_footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task body: rows (path) -> rows (path, rows, problem) from the file footers."""
    import pyarrow.parquet as pq

    for batch in batches:
        paths = batch.column("path").to_pylist()
        rows: list[int | None] = []
        problems: list[str | None] = []
        for path in paths:
            fs, inner = file_system(path)
            try:
                with fs.open_input_file(inner) as stream:
                    rows.append(pq.read_metadata(stream).num_rows)
                problems.append(None)
            except (OSError, pa.ArrowException) as error:
                rows.append(None)
                problems.append(str(error))
        yield pa.RecordBatch.from_arrays(
            [pa.array(paths, pa.string()), pa.array(rows, pa.int64()), pa.array(problems, pa.string())],
            names=["path", "rows", "problem"],
        )


def check_footers(files: DataFrame) -> DataFrame:
    """Rows of every listed Parquet file, or why its footer cannot be read."""
    return files.select("path").mapInArrow(read_footers, FOOTER_SCHEMA)


def readable_rows(rows: DataFrame) -> DataFrame:
    """(path, readable): rows of each file that can be read with all their columns.

    ``rows`` is a scan that goes on behind damaged files; of such a file it may have given
    some rows.
    """
    every = F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]) if rows.columns else F.lit(1)
    # Counting both signs of a hash makes the scan decode every column.
    return (
        rows.select(P.decoded_path(F.col("_metadata.file_path")).alias("path"), every.alias("h"))
        .groupBy("path")
        .agg((F.count_if(F.col("h") >= 0) + F.count_if(F.col("h") < 0)).alias("readable"))
    )


def damaged(footers: DataFrame, rows: DataFrame) -> DataFrame:
    """(path, rows, readable, problem) of the files that the scan ``rows`` does not give in full.

    ``rows`` as the footer says, null where that cannot be read; ``readable`` as they were
    found. The table is stored: it takes a scan of all files.
    """
    met = footers.join(readable_rows(rows), "path", "left")
    found = F.coalesce("readable", F.lit(0))
    text = F.concat_ws(" ", found.cast("string"), F.lit("of"), F.col("rows").cast("string"), F.lit("rows are readable"))
    problem = F.coalesce("problem", F.when(found < F.col("rows"), text))
    met = met.select("path", "rows", found.alias("readable"), problem.alias("problem"))
    return fixed(met.filter(F.col("problem").isNotNull()), "damaged-files")


def reencode_tree(
    spark: SparkSession,
    root: str,
    out: str,
    profile: str = "compact",
    batch_size: int = 1_000_000,
    recursive: bool = True,
    overwrite: bool = False,
    on_error: str = "fail",
    partition_by: Sequence[str] | None = None,
) -> tuple[DataFrame | None, DataFrame]:
    """Rewrite every Parquet file below a folder in one job.

    Folders of the form ``column=value`` are kept as they are when ``partition_by``
    names them. In any other tree each input file becomes the partition ``source=<its
    relative path without the suffix>``, so equal names in different folders stay apart.

    Returns (table, report of the files left out). With ``on_error="skip"`` a first scan
    reads every file; those without a readable footer, or of which not all rows could be
    read, are reported and none of their rows is rewritten. ``"fail"`` stops at the first.
    """
    if on_error not in ("fail", "skip"):
        raise ValueError(f"on_error must be fail or skip, not {on_error!r}")
    files = collect_parquet(spark, root, recursive)
    if not is_directory(spark, root):
        raise NotADirectoryError(root)
    root = qualified(spark, root)
    none = spark.createDataFrame([], "path string, rows long, readable long, problem string")
    fresh = False
    if not overwrite and is_reusable(spark, out):
        made = F.timestamp_millis(F.lit(modified_ms(spark, f"{out}/_SUCCESS")))
        fresh = files.filter(F.col("modified") > made).isEmpty()
    if fresh and on_error == "fail":
        return _tree_table(spark, out, partition_by), none
    if files.isEmpty():
        return None, none
    if on_error == "skip":
        footers = fixed(check_footers(files), "footers")
        if footers.filter(F.col("problem").isNull()).isEmpty():
            return None, footers.select("path", "rows", F.lit(0).cast("long").alias("readable"), "problem")
    # Files may differ in columns; the result has all of them.
    reader = spark.read.option("mergeSchema", "true")
    if on_error == "skip":
        # Sums of pages, where the writer left them, tell damage that still decodes.
        reader = reader.option("ignoreCorruptFiles", "true").option("parquet.page.verify-checksum.enabled", "true")
    wanted = root if recursive else f"{root}/*.parquet"
    if partition_by:
        rows = reader.option("basePath", root).load(wanted)
        columns = tuple(partition_by)
    else:
        rows = reader.option("recursiveFileLookup", str(recursive).lower()).load(wanted)
        columns = (SOURCE_COL,)
    path = P.decoded_path(F.col("_metadata.file_path"))
    broken = damaged(footers, rows) if on_error == "skip" else none
    if fresh:
        return _tree_table(spark, out, partition_by), broken
    some_broken = not broken.isEmpty()
    kept = rows.withColumn("_file", path) if some_broken else rows
    if not partition_by:
        relative = P.relative_path(path, root)
        kept = kept.withColumn(SOURCE_COL, F.regexp_replace(relative, "[.]parquet$", ""))
    if some_broken:
        kept = kept.join(broken.select(F.col("path").alias("_file")), "_file", "left_anti").drop("_file")
    kept = kept.sortWithinPartitions(*[c for c in (*columns, "chrom", "start") if c in kept.columns])
    save(
        spark,
        kept,
        out,
        mode="overwrite",
        profile=profile,
        partition_by=columns,
        batch_size=batch_size,
    )
    return _tree_table(spark, out, partition_by), broken


def _tree_table(
    spark: SparkSession, out: str, partition_by: Sequence[str] | None
) -> DataFrame:
    return scan_split(spark, out, tuple(partition_by) if partition_by else (SOURCE_COL,))


def size_report(before: DataFrame, after: DataFrame, key: str = "key") -> DataFrame:
    """Sizes before and after per key, in MB, and the percentage saved.

    Both sides hold (key, size) and may list several files per key: they are summed
    first, so the join meets each key once per side.
    """
    b = before.groupBy(key).agg(F.sum("size").alias("before"))
    a = after.groupBy(key).agg(F.sum("size").alias("after"))
    return b.join(a, key).select(
        key,
        P.megabytes(F.col("before")).alias("before_mb"),
        P.megabytes(F.col("after")).alias("after_mb"),
        P.saved_percent(F.col("before"), F.col("after")).alias("saved_percent"),
    )


def tree_sizes(spark: SparkSession, root: str) -> DataFrame:
    """(key, size) per folder of a tree, ready for :func:`size_report`."""
    files = list_files(spark, root, recursive=True)
    relative = P.relative_path(F.col("path"), qualified(spark, root))
    folder = F.regexp_extract(relative, "^(.*)/[^/]*$", 1)
    return files.select(folder.alias("key"), "size")
