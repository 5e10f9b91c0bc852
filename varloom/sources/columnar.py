"""Columnar tables: scans with column lists and predicates, and split layouts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from varloom.schema import FILE_COL, SOURCE_COL, TYPE_COL
from varloom.sources.files import exists


def scan(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Sequence[str] | None = None,
    predicate: Column | str | None = None,
    file_format: str = "parquet",
) -> DataFrame:
    """Scan a table; both the column list and the predicate reach the file reader.

    The predicate may use columns that are not selected. Several paths are read with all
    the columns any of them has.
    """
    paths = [path] if isinstance(path, str) else list(path)
    reader = spark.read.format(file_format).option("mergeSchema", str(len(paths) > 1).lower())
    try:
        df = reader.load(paths)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            raise FileNotFoundError(f"no table at {paths}") from error
        raise
    if predicate is not None:
        df = df.filter(predicate)
    return df.select(*columns) if columns else df


def scan_split(
    spark: SparkSession,
    root: str,
    partition_columns: Sequence[str] = (TYPE_COL, SOURCE_COL),
    file_format: str = "parquet",
    written: T.StructType | None = None,
    empty: T.StructType | None = None,
) -> DataFrame:
    """Scan a split layout with its directory columns read back as text.

    Left to inference a source named ``02`` would come back as the number 2. A caller
    that has just written the table passes its schema as ``written``, which saves a
    listing; ``empty`` is the schema of a table without a file to learn it from.
    """
    if not exists(spark, root):
        raise FileNotFoundError(f"no table at {root}")
    stored = written or stored_schema(spark, root, file_format) or empty
    if stored is None:
        raise FileNotFoundError(f"no file to learn the columns of {root} from")
    named = [T.StructField(c, T.StringType()) for c in partition_columns]
    body = [f for f in stored.fields if f.name not in (*partition_columns, FILE_COL)]
    table = spark.read.format(file_format).schema(T.StructType(body + named)).load(root)
    return table.drop(FILE_COL)


def stored_schema(spark: SparkSession, root: str, file_format: str = "parquet") -> T.StructType | None:
    """Columns of all files below a folder together; None where there is no file."""
    # Sources added later may have brought further columns.
    reader = spark.read.format(file_format).option("recursiveFileLookup", "true").option("mergeSchema", "true")
    try:
        return reader.load(root).schema
    except AnalysisException as error:
        if "UNABLE_TO_INFER_SCHEMA" in str(error):
            return None
        raise


def spread(df: DataFrame, parts: int = 0) -> DataFrame:
    """Spread rows over all cores if the scan would leave most of them idle.

    One large gzip file, or one row group, is a single task however heavy the work on
    its rows. Tables of at least as many partitions as cores are returned untouched, so
    nothing is shuffled at scale; others are dealt to ``parts``, if that is more.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(cores, parts)) if df.rdd.getNumPartitions() < cores else df


def type_directory(
    spark: SparkSession, root: str, variant_type: str, type_col: str = TYPE_COL
) -> str:
    """Folder of one variant type: under the root, or under ``data`` below it."""
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    for place in (root, f"{root}/data"):
        for name in (f"{type_col}={escape(variant_type)}", variant_type):
            if exists(spark, f"{place}/{name}"):
                return f"{place}/{name}"
    raise FileNotFoundError(f"no folder for type {variant_type!r} under {root}")


def scan_type(
    spark: SparkSession, root: str, variant_type: str, type_col: str = TYPE_COL
) -> DataFrame:
    """Rows of one variant type of a table laid out by type; folder values stay text."""
    folder = type_directory(spark, root, variant_type, type_col)
    base, name = folder.rsplit("/", 1)
    if not name.startswith(f"{type_col}="):
        return spark.read.parquet(folder).withColumn(type_col, F.lit(variant_type))
    below = [c for c in (SOURCE_COL,) if c in spark.read.parquet(folder).columns]
    return scan_split(spark, base, (type_col, *below)).filter(F.col(type_col) == variant_type)


def read_one(
    table: DataFrame,
    variant_type: str,
    source: str | None = None,
    type_col: str = TYPE_COL,
    source_col: str = SOURCE_COL,
) -> DataFrame:
    """One type, optionally one source, of a split table: only those folders are read."""
    chosen = table.filter(F.col(type_col) == variant_type)
    return chosen if source is None else chosen.filter(F.col(source_col) == source)
