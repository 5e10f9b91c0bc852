"""File listings as DataFrames ("manifests"); no file body is ever read.

A listing is stored once below the shared folder and read from there by whatever uses it.

Spark skips names starting with ``_`` or ``.`` and files of zero bytes, so neither
appears in a manifest.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varloom.functions import paths as P
from varloom.session import new_folder
from varloom.sources.files import qualified


def with_names(files: DataFrame) -> DataFrame:
    """Add ``name`` and ``is_variant_file`` to rows holding a ``path``."""
    name = P.base_name(F.col("path"))
    return files.withColumn("name", name).withColumn("is_variant_file", P.is_variant_file(name))


def matching(files: DataFrame, pattern: str | None) -> DataFrame:
    """Keep rows whose file name contains a match of ``pattern``."""
    if not pattern:
        return files
    return files.filter(F.regexp_like(P.base_name(F.col("path")), F.lit(pattern)))


def list_files(
    spark: SparkSession,
    location: str | list[str],
    pattern: str | None = None,
    recursive: bool = False,
    glob: str | None = None,
) -> DataFrame:
    """Manifest of a folder, file or glob: path, name, size, modified, is_variant_file.

    Spark packs files into tasks by their length, though none is opened here. A session of
    its own lifts the bound on a task's bytes, so that a listing takes as many tasks as
    there are cores, not one per large file.
    """
    lister = spark.newSession()
    lister.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 60))
    reader = lister.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    places = [location] if isinstance(location, str) else list(location)
    try:
        found = reader.load(places)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            raise FileNotFoundError(f"nothing at {places}") from error
        raise
    files = found.select(
        P.plain_path_col(F.col("path")).alias("path"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("modified"),
    )
    is_glob = any(c in place for place in places for c in "*?[{")
    if not recursive and not is_glob:
        below = [P.relative_path(F.col("path"), qualified(spark, p)) for p in places]
        direct = [b.isNotNull() & ~F.contains(b, F.lit("/")) for b in below]
        is_place_itself = reduce(and_, [b.isNull() for b in below])
        files = files.filter(reduce(or_, direct, is_place_itself))
    files = matching(files, pattern)
    named = with_names(files).select("path", "name", "size", "modified", "is_variant_file")
    stored = new_folder(spark, "listing")
    named.write.parquet(stored)
    return spark.read.schema(named.schema).parquet(stored)


def collect_parquet(spark: SparkSession, source_dir: str, recursive: bool = True) -> DataFrame:
    """Manifest of the Parquet files below (or directly in) a folder."""
    files = list_files(spark, source_dir, recursive=recursive, glob="*.parquet")
    return files.filter(P.has_suffix(F.col("name"), ".parquet"))
