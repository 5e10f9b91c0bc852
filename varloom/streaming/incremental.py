"""Converting only the files that have not been converted before.

The stream is a stream of file names: its checkpoint remembers which files of the
landing folder were taken. Each micro-batch converts its files like any other set, so
every compression works, and writes the folder ``batch=<number>``. A batch that is run
again after a failure overwrites its own folder, so no row is lost or doubled.

A stream takes a name once. To follow files that are replaced under their names, the table
is kept in a folder per file instead, with a record of each file's size and time; after the
stream has taken what is new, a listing is compared with these records.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varloom.functions import paths as P
from varloom.operators.sinks import convert_listed, convert_vcf
from varloom.schema import SOURCE_COL
from varloom.sources.columnar import scan_split
from varloom.sources.files import exists
from varloom.sources.listing import list_files, matching, with_names

FILE_STREAM_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def file_stream(spark: SparkSession, landing: str, max_files: int = 10_000) -> DataFrame:
    """Stream of (path, size, modified) of files arriving in a folder; bodies are not read."""
    return (
        spark.readStream.format("binaryFile")
        .schema(FILE_STREAM_SCHEMA)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", str(max_files))
        .load(landing)
        .select(
            P.plain_path_col(F.col("path")).alias("path"),
            F.col("length").alias("size"),
            F.col("modificationTime").alias("modified"),
        )
    )


def incremental_convert(
    spark: SparkSession,
    landing: str,
    out: str,
    checkpoint: str,
    info_fields: Sequence[str] | None = None,
    pattern: str | None = None,
    always_variant: bool = False,
    malformed: str = "reject",
    max_files: int = 10_000,
    follow_changes: bool = False,
) -> DataFrame | None:
    """Convert new variant files of ``landing`` and stop; returns the whole table.

    Returns None while nothing has ever been converted. With ``follow_changes`` a file that
    has another size or time than when it was converted is converted again in place of its
    old rows; a file removed from ``landing`` keeps its rows. Such a table is written anew
    where a later header would widen a stored column, see ``agreed_fields``, and one kept in
    batches cannot be turned into one.
    """
    if follow_changes and batches_of(spark, out):
        raise ValueError(f"{out} is kept in batches and cannot follow changes")
    per_file = {"info_fields": info_fields, "always_variant": always_variant, "malformed": malformed}

    def follow(batch: DataFrame, number: int) -> None:
        # A batch has at most max_files names; a batch run again finds its files recorded.
        taken = with_names(matching(batch, pattern))
        files = batch.sparkSession.createDataFrame(taken.collect(), taken.schema)
        convert_listed(batch.sparkSession, files, out, **per_file)

    def convert(batch: DataFrame, number: int) -> None:
        files = with_names(matching(batch, pattern))
        if not always_variant:
            files = files.filter("is_variant_file")
        rows = [(r.path, r.size, r.name) for r in files.select("path", "size", "name").collect()]
        if not rows:
            return
        chosen = batch.sparkSession.createDataFrame(rows, "path string, size bigint, name string")
        convert_vcf(
            batch.sparkSession,
            chosen,
            f"{out}/batch={number}",
            info_fields,
            mode="overwrite",
            malformed=malformed,
            rejects_out=f"{out}_rejects/batch={number}",
            agree_with=out,
        )

    query = (
        file_stream(spark, landing, max_files)
        .writeStream.foreachBatch(follow if follow_changes else convert)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if not follow_changes:
        return converted_so_far(spark, out)
    convert_listed(spark, list_files(spark, landing, pattern, recursive=True), out, **per_file)
    return scan_split(spark, out, [SOURCE_COL]) if exists(spark, out) else None


def batches_of(spark: SparkSession, out: str) -> bool:
    """Whether a table is kept in a folder per batch."""
    return exists(spark, f"{out}/batch=0") or exists(spark, f"{out}/batch=1")


def converted_so_far(spark: SparkSession, out: str) -> DataFrame | None:
    if not exists(spark, out):
        return None
    # Later batches may declare further INFO fields.
    return spark.read.option("mergeSchema", "true").parquet(out)
