"""Publication in versions: a reader meets the old set of files or the new one, never both.

Each publication is a folder of its own, ``<target>/versions/<id>``, that is filled by tasks and
not touched again. The file ``<target>/CURRENT`` names the one in force; it is replaced by a
single rename once every file is in place. A job that dies before leaves a folder nobody reads.
Files that are published already are copied from the version in force, so that the source is
read for changed files only. On file systems whose rename is a copy, the pointer file is small
enough to be written in one request.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varloom.functions import paths as P
from varloom.operators import manifest as M
from varloom.operators.sinks import fixed
from varloom.plans.publish import COPY_SCHEMA, MAX_COPY_TASKS, Published, copy_files
from varloom.session import new_folder
from varloom.sources.files import _hadoop, exists, qualified
from varloom.sources.listing import collect_parquet, list_files

POINTER = "CURRENT"


def current_version(spark: SparkSession, target: str) -> str | None:
    """The folder of the version in force; None before the first."""
    pointer = f"{qualified(spark, target)}/{POINTER}"
    if not exists(spark, pointer):
        return None
    return f"{qualified(spark, target)}/versions/{spark.read.text(pointer).first().value}"


def point_to(spark: SparkSession, target: str, version: str) -> None:
    """Puts a version in force, replacing the pointer in one step."""
    fs, pointer = _hadoop(spark, f"{target}/{POINTER}")
    part = _hadoop(spark, f"{target}/.{POINTER}-{uuid.uuid4().hex}")[1]
    out = fs.create(part, False)
    out.write(bytearray(f"{version}\n".encode()))
    out.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    modes = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    modes[0] = hadoop.Options.Rename.OVERWRITE
    context = hadoop.FileContext.getFileContext(pointer.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(context.makeQualified(part), context.makeQualified(pointer), modes)


def publish_version(
    spark: SparkSession, source_dir: str, target: str, prefix: str = "data", files: DataFrame | None = None
) -> Published:
    """Publish the Parquet files of ``source_dir`` as a new version of ``target``, all or nothing.

    The plan says of each file whether it was new or changed by size; ``copied`` counts those.
    Files the data set no longer has are not in the new version. Without a file to publish
    nothing changes.
    """
    chosen = collect_parquet(spark, source_dir) if files is None else fixed(files, "publish-files")
    M.guard_extension(chosen)
    source_dir, target = qualified(spark, source_dir), qualified(spark, target)
    planned = M.target_paths(chosen, prefix, source_dir)
    M.guard_targets(planned)
    old = current_version(spark, target)
    if old is None:
        remote = spark.createDataFrame([], "path_in_repo string, size bigint")
    else:
        held = list_files(spark, old, recursive=True)
        remote = held.select(P.relative_path(F.col("path"), old).alias("path_in_repo"), "size")
    plan = fixed(M.publish_plan(planned, remote), "publish-plan")
    stats = M.dataset_stats(chosen, source_dir)
    count = plan.count()
    if not count:
        return Published(plan, M.publish_summary(plan), stats, 0)
    version = uuid.uuid4().hex
    within = lambda folder: F.concat(F.lit(f"{folder}/"), F.col("path_in_repo"))
    source = F.when(F.col("uploaded"), F.col("file")).otherwise(within(old))
    copies = plan.select(source.alias("from_path"), within(f"{target}/versions/{version}").alias("to_path"))
    report = f"{new_folder(spark, 'publish-copies')}/done"
    copies.repartition(min(count, MAX_COPY_TASKS)).mapInArrow(copy_files, COPY_SCHEMA).write.parquet(report)
    done = spark.read.parquet(report).count()
    if done != count:
        raise RuntimeError(f"{done} of {count} files were copied; version {version} is not put in force")
    point_to(spark, target, version)
    return Published(plan, M.publish_summary(plan), stats, plan.filter("uploaded").count())
