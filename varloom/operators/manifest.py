"""Joins and aggregates over file manifests: validation, publication plan, statistics.

Where a key may repeat on the side that is looked up, that side is aggregated to one
row per key first. This keeps the result one row per left row, combines on the map side,
and leaves the join without many-to-many keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varloom.functions import paths as P


def missing_by(expected: DataFrame, present: DataFrame, key: str = "name") -> DataFrame:
    """Expected rows whose key is not present."""
    return expected.join(present.select(key).distinct(), key, "left_anti")


def reconcile_sizes(expected: DataFrame, present: DataFrame) -> DataFrame:
    """Compare sizes of files matched by name.

    ``expected`` holds (name, size) with null for an unknown size; ``present`` holds
    (name, path, size). Where folders repeat a name each file is compared. Result: name, local_path, local_size, remote_size, diff, status
    (``size_match``, ``size_differs``, ``size_unknown``).
    """
    local = present.select(
        "name", F.col("path").alias("local_path"), F.col("size").alias("local_size")
    )
    joined = expected.select("name", F.col("size").alias("remote_size")).join(local, "name")
    status = (
        F.when(F.col("remote_size").isNull(), "size_unknown")
        .when(F.col("remote_size") == F.col("local_size"), "size_match")
        .otherwise("size_differs")
    )
    return joined.select(
        "name",
        "local_path",
        "local_size",
        "remote_size",
        (F.col("local_size") - F.col("remote_size")).alias("diff"),
        status.alias("status"),
    )


def size_mismatches(expected: DataFrame, present: DataFrame) -> DataFrame:
    """Files whose sizes differ: name, local_path, local_size, remote_size, diff."""
    return reconcile_sizes(expected, present).filter("status = 'size_differs'").drop("status")


def conversion_counts(files: DataFrame) -> DataFrame:
    """Variant inputs and Parquet outputs of a manifest, in one aggregate.

    ``complete`` is a warning only: steps may skip or merge files legitimately.
    """
    n_variant = F.count_if(P.is_variant_file(F.col("name")))
    n_parquet = F.count_if(P.has_suffix(F.col("name"), ".parquet"))
    return files.agg(n_variant.alias("n_variant"), n_parquet.alias("n_parquet")).withColumn(
        "complete", F.col("n_parquet") >= F.col("n_variant")
    )


def check_splits(inputs: DataFrame, present: DataFrame, splits: DataFrame) -> DataFrame:
    """One row per input (column ``name``) with its problem, or ``ok``.

    ``present`` lists the inputs that exist; ``splits`` holds (name, exists) per split
    file. Problems: ``missing input``, ``no splits``, ``missing split files``.
    """
    here = present.select("name").distinct().withColumn("here", F.lit(True))
    made = splits.groupBy("name").agg(
        F.count(F.lit(1)).alias("n_splits"), F.count_if(~F.col("exists")).alias("n_missing")
    )
    problem = (
        F.when(F.col("here").isNull(), "missing input")
        .when(F.col("n_splits").isNull(), "no splits")
        .when(F.col("n_missing") > 0, "missing split files")
        .otherwise("ok")
    )
    return (
        inputs.select("name")
        .join(here, "name", "left")
        .join(made, "name", "left")
        .select("name", problem.alias("problem"))
    )


def fail_on_problems(checked: DataFrame, shown: int = 20) -> None:
    """Raise once, naming all kinds of problems and a few examples of them."""
    bad = checked.filter(F.col("problem") != "ok")
    counts = {r.problem: r.n for r in bad.groupBy("problem").agg(F.count(F.lit(1)).alias("n")).collect()}
    if counts:
        names = [f"{r.problem}: {r.name}" for r in bad.orderBy("name").limit(shown).collect()]
        raise FileNotFoundError(f"{counts}; " + "; ".join(names))


def target_paths(files: DataFrame, prefix: str = "data", root: str | None = None) -> DataFrame:
    """Add ``path_in_repo``, the published place of each file."""
    return files.withColumn("path_in_repo", P.target_path(F.col("path"), prefix, root))


def not_publishable(files: DataFrame) -> DataFrame:
    """Files without the Parquet suffix."""
    return files.filter(~P.has_suffix(F.col("name"), ".parquet"))


def guard_extension(files: DataFrame, shown: int = 3) -> None:
    """Refuse a batch holding any file that is not Parquet."""
    bad = not_publishable(files)
    count = bad.count()
    if count:
        some = [r.name for r in bad.select("name").orderBy("name").limit(shown).collect()]
        raise ValueError(f"{count} files do not end in .parquet, such as {', '.join(some)}")


def guard_targets(planned: DataFrame, shown: int = 3) -> None:
    """Refuse a batch in which two files would be published at one place."""
    twice = planned.groupBy("path_in_repo").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    names = [r.path_in_repo for r in twice.orderBy("path_in_repo").limit(shown).collect()]
    if names:
        raise ValueError(f"several files map to one target: {names}")


def publish_plan(local: DataFrame, remote: DataFrame) -> DataFrame:
    """What to publish: equal sizes are skipped, all else goes, with the reason.

    ``local`` holds (path, path_in_repo, size), ``remote`` (path_in_repo, size). A remote
    file of unknown size is published again as ``size_unknown``.
    """
    there = remote.groupBy("path_in_repo").agg(
        F.max("size").alias("remote_size"), F.lit(True).alias("there")
    )
    joined = local.select(
        F.col("path").alias("file"), "path_in_repo", F.col("size").alias("local_size")
    ).join(there, "path_in_repo", "left")
    reason = (
        F.when(F.col("there").isNull(), "new_file")
        .when(F.col("remote_size").isNull(), "size_unknown")
        .when(F.col("remote_size") == F.col("local_size"), "size_match")
        .otherwise("size_differs")
    )
    return joined.withColumn("reason", reason).select(
        "file",
        "path_in_repo",
        (F.col("reason") != "size_match").alias("uploaded"),
        "reason",
        "local_size",
        "remote_size",
    )


def publish_summary(plan: DataFrame) -> DataFrame:
    return plan.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("uploaded").alias("num_uploaded"),
        F.count_if(~F.col("uploaded")).alias("num_skipped"),
    )


def with_variant_type(files: DataFrame, root: str) -> DataFrame:
    """Add ``variant_type``: the first folder below the root, null right under it."""
    relative = P.relative_path(F.col("path"), root)
    return files.withColumn("variant_type", P.partition_value(P.first_component(relative)))


def dataset_stats(files: DataFrame, root: str) -> DataFrame:
    """File count, size in GiB and the sorted variant types of a data set.

    Files are combined per type first; only the few types reach the final row.
    """
    per_type = (
        with_variant_type(files, root)
        .groupBy("variant_type")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"))
    )
    return per_type.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("num_files"),
        (F.coalesce(F.sum("bytes"), F.lit(0)) / F.lit(float(1024**3))).alias("total_size_gb"),
        F.sort_array(F.collect_list("variant_type")).alias("variant_types"),
    )
