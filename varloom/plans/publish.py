"""Publishing a prepared data set to a target folder, and its statistics.

Files are copied by tasks into a staging folder of the target; only when every copy has
succeeded are they moved into place. Both steps may be repeated safely, so a lost
executor costs a retry and nothing else. Moving many files is not one atomic step: readers
may meet old and new files while it lasts. Files that are replaced are kept in a hidden
folder ``.replaced-<id>`` of the target until every move is done, so a job that dies there
loses none; publishing again completes it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varloom.functions import paths as P
from varloom.operators import manifest as M
from varloom.operators.sinks import fixed
from varloom.session import new_folder
from varloom.sources.files import delete_tree, exists, file_system, qualified
from varloom.sources.listing import collect_parquet, list_files

COPY_SCHEMA = "from_path string, to_path string, bytes bigint"
COPY_CHUNK = 8 << 20
MAX_COPY_TASKS = 20_000


@dataclass(frozen=True)
class Published:
    plan: DataFrame
    summary: DataFrame
    stats: DataFrame
    copied: int


def copy_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task body: copy ``from_path`` to ``to_path``; a copy appears only when whole."""
    for batch in batches:
        sizes = []
        for row in batch.to_pylist():
            (src_fs, src), (dst_fs, dst) = file_system(row["from_path"]), file_system(row["to_path"])
            dst_fs.create_dir(dst.rsplit("/", 1)[0], recursive=True)
            part = f"{dst}.{uuid.uuid4().hex}.part"
            done = 0
            with src_fs.open_input_stream(src, compression=None) as reader:
                with dst_fs.open_output_stream(part, compression=None) as writer:
                    while chunk := reader.read(COPY_CHUNK):
                        writer.write(chunk)
                        done += len(chunk)
            _move(dst_fs, part, dst)
            sizes.append(done)
        yield _copied(batch, sizes)


def move_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task body: move staged files into place; one already moved is left alone.

    A file that stands there is moved to ``kept_path`` first.
    """
    from pyarrow.fs import FileType

    for batch in batches:
        sizes = []
        for row in batch.to_pylist():
            (fs, src), (_, dst) = file_system(row["from_path"]), file_system(row["to_path"])
            if fs.get_file_info(src).type != FileType.NotFound:
                fs.create_dir(dst.rsplit("/", 1)[0], recursive=True)
                kept = file_system(row["kept_path"])[1]
                if fs.get_file_info(dst).type != FileType.NotFound and fs.get_file_info(kept).type == FileType.NotFound:
                    fs.create_dir(kept.rsplit("/", 1)[0], recursive=True)
                    fs.move(dst, kept)
                _move(fs, src, dst)
            sizes.append(fs.get_file_info(dst).size)
        yield _copied(batch, sizes)


def _move(fs, src: str, dst: str) -> None:
    from pyarrow.fs import FileType

    if fs.get_file_info(dst).type != FileType.NotFound:
        fs.delete_file(dst)
    fs.move(src, dst)


def _copied(batch: pa.RecordBatch, sizes: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [batch.column("from_path"), batch.column("to_path"), pa.array(sizes, pa.int64())],
        names=["from_path", "to_path", "bytes"],
    )


def remote_files(spark: SparkSession, target: str) -> DataFrame:
    """(path_in_repo, size) of the files at the target; empty if there is none yet."""
    if not exists(spark, target):
        return spark.createDataFrame([], "path_in_repo string, size bigint")
    files = list_files(spark, target, recursive=True)
    return files.select(
        P.relative_path(F.col("path"), qualified(spark, target)).alias("path_in_repo"), "size"
    )


def stale_files(planned: DataFrame, remote: DataFrame, prefix: str) -> DataFrame:
    """Published Parquet files below the prefix that the data set no longer holds.

    Spark names files anew on every write, so leaving them beside a rewritten table
    would make its rows appear twice.
    """
    ours = F.startswith(F.col("path_in_repo"), F.lit(prefix + "/"))
    parquet = P.has_suffix(F.col("path_in_repo"), ".parquet")
    return M.missing_by(remote.filter(ours & parquet), planned, "path_in_repo")


def publish(
    spark: SparkSession,
    source_dir: str,
    target: str,
    prefix: str = "data",
    files: DataFrame | None = None,
    dry_run: bool = False,
    stale: str = "fail",
) -> Published:
    """Publish the Parquet files of ``source_dir`` under ``<target>/<prefix>``.

    Files of equal size are skipped. ``stale`` says what happens to files published
    before and absent now: ``fail``, ``remove`` or ``keep``.
    """
    if stale not in ("fail", "remove", "keep"):
        raise ValueError(f"stale must be fail, remove or keep, not {stale!r}")
    chosen = collect_parquet(spark, source_dir) if files is None else fixed(files, "publish-files")
    M.guard_extension(chosen)
    source_dir, target = qualified(spark, source_dir), qualified(spark, target)
    planned = M.target_paths(chosen, prefix, source_dir)
    M.guard_targets(planned)
    remote = fixed(remote_files(spark, target), "publish-remote")
    # Stored before anything is copied: the plan must not see its own effects.
    folder = new_folder(spark, "publish")
    M.publish_plan(planned, remote).write.parquet(f"{folder}/plan")
    stale_files(planned, remote, prefix).write.parquet(f"{folder}/stale")
    plan, old = spark.read.parquet(f"{folder}/plan"), spark.read.parquet(f"{folder}/stale")
    if stale == "fail" and not dry_run:
        names = [r.path_in_repo for r in old.orderBy("path_in_repo").limit(3).collect()]
        if names:
            raise ValueError(f"target holds files the data set no longer has, such as {names}")
    copied = 0
    if not dry_run:
        copied = _copy_planned(spark, plan, target, folder)
        if stale == "remove":
            _remove_stale(old, target, folder)
    stats = M.dataset_stats(chosen, source_dir)
    return Published(plan, M.publish_summary(plan), stats, copied)


def remove_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task body: delete ``from_path``; one that is gone already is left alone."""
    from pyarrow.fs import FileType

    for batch in batches:
        for path in batch.column("from_path").to_pylist():
            fs, inner = file_system(path)
            if fs.get_file_info(inner).type != FileType.NotFound:
                fs.delete_file(inner)
        yield _copied(batch, [0] * batch.num_rows)


def _remove_stale(old: DataFrame, target: str, folder: str) -> None:
    place = F.concat(F.lit(target + "/"), F.col("path_in_repo"))
    named = old.select(place.alias("from_path"), place.alias("to_path"))
    named.mapInArrow(remove_files, COPY_SCHEMA).write.parquet(f"{folder}/removed")


def _copy_planned(spark: SparkSession, plan: DataFrame, target: str, folder: str) -> int:
    todo = plan.filter("uploaded")
    count = todo.count()
    if not count:
        return 0
    tasks = min(count, MAX_COPY_TASKS)
    run = uuid.uuid4().hex
    staging, replaced = f"{target}/.staging-{run}", f"{target}/.replaced-{run}"
    place = lambda base: F.concat(F.lit(base + "/"), F.col("path_in_repo"))
    staged = (
        todo.select(F.col("file").alias("from_path"), place(staging).alias("to_path"))
        .repartition(tasks)
        .mapInArrow(copy_files, COPY_SCHEMA)
    )
    staged.write.parquet(f"{folder}/staged")
    moved = (
        todo.select(
            place(staging).alias("from_path"), place(target).alias("to_path"), place(replaced).alias("kept_path")
        )
        .repartition(tasks)
        .mapInArrow(move_files, COPY_SCHEMA)
    )
    moved.write.parquet(f"{folder}/moved")
    delete_tree(spark, staging)
    delete_tree(spark, replaced)
    return spark.read.parquet(f"{folder}/moved").count()


def refresh_stats(spark: SparkSession, source_dir: str) -> DataFrame:
    """Statistics of the data set below a folder: files, GiB, variant types."""
    files = collect_parquet(spark, source_dir)
    return M.dataset_stats(files, qualified(spark, source_dir))
