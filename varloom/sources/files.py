"""Small file helpers: existence on the driver, byte streams inside tasks."""

from __future__ import annotations

from urllib.parse import quote

from pyspark.sql import SparkSession

from varloom.functions.paths import plain_path


def _hadoop(spark: SparkSession, path: str):
    sc = spark.sparkContext
    target = sc._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(sc._jsc.hadoopConfiguration()), target


def qualified(spark: SparkSession, path: str) -> str:
    """A path as scans report it: absolute, with the default host filled in."""
    fs, target = _hadoop(spark, path)
    return plain_path(fs.makeQualified(target).toString())


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _hadoop(spark, path)
    return bool(fs.exists(target))


def is_directory(spark: SparkSession, path: str) -> bool:
    fs, target = _hadoop(spark, path)
    return bool(fs.exists(target)) and bool(fs.getFileStatus(target).isDirectory())


def modified_ms(spark: SparkSession, path: str) -> int:
    fs, target = _hadoop(spark, path)
    return int(fs.getFileStatus(target).getModificationTime())


def delete_tree(spark: SparkSession, path: str) -> None:
    fs, target = _hadoop(spark, path)
    fs.delete(target, True)


def rename(spark: SparkSession, path: str, to: str) -> None:
    """Give a file or folder another place; its files keep their times. An error if there is none."""
    fs, source = _hadoop(spark, path)
    target = _hadoop(spark, to)[1]
    fs.mkdirs(target.getParent())
    if not fs.rename(source, target):
        raise OSError(f"{path} could not be moved to {to}")


def is_complete(spark: SparkSession, table: str) -> bool:
    """A table counts as present only once its committed-job marker exists."""
    return exists(spark, f"{table}/_SUCCESS")


def file_system(path: str):
    """(filesystem, path inside it) for a task; Hadoop's S3 scheme is spelled ``s3``."""
    from pyarrow import fs as pafs

    spelled = plain_path(path)
    if "://" not in spelled:
        return pafs.LocalFileSystem(), spelled
    scheme, rest = spelled.split("://", 1)
    scheme = "s3" if scheme in ("s3a", "s3n") else scheme
    return pafs.FileSystem.from_uri(f"{scheme}://{quote(rest, safe='/@:')}")
