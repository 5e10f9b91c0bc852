"""Helpers of the training-data operators: input columns, stored steps, per-text functions."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from varloom.session import new_folder

#: Text bytes and rows that a task's Python code works on at once.
SLICE_BYTES = 2 << 20
SLICE_ROWS = 2048


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written below the shared folder and read again, so that nothing before it runs twice.

    The schema read back is the one written, also for a table without rows.
    """
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def held_out(doc_id: str = "doc_id", folds: int = 5) -> Column:
    """Rows never learned from: crc32 of the identifier's text divisible by ``folds``.

    A null identifier counts as the empty text, whose crc32 is 0.
    """
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % folds == 0


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """The wanted names, each with as many underscores behind it as keep it apart from ``df``'s columns."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def text_id(text: Column) -> tuple[Column, Column]:
    """128 bits that stand for a whole text, as two numbers."""
    return F.xxhash64(text), F.xxhash64(F.lit(11), text)


def unit_hash(name: str, seed: int) -> Column:
    """A fixed number in [0, 1) for each value, for bounded samples that repeat exactly."""
    return F.pmod(F.xxhash64(F.col(name), F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)


def slices(batch: pa.Array) -> Iterator[pa.Array]:
    """A batch in pieces of about ``SLICE_BYTES`` of text, or of ``SLICE_ROWS`` rows.

    Of structs, the first field is the text.
    """
    sized = batch.field(0) if pa.types.is_struct(batch.type) else batch
    if pa.types.is_string(sized.type) or pa.types.is_binary(sized.type):
        ends = np.cumsum(pc.fill_null(pc.binary_length(sized), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    else:
        ends = np.zeros(len(batch), np.int64)
    at = 0
    while at < len(batch):
        before = int(ends[at - 1]) if at else 0
        end = max(at + 1, min(at + SLICE_ROWS, int(np.searchsorted(ends, before + SLICE_BYTES))))
        yield batch.slice(at, end - at)
        at = end


def give_back() -> None:
    """Returns memory that Arrow and the C library keep for reuse; workers live on for other stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def per_batch(
    start: Callable[[], Callable[[pa.Array], pa.Array]], returns: DataType | str
) -> Callable[..., Column]:
    """A column function applied to pieces of Arrow batches; ``start`` runs once per task.

    Results leave a task piece by piece, so what it holds does not depend on the size of
    Spark's batches. The function counts as not deterministic, so that the optimizer never
    copies it into a second place.
    """

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        work = start()
        for batch in batches:
            for piece in slices(batch):
                yield work(piece)
        give_back()

    return F.arrow_udf(run, returns).asNondeterministic()


def texts_of(batch: pa.Array) -> list[str]:
    """Texts of a batch, null as the empty text."""
    return ["" if t is None else t for t in batch.to_pylist()]


def fields(df: DataFrame, packed: str, names: list[str]) -> DataFrame:
    """The fields of struct column ``packed`` as columns; columns of these names are replaced."""
    kept = [F.col(f"`{c}`") for c in df.columns if c != packed and c not in names]
    return df.select(*kept, *[F.col(f"`{packed}`.`{n}`").alias(n) for n in names])
