"""Removal of lines that many documents hold, over a store of levelled sorted runs.

The store keeps, per line key, in how many documents it was seen. It consists of runs: tables
bucketed and sorted by the key's hash. Documents arrive in batches. A batch's keys are counted
per document, merged against the runs to leave out keys already known to be frequent (a sorted
anti-join, without a shuffle on the runs' side), and added as a run of level 0. Once a level
has ``fanout`` runs, they are merged into one run of the next level, so that a key is rewritten
as often as there are levels. A run is named after the batches it covers; a run without its
committed-job marker does not exist, and one covered by another is out of use, so a job that
dies between two steps leaves a store that can be read.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varloom.llm.common import free_names, per_batch, slices, stored, text_id
from varloom.session import new_folder
from varloom.sources.files import _hadoop, is_complete

#: Bytes cut from both ends of a line, and the case of A-Z, for its key.
BLANK = b" \t\n\x0b\x0c\r"
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
LEAST_DOCUMENTS = 10
LEAST_LENGTH = 1
#: Batches that a table is taken in, and runs of a level that are merged into one.
BATCHES = 6
FANOUT = 3
#: Texts with lines to drop, and positions of such lines, that are sent to all executors at most.
BROADCAST_TEXTS, BROADCAST_LINES = 200_000, 2_000_000
ROWS_OUT = 1 << 16
LINES = "ta long, tb long, ha long, hb long, at array<int>"


def key_of(line: bytes) -> bytes:
    return line.strip(BLANK).translate(LOWER)


def line_table(df: DataFrame, text: str = "text", least_length: int = LEAST_LENGTH) -> DataFrame:
    """(ta, tb, ha, hb, at): per document one row for each distinct key of its lines.

    (ta, tb) stands for the text, (ha, hb) for the key, ``at`` holds the numbers of the lines
    with that key. Keys of fewer than ``least_length`` code points are left out. Null texts
    count as empty.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, digests, places = [], [], []

        def batch_of() -> pa.RecordBatch:
            of_text = np.array(ids, np.int64).reshape(-1, 2)
            of_key = np.frombuffer(b"".join(digests), ">i8").astype(np.int64).reshape(-1, 2)
            arrays = [of_text[:, 0], of_text[:, 1], of_key[:, 0], of_key[:, 1]]
            out = [*map(pa.array, map(np.ascontiguousarray, arrays)), pa.array(places, pa.list_(pa.int32()))]
            for held in (ids, digests, places):
                held.clear()
            return pa.RecordBatch.from_arrays(out, ["ta", "tb", "ha", "hb", "at"])

        for batch in batches:
            at = 0
            for piece in slices(batch.column(2)):
                names = zip(batch.column(0)[at:].to_numpy(), batch.column(1)[at:].to_numpy(), strict=True)
                at += len(piece)
                for value, name in zip(piece, names, strict=False):
                    found: dict[bytes, list[int]] = {}
                    for number, line in enumerate((value.as_py() or "").encode().split(b"\n")):
                        found.setdefault(key_of(line), []).append(number)
                    for key, numbers in found.items():
                        if least_length > 1 and len(key.decode()) < least_length or len(key) < least_length:
                            continue
                        ids.append(name)
                        digests.append(xxhash.xxh3_128_digest(key))
                        places.append(numbers)
                        if len(ids) >= ROWS_OUT:
                            yield batch_of()
                if ids:
                    yield batch_of()

    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    ta, tb = text_id(whole)
    return df.select(ta.alias("ta"), tb.alias("tb"), whole.alias("t")).mapInArrow(rows, LINES)


class LineRuns:
    """A folder of runs (ha, hb, n): documents that hold a key, ``n`` summed over the runs.

    Sums are exact up to ``settled``: of a key that one run shows in that many documents,
    later batches are not counted.
    """

    def __init__(self, spark: SparkSession, folder: str, settled: int = LEAST_DOCUMENTS, fanout: int = FANOUT):
        self.spark, self.folder, self.settled, self.fanout = spark, folder, settled, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.tables: dict[tuple[int, int, int], str] = {}
        for run in self._listed():
            self.tables[run] = self._opened(run)

    def _path(self, run: tuple[int, int, int]) -> str:
        return f"{self.folder}/level{run[0]}-{run[1]}-{run[2]}-{self.buckets}"

    def _listed(self) -> list[tuple[int, int, int]]:
        """Complete runs of the folder that no other run covers, as (level, first batch, last batch)."""
        fs, home = _hadoop(self.spark, self.folder)
        names = [s.getPath().getName() for s in fs.listStatus(home)] if fs.exists(home) else []
        found = [m for m in (re.fullmatch(r"level(\d+)-(\d+)-(\d+)-(\d+)", n) for n in names) if m]
        if found:
            self.buckets = int(found[0][4])
        runs = [tuple(int(m[i]) for i in (1, 2, 3)) for m in found if is_complete(self.spark, f"{self.folder}/{m[0]}")]
        return sorted(
            a for a in runs if not any(b[0] > a[0] and b[1] <= a[1] and a[2] <= b[2] for b in runs)
        )

    def _opened(self, run: tuple[int, int, int]) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        self.spark.sql(
            f"CREATE TABLE {name} (ha LONG, hb LONG, n LONG) USING parquet LOCATION '{self._path(run)}' "
            f"CLUSTERED BY (ha, hb) SORTED BY (ha, hb) INTO {self.buckets} BUCKETS"
        )
        return name

    def _write(self, counts: DataFrame, run: tuple[int, int, int]) -> None:
        name = f"line_run_{uuid.uuid4().hex}"
        writer = counts.write.bucketBy(self.buckets, "ha", "hb").sortBy("ha", "hb").mode("overwrite")
        writer.option("path", self._path(run)).saveAsTable(name)
        self.tables[run] = name

    def _merged(self, runs: list[tuple[int, int, int]]) -> DataFrame:
        # Read as plain files: over a union of bucketed tables Spark 4.1 leaves out the exchange
        # that the sum needs.
        paths = [self._path(run) for run in runs]
        every = self.spark.read.schema("ha long, hb long, n long").parquet(*paths)
        return every.groupBy("ha", "hb").agg(F.sum("n").alias("n"))

    def batches(self) -> int:
        """Batches that the runs cover."""
        return max((last for _, _, last in self.tables), default=-1) + 1

    def unsettled(self, counts: DataFrame) -> DataFrame:
        """Rows of ``counts`` whose key no run shows in ``settled`` documents."""
        for name in self.tables.values():
            known = self.spark.table(name).filter(F.col("n") >= self.settled).select("ha", "hb")
            counts = counts.join(known.hint("merge"), ["ha", "hb"], "left_anti")
        return counts

    def add(self, lines: DataFrame) -> None:
        """Adds one batch: rows (ha, hb) of ``lines``, one for each document and key."""
        number = self.batches()
        counts = lines.groupBy("ha", "hb").agg(F.count(F.lit(1)).alias("n"))
        self._write(self.unsettled(counts), (0, number, number))
        self.compact()

    def compact(self) -> None:
        """Merges the runs of every level that has ``fanout`` of them, lowest level first."""
        level = 0
        while True:
            runs = sorted(r for r in self.tables if r[0] == level)
            if not runs:
                return
            if len(runs) >= self.fanout:
                self._write(self._merged(runs), (level + 1, runs[0][1], runs[-1][2]))
                self._forget(runs)
            level += 1

    def _forget(self, runs: list[tuple[int, int, int]]) -> None:
        for run in runs:
            self.spark.sql(f"DROP TABLE {self.tables.pop(run)}")

    def frequent(self, least: int | None = None) -> DataFrame:
        """(ha, hb) of keys in at least ``least`` documents, at most ``settled``."""
        least = self.settled if least is None else least
        if least > self.settled:
            raise ValueError(f"documents are counted up to {self.settled}, not to {least}")
        if not self.tables:
            return self.spark.createDataFrame([], "ha long, hb long")
        return self._merged(list(self.tables)).filter(F.col("n") >= least).select("ha", "hb")

    def close(self) -> None:
        """Drops the catalogue's entries; the runs stay in their folder."""
        self._forget(list(self.tables))


def without(text: str, numbers: list[int]) -> str:
    gone = set(numbers)
    return "\n".join(line for number, line in enumerate(text.split("\n")) if number not in gone)


def _shortened(text: str, at: str):
    def start():
        def work(batch: pa.Array) -> pa.Array:
            pairs = zip(batch.field(0), batch.field(1), strict=True)
            return pa.array([None if not n.is_valid else without(t.as_py(), n.as_py()) for t, n in pairs], pa.string())

        return work

    # Texts that keep all their lines are not sent to Python.
    sent = F.struct(F.when(F.col(at).isNotNull(), F.col(text)).alias("t"), F.col(at).alias("at"))
    return per_batch(start, "string")(sent)


def drop_repeated(
    df: DataFrame,
    text: str = "text",
    least_documents: int = LEAST_DOCUMENTS,
    least_length: int = LEAST_LENGTH,
    batches: int = BATCHES,
    fanout: int = FANOUT,
) -> DataFrame:
    """``df`` with ``n_lines``, ``n_dropped`` and ``kept``, the text without its repeated lines.

    Lines end at a line feed; a line's key is the line without white space at its ends and
    with A-Z lower-cased. Keys of at least ``least_length`` code points that are found in at
    least ``least_documents`` rows lose all their lines. Null texts count as empty: one empty
    line, kept. A text all of whose lines go becomes the empty text. Rows are documents:
    repeated rows count each. Other columns stay; those of the three names are replaced.
    """
    spark = df.sparkSession
    lines = line_table(df, text, least_length).withColumn("batch", F.spark_partition_id() % batches)
    folder = new_folder(spark, "lines")
    lines.write.partitionBy("batch").parquet(folder)
    lines = spark.read.schema(f"{LINES}, batch int").parquet(folder)
    runs = LineRuns(spark, new_folder(spark, "line-runs"), least_documents, fanout)
    for number in range(batches):
        runs.add(lines.filter(F.col("batch") == number))
    frequent = stored(runs.frequent(), "frequent-lines")
    runs.close()
    hits = lines.select("ta", "tb", "ha", "hb", "at").join(frequent, ["ha", "hb"])
    once = hits.groupBy("ta", "tb", "ha", "hb").agg(F.first("at").alias("at"))
    gone = once.groupBy("ta", "tb").agg(F.flatten(F.collect_list("at")).alias("at"))
    gone = stored(gone, "lines-to-drop")
    size = gone.agg(F.count(F.lit(1)).alias("texts"), F.coalesce(F.sum(F.size("at")), F.lit(0)).alias("lines")).first()
    small = size.texts <= BROADCAST_TEXTS and size.lines <= BROADCAST_LINES
    ta, tb, at, whole, kept = free_names(df, "ta", "tb", "at", "whole", "kept_text")
    gone = gone.select(F.col("ta").alias(ta), F.col("tb").alias(tb), F.col("at").alias(at))
    docs = df.withColumn(whole, F.coalesce(F.col(f"`{text}`"), F.lit("")))
    first, second = text_id(F.col(whole))
    docs = docs.withColumn(ta, first).withColumn(tb, second)
    # Beyond the bound the lists are the side that is hashed, which spares a sort of the texts.
    docs = docs.join(F.broadcast(gone) if small else gone.hint("shuffle_hash"), [ta, tb], "left")
    docs = docs.withColumn(kept, _shortened(whole, at))
    made = ("n_lines", "n_dropped", "kept")
    return docs.select(
        *[F.col(f"`{c}`") for c in df.columns if c not in made],
        F.size(F.split(whole, "\n", -1)).cast("long").alias("n_lines"),
        F.coalesce(F.size(at), F.lit(0)).cast("long").alias("n_dropped"),
        F.coalesce(kept, whole).alias("kept"),
    )
