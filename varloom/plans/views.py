"""Variant tables and file manifests derived from the driver's tables.

The texts run unchanged on Spark SQL and DuckDB, so one definition feeds both a query
and its oracle. Every view covers its whole base tables.
"""

from __future__ import annotations

import itertools
import struct
import zlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varloom.session import new_folder
from varloom.sources.files import file_system
from varloom.sources.listing import list_files

# Variants (from lineitem): keys repeat, alleles are lists, single or null.
VARIANTS = """
select concat('chr', l_orderkey % 22 + 1) as chrom, l_orderkey * 10 + 1 as start,
       concat('rs', l_partkey) as id,
       substr('ACGT', cast(l_orderkey % 4 + 1 as int), 1) as ref,
       case l_returnflag when 'R' then null when 'A' then 'C|G' else 'T' end as alt,
       l_quantity as qual, l_linestatus as filter,
       case when l_linenumber <= 2 then 'SNV' when l_linenumber = 3 then 'insertion'
            when l_linenumber = 4 then 'deletion' when l_linenumber = 5 then 'indel'
            when l_linenumber = 6 then 'substitution' else 'sequence_alteration' end as tsa,
       l_extendedprice as score, l_linestatus = 'O' as db,
       concat('set', l_suppkey % 10) as source
from lineitem
"""

# Clinical annotation (from orders): one key per order, shared with the variants.
CLINICAL = """
select concat('chr', o_orderkey % 22 + 1) as chrom, o_orderkey * 10 + 1 as start,
       substr('ACGT', cast(o_orderkey % 4 + 1 as int), 1) as ref,
       case o_orderstatus when 'O' then 'T' when 'F' then 'C' else 'G' end as alt,
       o_orderpriority as clnsig, concat('disease ', o_custkey) as clndn,
       o_totalprice as af_total, o_totalprice * 0.5 as af_half
from orders
"""

# The same with a tenth of its rows under one key.
CLINICAL_HOT = f"""
select case when start % 100 = 1 then 'chr2' else chrom end as chrom,
       case when start % 100 = 1 then 11 else start end as start,
       case when start % 100 = 1 then 'C' else ref end as ref,
       case when start % 100 = 1 then 'T' else alt end as alt, clnsig, clndn
from ({CLINICAL}) c
"""

# Expected files (from documents): a place, a name and a size each.
EXPECTED = """
select concat('data/', source, '/d', doc_id,
              case lang when 'en' then '.vcf.gz' when 'fr' then '.vcf.bgz'
                        when 'de' then '.vcf.gz.tbi' else '.parquet' end) as path,
       concat('d', doc_id,
              case lang when 'en' then '.vcf.gz' when 'fr' then '.vcf.bgz'
                        when 'de' then '.vcf.gz.tbi' else '.parquet' end) as name,
       n_chars as size, doc_id, source, lang
from documents
"""

# Files that are present (documents with a label); some sizes are off, some unknown.
PRESENT = """
select e.path, e.name, e.size - l.toxic as size, e.doc_id, e.source, e.lang,
       l.quality, l.toxic
from expected e join labels l on e.doc_id = l.doc_id
"""

WITH_VARIANTS = f"with v as ({VARIANTS})"
WITH_BOTH = f"with v as ({VARIANTS}), r as ({CLINICAL})"
WITH_FILES = f"with expected as ({EXPECTED}), present as ({PRESENT})"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _from(spark: SparkSession, text: str, **tables: DataFrame) -> DataFrame:
    """Run a text whose table names are bound to DataFrames (no session state kept)."""
    bound = text
    for name in tables:
        bound = bound.replace(f"from {name}", f"from {{{name}}}").replace(
            f"join {name} ", f"join {{{name}}} "
        )
    return spark.sql(bound, **tables)


def variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _from(spark, VARIANTS, lineitem=table(spark, sf_dir, "lineitem"))


def clinical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _from(spark, CLINICAL, orders=table(spark, sf_dir, "orders"))


def clinical_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _from(spark, CLINICAL_HOT, orders=table(spark, sf_dir, "orders"))


def expected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _from(spark, EXPECTED, documents=table(spark, sf_dir, "documents"))


def present(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _from(
        spark,
        PRESENT,
        expected=expected(spark, sf_dir),
        labels=table(spark, sf_dir, "labels"),
    )


def vcf_lines(rows: DataFrame) -> DataFrame:
    """Variants as VCF body lines (column ``value``), to be parsed again."""
    dot = F.lit(".")
    info = F.concat(
        F.lit("TSA="),
        F.col("tsa"),
        F.when(F.col("db"), ";DB").otherwise(""),
        F.lit(";SC="),
        F.col("score").cast("string"),
        F.lit(";SET="),
        F.col("source"),
    )
    return rows.select(
        F.concat_ws(
            "\t",
            "chrom",
            F.col("start").cast("string"),
            "id",
            "ref",
            F.coalesce(F.replace(F.col("alt"), F.lit("|"), F.lit(",")), dot),
            F.col("qual").cast("string"),
            "filter",
            info,
        ).alias("value")
    )


# The header that describes the lines above.
LINE_FIELDS = (
    ("TSA", "1", "String"),
    ("DB", "0", "Flag"),
    ("SC", "1", "Float"),
    ("SET", "1", "String"),
)


def vcf_header(spark: SparkSession) -> DataFrame:
    lines = ["##fileformat=VCFv4.2"]
    for name, number, kind in LINE_FIELDS:
        lines.append(f'##INFO=<ID={name},Number={number},Type={kind},Description="{name}, made">')
    lines.append("#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO")
    return spark.createDataFrame([(line,) for line in lines], "value string")


def write_vcf(spark: SparkSession, lines: DataFrame, folder: str, compression: str = "none") -> str:
    """Write lines as VCF text files, the header in a file of its own."""
    vcf_header(spark).coalesce(1).write.option("compression", compression).text(f"{folder}/head")
    lines.write.option("compression", compression).text(f"{folder}/body")
    return folder


# Lines that are joined to one piece of text at a time.
LINES_AT_ONCE = 16_384


def text_of(lines: pa.Array) -> pa.Buffer | bytes:
    """The lines as one text, a line feed behind each; a null reads ``None``."""
    ended = pc.binary_join_element_wise(pc.fill_null(lines, "None"), "", "\n")
    whole = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(ended)], pa.int32()), ended), "")
    return whole[0].as_buffer()


def write_named(
    spark: SparkSession, lines: DataFrame, folder: str, name: str, header: Sequence[str] | None = None
) -> str:
    """Write lines as files ``<folder>/p<number>/<name>``, one for each partition with lines.

    The header stands before the lines of each. A task run again replaces its own file.
    """
    top = [r.value for r in vcf_header(spark).collect()]
    if header is not None:
        top = ["##fileformat=VCFv4.2", *header]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        first = next(batches, None)
        if first is None:
            return
        fs, place = file_system(f"{folder}/p{task.partitionId()}")
        part = f"{place}/.{name}-{task.taskAttemptId()}"
        fs.create_dir(place, recursive=True)
        with fs.open_output_stream(part, compression=None) as out:
            out.write("".join(f"{line}\n" for line in top).encode())
            for batch in itertools.chain([first], batches):
                for at in range(0, batch.num_rows, LINES_AT_ONCE):
                    out.write(text_of(batch.column(0).slice(at, LINES_AT_ONCE)))
        fs.move(part, f"{place}/{name}")
        yield pa.RecordBatch.from_arrays([pa.array([f"{place}/{name}"])], ["path"])

    lines.select("value").mapInArrow(write, "path string").write.format("noop").mode("overwrite").save()
    return folder


def harm_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task body: rows (path, size, tsa) of Parquet files to damage, in the pages or, for indels, in the footer."""
    for batch in batches:
        for row in batch.to_pylist():
            fs, inner = file_system(row["path"])
            with fs.open_input_stream(inner, compression=None) as stream:
                data = bytearray(stream.read())
            at = len(data) - 12 if row["tsa"] == "indel" else 4
            data[at : at + 12 if at > 4 else len(data) // 2] = b"\xff" * (min(12, len(data) - at) if at > 4 else len(data) // 2 - 4)
            # A sum of the file that a writer left beside it would tell before Parquet does.
            folder, _, name = inner.rpartition("/")
            if fs.get_file_info(f"{folder}/.{name}.crc").type.name == "File":
                fs.delete_file(f"{folder}/.{name}.crc")
            with fs.open_output_stream(inner, compression=None) as out:
                out.write(bytes(data))
        yield batch.select(["path"])


def write_blocks(spark: SparkSession, source: str, folder: str) -> str:
    """Copies of text files as block-compressed ``.vcf.bgz`` files, one task each."""

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                (fs, inner), target = file_system(path), f"{folder}/{path.rsplit('/', 1)[1]}.vcf.bgz"
                fs.create_dir(file_system(folder)[1], recursive=True)
                with fs.open_input_stream(inner, compression=None) as text, fs.open_output_stream(
                    file_system(target)[1], compression=None
                ) as out:
                    while piece := text.read(60_000):
                        out.write(block_of(piece))
                    out.write(block_of(b""))
            yield batch

    files = list_files(spark, source).select("path")
    # From one partition rows are dealt in turn, so that every task gets one file.
    dealt = files.coalesce(1).repartition(max(files.count(), 1))
    dealt.mapInArrow(copy, "path string").write.format("noop").mode("overwrite").save()
    return folder


def block_of(piece: bytes) -> bytes:
    """One block of the block-compressed form: a gzip member that tells its own size."""
    raw = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = raw.compress(piece) + raw.flush()
    head = b"\x1f\x8b\x08\x04" + b"\0" * 4 + b"\0\xff" + struct.pack("<HBBHH", 6, 66, 67, 2, len(body) + 25)
    return head + body + struct.pack("<II", zlib.crc32(piece), len(piece))
