from __future__ import annotations

import pathlib
import struct
import sys
import zlib

import pytest

ROOT = pathlib.Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from pyspark.sql import SparkSession  # noqa: E402

from varloom.session import configure  # noqa: E402

SF = "/root/testdata/sf0.001"

HEADER = """##fileformat=VCFv4.2
##INFO=<ID=TSA,Number=1,Type=String,Description="type, with a comma">
##INFO=<ID=AF,Number=A,Type=Float,Description="frequency">
##INFO=<ID=DB,Number=0,Type=Flag,Description="flag">
#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO
"""
BODY = """chr1\t100\trs1\tA\tC,G\t50.5\tPASS\tTSA=SNV;AF=0.1,1e-5;DB
chr1\t200\t.\tAT\tA\t.\t.\tTSA=deletion
chr2\t300\trs3\tG\t.\t.\tq10\t.
chr2\t400\trs4\tT\tTA,TAA\t.\tPASS\tTSA=insertion;AF=0.2;AF=0.3
chr3\tbad\trs5\tA\tT\t.\tPASS\tTSA=SNV
chr3\t500\trs6\tA
"""


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = configure(SparkSession.builder.master("local[4]").appName("tests"))
    session = (
        builder.config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def vcf_file(tmp_path):
    path = tmp_path / "sample.vcf"
    path.write_text(HEADER + BODY)
    return str(path)


def block_gzip(data: bytes, block: int = 60_000) -> bytes:
    """Block-compressed bytes, built here so that tests need no tool for it."""
    out = b""
    pieces = [data[i : i + block] for i in range(0, len(data), block)]
    for piece in [*pieces, b""]:
        raw = zlib.compressobj(6, zlib.DEFLATED, -15)
        body = raw.compress(piece) + raw.flush()
        total = 18 + len(body) + 8
        head = b"\x1f\x8b\x08\x04" + b"\0" * 4 + b"\0\xff" + struct.pack("<H", 6)
        head += b"BC" + struct.pack("<HH", 2, total - 1)
        out += head + body + struct.pack("<II", zlib.crc32(piece), len(piece))
    return out


def plan_of(df) -> str:
    """The formatted physical plan as text."""
    import contextlib
    import io

    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def rows(df, *columns):
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=repr)
