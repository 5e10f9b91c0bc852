from __future__ import annotations

import gzip
import io

import pytest
from conftest import BODY, HEADER, block_gzip, plan_of, rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Observation
from pyspark.sql import functions as F

from varloom.sources import blocks, vcf
from varloom.sources.vcf import InfoField

EXPECTED = [
    ("chr1", 100, 100, "rs1", "A", "C|G", 50.5, "PASS", "SNV", [0.1, 1e-5], True, "sample"),
    ("chr1", 200, 201, None, "AT", "A", None, None, "deletion", None, False, "sample"),
    ("chr2", 300, 300, "rs3", "G", None, None, "q10", None, None, False, "sample"),
    ("chr2", 400, 400, "rs4", "T", "TA|TAA", None, "PASS", "insertion", [0.2], False, "sample"),
]


def test_fields_in_header_order(spark, vcf_file):
    assert vcf.info_fields(spark, vcf_file) == ["TSA", "AF", "DB"]
    assert vcf.info_definitions_of(spark, vcf_file)[1] == InfoField("AF", "A", "Float")


def test_golden_file(spark, vcf_file):
    assert rows(vcf.scan_vcf(spark, vcf_file)) == sorted(EXPECTED, key=repr)


def test_schema_is_typed(spark, vcf_file):
    kinds = dict(vcf.scan_vcf(spark, vcf_file).dtypes)
    assert kinds["start"] == kinds["end"] == "bigint" and kinds["qual"] == "double"
    assert kinds["af"] == "array<double>" and kinds["db"] == "boolean" and kinds["tsa"] == "string"


def test_requested_fields_only(spark, vcf_file):
    table = vcf.scan_vcf(spark, vcf_file, ["DB", "ZZ"])
    assert table.columns[8:] == ["db", "zz", "source"]
    assert {r.zz for r in table.collect()} == {None}
    assert vcf.scan_vcf(spark, vcf_file, []).columns[8:] == ["source"]


def test_rejected_lines_are_kept_apart(spark, vcf_file):
    bad = vcf.rejected_lines(vcf.read_lines(spark, vcf_file))
    assert sorted(r.reason for r in bad.collect()) == [
        "malformed position or column",
        "too few columns",
    ]
    with pytest.raises(Exception, match="malformed VCF line"):
        vcf.scan_vcf(spark, vcf_file, malformed="fail").collect()


@pytest.mark.parametrize("name", ["a.vcf.gz", "a.vcf.bgz"])
def test_gzip_of_two_members_under_either_name(spark, tmp_path, name):
    text = (HEADER + BODY).encode()
    (tmp_path / name).write_bytes(gzip.compress(text[:300]) + gzip.compress(text[300:]))
    table = vcf.scan_vcf(spark, str(tmp_path / name))
    assert rows(table.drop("source")) == sorted((r[:-1] for r in EXPECTED), key=repr)
    assert {r.source for r in table.collect()} == {"a"}


@pytest.mark.parametrize("name", ["b.vcf.gz", "b.vcf.bgz"])
def test_block_gzip_in_ranges(spark, tmp_path, name):
    body = "".join(
        f"chr{i % 22}\t{i + 1}\trs{i}\tA\tC\t.\tPASS\tTSA=SNV;AF={i % 7}.5\n" for i in range(20_000)
    )
    (tmp_path / name).write_bytes(block_gzip((HEADER + body).encode(), 3000))
    table = vcf.scan_vcf(spark, str(tmp_path / name), range_bytes=20_000)
    assert "MapInArrow" in plan_of(table)
    assert sorted(r.start for r in table.select("start").collect()) == list(range(1, 20_001))
    assert table.rdd.getNumPartitions() > 5


def test_mixed_compression_and_headers(spark, tmp_path):
    other = HEADER.replace("ID=AF,Number=A,Type=Float", "ID=AF,Number=1,Type=Integer")
    other = other.replace("##INFO=<ID=DB", "##INFO=<ID=XX,Number=1,Type=Integer>\n##INFO=<ID=DB")
    line = "chr9\t7\trs9\tA\tC\t.\tPASS\tXX=4;AF=2\n"
    (tmp_path / "a.vcf").write_text(HEADER + BODY)
    (tmp_path / "b.vcf.gz").write_bytes(gzip.compress((other + line).encode()))
    (tmp_path / "c.vcf.bgz").write_bytes(block_gzip((other + line).encode()))
    (tmp_path / "d.vcf").write_text(line)
    fields = {f.field: f for f in vcf.info_definitions_of(spark, str(tmp_path))}
    assert set(fields) == {"TSA", "AF", "XX", "DB"}
    assert fields["AF"] == InfoField("AF", ".", "String")
    table = vcf.scan_vcf(spark, str(tmp_path))
    assert sorted(r.source for r in table.filter("start = 7").collect()) == ["b", "c", "d"]
    assert table.count() == 7


def test_empty_body_and_no_header(spark, tmp_path):
    (tmp_path / "empty.vcf").write_text(HEADER)
    assert vcf.scan_vcf(spark, str(tmp_path / "empty.vcf")).count() == 0
    (tmp_path / "bare.vcf").write_text(BODY)
    assert vcf.info_fields(spark, str(tmp_path / "bare.vcf")) == []
    assert vcf.scan_vcf(spark, str(tmp_path / "bare.vcf")).count() == 4


def test_windows_line_ends_and_sample_columns(spark, tmp_path):
    line = "chr1\t5\t.\tA\tC\t.\tPASS\tTSA=SNV\tGT\t0/1\t1/1\r\nchr1\t6\t.\tA\tC\t.\tPASS\tTSA=indel\r\n"
    text = HEADER.replace("\n", "\r\n") + line
    (tmp_path / "w.vcf").write_bytes(text.encode())
    (tmp_path / "w.vcf.bgz").write_bytes(block_gzip(text.encode(), 50))
    for name in ("w.vcf", "w.vcf.bgz"):
        table = vcf.scan_vcf(spark, str(tmp_path / name), range_bytes=100)
        assert rows(table, "start", "tsa") == [(5, "SNV"), (6, "indel")]


def test_missing_location(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        vcf.scan_vcf(spark, str(tmp_path / "none.vcf"))


def test_header_stops_at_first_body_line():
    text = b"##INFO=<ID=A,x>\n#CHROM\nchr1\t1\n##INFO=<ID=B,x>\n"
    head = blocks._head_of("p", iter([text]))
    assert head.column("value").to_pylist() == ["##INFO=<ID=A,x>", "#CHROM"]


def test_core_names_win(spark):
    lines = spark.createDataFrame([("1\t10\t.\tA\tC\t.\t.\tEND=25;ID=x;Af=1;AF=2",)], "value string")
    fields = [("END", "1", "Integer"), ("ID", "1", "String"), ("Af", "1", "Float"), ("AF", "1", "Float")]
    row = vcf.parse_lines(lines, fields).first()
    assert (row.end, row.info_end, row.info_id, row.af, row.info_af) == (25, 25, "x", 1.0, 2.0)


KEYS = st.sampled_from(["AF", "AFX", "X", "DB", "TSA", "Q"])
VALUES = st.text(st.sampled_from(list('ab=.,"\\ 019é{}:')), max_size=6)
ITEMS = st.lists(
    st.one_of(KEYS, st.builds(lambda k, v: f"{k}={v}", KEYS, VALUES)), min_size=1, max_size=8
)


def by_hand(info: str, key: str) -> str | None:
    for item in info.split(";"):
        name, mark, value = item.partition("=")
        if mark and name == key:
            return value
    return None


def set_by_hand(info: str, key: str) -> bool:
    return any(item.partition("=")[0] == key for item in info.split(";"))


def test_info_is_read_as_by_hand(spark):
    from random import Random

    made = []

    @settings(max_examples=300, deadline=None, database=None)
    @given(ITEMS)
    def collect(items):
        made.append(";".join(items))

    collect()
    Random(1).shuffle(made)
    lines = spark.createDataFrame(
        [(f"1\t{n + 1}\t.\tA\tC\t.\t.\t{info or '.'}",) for n, info in enumerate(made)], "value string"
    )
    fields = [(k, "1", "String") for k in ("AF", "AFX", "X", "TSA", "Q")] + [("DB", "0", "Flag")]
    wanted = ("start", "af", "afx", "x", "tsa", "q", "db")
    got = rows(vcf.parse_lines(lines, fields), *wanted)
    none = lambda v: None if v == "." else v
    hand = sorted(
        (
            (n + 1, *[none(by_hand(i, k)) for k in ("AF", "AFX", "X", "TSA", "Q")], set_by_hand(i, "DB"))
            for n, i in enumerate(made)
        ),
        key=repr,
    )
    assert got == hand


def test_many_fields_and_long_bare_tokens(spark):
    names = ["DP", "Dp", *[f"X{n}" for n in range(20)]]
    info = "x" * 60_000 + ";" + ";".join(f"{k}={n}" for n, k in enumerate(names))
    lines = spark.createDataFrame([(f"1\t9\t.\tA\tC\t.\t.\t{info}",)], "value string")
    got = vcf.parse_lines(lines, [(k, "1", "Integer") for k in names]).first()
    assert (got.dp, got.info_dp, got.x19) == (0, 1, 21)


def test_positions_up_to_the_largest_bigint(spark):
    made = [str(2**63 - 1), str(2**63), "1" + "0" * 30]
    lines = spark.createDataFrame([(f"1\t{p}\t.\tA\tC\t.\t.\t.",) for p in made], "value string")
    assert rows(vcf.parse_lines(lines), "start") == [(2**63 - 1,)]
    assert vcf.rejected_lines(lines).count() == 2


def test_lone_carriage_returns_stay_whichever_reader_is_used(spark, tmp_path):
    body = "1\t9\ta\rb\tA\tC\t.\t.\tX=1\r\n1\t10\tc\tA\tC\t.\t.\tX=2\r\r\n1\t11\td\tA\tC\t.\t.\tX=3\r"
    (tmp_path / "plain.vcf").write_bytes(body.encode())
    (tmp_path / "one.vcf.gz").write_bytes(gzip.compress(body.encode()))
    (tmp_path / "block.vcf.bgz").write_bytes(block_gzip(body.encode(), 20))
    found = {
        name: rows(vcf.scan_vcf(spark, str(tmp_path / name), ["X"]), "start", "id", "x")
        for name in ("plain.vcf", "one.vcf.gz", "block.vcf.bgz")
    }
    assert found["plain.vcf"] == [(10, "c", "2\r"), (11, "d", "3"), (9, "a\rb", "1")]
    assert found["one.vcf.gz"] == found["block.vcf.bgz"] == found["plain.vcf"]


@settings(max_examples=150, deadline=None)
@given(
    st.lists(st.text(st.sampled_from("abc\t"), max_size=30), max_size=60),
    st.integers(1, 80),
    st.integers(20, 400),
    st.booleans(),
)
def test_every_line_belongs_to_one_range(lines, block, step, final_newline):
    text = "\n".join(lines) + ("\n" if final_newline and lines else "")
    data = block_gzip(text.encode(), block)
    found = []
    for start in range(0, len(data), step):
        pieces = blocks.owned_text(io.BytesIO(data), start, min(start + step, len(data)), len(data))
        for batch in blocks.line_batches(pieces):
            found += batch.to_pylist()
    want = text.split("\n")
    if want[-1] == "":
        want = want[:-1]
    assert [x for x in found if x] == [x for x in want if x]


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=3000), st.integers(1, 500), st.integers(7, 200))
def test_inflated_reads_any_member_layout(data, cut, read_size):
    packed = b"".join(gzip.compress(data[i : i + cut]) for i in range(0, len(data), cut))
    packed = packed or gzip.compress(b"")
    assert b"".join(blocks.inflated(io.BytesIO(packed), read_size)) == data


def test_truncated_gzip_is_an_error():
    packed = gzip.compress(b"abc" * 1000)[:-20]
    with pytest.raises(ValueError):
        b"".join(blocks.inflated(io.BytesIO(packed), 16))


def test_short_ranges_share_tasks_and_read_little(spark, tmp_path):
    """A range reads not much more than its own bytes, and no task is made for each small one."""
    import random

    draw = random.Random(1)
    text = "".join(f"{i} {draw.random()} {draw.random()}\n" for i in range(60_000)).encode()
    data = block_gzip(text, 20_000)
    (tmp_path / "a.vcf.bgz").write_bytes(data)
    lines = vcf.read_lines(spark, str(tmp_path), range_bytes=2_000)
    assert len(data) // 2_000 > 500 and lines.rdd.getNumPartitions() <= 8 * spark.sparkContext.defaultParallelism
    assert sorted(r.value for r in lines.collect()) == sorted(text.decode().splitlines())

    class Counting(io.BytesIO):
        taken = 0

        def read(self, size=-1):
            got = super().read(size)
            self.taken += len(got)
            return got

    stream = Counting(data)
    assert b"".join(blocks.owned_text(stream, 100_000, 300_000, len(data))) in text
    assert stream.taken < 200_000 + 5 * blocks.BLOCK_MAX


def test_sources_are_worked_out_once_for_each_file(spark, tmp_path):
    for name in ("a b.vcf", "c+d.vcf.gz"):
        text = (HEADER + BODY).encode()
        (tmp_path / name).write_bytes(gzip.compress(text) if name.endswith("gz") else text)
    table = vcf.scan_vcf(spark, str(tmp_path))
    assert "BroadcastHashJoin" in plan_of(table)
    assert sorted((r.source, r.n) for r in table.groupBy("source").agg(F.count(F.lit(1)).alias("n")).collect()) == [("a b", 4), ("c+d", 4)]
    # A path that the listing spells otherwise still has its source.
    lines = spark.createDataFrame([("x", "/in/e.vcf"), ("y", "/in/f.vcf")], "value string, path string")
    files = spark.createDataFrame([("/in/e.vcf",), ("/in/e.vcf",), ("/in//f.vcf",)], "path string")
    assert rows(vcf.with_source(lines, files), "value", "source") == [("x", "e"), ("y", "f")]


def test_one_look_tells_readable_lines_and_counts_the_others(spark):
    text = [*(HEADER + BODY).splitlines(), "", "  ", " #chr1\t1", "chr1\t99999999999999999999\t.\tA\tC\t.\t.\t."]
    lines = spark.createDataFrame([(v,) for v in text], "value string")
    seen = Observation()
    told = vcf.told_lines(lines, seen)
    assert told.columns == ["value"] and plan_of(told).count("CollectMetrics (") == 1
    assert rows(told) == rows(lines.filter(vcf.is_body_line(F.col("value"))))
    assert seen.get["n"] == vcf.rejected_lines(lines).count() == 4
