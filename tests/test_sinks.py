from __future__ import annotations

import glob
import os

import pyarrow.parquet as pq
import pytest
from conftest import BODY, HEADER, plan_of, rows

from varloom.functions.paths import variant_stem_of
from varloom.operators import compare as CM
from varloom.operators import reencode as RE
from varloom.operators import sinks as K
from varloom.sources import columnar
from varloom.sources.listing import list_files

SAMPLE = [
    ("chr1", 100, 101, "A", "T", "GENE1", "missense"),
    ("chr1", 200, 201, "C", "G", "GENE2", "synonymous"),
    ("chr2", 300, 301, "G", "A", "GENE3", "missense"),
    ("chr2", 400, 401, "T", "C", "GENE4", "nonsense"),
    ("chr3", 500, 501, "A", "G", "GENE5", "missense"),
]
SCHEMA = (
    "chrom string, start bigint, end bigint, ref string, alt string, "
    "gene_name string, consequence string"
)


@pytest.fixture
def stored(spark, tmp_path):
    path = str(tmp_path / "variants.parquet")
    spark.createDataFrame(SAMPLE, SCHEMA).coalesce(1).write.parquet(path)
    return path


@pytest.mark.parametrize("file_format", ["parquet", "orc"])
@pytest.mark.parametrize("profile", ["compact", "default"])
def test_reencode_round_trip(spark, stored, tmp_path, profile, file_format):
    rows_in_group = 2 if file_format == "parquet" else None
    out = RE.reencode(spark, stored, str(tmp_path / "o"), profile, rows_in_group, file_format)
    again = columnar.scan(spark, out, file_format=file_format)
    assert again.columns == spark.read.parquet(stored).columns
    assert [tuple(r) for r in again.orderBy("chrom", "start").collect()] == SAMPLE
    assert CM.same_rows(spark.read.parquet(stored), again)


def test_batch_size_bounds_row_groups(spark, tmp_path):
    spark.range(1000).coalesce(1).write.parquet(str(tmp_path / "n.parquet"))
    out = RE.reencode(spark, str(tmp_path / "n.parquet"), batch_size=200)
    meta = pq.read_metadata(glob.glob(f"{out}/*.parquet")[0])
    assert meta.num_row_groups == 5
    assert meta.row_group(0).column(0).compression == "ZSTD"
    assert out.endswith("n.compact")


def test_copies_are_made_again_and_kept_apart(spark, tmp_path):
    path = str(tmp_path / "n.parquet")
    spark.range(5).write.parquet(path)
    first = RE.reencode(spark, path)
    assert RE.reencode(spark, path) == first
    spark.range(9).write.mode("overwrite").parquet(path)
    later = os.path.getmtime(f"{first}/_SUCCESS") + 10
    os.utime(f"{path}/_SUCCESS", (later, later))
    assert spark.read.parquet(RE.reencode(spark, path)).count() == 9
    orc = RE.reencode(spark, path, file_format="orc")
    assert orc.endswith("n.compact.orc") and spark.read.orc(orc).count() == 9
    with pytest.raises(ValueError, match="batch_size"):
        RE.reencode(spark, path, batch_size=3, file_format="orc")


def test_a_single_file_that_exists_is_reused(spark, vcf_file, tmp_path):
    spark.range(3).coalesce(1).write.parquet(str(tmp_path / "made"))
    target = str(tmp_path / "x.parquet")
    os.rename(glob.glob(f"{tmp_path}/made/*.parquet")[0], target)
    assert K.vcf_to_parquet(spark, vcf_file, target)[0].count() == 3
    assert os.path.isfile(target)


def test_read_vcf_modes(spark, vcf_file, tmp_path):
    out = str(tmp_path / "m.parquet")
    K.read_vcf(spark, vcf_file, save_to=out)
    with pytest.raises(FileExistsError):
        K.read_vcf(spark, vcf_file, save_to=out, mode="fail")
    made = os.path.getmtime(f"{out}/_SUCCESS")
    assert K.read_vcf(spark, vcf_file, save_to=out, mode="reuse").count() == 4
    assert os.path.getmtime(f"{out}/_SUCCESS") == made


def test_missing_table(spark):
    with pytest.raises(FileNotFoundError):
        columnar.scan(spark, "/tmp/no-such-table.parquet")
    with pytest.raises(FileNotFoundError):
        columnar.scan_split(spark, "/tmp/no-such-table.parquet")


def test_columns_and_predicate_reach_the_reader(spark, stored):
    df = columnar.scan(spark, stored, ["chrom", "start"], "chrom = 'chr1' and ref = 'C'")
    plan = plan_of(df)
    assert "EqualTo(chrom,chr1)" in plan and "EqualTo(ref,C)" in plan
    assert "gene_name" not in plan
    assert rows(df) == [("chr1", 200)]


def test_save_modes(spark, tmp_path):
    out = str(tmp_path / "t")
    a, b = spark.range(3), spark.range(5)
    assert K.save(spark, a, out)
    with pytest.raises(FileExistsError):
        K.save(spark, b, out)
    assert not K.save(spark, b, out, mode="reuse")
    assert spark.read.parquet(out).count() == 3
    os.remove(f"{out}/_SUCCESS")
    assert K.save(spark, b, out, mode="reuse")
    assert K.save(spark, a, out, mode="overwrite")
    assert spark.read.parquet(out).count() == 3
    with pytest.raises(ValueError):
        K.save(spark, a, out, mode="append")
    with pytest.raises(ValueError):
        K.save(spark, a, out, mode="overwrite", profile="tiny")


@pytest.mark.parametrize(
    ("name", "stem"),
    [
        ("a.vcf", "a"),
        ("a.vcf.gz", "a"),
        ("a.b.vcf.gz", "a.b"),
        ("a.vcf.bgz", "a"),
        ("GCF_000001405.40.gz", "GCF_000001405.40"),
        ("a.txt", "a"),
        (".hidden", ".hidden"),
    ],
)
def test_output_names(spark, name, stem):
    from pyspark.sql import functions as F

    from varloom.functions.paths import variant_stem

    assert variant_stem_of(name) == stem
    assert K.default_output(f"/x/{name}") == f"/x/{stem}.parquet"
    got = spark.createDataFrame([(name,)], "n string").select(variant_stem(F.col("n"))).first()[0]
    assert got == stem


def test_save_policy():
    assert K.resolve_output(None, "/x/a.vcf") is None
    assert K.resolve_output("auto", "/x/a.vcf.gz") == "/x/a.parquet"
    assert K.resolve_output("/y/b", "/x/a.vcf") == "/y/b"


def test_read_vcf_with_both_outputs(spark, vcf_file, tmp_path):
    df = K.read_vcf(spark, vcf_file, save_to=str(tmp_path / "v.parquet"), save_compact="auto")
    assert df.count() == 4
    assert os.path.exists(tmp_path / "v.parquet") and os.path.exists(tmp_path / "v.compact")
    assert CM.same_rows(df, columnar.scan(spark, str(tmp_path / "v.compact")))


def test_read_vcf_compact_only(spark, vcf_file, tmp_path):
    df = K.read_vcf(spark, vcf_file, save_to=None, save_compact=str(tmp_path / "only.compact"))
    assert os.path.exists(tmp_path / "only.compact") and not os.path.exists(tmp_path / "sample.parquet")
    assert "Scan text" in plan_of(df)


def test_read_vcf_auto_and_parquet_shortcut(spark, vcf_file, tmp_path):
    df = K.read_vcf(spark, vcf_file)
    assert "Scan parquet" in plan_of(df)
    again = K.read_vcf(spark, str(tmp_path / "sample.parquet"))
    assert CM.same_rows(df, again)


def test_conversion_counts_and_keeps_rejects(spark, vcf_file, tmp_path):
    done = K.convert_vcf(spark, vcf_file, str(tmp_path / "out"))
    assert (done.written, done.rejected) == (True, 2)
    assert spark.read.parquet(done.rejects_path).count() == 2
    again = K.convert_vcf(spark, vcf_file, str(tmp_path / "out"))
    assert not again.written and again.table.count() == 4


def test_newer_input_is_converted_again(spark, vcf_file, tmp_path):
    out = str(tmp_path / "o.parquet")
    K.vcf_to_parquet(spark, vcf_file, out)
    with open(vcf_file, "a") as f:
        f.write("chr9\t9\t.\tA\tC\t.\tPASS\t.\n")
    later = os.path.getmtime(f"{out}/_SUCCESS") + 10
    os.utime(vcf_file, (later, later))
    assert K.vcf_to_parquet(spark, vcf_file, out)[0].count() == 4
    assert K.vcf_to_parquet(spark, vcf_file, out, check_newer=True)[0].count() == 5


def test_listed_conversion_passes_other_files_through(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name in ("02.vcf", "b.vcf"):
        (tmp_path / "in" / name).write_text(HEADER + BODY)
    (tmp_path / "in" / "b.vcf.gz.tbi").write_bytes(b"index")
    files = list_files(spark, str(tmp_path / "in"))
    done, passed = K.convert_listed(spark, files, str(tmp_path / "out"))
    assert rows(passed, "name") == [("b.vcf.gz.tbi",)]
    assert rows(done.table.groupBy("source").count()) == [("02", 4), ("b", 4)]
    none, _ = K.convert_listed(spark, files.filter("not is_variant_file"), str(tmp_path / "none"))
    assert none is None


def test_tree_keeps_relative_names_and_skips_broken_files(spark, tmp_path):
    root = tmp_path / "tree"
    (root / "SNV").mkdir(parents=True)
    (root / "indel").mkdir()
    for n, place in enumerate(("SNV/a.parquet", "indel/a.parquet")):
        pq.write_table(spark.range(n + 3).toArrow(), str(root / place))
    (root / "SNV" / "broken.parquet").write_bytes(b"PAR1 not a table PAR1")
    with pytest.raises(Exception):  # noqa: B017 - the reader's own error
        RE.reencode_tree(spark, str(root), str(tmp_path / "fail"))
    table, broken = RE.reencode_tree(spark, str(root), str(tmp_path / "out"), on_error="skip")
    assert rows(table.groupBy("source").count()) == [("SNV/a", 3), ("indel/a", 4)]
    assert [os.path.basename(r.path) for r in broken.collect()] == ["broken.parquet"]
    again, _ = RE.reencode_tree(spark, str(root), str(tmp_path / "out"), on_error="skip")
    assert again.count() == 7


def test_tree_of_files_with_different_columns(spark, tmp_path):
    (tmp_path / "t").mkdir()
    pq.write_table(spark.range(2).toArrow(), str(tmp_path / "t" / "a.parquet"))
    wider = spark.range(3).selectExpr("id", "'x' extra")
    pq.write_table(wider.toArrow(), str(tmp_path / "t" / "b.parquet"))
    table, _ = RE.reencode_tree(spark, os.path.relpath(tmp_path / "t"), str(tmp_path / "o"))
    assert rows(table.groupBy("source").agg({"extra": "count"})) == [("a", 0), ("b", 3)]


def test_tree_errors(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        RE.reencode_tree(spark, str(tmp_path / "none"), str(tmp_path / "o"))
    with pytest.raises(ValueError):
        RE.reencode_tree(spark, str(tmp_path), str(tmp_path / "o"), on_error="maybe")
    (tmp_path / "empty").mkdir()
    assert RE.reencode_tree(spark, str(tmp_path / "empty"), str(tmp_path / "o"))[0] is None


def test_size_report(spark):
    before = spark.createDataFrame([("a", 1000), ("a", 600), ("b", 0)], "key string, size bigint")
    after = spark.createDataFrame([("a", 1500), ("b", 7)], "key string, size bigint")
    got = {r.key: r.saved_percent for r in RE.size_report(before, after).collect()}
    assert got == {"a": 6.2, "b": 0.0}  # 6.25 rounds half to even


def test_bag_comparison(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (None,)], "x int")
    b = spark.createDataFrame([(1,), (2,), (2,), (None,), (3,)], "x int")
    got = CM.difference_counts(a, b).first()
    assert (got.left_only, got.right_only) == (1, 2)
    assert not CM.same_rows(a, b) and CM.same_rows(a, a.orderBy("x"))
    assert not CM.same_rows(a, a.selectExpr("cast(x as bigint) x"))
    assert CM.fingerprint(a).first() == CM.fingerprint(a.repartition(3)).first()
    assert CM.fingerprint(a).first() != CM.fingerprint(b).first()


def test_tree_leaves_out_files_with_damaged_pages(spark, tmp_path):
    """No row of a half-readable file is kept; what was readable is reported."""
    root = tmp_path / "in"
    for name in ("a", "b"):
        rows = spark.range(0, 200_000, 1, 1).selectExpr("id", "concat('text', id) AS t")
        writer = rows.write.option("parquet.block.size", "200000").option("parquet.page.size", "20000")
        writer.parquet(str(root / name))
    harmed = next((root / "b").glob("*.parquet"))
    data = bytearray(harmed.read_bytes())
    data[len(data) // 2 : len(data) // 2 + 20_000] = b"\xff" * 20_000
    (root / "b" / f".{harmed.name}.crc").unlink()
    harmed.write_bytes(data)
    table, left_out = RE.reencode_tree(spark, str(root), str(tmp_path / "out"), on_error="skip")
    (row,) = left_out.collect()
    assert os.path.basename(row.path) == harmed.name and row.rows == 200_000 and 0 <= row.readable < 200_000
    assert f"{row.readable} of 200000 rows" in row.problem
    assert table.count() == 200_000 and table.select("source").distinct().count() == 1
    again, left_out = RE.reencode_tree(spark, str(root), str(tmp_path / "out"), on_error="skip")
    assert left_out.count() == 1 and again.count() == 200_000
    with pytest.raises(Exception):
        RE.reencode_tree(spark, str(root), str(tmp_path / "stop"))


def test_the_latest_record_of_a_file_counts(spark, tmp_path):
    """A file that goes from A to B and back to A, times included, ends with A's rows."""
    place, out = tmp_path / "in" / "chr1.vcf", str(tmp_path / "out")
    place.parent.mkdir()
    head = "##fileformat=VCFv4.2\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\n"
    form = lambda n: head + "".join(f"chr1\t{i}\t.\tA\tC\t.\t.\t.\n" for i in range(1, n + 1))

    def converted(n, time):
        place.write_text(form(n))
        os.utime(place, (time, time))
        files = list_files(spark, str(place.parent))
        return K.convert_listed(spark, files, out)[0].table.count()

    assert [converted(3, 1000), converted(5, 2000), converted(3, 1000), converted(4, 500)] == [3, 5, 3, 4]


def test_a_job_that_died_is_redone_after_the_file_is_put_back(spark, tmp_path, monkeypatch):
    place, out = tmp_path / "in" / "chr1.vcf", str(tmp_path / "out")
    place.parent.mkdir()
    head = "##fileformat=VCFv4.2\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\n"

    def converted(n, time):
        place.write_text(head + "".join(f"chr1\t{i}\t.\tA\tC\t.\t.\t.\n" for i in range(1, n + 1)))
        os.utime(place, (time, time))
        return K.convert_listed(spark, list_files(spark, str(place.parent)), out)[0].table.count()

    assert converted(3, 1000) == 3
    real = K.save

    def dies(*args, **options):
        raise RuntimeError("lost")

    monkeypatch.setattr(K, "save", dies)
    with pytest.raises(RuntimeError):
        converted(5, 2000)
    monkeypatch.setattr(K, "save", real)
    assert converted(3, 1000) == 3


def test_a_folder_for_each_file_is_written_without_a_sort(spark, tmp_path, monkeypatch):
    """Accepted rows and rejects, whose sort would hold all that a task reads."""
    from pyspark.sql import DataFrameWriter

    name, seen = "spark.sql.maxConcurrentOutputFileWriters", []
    real, before = DataFrameWriter.save, spark.conf.get(name)
    monkeypatch.setattr(DataFrameWriter, "save", lambda self, out: seen.append(spark.conf.get(name)) or real(self, out))
    for n in range(12):
        folder = tmp_path / "in" / f"f{n} %"
        folder.mkdir(parents=True)
        (folder / "x.vcf").write_text(f"chr1\t{n}\t.\tA\tC\t.\t.\tDB\nchr1\tbad {n}\n")
    done = K.convert_vcf(spark, str(tmp_path / "in"), str(tmp_path / "out"), ["DB"], partition_by_source=True)
    assert seen == [str(K.OPEN_WRITERS)] * 2 and spark.conf.get(name) == before
    assert sorted((r.source, r.start) for r in done.table.collect()) == [("x", n) for n in range(12)]
    kept = spark.read.parquet(done.rejects_path)
    assert {r.value for r in kept.collect()} == {f"chr1\tbad {n}" for n in range(12)} and kept.count() == 12


def test_lines_joined_to_a_text(spark):
    import pyarrow as pa

    from varloom.plans import views

    lines = pa.array(["x", "a\tb", "", None, "\u00e9"]).slice(1)
    assert bytes(views.text_of(lines)) == "a\tb\n\nNone\n\u00e9\n".encode()
    assert bytes(views.text_of(lines.slice(0, 0))) == b""
