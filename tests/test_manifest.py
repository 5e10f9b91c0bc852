from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from varloom.functions import paths as P
from varloom.operators import manifest as M
from varloom.sources import presets
from varloom.sources.listing import collect_parquet, list_files, with_names


def names(spark, *items):
    return spark.createDataFrame([(i,) for i in items], "name string")


def sized(spark, items, columns="name string, size bigint"):
    return spark.createDataFrame(items, columns)


@pytest.mark.parametrize(
    ("name", "is_variant"),
    [
        ("a.vcf", True),
        ("a.vcf.gz", True),
        ("a.vcf.bgz", True),
        ("a.b.vcf.gz", True),
        ("a.vcf.gz.tbi", False),
        ("a.vcf.csi", False),
        ("a.vcf.idx", False),
        ("a.vcfx", False),
        ("vcf", False),
        (".vcf", False),
        ("GCF_000001405.40.gz", False),
        ("a.parquet", False),
    ],
)
def test_classifier(spark, name, is_variant):
    files = spark.createDataFrame([(f"/d.vcf/{name}",)], "path string")
    assert with_names(files).first().is_variant_file is is_variant


# Written by hand: sizes and the text each must have.
SIZE_TEXTS = [
    (0, "0 B"), (1, "1 B"), (1023, "1023 B"), (1024, "1.0 KB"), (1280, "1.2 KB"), (1536, "1.5 KB"),
    (1792, "1.8 KB"), (1_000_000, "976.6 KB"), (1_048_576, "1.0 MB"), (123_456_789, "117.7 MB"),
    (5_000_000_000, "4.7 GB"), (1_099_511_627_776, "1.0 TB"), (4_503_599_627_370_496, "4096.0 TB"),
]


def test_byte_texts(spark):
    df = spark.createDataFrame([(s,) for s, _ in SIZE_TEXTS], "s bigint").select("s", P.human_bytes(F.col("s")))
    assert [tuple(r) for r in df.orderBy("s").collect()] == SIZE_TEXTS


def test_missing_names_with_repeats(spark):
    got = M.missing_by(names(spark, "a", "b", "b", "c"), names(spark, "a", "a", "d"))
    assert rows(got) == [("b",), ("b",), ("c",)]


def test_every_file_of_a_name_is_compared(spark):
    present = spark.createDataFrame(
        [("a", "/x/a", 1), ("a", "/y/a", 5), ("b", "/x/b", 7), ("c", "/x/c", 2048)],
        "name string, path string, size bigint",
    )
    expected = sized(spark, [("a", 5), ("b", None), ("c", 1024), ("z", 1)])
    got = {r.local_path: (r.name, r.status, r.diff) for r in M.reconcile_sizes(expected, present).collect()}
    assert got == {
        "/x/a": ("a", "size_differs", -4),
        "/y/a": ("a", "size_match", 0),
        "/x/b": ("b", "size_unknown", None),
        "/x/c": ("c", "size_differs", 1024),
    }
    wrong = M.size_mismatches(expected, present).filter("name = 'c'").first()
    assert (wrong.local_path, wrong.local_size, wrong.remote_size, wrong.diff) == ("/x/c", 2048, 1024, 1024)


def test_conversion_counts(spark):
    got = M.conversion_counts(names(spark, "a.vcf", "b.vcf.gz", "b.vcf.gz.tbi", "a.parquet")).first()
    assert tuple(got) == (2, 1, False)


def test_split_checks_collect_every_problem(spark):
    inputs = names(spark, "a", "b", "c", "d")
    splits = spark.createDataFrame(
        [("a", True), ("a", True), ("b", True), ("b", False)], "name string, exists boolean"
    )
    checked = M.check_splits(inputs, names(spark, "a", "b", "c"), splits)
    assert rows(checked) == [
        ("a", "ok"),
        ("b", "missing split files"),
        ("c", "no splits"),
        ("d", "missing input"),
    ]
    with pytest.raises(FileNotFoundError, match="no splits: c"):
        M.fail_on_problems(checked)
    M.fail_on_problems(checked.filter("problem = 'ok'"))


def test_plan_and_summary(spark):
    local = spark.createDataFrame(
        [("/d/n", "p/n", 1), ("/d/s", "p/s", 2), ("/d/x", "p/x", 3), ("/d/u", "p/u", 4)],
        "path string, path_in_repo string, size bigint",
    )
    remote = sized(
        spark, [("p/s", 2), ("p/x", 9), ("p/u", None), ("p/old", 1)], "path_in_repo string, size bigint"
    )
    plan = M.publish_plan(local, remote)
    got = {r.file: (r.uploaded, r.reason, r.remote_size) for r in plan.collect()}
    assert got == {
        "/d/n": (True, "new_file", None),
        "/d/s": (False, "size_match", 2),
        "/d/x": (True, "size_differs", 9),
        "/d/u": (True, "size_unknown", None),
    }
    assert tuple(M.publish_summary(plan).first()) == (4, 3, 1)
    assert tuple(M.publish_summary(plan.filter("file = ''")).first()) == (0, 0, 0)


def test_targets(spark):
    files = spark.createDataFrame([("/d/SNV/a.parquet",), ("/e/b.parquet",)], "path string")
    got = M.target_paths(files, "data", "/d/").select("path_in_repo")
    assert rows(got) == [("data/SNV/a.parquet",), ("data/b.parquet",)]
    flat = M.target_paths(files, "data").select("path_in_repo")
    assert rows(flat) == [("data/a.parquet",), ("data/b.parquet",)]
    M.guard_targets(M.target_paths(files))
    twice = spark.createDataFrame([("/d/a/x.parquet",), ("/d/b/x.parquet",)], "path string")
    with pytest.raises(ValueError, match="data/x.parquet"):
        M.guard_targets(M.target_paths(twice))


def test_only_parquet_is_publishable(spark):
    M.guard_extension(names(spark, "a.parquet"))
    with pytest.raises(ValueError, match="2 files .* a.vcf, b.tbi"):
        M.guard_extension(names(spark, "a.parquet", "b.tbi", "a.vcf"))


def test_statistics(spark):
    files = spark.createDataFrame(
        [("/d/SNV/a.parquet", 2**30), ("/d/tsa=a%2Fb/x.parquet", 2**29), ("/d/top.parquet", 0)],
        "path string, size bigint",
    )
    got = M.dataset_stats(files, "/d").first()
    assert (got.num_files, got.total_size_gb, got.variant_types) == (3, 1.5, ["SNV", "a/b"])
    none = M.dataset_stats(files.filter("size < 0"), "/d").first()
    assert (none.num_files, none.total_size_gb, none.variant_types) == (0, 0.0, [])


def test_listing(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    for name in ("a 1.vcf", "b+%41.parquet", "sub/c.parquet"):
        (tmp_path / name).write_text("xyz")
    flat = list_files(spark, str(tmp_path))
    assert rows(flat, "name", "size") == [("a 1.vcf", 3), ("b+%41.parquet", 3)]
    assert list_files(spark, str(tmp_path), recursive=True).count() == 3
    assert rows(list_files(spark, f"{tmp_path}/*/*.parquet"), "name") == [("c.parquet",)]
    assert rows(list_files(spark, str(tmp_path), "^a.*f$"), "name") == [("a 1.vcf",)]
    assert rows(collect_parquet(spark, str(tmp_path)), "name") == [("b+%41.parquet",), ("c.parquet",)]
    assert collect_parquet(spark, str(tmp_path), recursive=False).count() == 1
    both = list_files(spark, [str(tmp_path), str(tmp_path / "sub")])
    assert rows(both, "name")[-1] == ("c.parquet",)
    assert rows(list_files(spark, str(tmp_path / "a 1.vcf")), "name") == [("a 1.vcf",)]
    import os

    assert list_files(spark, os.path.relpath(tmp_path)).count() == 2
    with pytest.raises(FileNotFoundError):
        list_files(spark, str(tmp_path / "none"))


def test_decoded_paths_equal_listed_ones(spark, tmp_path):
    name = "a +%41é.txt"
    (tmp_path / name).write_text("x")
    read = spark.read.text(str(tmp_path)).select(P.decoded_path(F.col("_metadata.file_path"))).first()[0]
    assert read == f"{tmp_path}/{name}" == list_files(spark, str(tmp_path)).first().path


def test_presets(spark):
    assert presets.preset("dbsnp").name == "dbsnp_grch38"
    assert presets.preset("gnomad", "v3").pattern.startswith("gnomad")
    for name, release in (("dbsnp", "GRCh36"), ("gnomad", "v9"), ("other", None)):
        with pytest.raises(ValueError, match="Unsupported"):
            presets.preset(name, release)
    files = spark.createDataFrame(
        [("/f/homo_sapiens-chr1.vcf.gz",), ("/f/clinvar.vcf.gz",), ("/f/homo_sapiens-chr1.vcf.gz.tbi",)],
        "path string",
    )
    assert rows(presets.assign_presets(files), "preset") == [("clinvar",), ("ensembl_variations",)]
