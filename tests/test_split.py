from __future__ import annotations

import pytest
from conftest import plan_of, rows

from varloom.operators import split as S
from varloom.sources import columnar

SCHEMA = "chrom string, start bigint, alt string, tsa string, source string"
TABLE = [
    ("chr1", 1, "C|G", "SNV", "02"),
    ("chr1", 2, "T", "SNV", "02"),
    ("chr1", 3, None, "SNV", "02"),
    ("chr1", 4, "C|", "SNV", "x y"),
    ("chr2", 5, "TA|TAA", "insertion", "02"),
    ("chr2", 6, "A|C", None, "02"),
    ("chr2", 7, "A", "a/b", "x y"),
]
EXPLODED = [
    ("chr1", 1, "C", "SNV", "02"),
    ("chr1", 1, "G", "SNV", "02"),
    ("chr1", 2, "T", "SNV", "02"),
    ("chr1", 3, None, "SNV", "02"),
    ("chr1", 4, "C", "SNV", "x y"),
    ("chr1", 4, "", "SNV", "x y"),
    ("chr2", 5, "TA|TAA", "insertion", "02"),
    ("chr2", 6, "A|C", None, "02"),
    ("chr2", 7, "A", "a/b", "x y"),
]


@pytest.fixture
def table(spark):
    return spark.createDataFrame(TABLE, SCHEMA)


def ordered(items):
    return sorted(items, key=repr)


def test_only_named_types_expand(table):
    assert rows(S.explode_alleles(table)) == ordered(EXPLODED)
    assert rows(S.explode_alleles(table, ())) == ordered(TABLE)


def test_all_types_expand(table):
    got = rows(S.explode_alleles(table, None), "start", "alt")
    assert ordered([(5, "TA"), (5, "TAA"), (6, "A"), (6, "C")]) == [r for r in got if r[0] in (5, 6)]
    assert (3, None) in got


def test_other_separator_and_columns(spark):
    df = spark.createDataFrame([("a.b", "k")], "list string, kind string")
    got = S.explode_alleles(df, ["k"], list_col="list", type_col="kind", sep=".")
    assert rows(got) == [("a", "k"), ("b", "k")]


def test_row_count_is_known_before_exploding(table):
    counted = S.exploded_rows(table).first()
    assert (counted.rows_in, counted.rows_out) == (len(TABLE), len(EXPLODED))


@pytest.mark.parametrize("layout", S.LAYOUTS)
def test_split_reads_back_whole(spark, table, tmp_path, layout):
    got, splits = S.split_by_type(spark, table, str(tmp_path / "out"), layout=layout)
    assert rows(got, *table.columns) == ordered(EXPLODED)
    listed = splits.collect()
    assert sum(r.rows for r in listed) == len(EXPLODED)
    assert {(r.variant_type, r.source) for r in listed} == {(r[3], r[4]) for r in EXPLODED}
    import os

    assert all(os.path.getsize(r.path) == r.size for r in listed)


def test_hot_type_is_cut_into_several_files(spark, tmp_path):
    spark.range(200_000).selectExpr(
        "concat('chr', id % 3) chrom", "id start", "repeat(uuid(), 3) alt", "'SNV' tsa", "'s' source"
    ).repartition(8).write.parquet(str(tmp_path / "in.parquet"))
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "2m")
    try:
        source = spark.read.parquet(str(tmp_path / "in.parquet"))
        _, splits = S.split_by_type(spark, source, str(tmp_path / "out"))
        files = splits.collect()
    finally:
        spark.conf.set(size, before)
    assert len(files) > 3
    assert max(r.rows for r in files) < 100_000


def test_unknown_layout_and_missing_column(spark, table, tmp_path):
    with pytest.raises(ValueError, match="layout"):
        S.split_by_type(spark, table, str(tmp_path / "o"), layout="nope")
    with pytest.raises(ValueError, match="clnvc"):
        S.split_by_type(spark, table, str(tmp_path / "o"), type_col="clnvc")


def test_finished_output_is_reused(spark, table, tmp_path):
    out = str(tmp_path / "out")
    S.split_by_type(spark, table, out)
    again, _ = S.split_by_type(spark, table.filter("start = 1"), out)
    assert again.count() == len(EXPLODED)
    fresh, _ = S.split_by_type(spark, table.filter("start = 1"), out, overwrite=True)
    assert fresh.count() == 2


def test_a_second_table_without_sources_is_no_silent_loss(spark, table, tmp_path):
    out = str(tmp_path / "out")
    S.split_by_type(spark, table.drop("source"), out)
    with pytest.raises(FileExistsError, match="source"):
        S.split_by_type(spark, table.drop("source"), out)
    again, _ = S.split_by_type(spark, table.drop("source"), out, overwrite=True)
    assert again.count() == len(EXPLODED)


def test_a_source_of_another_stamp_is_split_again(spark, table, tmp_path):
    out = str(tmp_path / "out")
    stamps = spark.createDataFrame([("02", "1"), ("x y", "1")], "source string, stamp string")
    S.split_by_type(spark, table, out, stamps=stamps)
    changed = spark.createDataFrame([("02", "2"), ("x y", "1")], "source string, stamp string")
    got, _ = S.split_by_type(spark, table.filter("start = 2 or source = 'x y'"), out, stamps=changed)
    assert rows(got, "start") == [(2,), (4,), (4,), (7,)]


def test_empty_table(spark, table, tmp_path):
    # Nothing is written below the folder, so the schema cannot come from a file.
    out = str(tmp_path / "out")
    got, splits = S.split_by_type(spark, table.filter("start < 0"), out)
    assert got.count() == 0 and splits.count() == 0


def test_one_scan_whatever_the_types(spark, table, tmp_path):
    table.write.parquet(str(tmp_path / "t.parquet"))
    stored = spark.read.parquet(str(tmp_path / "t.parquet"))
    plan = plan_of(S.laid_out(S.explode_alleles(stored), "rebalance", ("tsa", "source")))
    assert plan.count("Scan parquet") == 2  # once in the tree, once in the details
    assert plan.count("REBALANCE_PARTITIONS_BY_COL") == 1
    direct = plan_of(S.laid_out(S.explode_alleles(stored), "direct", ("tsa", "source")))
    assert "Exchange" not in direct


def test_type_and_source_prune_folders(spark, table, tmp_path):
    got, _ = S.split_by_type(spark, table, str(tmp_path / "out"))
    one = columnar.read_one(got, "SNV", "02")
    plan = plan_of(one.select("start"))
    assert "PartitionFilters: [isnotnull(tsa" in plan and "(source" in plan
    assert rows(one, "start") == [(1,), (1,), (2,), (3,)]
    assert columnar.read_one(got, "insertion").count() == 1


def test_catalogue(spark, table, tmp_path):
    _, a = S.split_by_type(spark, table, str(tmp_path / "a"))
    _, b = S.split_by_type(spark, table, str(tmp_path / "b"))
    merged = S.merge_catalogues([a, b])
    assert merged.count() == 2 * a.count()
    snv = S.catalogue_summary(merged).filter("variant_type = 'SNV'").first()
    assert (snv.num_files, snv.total_rows) == (4, 12)


def test_type_directory_places(spark, table, tmp_path):
    S.split_by_type(spark, table, str(tmp_path / "pub" / "data"))
    (tmp_path / "plain").mkdir()
    table.filter("tsa = 'SNV'").drop("tsa").write.parquet(str(tmp_path / "plain" / "SNV"))
    nested = columnar.scan_type(spark, str(tmp_path / "pub"), "insertion")
    assert rows(nested, "start", "tsa") == [(5, "insertion")]
    assert columnar.scan_type(spark, str(tmp_path / "plain"), "SNV").count() == 4
    odd = columnar.scan_type(spark, str(tmp_path / "pub"), "a/b")
    assert rows(odd, "start", "tsa", "source") == [(7, "a/b", "x y")]
    with pytest.raises(FileNotFoundError):
        columnar.type_directory(spark, str(tmp_path / "pub"), "nope")
