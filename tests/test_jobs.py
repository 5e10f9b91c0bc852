from __future__ import annotations

import glob
import gzip
import os

import pytest
from conftest import BODY, HEADER, block_gzip, rows

from varloom.operators import compare as CM
from varloom.plans import prepare, publish
from varloom.session import shared_folder
from varloom.sources import columnar
from varloom.streaming.incremental import incremental_convert


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.vcf").write_text(HEADER + BODY)
    (folder / "b.vcf.gz").write_bytes(gzip.compress((HEADER + BODY).encode()))
    (folder / "b.vcf.gz.tbi").write_bytes(b"index")
    return folder


def test_prepare_with_splitting(spark, landing, tmp_path):
    done = prepare.prepare_source(spark, str(landing), str(tmp_path / "out"), with_splitting=True)
    assert done.files.count() == 3 and rows(done.passed_through, "name") == [("b.vcf.gz.tbi",)]
    assert done.converted.rejected == 4
    assert tuple(done.counts.first()) == (2, 2, True)
    assert done.split_table.count() == 10  # two files, each four rows and one more allele
    assert sum(r.rows for r in done.splits.collect()) == 10
    again = prepare.prepare_source(spark, str(landing), str(tmp_path / "out"), with_splitting=True)
    assert not again.converted.written and CM.same_rows(again.split_table, done.split_table)


def test_prepare_again_takes_new_files_only(spark, landing, tmp_path):
    def run():
        return prepare.prepare_source(spark, str(landing), str(tmp_path / "o"), with_splitting=True)

    run()
    old = {p: os.path.getmtime(p) for p in glob.glob(f"{tmp_path}/o/split/*/*/*.parquet")}
    wider = HEADER.replace("##INFO=<ID=DB", "##INFO=<ID=XX,Number=1,Type=Integer>\n##INFO=<ID=DB")
    (landing / "02.vcf").write_text(wider + "chr1\t1\t.\tA\tC,G\t.\t.\tTSA=SNV;XX=4\n")
    done = run()
    assert done.converted.written and done.converted.rejected == 0
    assert rows(done.split_table.groupBy("source").count()) == [("02", 2), ("a", 5), ("b", 5)]
    assert rows(done.split_table.filter("source = '02'"), "xx") == [(4,), (4,)]
    assert all(os.path.getmtime(p) == t for p, t in old.items())
    assert not run().converted.written


def test_a_file_not_marked_as_done_is_written_again(spark, landing, tmp_path):
    out = tmp_path / "o"
    prepare.prepare_source(spark, str(landing), str(out))
    done = spark.read.parquet(str(out / "variants" / "_sources"))
    kept, schema = [tuple(r) for r in done.collect() if r.source != "b"], done.schema
    for name in glob.glob(f"{out}/variants/_sources/*.parquet"):
        os.remove(name)
    spark.createDataFrame(kept, schema).write.mode("append").parquet(str(out / "variants" / "_sources"))
    again = prepare.prepare_source(spark, str(landing), str(out))
    assert rows(again.converted.table.groupBy("source").count()) == [("a", 4), ("b", 4)]


def test_equal_stems_and_changed_files(spark, landing, tmp_path):
    """Another folder's file of a known stem is added, and a changed file replaces its old rows."""

    def run():
        places = [str(landing), str(tmp_path / "more")]
        return prepare.prepare_source(spark, places, str(tmp_path / "o"), with_splitting=True)

    (tmp_path / "more").mkdir()
    (tmp_path / "more" / "z.vcf").write_text(HEADER + BODY)
    first = run()
    assert first.converted.rejected == 6
    (tmp_path / "more" / "a.vcf").write_text(HEADER + BODY)
    (tmp_path / "more" / "a.vcf.gz").write_bytes(gzip.compress((HEADER + BODY).encode()))
    second = run()
    assert rows(second.converted.table.groupBy("source").count()) == [("a", 12), ("b", 4), ("z", 4)]
    assert rows(second.split_table.groupBy("source").count()) == [("a", 15), ("b", 5), ("z", 5)]
    assert spark.read.parquet(second.converted.rejects_path).count() == 10
    (landing / "a.vcf").write_text(HEADER)
    later = os.path.getmtime(landing / "a.vcf") + 10
    os.utime(landing / "a.vcf", (later, later))
    third = run()
    assert rows(third.converted.table.groupBy("source").count()) == [("a", 8), ("b", 4), ("z", 4)]
    assert rows(third.split_table.groupBy("source").count()) == [("a", 10), ("b", 5), ("z", 5)]
    assert spark.read.parquet(f"{tmp_path}/o/variants_rejects").count() == 8
    status = {os.path.relpath(r.path, tmp_path): r.status for r in third.status.collect()}
    assert status == {"in/a.vcf": "no rows", **dict.fromkeys(["in/b.vcf.gz", "more/a.vcf", "more/a.vcf.gz", "more/z.vcf"], "converted")}
    assert not run().converted.written


@pytest.mark.parametrize("number", ["A", "."])
def test_a_header_that_cannot_fit_fails_before_anything_is_written(spark, landing, tmp_path, number):
    out = str(tmp_path / "o")
    (landing / "b.vcf.gz").rename(tmp_path / "b.vcf.gz")
    wider = HEADER.replace("ID=TSA,Number=1", "ID=TSA,Number=.")
    (landing / "a.vcf").write_text(wider + BODY)
    prepare.prepare_source(spark, str(landing), out)
    (tmp_path / "b.vcf.gz").rename(landing / "b.vcf.gz")
    both = prepare.prepare_source(spark, str(landing), out).converted.table
    assert both.count() == 8 and dict(both.dtypes)["tsa"] == "array<string>"
    (landing / "c.vcf").write_text(HEADER.replace("ID=DB,Number=0,Type=Flag", f"ID=DB,Number={number},Type=Integer") + BODY)
    with pytest.raises(ValueError, match="DB"):
        prepare.prepare_source(spark, str(landing), out)
    assert columnar.scan_split(spark, f"{out}/variants", ["source"]).count() == 8


def test_prepare_checks_an_expected_listing(spark, landing, tmp_path):
    def run(items):
        expected = spark.createDataFrame(items, "name string, size bigint")
        return prepare.prepare_source(
            spark, str(landing), str(tmp_path / "o"), pattern="[.]vcf$", expected=expected
        )

    size = os.path.getsize(landing / "a.vcf")
    assert run([("a.vcf", size)]).converted.table.count() == 4
    with pytest.raises(FileNotFoundError, match="lost.vcf"):
        run([("a.vcf", size), ("lost.vcf", 1)])
    with pytest.raises(ValueError, match="bytes, not 1"):
        run([("a.vcf", 1)])


def test_prepare_of_other_files_only(spark, landing, tmp_path):
    done = prepare.prepare_source(spark, str(landing), str(tmp_path / "o"), pattern="tbi$", with_splitting=True)
    assert done.converted is None and done.splits is None
    assert rows(done.passed_through, "name") == [("b.vcf.gz.tbi",)]
    assert done.counts.first().complete


def test_prepare_named_source_of_unmarked_names(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "GCF_000001405.40.gz").write_bytes(block_gzip((HEADER + BODY).encode()))
    (tmp_path / "in" / "other.vcf").write_text(HEADER + BODY)
    done = prepare.prepare_named(spark, "dbsnp", str(tmp_path / "in"), str(tmp_path / "o"), with_splitting=True)
    assert rows(done.split_table.select("source").distinct()) == [("GCF_000001405.40",)]
    assert done.split_table.count() == 5


def test_named_type_column(spark, tmp_path):
    (tmp_path / "in").mkdir()
    text = HEADER.replace("ID=TSA", "ID=CLNVC") + BODY.replace("TSA=", "CLNVC=")
    (tmp_path / "in" / "clinvar.vcf.gz").write_bytes(gzip.compress(text.encode()))
    done = prepare.prepare_named(spark, "clinvar", str(tmp_path / "in"), str(tmp_path / "o"), with_splitting=True)
    assert "clnvc=SNV" in os.listdir(tmp_path / "o" / "split")


def test_split_existing(spark, tmp_path):
    for name in ("x.parquet", "y.parquet"):
        spark.createDataFrame([("A|C", "SNV"), ("T", "indel")], "alt string, tsa string").coalesce(
            1
        ).write.parquet(str(tmp_path / name))
    paths = [str(tmp_path / n) for n in ("x.parquet", "y.parquet", "readme.txt")]
    table, splits = prepare.split_existing(spark, paths, str(tmp_path / "o"))
    assert rows(table.groupBy("source").count()) == [("x", 3), ("y", 3)]
    assert rows(splits, "variant_type", "source") == [
        ("SNV", "x"), ("SNV", "y"), ("indel", "x"), ("indel", "y"),
    ]
    with pytest.raises(ValueError):
        prepare.split_existing(spark, ["a.txt"], str(tmp_path / "n"))
    again, _ = prepare.split_existing(spark, [os.path.relpath(p) for p in paths], str(tmp_path / "relative"))
    assert rows(again.groupBy("source").count()) == [("x", 3), ("y", 3)]


@pytest.fixture
def dataset(spark, tmp_path):
    out = str(tmp_path / "set")
    spark.range(100).selectExpr("id", "if(id % 3 = 0, 'SNV', 'indel') tsa", "'s' source").write.partitionBy(
        "tsa", "source"
    ).parquet(out)
    return out


def test_publish_copies_whole_files_once(spark, dataset, tmp_path):
    hub = str(tmp_path / "hub")
    dry = publish.publish(spark, dataset, hub, dry_run=True)
    assert dry.copied == 0 and not os.path.exists(hub)
    first = publish.publish(spark, dataset, hub)
    total = first.summary.first().total
    assert first.copied == total and first.summary.first().num_uploaded == total
    assert first.stats.first().variant_types == ["SNV", "indel"]
    assert CM.same_rows(columnar.scan_split(spark, f"{hub}/data"), columnar.scan_split(spark, dataset))
    assert not [n for n in os.listdir(hub) if n.startswith(".staging")]
    again = publish.publish(spark, dataset, hub)
    assert again.copied == 0 and again.summary.first().num_skipped == total


def test_publish_between_relative_folders(spark, dataset, tmp_path):
    hub = str(tmp_path / "hub")
    publish.publish(spark, os.path.relpath(dataset), "file://" + hub)
    assert columnar.scan_split(spark, f"{hub}/data").count() == 100
    again = publish.publish(spark, "file:" + dataset, os.path.relpath(hub))
    assert again.copied == 0
    assert publish.refresh_stats(spark, os.path.relpath(dataset)).first().variant_types == ["SNV", "indel"]


def test_publish_replaces_a_changed_file(spark, dataset, tmp_path):
    hub = str(tmp_path / "hub")
    publish.publish(spark, dataset, hub)
    victim = glob.glob(f"{hub}/data/tsa=SNV/source=s/*.parquet")[0]
    with open(victim, "ab") as f:
        f.write(b"x")
    again = publish.publish(spark, dataset, hub)
    assert again.copied == 1
    assert rows(again.plan.filter("uploaded"), "reason") == [("size_differs",)]
    assert columnar.scan_split(spark, f"{hub}/data").count() == 100


def test_publish_of_a_rewritten_set_never_doubles_rows(spark, dataset, tmp_path):
    hub = str(tmp_path / "hub")
    publish.publish(spark, dataset, hub)
    spark.range(40).selectExpr("id", "'SNV' tsa", "'s' source").write.mode("overwrite").partitionBy(
        "tsa", "source"
    ).parquet(dataset)
    with pytest.raises(ValueError, match="no longer has"):
        publish.publish(spark, dataset, hub)
    publish.publish(spark, dataset, hub, stale="remove")
    assert columnar.scan_split(spark, f"{hub}/data").count() == 40


def test_publish_nothing(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    done = publish.publish(spark, str(tmp_path / "empty"), str(tmp_path / "hub"))
    assert tuple(done.summary.first()) == (0, 0, 0)
    assert tuple(publish.refresh_stats(spark, str(tmp_path / "empty")).first()) == (0, 0.0, [])


def test_moving_twice_is_harmless(tmp_path):
    import pyarrow as pa

    (tmp_path / "s").write_text("abc")
    places = {"from_path": tmp_path / "s", "to_path": tmp_path / "x/y", "kept_path": tmp_path / "k/y"}
    (tmp_path / "x").mkdir()
    (tmp_path / "x/y").write_text("old file")
    batch = pa.RecordBatch.from_pylist([{k: str(v) for k, v in places.items()}])
    for _ in range(2):
        done = list(publish.move_files(iter([batch])))
        assert done[0].column("bytes").to_pylist() == [3]
    assert (tmp_path / "k/y").read_text() == "old file" and (tmp_path / "x/y").read_text() == "abc"


def test_incremental_takes_each_file_once(spark, landing, tmp_path):
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    first = incremental_convert(spark, str(landing), out, state)
    assert rows(first.groupBy("source").count()) == [("a", 4), ("b", 4)]
    assert incremental_convert(spark, str(landing), out, state).count() == 8
    wider = HEADER.replace("##INFO=<ID=DB", "##INFO=<ID=XX,Number=1,Type=Integer>\n##INFO=<ID=DB")
    (landing / "c.vcf.bgz").write_bytes(block_gzip((wider + "chr1\t1\t.\tA\tC\t.\t.\tXX=4\n").encode()))
    third = incremental_convert(spark, str(landing), out, state)
    assert third.count() == 9
    assert rows(third.filter("source = 'c'"), "xx") == [(4,)]
    assert spark.read.parquet(f"{out}_rejects").count() == 4


def test_incremental_follows_changed_files(spark, landing, tmp_path):
    """A file replaced under its name, by a newer and by an older one, replaces its rows."""
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    run = lambda: incremental_convert(spark, str(landing), out, state, follow_changes=True)
    assert rows(run().groupBy("source").count()) == [("a", 4), ("b", 4)]
    (landing / "a.vcf").write_text(HEADER + "chr9\t7\tnew\tA\tC\t.\t.\tTSA=SNV\n")
    (landing / "c.vcf").write_text(HEADER + BODY)
    got = run()
    assert rows(got.groupBy("source").count()) == [("a", 1), ("b", 4), ("c", 4)]
    assert rows(got.filter("source = 'a'"), "chrom", "id") == [("chr9", "new")]
    (landing / "c.vcf").write_text(HEADER + "chr8\t7\told\tA\tC\t.\t.\tTSA=SNV\n")
    os.utime(landing / "c.vcf", (1_000_000_000, 1_000_000_000))
    assert rows(run().filter("source = 'c'"), "id") == [("old",)]
    assert run().count() == 6
    assert incremental_convert(spark, str(landing), str(tmp_path / "by_batch"), str(tmp_path / "s2")).count() == 6
    with pytest.raises(ValueError, match="batches"):
        incremental_convert(spark, str(landing), str(tmp_path / "by_batch"), str(tmp_path / "s2"), follow_changes=True)


def test_incremental_without_variant_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "note.txt").write_text("x")
    assert incremental_convert(spark, str(tmp_path / "in"), str(tmp_path / "o"), str(tmp_path / "s")) is None
    empty = incremental_convert(spark, str(tmp_path / "in"), str(tmp_path / "o"), str(tmp_path / "f"), follow_changes=True)
    assert empty is None


def test_shared_folder_is_the_configured_one(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
