from __future__ import annotations

from collections import defaultdict
from random import Random

import pytest
from conftest import plan_of, rows

from varloom.operators import annotate as AN
from varloom.operators import lookup as LK
from varloom.operators import split as S

MADE = ("concat('chr', id % 5) chrom", "id start", "'A' ref", "'C' alt")
KEYS = "chrom string, start bigint, ref string, alt string"


def made(seed: int, count: int, null: float = 0.1):
    r = Random(seed)
    pick = lambda *options: r.choice(options)
    return [
        (
            pick("chr1", "chr2", "chr3", None),
            r.randrange(40),
            pick("A", "C"),
            None if r.random() < null else pick("G", "T"),
            f"{seed}-{n}",
        )
        for n in range(count)
    ]


@pytest.fixture(scope="module")
def sides(spark):
    left = made(1, 500) + [("chr1", 7, "A", "G", f"hot-{n}") for n in range(250)]
    right = made(2, 200) + [("chr9", 1, "A", "G", "far")]
    return (
        left,
        right,
        spark.createDataFrame(left, KEYS + ", sid string"),
        spark.createDataFrame(right, KEYS + ", ann string"),
    )


def joined_by_hand(left, right, dedupe=False):
    by_key = defaultdict(list)
    for *key, ann in right:
        by_key[tuple(key)].append(ann)
    out = []
    for *key, sid in left:
        found = [] if None in key else by_key.get(tuple(key), [])
        if dedupe and found:
            found = [min(found)]
        out += [(sid, a) for a in found] or [(sid, None)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("dedupe", [False, True])
@pytest.mark.parametrize("options", [{"reduction": r} for r in AN.REDUCTIONS])
def test_every_way_agrees_with_brute_force(sides, options, dedupe):
    left, right, sample, table = sides
    got = AN.annotate(sample, table, ["ann"], dedupe_keys=dedupe, **options)
    assert got.columns == [*sample.columns, "ann"]
    assert rows(got, "sid", "ann") == joined_by_hand(left, right, dedupe)


def test_agreement_without_broadcast_at_all(spark, sides):
    left, right, sample, table = sides
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        got = AN.annotate(sample, table, ["ann"], reduction="none")
        assert "SortMergeJoin" in plan_of(got) and "BroadcastHashJoin" not in plan_of(got)
        assert rows(got, "sid", "ann") == joined_by_hand(left, right)
    finally:
        spark.conf.set(key, before)


@pytest.mark.parametrize("heavy_rows", [1, 5, 40, 10_000, 0])
@pytest.mark.parametrize("max_bytes", [1, 1 << 20])
@pytest.mark.parametrize("reduction", AN.REDUCTIONS)
def test_heavy_keys_in_parts_agree_with_brute_force(spark, sides, heavy_rows, max_bytes, reduction):
    left, right, sample, table = sides
    many = [("chr1", 7, "A", "G", f"many-{n}") for n in range(90)] + [("chr1", 7, "A", "G", "same")] * 3
    more = table.unionByName(spark.createDataFrame(many, KEYS + ", ann string"))
    got = AN.annotate(sample, more, ["ann"], reduction=reduction, heavy_rows=heavy_rows, max_bytes=max_bytes)
    assert got.columns == [*sample.columns, "ann"]
    assert rows(got, "sid", "ann") == joined_by_hand(left, right + many)
    assert AN.annotate(sample.limit(0), more, ["ann"], heavy_rows=heavy_rows).isEmpty()
    assert AN.annotate(sample, more.limit(0), ["ann"], heavy_rows=heavy_rows).filter("ann is null").count() == len(left)


def test_a_hot_annotation_key_fills_no_single_task(spark, tmp_path):
    made = "if(id % 3 = 0, 'hot', concat('k', id)) chrom", "7L start", "'A' ref", "'C' alt", "id ann"
    spark.range(30_000).selectExpr(*made).write.parquet(str(tmp_path / "a"))
    table = spark.read.parquet(str(tmp_path / "a"))
    sample = table.groupBy("chrom", "start", "ref", "alt").count().drop("count")
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    before = [spark.conf.get(n) for n in names]
    for name, value in zip(names, ("-1", "16", "false"), strict=True):
        spark.conf.set(name, value)
    try:
        got = AN.annotate(sample, table, ["ann"], reduction="none", heavy_rows=100)
        sizes = [r[0] for r in got.groupBy(AN.F.spark_partition_id()).count().select("count").collect()]
        assert sum(sizes) == 30_000 and got.select("ann").distinct().count() == 30_000
        assert max(sizes) <= 2 * sorted(sizes)[len(sizes) // 2]
    finally:
        for name, value in zip(names, before, strict=True):
            spark.conf.set(name, value)


def test_a_bucketed_annotation_table_stays_where_it_is(spark, tmp_path):
    made = "if(id % 3 = 0, 'hot', concat('k', id)) chrom", "id % 50 start", "'A' ref", "'C' alt", "id ann"
    table = spark.range(5000).selectExpr(*made)
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        stored = AN.store_in_buckets(table, "annotation_in_buckets", str(tmp_path / "b"), buckets=8)
        made = "if(id % 2 = 0, 'hot', concat('k', id)) chrom", "id % 50 start", "'A' ref", "if(id < 390, 'C', null) alt", "id sid"
        spark.range(400).selectExpr(*made).write.parquet(str(tmp_path / "sample"))
        sample = spark.read.parquet(str(tmp_path / "sample"))
        plain = AN.annotate(sample, table, ["ann"], reduction="none", heavy_rows=0)
        for options in ({"reduction": "none"}, {"reduction": "keys"}):
            got = AN.annotate(sample, stored, ["ann"], heavy_rows=0, **options)
            assert plan_of(got).count("Arguments: hashpartitioning") == 1, plan_of(got)
            assert rows(got, "sid", "ann") == rows(plain, "sid", "ann")
        parts = AN.annotate(sample, stored, ["ann"], reduction="none", heavy_rows=20)
        assert rows(parts, "sid", "ann") == rows(plain, "sid", "ann")
        counted = parts.groupBy("chrom", "start", "ref", "alt").count()
        assert rows(counted) == rows(plain.groupBy("chrom", "start", "ref", "alt").count())
    finally:
        spark.conf.set(key, before)
        spark.sql("DROP TABLE IF EXISTS annotation_in_buckets")


def test_annotation_is_cut_where_it_is_scanned(spark, sides, tmp_path):
    _, _, sample, table = sides
    table.write.parquet(str(tmp_path / "a.parquet"))
    stored = spark.read.parquet(str(tmp_path / "a.parquet"))
    plan = plan_of(AN.annotate(sample, stored, ["ann"], reduction="keys"))
    assert "GreaterThanOrEqual(start" in plan and "LeftSemi" in plan
    cut = AN.reduce_annotation(stored, sample, reduction="keys")
    assert cut.filter("chrom = 'chr9'").count() == 0


def test_reduction_is_chosen_by_size(spark, tmp_path):
    spark.range(200_000).selectExpr(*MADE, "uuid() ann").write.parquet(str(tmp_path / "big"))
    spark.range(50).selectExpr(*MADE, "uuid() sid").write.parquet(str(tmp_path / "small"))
    big, small = (spark.read.parquet(str(tmp_path / n)) for n in ("big", "small"))
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    assert "LeftSemi" not in plan_of(AN.annotate(small, big, ["ann"]))  # Spark broadcasts it
    spark.conf.set(key, "10k")
    try:
        assert "LeftSemi" in plan_of(AN.annotate(small, big, ["ann"]))
        for reduction in ("auto", "keys"):
            beyond = plan_of(AN.annotate(small, big, ["ann"], reduction=reduction, max_bytes=10))
            assert "LeftSemi" not in beyond and "GreaterThanOrEqual(start" in beyond
        assert "LeftSemi" not in plan_of(AN.annotate(big.drop("ann"), big, ["ann"]))
    finally:
        spark.conf.set(key, before)


@pytest.mark.parametrize("keys", [["sid"], ["start", "sid"], ["sid", "start", "chrom"]])
@pytest.mark.parametrize("threshold", ["1", "1t"])
def test_any_keys_in_any_order(spark, keys, threshold):
    sample = spark.range(40).selectExpr("id sid", "id * 2 start", "'c' chrom", "'x' ref")
    table = spark.range(20, 60).selectExpr("id sid", "id * 2 start", "'c' chrom", "uuid() ann")
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, threshold)
    try:
        for reduction in AN.REDUCTIONS:
            got = AN.annotate(sample, table, ["ann"], keys=keys, reduction=reduction)
            assert got.count() == 40 and got.filter("ann is not null").count() == 20
    finally:
        spark.conf.set(name, before)


def test_many_contigs_are_not_listed(spark):
    many = spark.range(300).selectExpr(
        "concat('c', id) chrom", "id start", "'A' ref", "'C' alt", "id sid"
    )
    weight, ranges = AN.sample_extent(many)
    assert ranges is None and weight > 300 * AN.ROW_OVERHEAD
    got = AN.annotate(many, many.withColumnRenamed("sid", "ann"), ["ann"])
    assert got.filter("sid = ann").count() == 300


def test_empty_sample(spark, sides):
    _, _, sample, table = sides
    assert AN.annotate(sample.filter("start < 0"), table, ["ann"]).count() == 0


def test_clinical_and_frequency_columns(spark):
    sample = spark.createDataFrame([("1", 1, "A", "C"), ("1", 2, "A", "C")], KEYS)
    table = spark.createDataFrame(
        [("1", 1, "A", "C", "Pathogenic", "d", 0.5, 0.1)],
        KEYS + ", CLNSIG string, CLNDN string, AF_EXAC double, af_tgp double",
    )
    both = AN.annotate_clinical(sample, table)
    assert both.columns[4:] == ["CLNSIG", "CLNDN"] and both.count() == 2
    assert rows(AN.annotate_clinical(sample, table, significant_only=True), "start") == [(1,)]
    assert AN.annotate_frequencies(sample, table).columns[4:] == ["AF_EXAC", "af_tgp"]


@pytest.fixture
def stored(spark, tmp_path):
    path = str(tmp_path / "v.parquet")
    spark.createDataFrame(
        [("chr1", 10, "A", "C", "rs1", "Pathogenic"), ("chr1", 20, "A", "C", "rs2", "Likely_pathogenic"),
         ("chr1", 30, "A", "C", "rs3", None), ("chr2", 20, "A", "C", "rs4", "Pathogenic/x")],
        KEYS + ", id string, clnsig string",
    ).write.parquet(path)
    return spark.read.parquet(path)


def test_range_scan(stored):
    assert rows(LK.range_scan(stored, 10, 20, "chr1"), "id") == [("rs1",), ("rs2",)]
    top = LK.range_scan(stored, 10, 30, limit=2, columns=["id"])
    assert [r.id for r in top.collect()] == ["rs1", "rs2"]
    plan = plan_of(LK.range_scan(stored, 10, 20, "chr1", columns=["id"]))
    for pushed in ("EqualTo(chrom,chr1)", "GreaterThanOrEqual(start,10)", "LessThanOrEqual(start,20)"):
        assert pushed in plan
    assert "TakeOrderedAndProject" in plan_of(top)


def test_range_scan_opens_only_files_that_meet_the_range(spark, tmp_path):
    rows_in = [(f"chr{c}", p, "A", "C", f"{c}-{p}", kind, "s[1]") for c in (1, 2, 3) for p in range(0, 2000, 10) for kind in ("SNV", "indel")]
    rows_in.append((None, None, "A", "C", "none", None, None))
    table = spark.createDataFrame(rows_in, KEYS + ", id string, tsa string, source string")
    out = str(tmp_path / "split")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    try:
        whole, _ = S.split_by_type(spark, table, out, (), layout="range")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    bounds = LK.file_bounds(spark, out)
    for low, high, chrom in [(100, 150, "chr2"), (0, 5000, None), (1990, 1990, None), (-9, -1, None), (0, 9, "chrX")]:
        got = LK.range_scan_files(spark, out, bounds, low, high, chrom)
        assert got.columns == whole.columns
        assert rows(got) == rows(LK.range_scan(whole, low, high, chrom))
        scanned = LK.range_scan_files(spark, out, bounds, low, high, chrom, max_files=0)
        assert rows(scanned) == rows(got)
    few = LK.range_scan_files(spark, out, bounds, 100, 150, "chr2")
    assert 0 < len(few.inputFiles()) < len(whole.inputFiles()) / 2


def test_text_match(stored):
    assert rows(LK.match_text(stored, "clnsig", "Pathogenic"), "id") == [("rs1",), ("rs4",)]
    assert LK.match_text(stored, "clnsig", "Path.*").count() == 0
    assert LK.match_text(stored, "clnsig", "(?i)path.*", regex=True).count() == 3
    assert rows(LK.match_text(stored, "clnsig", "P", limit=1), "id") == [("rs1",)]
    assert LK.annotated_only(stored, "clnsig").count() == 3


def test_id_lookup(spark, stored):
    assert rows(LK.lookup_ids(stored, ["rs1", "rs4", "rs9"]), "id") == [("rs1",), ("rs4",)]
    assert "In(id" in plan_of(LK.lookup_ids(stored, ["rs1", "rs4"]))
    long = [f"rs{n}" for n in range(3, 3000)]
    assert rows(LK.lookup_ids(stored, long), "id") == [("rs3",), ("rs4",)]
    table = spark.createDataFrame([("rs2",), ("rs2",)], "any string")
    assert rows(LK.lookup_ids(stored, table), "id") == [("rs2",)]
    assert LK.lookup_ids(stored, table).columns == stored.columns


@pytest.mark.parametrize("options", [{}, {"dedupe_keys": True}, {"heavy_rows": 2}])
def test_rows_without_a_whole_key_are_not_shuffled(spark, tmp_path, options):
    """Nulls in the key match nothing; by key they would all go to one task."""
    rows = [(None if n % 2 else f"k{n}", n % 3 or None, n) for n in range(60)]
    spark.createDataFrame(rows, "a string, b int, n int").write.parquet(str(tmp_path / "s"))
    known = [(f"k{n}", n % 3 or None, f"c{n}") for n in range(60)] + [(None, 1, "no"), ("k4", 1, "c4")]
    spark.createDataFrame(known, "a string, b int, clnsig string").write.parquet(str(tmp_path / "r"))
    sample, annotation = (spark.read.parquet(str(tmp_path / x)) for x in "sr")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        got = AN.annotate(sample, annotation, ["clnsig"], keys=["a", "b"], **options)
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        found = sorted(((r.n, r.clnsig) for r in got.collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    want = [(n, f"c{n}" if n % 2 == 0 and n % 3 else None) for n in range(60)]
    want += [] if "dedupe_keys" in options else [(4, "c4")]
    assert found == sorted(want, key=repr)
    assert "Union" in plan and "isnull(a" in plan
