"""The query catalogue: one entry per operator, with its oracle text where SQL can say it.

Keys start with the operator's id in the blueprint. A query whose operator writes files
writes them below the shared folder of the session and returns what reads back, so that
the written data itself is checked.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varloom.functions import paths as P
from varloom.operators import annotate as AN
from varloom.operators import compare as CM
from varloom.operators import lookup as LK
from varloom.operators import manifest as M
from varloom.operators import reencode as RE
from varloom.operators import sinks as K
from varloom.operators import split as S
from varloom.plans import prepare, publish, versions
from varloom.plans import views as V
from varloom.session import new_folder
from varloom.sources import columnar, presets, vcf
from varloom.sources.files import rename
from varloom.sources.listing import collect_parquet, list_files, matching, with_names
from varloom.streaming.incremental import incremental_convert

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if oracle is not None:
            ORACLE[name] = oracle
        return function

    return register


PARSED = """
select chrom, start, start + length(ref) - 1 as "end", id, ref, alt, qual, filter,
       tsa, db, score as sc, source as "set"
from v
"""
PARSED_COLUMNS = (
    "chrom", "start", "end", "id", "ref", "alt", "qual", "filter", "tsa", "db", "sc", "set"
)
EXPLODED = """
select chrom, start, id, ref, unnest(string_split(alt, '|')) as alt, tsa, source
from v where tsa = 'SNV' and alt is not null
union all
select chrom, start, id, ref, alt, tsa, source from v where tsa <> 'SNV' or alt is null
"""
SPLIT_COLUMNS = ("chrom", "start", "id", "ref", "alt", "tsa", "source")
VARIANT_TEST = (
    "(regexp_matches(name, '[.]vcf([.]|$)') and not regexp_matches(name, '[.](tbi|csi|idx)$'))"
)


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    return V.vcf_lines(columnar.spread(V.variants(spark, sf)))


def _stored(spark: SparkSession, sf: str, label: str) -> str:
    """The variants as a stored table."""
    out = f"{new_folder(spark, label)}/variants.parquet"
    columnar.spread(V.variants(spark, sf)).write.parquet(out)
    return out


def _split(spark: SparkSession, sf: str, label: str, **options) -> tuple[DataFrame, DataFrame, str]:
    out = f"{new_folder(spark, label)}/split"
    rows = columnar.spread(V.variants(spark, sf).select(*SPLIT_COLUMNS))
    table, manifest = S.split_by_type(spark, rows, out, **options)
    return table, manifest, out


# ---------------------------------------------------------------- sources


@query("s1_parse_vcf_lines", f"{V.WITH_VARIANTS} {PARSED}")
def s1_parse(spark, sf):
    return vcf.parse_lines(_lines(spark, sf), V.LINE_FIELDS)


@query("s1_scan_vcf_files", f"{V.WITH_VARIANTS} {PARSED}")
def s1_files(spark, sf):
    folder = V.write_vcf(spark, _lines(spark, sf), new_folder(spark, "s1"))
    return vcf.scan_vcf(spark, folder).select(*PARSED_COLUMNS)


@query(
    "s2_info_field_discovery",
    "select replace(n_name, ' ', '_') as field, 'A' as number, 'Float' as type from nation",
)
def s2_fields(spark, sf):
    name = F.replace(F.col("n_name"), F.lit(" "), F.lit("_"))
    lines = V.table(spark, sf, "nation").select(
        F.lit("made.vcf").alias("path"),
        F.col("n_nationkey").cast("bigint").alias("line_no"),
        F.concat(
            F.lit("##INFO=<ID="), name, F.lit(',Number=A,Type=Float,Description="a, b>,Type=x">')
        ).alias("value"),
    )
    return vcf.merged_definitions(vcf.info_definitions(lines)).select("field", "number", "type")


@query("s3_info_projection", f"{V.WITH_VARIANTS} select id, tsa, db, score as sc from v")
def s3_projection(spark, sf):
    wanted = [("TSA", "1", "String"), ("DB", "0", "Flag"), ("SC", "1", "Float")]
    return vcf.parse_lines(_lines(spark, sf), wanted).select("id", "tsa", "db", "sc")


@query("s3_info_projection_one_pass", f"{V.WITH_VARIANTS} select id, tsa, db, score as sc from v")
def s3_one_pass(spark, sf):
    wanted = [("TSA", "1", "String"), ("DB", "0", "Flag"), ("SC", "1", "Float")]
    return vcf.parse_lines(_lines(spark, sf), wanted).select("id", "tsa", "db", "sc")


MANY_FIELDS = [("X" + str(n), "1", "Integer") for n in range(18)]


@query(
    "s3_many_fields",
    f"{V.WITH_VARIANTS} select id, start as dp, -start as dp_other, start + 17 as x17, tsa from v",
)
def s3_many(spark, sf):
    """Over sixteen fields, two of which differ only in case."""
    extra = [F.concat(F.lit(f";X{n}="), (F.col("start") + n).cast("string")) for n in range(18)]
    start = F.col("start").cast("string")
    lines = columnar.spread(V.variants(spark, sf)).select(
        F.concat_ws(
            "\t", "chrom", start, "id", "ref", F.lit("A"), F.lit("."), F.lit("."),
            F.concat(F.lit("DP="), start, F.lit(";Dp=-"), start, *extra, F.lit(";TSA="), "tsa"),
        ).alias("value")
    )
    wanted = [("DP", "1", "Integer"), ("Dp", "1", "Integer"), *MANY_FIELDS, ("TSA", "1", "String")]
    return vcf.parse_lines(lines, wanted).select("id", "dp", F.col("info_dp").alias("dp_other"), "x17", "tsa")


@query("s4_parquet_scan", f"{V.WITH_VARIANTS} select chrom, start, id, ref, alt, tsa from v")
def s4_scan(spark, sf):
    stored = _stored(spark, sf, "s4")
    return K.read_vcf(spark, stored).select("chrom", "start", "id", "ref", "alt", "tsa")


@query("s5_compressed_vcf_scan", f"{V.WITH_VARIANTS} {PARSED}")
def s5_gzip(spark, sf):
    folder = V.write_vcf(spark, _lines(spark, sf), new_folder(spark, "s5"), "gzip")
    return vcf.scan_vcf(spark, folder).select(*PARSED_COLUMNS)


@query("s5_block_gzip_scan", f"{V.WITH_VARIANTS} {PARSED}")
def s5_blocks(spark, sf):
    """Gzip members one behind another are cut into many ranges, each read on its own."""
    folder = V.write_vcf(spark, _lines(spark, sf), new_folder(spark, "s5b"))
    V.write_blocks(spark, f"{folder}/head", f"{folder}_bgz/head")
    V.write_blocks(spark, f"{folder}/body", f"{folder}_bgz/body")
    return vcf.scan_vcf(spark, f"{folder}_bgz", range_bytes=100_000).select(*PARSED_COLUMNS)


@query(
    "s6_scan_columns_and_predicate",
    f"{V.WITH_VARIANTS} select chrom, start, ref, alt from v where qual >= 25 and tsa = 'SNV'",
)
def s6_scan(spark, sf):
    stored = _stored(spark, sf, "s6")
    return columnar.scan(
        spark, stored, ["chrom", "start", "ref", "alt"], "qual >= 25 and tsa = 'SNV'"
    )


@query(
    "s7_listing_by_pattern",
    r"select url as path, regexp_extract(url, '([^/]*)$', 1) as name from pages "
    r"where regexp_matches(regexp_extract(url, '([^/]*)$', 1), '^[0-9]+')",
)
def s7_listing(spark, sf):
    urls = V.table(spark, sf, "pages").select(F.col("url").alias("path"))
    return with_names(matching(urls, "^[0-9]+")).select("path", "name")


@query(
    "s8_collect_parquet_files",
    f"{V.WITH_VARIANTS} select tsa as variant_type, true as as_the_scan_says from v group by tsa",
)
def s8_collect(spark, sf):
    """The listing has the files that a scan of the table reads, with their sizes."""
    _, manifest, out = _split(spark, sf, "s8")
    files = M.with_variant_type(collect_parquet(spark, out), out)
    scanned = manifest.select("path", F.col("size").alias("scanned"))
    met = files.join(scanned, "path", "full")
    same = F.coalesce(F.col("size") == F.col("scanned"), F.lit(False))
    return met.groupBy("variant_type").agg(F.bool_and(same).alias("as_the_scan_says"))


@query(
    "s9_type_directory",
    f"{V.WITH_VARIANTS} select chrom, start, id, ref, alt from v where tsa = 'deletion'",
)
def s9_directory(spark, sf):
    _, _, out = _split(spark, sf, "s9")
    return columnar.scan_type(spark, out, "deletion").select("chrom", "start", "id", "ref", "alt")


@query(
    "s9_odd_type_value",
    f"{V.WITH_VARIANTS} select chrom, start, id, ref, alt, 'a/b 02%' as tsa from v where tsa = 'deletion'",
)
def s9_odd(spark, sf):
    odd = F.when(F.col("tsa") == "deletion", "a/b 02%").otherwise(F.col("tsa"))
    rows = columnar.spread(V.variants(spark, sf).select(*SPLIT_COLUMNS)).withColumn("tsa", odd)
    out = f"{new_folder(spark, 's9o')}/split"
    S.split_by_type(spark, rows, out)
    return columnar.scan_type(spark, out, "a/b 02%").select("chrom", "start", "id", "ref", "alt", "tsa")


@query(
    "s10_variant_file_classifier",
    f"{V.WITH_FILES} select name, {VARIANT_TEST} as is_variant_file from expected",
)
def s10_classifier(spark, sf):
    return with_names(V.expected(spark, sf).select("path")).select("name", "is_variant_file")


PRESET_NAMES = """
select concat('in/', source, '/',
       case lang when 'en' then concat('homo_sapiens-chr', doc_id, '.vcf.gz')
                 when 'fr' then concat('gnomad.v4.0.sites.chr', doc_id, '.vcf.bgz')
                 when 'de' then 'clinvar.vcf.gz' else 'GCF_000001405.40.gz' end) as path
from documents
"""


@query(
    "s11_source_presets",
    f"""with f as ({PRESET_NAMES})
    select path, case when regexp_matches(path, 'homo_sapiens-chr([^.]+)\\.vcf\\.gz$')
                      then 'ensembl_variations'
                      when regexp_matches(path, 'gnomad\\.v4\\.0\\..+\\.vcf\\.bgz$') then 'gnomad_v4'
                      when regexp_matches(path, 'clinvar\\.vcf\\.gz$') then 'clinvar'
                      else 'dbsnp_grch38' end as preset from f""",
)
def s11_presets(spark, sf):
    files = V._from(spark, PRESET_NAMES, documents=V.table(spark, sf, "documents"))
    return presets.assign_presets(files).select("path", "preset")


# ---------------------------------------------------------------- transforms


@query("t1_projection", f"{V.WITH_VARIANTS} select id, ref, alt from v")
def t1_projection(spark, sf):
    return V.variants(spark, sf).select("id", "ref", "alt")


@query("t2_predicate_filter", f"{V.WITH_VARIANTS} select id, qual from v where qual > 30 and not db")
def t2_filter(spark, sf):
    return V.variants(spark, sf).filter("qual > 30 and not db").select("id", "qual")


@query("t3_type_filter", f"{V.WITH_VARIANTS} select id, start, tsa from v where tsa = 'indel'")
def t3_type(spark, sf):
    return S.of_type(V.variants(spark, sf), "indel").select("id", "start", "tsa")


@query("t4_distinct_types", f"{V.WITH_VARIANTS} select distinct tsa from v")
def t4_types(spark, sf):
    return S.variant_types(V.variants(spark, sf))


@query("t4_type_counts", f"{V.WITH_VARIANTS} select tsa, count(*) as n from v group by tsa")
def t4_counts(spark, sf):
    return S.variant_type_counts(V.variants(spark, sf))


@query(
    "t5_t6_explode_all_types",
    f"""{V.WITH_VARIANTS}
    select chrom, start, ref, unnest(string_split(alt, '|')) as alt from v where alt is not null
    union all select chrom, start, ref, alt from v where alt is null""",
)
def t5_explode_all(spark, sf):
    rows = S.explode_alleles(V.variants(spark, sf), explode_types=None)
    return rows.select("chrom", "start", "ref", "alt")


@query("t7_conditional_explode", f"{V.WITH_VARIANTS} {EXPLODED}")
def t7_explode(spark, sf):
    return S.explode_alleles(V.variants(spark, sf).select(*SPLIT_COLUMNS))


@query("t8_split_by_type", f"{V.WITH_VARIANTS} {EXPLODED}")
def t8_split(spark, sf):
    return _split(spark, sf, "t8")[0].select(*SPLIT_COLUMNS)


@query("t8_split_range_layout", f"{V.WITH_VARIANTS} {EXPLODED}")
def t8_range(spark, sf):
    return _split(spark, sf, "t8r", layout="range")[0].select(*SPLIT_COLUMNS)


@query("t8_split_direct_layout", f"{V.WITH_VARIANTS} {EXPLODED}")
def t8_direct(spark, sf):
    return _split(spark, sf, "t8d", layout="direct")[0].select(*SPLIT_COLUMNS)


@query(
    "t8_split_row_property",
    f"""{V.WITH_VARIANTS}
    select count(*) as rows_in,
           cast(sum(case when tsa = 'SNV' and alt is not null
                         then length(alt) - length(replace(alt, '|', '')) + 1 else 1 end)
                as bigint) as rows_out from v""",
)
def t8_property(spark, sf):
    return S.exploded_rows(V.variants(spark, sf))


@query(
    "t9_merged_catalogue",
    f"""{V.WITH_VARIANTS}, x as ({EXPLODED}), r as ({V.CLINICAL})
    select variant_type, cast(sum(n) as bigint) as total_rows from (
      select tsa as variant_type, count(*) as n from x group by tsa
      union all select clnsig, count(*) from r group by clnsig) group by variant_type""",
)
def t9_catalogue(spark, sf):
    _, first, _ = _split(spark, sf, "t9")
    _, second = S.split_by_type(
        spark, V.clinical(spark, sf), f"{new_folder(spark, 't9')}/split", type_col="clnsig"
    )
    merged = S.catalogue_summary(S.merge_catalogues([first, second]))
    return merged.select("variant_type", "total_rows")


@query(
    "t9_files_and_rows",
    f"""{V.WITH_VARIANTS}, x as ({EXPLODED})
    select tsa as variant_type, count(*) as total_rows, true as has_files, true as sizes_agree
    from x group by tsa""",
)
def t9_files(spark, sf):
    """Files and bytes per type are those that a listing of the folder finds."""
    _, splits, out = _split(spark, sf, "t9f")
    summary = S.catalogue_summary(splits)
    listed = M.with_variant_type(collect_parquet(spark, out), out).groupBy("variant_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes")
    )
    agree = (F.col("n") == F.col("num_files")) & (F.col("bytes") == F.col("total_size"))
    return summary.join(listed, "variant_type").select(
        "variant_type", "total_rows", (F.col("num_files") > 0).alias("has_files"), agree.alias("sizes_agree")
    )


@query(
    "t8_second_table_added",
    f"{V.WITH_VARIANTS}, y as ({EXPLODED}) select * from y union all select chrom, start, id, ref, alt, tsa, "
    "concat('more ', source) from y",
)
def t8_second(spark, sf):
    """A second table with other sources is added to the first."""
    _, _, out = _split(spark, sf, "t8s")
    more = columnar.spread(V.variants(spark, sf).select(*SPLIT_COLUMNS))
    more = more.withColumn("source", F.concat(F.lit("more "), "source"))
    return S.split_by_type(spark, more, out)[0].select(*SPLIT_COLUMNS)


@query(
    "t9_paths_by_type",
    f"{V.WITH_FILES} select lang as variant_type, path from expected "
    "union all select lang, concat('again/', path) from present",
)
def t9_paths(spark, sf):
    first = V.expected(spark, sf).select(F.col("lang").alias("variant_type"), "path")
    second = V.present(spark, sf).select(
        F.col("lang").alias("variant_type"), F.concat(F.lit("again/"), "path").alias("path")
    )
    return S.merge_catalogues([first, second])


@query(
    "t10_row_and_batch_count",
    f"{V.WITH_VARIANTS} select tsa, count(*) as n, "
    "cast(ceil(count(*) / 1000.0) as bigint) as batches from v group by tsa",
)
def t10_counts(spark, sf):
    counts = S.variant_type_counts(V.variants(spark, sf))
    return counts.withColumn("batches", P.batches(F.col("n"), 1000))


@query(
    "t11_sort",
    f"{V.WITH_VARIANTS} select chrom, start, id from v order by chrom, start, id",
)
def t11_sort(spark, sf):
    return V.variants(spark, sf).select("chrom", "start", "id").orderBy("chrom", "start", "id")


# ---------------------------------------------------------------- sinks


@query("k1_columnar_sink", f"{V.WITH_VARIANTS} select chrom, start, id, ref, alt, score from v")
def k1_sink(spark, sf):
    out = f"{new_folder(spark, 'k1')}/t.parquet"
    K.save(spark, V.variants(spark, sf), out)
    return columnar.scan(spark, out, ["chrom", "start", "id", "ref", "alt", "score"])


@query("k2_vcf_to_parquet", f"{V.WITH_VARIANTS} {PARSED}")
def k2_convert(spark, sf):
    folder = V.write_vcf(spark, _lines(spark, sf), new_folder(spark, "k2"))
    table, _ = K.vcf_to_parquet(spark, folder, f"{folder}.parquet")
    return table.select(*PARSED_COLUMNS)


@query("k3_reuse_if_present", f"{V.WITH_VARIANTS} select chrom, start, id from v")
def k3_reuse(spark, sf):
    out = f"{new_folder(spark, 'k3')}/t.parquet"
    rows = V.variants(spark, sf).select("chrom", "start", "id")
    K.save(spark, rows, out, mode="reuse")
    # A finished output is reused: this plan must not replace it.
    K.save(spark, rows.filter("start < 0"), out, mode="reuse")
    return columnar.scan(spark, out)


@query(
    "k4_output_names",
    f"{V.WITH_FILES} select name, case when regexp_matches(name, '[.]vcf([.]b?gz)?$') "
    "then regexp_replace(name, '[.]vcf([.]b?gz)?$', '') "
    "else regexp_replace(name, '[.][^.]+$', '') end as stem from expected",
)
def k4_names(spark, sf):
    return V.expected(spark, sf).select("name", P.variant_stem(F.col("name")).alias("stem"))


@query("k5_batch_convert", f"{V.WITH_VARIANTS} {PARSED}")
def k5_batch(spark, sf):
    folder = V.write_vcf(spark, _lines(spark, sf), new_folder(spark, "k5"), "gzip")
    files = list_files(spark, folder, recursive=True)
    done, _ = K.convert_listed(spark, files, f"{folder}_out", always_variant=True)
    return done.table.select(*PARSED_COLUMNS)


def _two_folders(spark: SparkSession, sf: str, label: str) -> tuple[str, DataFrame]:
    """A folder that holds a file of one stem, and the lines for a second of that stem."""
    folder = new_folder(spark, label)
    lines = _lines(spark, sf)
    V.write_named(spark, lines, f"{folder}/in/x", "chr1.vcf")
    return folder, lines


def _convert_below(spark: SparkSession, folder: str) -> K.Converted:
    files = list_files(spark, f"{folder}/in", recursive=True)
    return K.convert_listed(spark, files, f"{folder}/out", ["TSA", "DB", "SC"])[0]


TWICE = f"""{V.WITH_VARIANTS}, y as (
  select chrom, start, id, ref, alt, qual, tsa, db, score as sc, 'chr1' as source from v)
select * from y union all select * from y"""
TWICE_COLUMNS = ("chrom", "start", "id", "ref", "alt", "qual", "tsa", "db", "sc", "source")


@query("k5_same_name_two_folders", TWICE)
def k5_two_folders(spark, sf):
    """A file of a known stem in another folder is converted too, on a later run."""
    folder, lines = _two_folders(spark, sf, "k5n")
    _convert_below(spark, folder)
    V.write_named(spark, lines, f"{folder}/in/y", "chr1.vcf")
    return _convert_below(spark, folder).table.select(*TWICE_COLUMNS)


@query(
    "k5_rejects_of_two_runs",
    "select concat(l_orderkey, ' is no position') as value, count(*) * 2 as n from lineitem group by 1",
)
def k5_rejects(spark, sf):
    """Unreadable lines of an earlier run stay where a later run has some too."""
    folder = new_folder(spark, "k5r")
    keys = columnar.spread(V.table(spark, sf, "lineitem").select("l_orderkey"))
    bad = keys.select(F.concat(F.col("l_orderkey").cast("string"), F.lit(" is no position")).alias("value"))
    for name in ("x", "y"):
        V.write_named(spark, bad, f"{folder}/in/{name}", "chr1.vcf")
        done = _convert_below(spark, folder)
    kept = spark.read.parquet(done.rejects_path)
    return kept.groupBy("value").agg(F.count(F.lit(1)).alias("n"))


CHANGED_LINES = """{start} y as (
  select chrom, start, id, ref, alt, qual, tsa, db, score as sc, 'chr1' as source from v)
select * from y"""


def _two_forms(spark: SparkSession, sf: str, label: str) -> tuple[str, str, str]:
    """Folders of all variants in files of equal names: as they are, and later with other ids and scores."""
    folder = new_folder(spark, label)
    rows = columnar.spread(V.variants(spark, sf))
    V.write_named(spark, V.vcf_lines(rows), f"{folder}/first", "chr1.vcf")
    other = rows.withColumn("id", F.concat(F.col("id"), F.lit("other"))).withColumn("score", F.col("score") + 1)
    V.write_named(spark, V.vcf_lines(other), f"{folder}/second", "chr1.vcf")
    return folder, f"{folder}/first", f"{folder}/second"


@query("k5_file_changed_back", CHANGED_LINES.format(start=V.WITH_VARIANTS + ","))
def k5_changed_back(spark, sf):
    """Files replaced by others of the same names, then put back with their old times."""
    folder, first, second = _two_forms(spark, sf, "k5b")
    inside = f"{folder}/in"
    for form in (first, second, first):
        rename(spark, form, inside)
        done = _convert_below(spark, folder)
        rename(spark, inside, form)
    return done.table.select(*TWICE_COLUMNS)


@query("k6_rebuilt_when_input_changes", f"{V.WITH_VARIANTS} select chrom, start, id, tsa from v")
def k6_rebuilt(spark, sf):
    """A copy older than its table is made again."""
    out = f"{new_folder(spark, 'k6r')}/variants.parquet"
    rows = columnar.spread(V.variants(spark, sf).select("chrom", "start", "id", "tsa"))
    rows.filter("start % 20 = 1").write.parquet(out)
    RE.reencode(spark, out)
    rows.write.mode("overwrite").parquet(out)
    return columnar.scan(spark, RE.reencode(spark, out))


@query("k6_compact_reencode", f"{V.WITH_VARIANTS} select chrom, start, id, ref, alt, tsa, score from v")
def k6_reencode(spark, sf):
    out = RE.reencode(spark, _stored(spark, sf, "k6"), batch_size=100_000)
    return columnar.scan(spark, out, ["chrom", "start", "id", "ref", "alt", "tsa", "score"])


@query("k6_compact_reencode_orc", f"{V.WITH_VARIANTS} select chrom, start, id, ref, alt, tsa, score from v")
def k6_orc(spark, sf):
    out = RE.reencode(spark, _stored(spark, sf, "k6o"), file_format="orc")
    columns = ["chrom", "start", "id", "ref", "alt", "tsa", "score"]
    return columnar.scan(spark, out, columns, file_format="orc")


@query("k7_reencode_tree", f"{V.WITH_VARIANTS} {EXPLODED}")
def k7_tree(spark, sf):
    _, _, out = _split(spark, sf, "k7")
    table, _ = RE.reencode_tree(
        spark, out, f"{out}_compact", on_error="skip", partition_by=("tsa", "source")
    )
    return table.select(*SPLIT_COLUMNS)


DAMAGED = ("deletion", "indel")


@query(
    "k7_damaged_file_left_out",
    f"""{V.WITH_VARIANTS}
    select tsa, start, id, cast(null as varchar) as problem from v where tsa not in {DAMAGED}
    union all select tsa, cast(null as bigint), cast(null as varchar), case tsa
      when 'indel' then 'no footer' else concat('some of ', count(*), ' rows are readable') end
    from v where tsa in {DAMAGED} group by tsa""",
)
def k7_damaged(spark, sf):
    """A table whose files of one type have damaged pages, and those of another no footer: what
    is left of it, and the report of the files left out, summed up by type."""
    folder = new_folder(spark, "k7d")
    rows = columnar.spread(V.variants(spark, sf).select("tsa", "start", "id"))
    rows.write.partitionBy("tsa").parquet(f"{folder}/in")
    kind = F.regexp_extract("path", "/tsa=([^/]*)/", 1).alias("tsa")
    harmed = collect_parquet(spark, f"{folder}/in").select("path", "size", kind).filter(kind.isin(*DAMAGED))
    harmed.mapInArrow(V.harm_files, "path string").write.format("noop").mode("overwrite").save()
    table, left_out = RE.reencode_tree(spark, f"{folder}/in", f"{folder}/out", on_error="skip", partition_by=("tsa",))
    summed = left_out.groupBy(kind).agg(F.sum("rows").alias("rows"), F.count_if(F.col("readable") >= F.col("rows")).alias("whole"))
    text = F.when(F.col("rows").isNull(), "no footer").when(
        F.col("whole") == 0, F.concat(F.lit("some of "), F.col("rows").cast("string"), F.lit(" rows are readable"))
    )
    report = summed.select("tsa", text.alias("problem"))
    return table.select("tsa", "start", "id").unionByName(report, allowMissingColumns=True)


@query(
    "k8_reencode_report",
    f"""{V.WITH_FILES},
    b as (select source, sum(size) as s from expected group by source),
    a as (select source, sum(size) as s from present group by source)
    select b.source as key, round_even(b.s / 1048576.0, 2) as before_mb,
           round_even(a.s / 1048576.0, 2) as after_mb,
           case when b.s > 0 then round_even((1.0 - a.s / b.s) * 100.0, 1) else 0.0 end
           as saved_percent from b join a on a.source = b.source""",
)
def k8_report(spark, sf):
    before = V.expected(spark, sf).select(F.col("source").alias("key"), "size")
    after = V.present(spark, sf).select(F.col("source").alias("key"), "size")
    return RE.size_report(before, after)


@query("k9_split_layout_readback", f"{V.WITH_VARIANTS} {EXPLODED}")
def k9_layout(spark, sf):
    _, _, out = _split(spark, sf, "k9", overwrite=True)
    return columnar.scan_split(spark, out).select(*SPLIT_COLUMNS)


@query("k10_incremental_convert", f"{V.WITH_VARIANTS} {PARSED} union all {PARSED}")
def k10_incremental(spark, sf):
    folder = new_folder(spark, "k10")
    lines = _lines(spark, sf)
    run = lambda: incremental_convert(
        spark, f"{folder}/in", f"{folder}/out", f"{folder}/state", always_variant=True
    )
    V.write_vcf(spark, lines, f"{folder}/in/first")
    run()
    V.write_vcf(spark, lines, f"{folder}/in/second", "gzip")
    return run().select(*PARSED_COLUMNS)


@query(
    "k10_later_header_widens",
    f"""{V.WITH_VARIANTS}
    select start, cast(null as varchar) as af from v
    union all select start, concat(start, ',', start) from v
    union all select start, cast(start as varchar) from v""",
)
def k10_widens(spark, sf):
    """Batches without a field, with a list of it, and with one value of it."""
    folder = new_folder(spark, "k10w")
    rows = columnar.spread(V.variants(spark, sf).select("chrom", "start"))
    at = F.col("start").cast("string")
    for name, number, info in (("a", None, F.lit(".")), ("b", "A", F.concat(F.lit("AF="), at, F.lit(","), at)), ("c", "1", F.concat(F.lit("AF="), at))):
        dot = F.lit(".")
        lines = rows.select(F.concat_ws("\t", "chrom", at, dot, F.lit("A"), F.lit("C"), dot, dot, info).alias("value"))
        header = [f"##INFO=<ID=AF,Number={number},Type=Float>"] if number else []
        V.write_named(spark, lines, f"{folder}/in/{name}", f"{name}.vcf", header)
        table = incremental_convert(spark, f"{folder}/in", f"{folder}/out", f"{folder}/state")
    whole = F.transform("af", lambda x: x.cast("bigint").cast("string"))
    return table.select("start", F.array_join(whole, ",").alias("af"))


@query("k10_changed_files", CHANGED_LINES.format(start=V.WITH_VARIANTS + ","))
def k10_changed(spark, sf):
    """Files replaced in the landing folder are converted again in place of their old rows."""
    folder, first, second = _two_forms(spark, sf, "k10c")
    inside = f"{folder}/in"
    for form in (second, first):
        rename(spark, form, inside)
        table = incremental_convert(
            spark, inside, f"{folder}/out", f"{folder}/state", ["TSA", "DB", "SC"], follow_changes=True
        )
        rename(spark, inside, form)
    return table.select(*TWICE_COLUMNS)


# ---------------------------------------------------------------- manifests


@query(
    "m1_missing_by_name",
    f"{V.WITH_FILES} select name from expected e "
    "where not exists (select 1 from present p where p.name = e.name)",
)
def m1_missing(spark, sf):
    return M.missing_by(V.expected(spark, sf), V.present(spark, sf)).select("name")


@query(
    "m2_missing_paths",
    f"{V.WITH_FILES} select path, size from expected e "
    "where not exists (select 1 from present p where p.path = e.path)",
)
def m2_missing(spark, sf):
    return M.missing_by(V.expected(spark, sf), V.present(spark, sf), "path").select("path", "size")


@query(
    "m3_size_reconciliation",
    f"""{V.WITH_FILES}
    select e.name, p.path as local_path, p.size as local_size, e.size as remote_size,
           p.size - e.size as diff
    from expected e join present p on e.name = p.name where p.size <> e.size""",
)
def m3_mismatches(spark, sf):
    return M.size_mismatches(V.expected(spark, sf).select("name", "size"), V.present(spark, sf))


@query(
    "m3_repeated_names",
    f"""{V.WITH_FILES}, everywhere as (
      select name, path, size from present
      union all select name, concat('again/', path), size + 7 from present)
    select e.name, b.path as local_path, b.size as local_size, e.size as remote_size,
           b.size - e.size as diff
    from expected e join everywhere b on e.name = b.name where b.size <> e.size""",
)
def m3_repeated(spark, sf):
    """Every file of a name is compared, whichever folder it lies in."""
    here = V.present(spark, sf).select("name", "path", "size")
    there = here.select("name", F.concat(F.lit("again/"), "path").alias("path"), (F.col("size") + 7).alias("size"))
    return M.size_mismatches(V.expected(spark, sf).select("name", "size"), here.unionAll(there))


@query(
    "m3_size_status",
    f"""{V.WITH_FILES}
    select e.name, p.path as local_path, p.size as local_size,
           nullif(e.size, 0) as remote_size, p.size - nullif(e.size, 0) as diff,
           case when nullif(e.size, 0) is null then 'size_unknown'
                when e.size = p.size then 'size_match' else 'size_differs' end as status
    from expected e join present p on e.name = p.name""",
)
def m3_status(spark, sf):
    listed = V.expected(spark, sf).select("name", F.nullif("size", F.lit(0)).alias("size"))
    return M.reconcile_sizes(listed, V.present(spark, sf))


@query(
    "m4_conversion_counts",
    f"""{V.WITH_FILES}, c as (
      select cast(count(*) filter (where {VARIANT_TEST}) as bigint) as n_variant,
             cast(count(*) filter (where name like '%.parquet') as bigint) as n_parquet
      from expected) select n_variant, n_parquet, n_parquet >= n_variant as complete from c""",
)
def m4_counts(spark, sf):
    return M.conversion_counts(V.expected(spark, sf))


@query(
    "m5_split_validation",
    f"""{V.WITH_FILES}, made as (
      select name, count(*) as n, count(*) filter (where toxic = 1) as gone
      from present where quality = 1 group by name)
    select e.name, case when p.name is null then 'missing input'
                        when m.n is null then 'no splits'
                        when m.gone > 0 then 'missing split files' else 'ok' end as problem
    from expected e left join present p on p.name = e.name left join made m on m.name = e.name""",
)
def m5_splits(spark, sf):
    here = V.present(spark, sf)
    splits = here.filter("quality = 1").select("name", (F.col("toxic") == 0).alias("exists"))
    return M.check_splits(V.expected(spark, sf), here, splits)


PLAN_SQL = f"""{V.WITH_FILES}, l as (
  select path as file, concat('pub/', substr(path, 6)) as path_in_repo, size as local_size
  from expected), t as (
  select concat('pub/', substr(path, 6)) as path_in_repo,
         case when quality = 1 then size end as remote_size from present), j as (
  select l.*, t.remote_size,
         case when t.path_in_repo is null then 'new_file'
              when t.remote_size is null then 'size_unknown'
              when t.remote_size = l.local_size then 'size_match'
              else 'size_differs' end as reason
  from l left join t on t.path_in_repo = l.path_in_repo)
"""


def _plan(spark: SparkSession, sf: str) -> DataFrame:
    local = M.target_paths(V.expected(spark, sf), "pub", "data")
    known = F.when(F.col("quality") == 1, F.col("size")).alias("size")
    remote = M.target_paths(V.present(spark, sf), "pub", "data").select("path_in_repo", known)
    return M.publish_plan(local, remote)


@query(
    "m6_publish_plan",
    f"{PLAN_SQL} select file, path_in_repo, reason <> 'size_match' as uploaded, reason, "
    "local_size, remote_size from j",
)
def m6_plan(spark, sf):
    return _plan(spark, sf)


@query(
    "m7_publish_summary",
    f"{PLAN_SQL} select count(*) as total, "
    "cast(count(*) filter (where reason <> 'size_match') as bigint) as num_uploaded, "
    "cast(count(*) filter (where reason = 'size_match') as bigint) as num_skipped from j",
)
def m7_summary(spark, sf):
    return M.publish_summary(_plan(spark, sf))


@query(
    "m8_target_paths",
    f"{V.WITH_FILES} "
    "select path, case when starts_with(path, 'data/src1/') "
    "then concat('pub/', substr(path, 11)) else concat('pub/', name) end as path_in_repo "
    "from expected",
)
def m8_targets(spark, sf):
    files = V.expected(spark, sf).select("path")
    return M.target_paths(files, "pub", "data/src1")


@query("m9_extension_guard", f"{V.WITH_FILES} select name from expected where name not like '%.parquet'")
def m9_guard(spark, sf):
    return M.not_publishable(V.expected(spark, sf)).select("name")


@query("m10_publish_by_copy", f"{V.WITH_VARIANTS} {EXPLODED}")
def m10_publish(spark, sf):
    _, _, out = _split(spark, sf, "m10")
    target = f"{new_folder(spark, 'm10')}/hub"
    publish.publish(spark, out, target)
    return columnar.scan_split(spark, f"{target}/data").select(*SPLIT_COLUMNS)


@query(
    "m10_publish_twice",
    f"{V.WITH_VARIANTS}, y as ({EXPLODED}) "
    "select chrom, start, concat(id, ' again') as id, ref, alt, tsa, source from y",
)
def m10_twice(spark, sf):
    """A table written anew replaces what was published, and nothing hidden stays behind."""
    _, _, out = _split(spark, sf, "m10t")
    target = f"{new_folder(spark, 'm10t')}/hub"
    publish.publish(spark, out, target)
    S.split_by_type(spark, _renamed(spark, sf), out, overwrite=True)
    publish.publish(spark, out, target, stale="remove")
    return columnar.scan_split(spark, f"{target}/data").select(*SPLIT_COLUMNS)


def _renamed(spark: SparkSession, sf: str) -> DataFrame:
    """All variants with other ids."""
    rows = columnar.spread(V.variants(spark, sf).select(*SPLIT_COLUMNS))
    return rows.withColumn("id", F.concat(F.col("id"), F.lit(" again")))


@query(
    "m10_publish_versions",
    f"{V.WITH_VARIANTS}, y as ({EXPLODED}) select y.*, 'first' as version from y "
    "union all select chrom, start, concat(id, ' again'), ref, alt, tsa, source, 'second' from y",
)
def m10_versions(spark, sf):
    """What a reader of the target finds after each of two publications, each whole."""
    _, _, out = _split(spark, sf, "m10v")
    target = f"{new_folder(spark, 'm10v')}/hub"
    found = []
    for name in ("first", "second"):
        if found:
            S.split_by_type(spark, _renamed(spark, sf), out, overwrite=True)
        versions.publish_version(spark, out, target)
        table = columnar.scan_split(spark, f"{versions.current_version(spark, target)}/data")
        found.append(table.select(*SPLIT_COLUMNS).withColumn("version", F.lit(name)))
    return found[0].unionByName(found[1])


STATS_SQL = """
select count(*) as num_files, sum(size) / 1073741824.0 as total_size_gb,
       string_agg(distinct source, ',' order by source) as variant_types from expected
"""


@query("m11_dataset_statistics", f"{V.WITH_FILES} {STATS_SQL}")
def m11_stats(spark, sf):
    stats = M.dataset_stats(V.expected(spark, sf), "data")
    return stats.withColumn("variant_types", F.concat_ws(",", "variant_types"))


@query(
    "m12_type_from_path",
    f"{V.WITH_FILES} select path, source as variant_type from expected "
    "union all select name, null from present",
)
def m12_types(spark, sf):
    inner = M.with_variant_type(V.expected(spark, sf).select("path"), "data")
    bare = M.with_variant_type(V.present(spark, sf).select(F.col("name").alias("path")), "data")
    return inner.unionByName(bare)


@query(
    "m13_round_trip_equality",
    f"{V.WITH_VARIANTS} select count(*) - count(*) as left_only, count(*) - count(*) as right_only from v",
)
def m13_round_trip(spark, sf):
    stored = _stored(spark, sf, "m13")
    again = columnar.scan(spark, RE.reencode(spark, stored))
    return CM.difference_counts(V.variants(spark, sf), again)


@query(
    "m13_bag_difference",
    """with a as (select o_custkey as k from orders), b as (select c_custkey as k from customer)
    select (select count(*) from (select k from a except all select k from b)) as left_only,
           (select count(*) from (select k from b except all select k from a)) as right_only""",
)
def m13_difference(spark, sf):
    a = V.table(spark, sf, "orders").select(F.col("o_custkey").alias("k"))
    b = V.table(spark, sf, "customer").select(F.col("c_custkey").alias("k"))
    return CM.difference_counts(a, b)


# ---------------------------------------------------------------- queries on tables


@query(
    "q1_range_scan",
    f"{V.WITH_VARIANTS} select chrom, start, id, ref, alt from v "
    "where chrom = 'chr3' and start between 1000 and 500000",
)
def q1_range(spark, sf):
    return LK.range_scan(
        V.variants(spark, sf), 1000, 500000, "chr3", columns=["chrom", "start", "id", "ref", "alt"]
    )


@query(
    "q1_range_scan_of_chosen_files",
    f"{V.WITH_VARIANTS}, y as ({EXPLODED}) select chrom, start, id, ref, alt, tsa, source from y "
    "where chrom = 'chr3' and start between 1000 and 500000",
)
def q1_chosen_files(spark, sf):
    """Bounds in the footers of a split by range choose the files that are opened."""
    _, _, out = _split(spark, sf, "q1f", layout="range")
    return LK.range_scan_files(
        spark, out, LK.file_bounds(spark, out), 1000, 500000, "chr3", columns=list(SPLIT_COLUMNS)
    )


@query(
    "q1_range_scan_top",
    f"{V.WITH_VARIANTS} select chrom, start, ref, alt, id from v "
    "where start between 1000 and 500000 order by chrom, start, ref, alt nulls first, id limit 10",
)
def q1_top(spark, sf):
    return LK.range_scan(
        V.variants(spark, sf), 1000, 500000, limit=10, columns=["chrom", "start", "ref", "alt", "id"]
    )


@query(
    "q2_text_match",
    f"with r as ({V.CLINICAL}) select chrom, start, ref, alt, clnsig, clndn from r "
    "where clnsig like '%HIGH%'",
)
def q2_match(spark, sf):
    return LK.match_text(
        V.clinical(spark, sf),
        "clnsig",
        "HIGH",
        columns=["chrom", "start", "ref", "alt", "clnsig", "clndn"],
    )


@query(
    "q2_text_match_regex_top",
    f"with r as ({V.CLINICAL}) select chrom, start, ref, alt, clnsig from r "
    "where regexp_matches(clnsig, '^[12]-') order by chrom, start, ref, alt limit 100",
)
def q2_regex(spark, sf):
    return LK.match_text(
        V.clinical(spark, sf),
        "clnsig",
        "^[12]-",
        regex=True,
        limit=100,
        columns=["chrom", "start", "ref", "alt", "clnsig"],
    )


@query("q3_annotated_only", f"{V.WITH_VARIANTS} select id, tsa, alt from v where alt is not null")
def q3_annotated(spark, sf):
    return LK.annotated_only(V.variants(spark, sf), "alt").select("id", "tsa", "alt")


ON_KEY = "q.chrom = r.chrom and q.start = r.start and q.ref = r.ref and q.alt = r.alt"


@query(
    "q4_annotate_by_key",
    f"{V.WITH_BOTH} select q.id, q.start, q.alt, r.clnsig, r.af_total "
    f"from v q left join r on {ON_KEY}",
)
def q4_annotate(spark, sf):
    sample = V.variants(spark, sf).select("chrom", "start", "ref", "alt", "id")
    joined = AN.annotate(sample, V.clinical(spark, sf), ["clnsig", "af_total"])
    return joined.select("id", "start", "alt", "clnsig", "af_total")


@query(
    "q4_annotate_shuffled",
    f"{V.WITH_BOTH} select q.id, q.start, q.alt, r.clnsig from v q left join r on {ON_KEY}",
)
def q4_shuffled(spark, sf):
    sample = V.variants(spark, sf).select("chrom", "start", "ref", "alt", "id")
    joined = AN.annotate(sample, V.clinical(spark, sf), ["clnsig"], reduction="none")
    return joined.select("id", "start", "alt", "clnsig")


@query(
    "q4_annotate_reduced_by_keys",
    f"{V.WITH_BOTH} select q.id, q.start, q.alt, r.clnsig from v q left join r on {ON_KEY}",
)
def q4_reduced_by_keys(spark, sf):
    sample = V.variants(spark, sf).select("chrom", "start", "ref", "alt", "id")
    joined = AN.annotate(sample, V.clinical(spark, sf), ["clnsig"], reduction="keys")
    return joined.select("id", "start", "alt", "clnsig")


@query(
    "q4_annotate_reduced_by_bitmap",
    f"{V.WITH_BOTH} select q.id, q.start, q.alt, r.clnsig from v q left join r on {ON_KEY}",
)
def q4_reduced_by_bitmap(spark, sf):
    sample = V.variants(spark, sf).select("chrom", "start", "ref", "alt", "id")
    # Keys above the bound are not broadcast: the cut by position remains.
    joined = AN.annotate(sample, V.clinical(spark, sf), ["clnsig"], reduction="keys", max_bytes=1)
    return joined.select("id", "start", "alt", "clnsig")


HOT_ORACLE = (
    f"with v as ({V.VARIANTS}), r as ({V.CLINICAL_HOT}) "
    f"select q.id, q.start, q.alt, r.clnsig, r.clndn from v q left join r on {ON_KEY}"
)


@query("q4_annotate_hot_key", HOT_ORACLE)
def q4_hot(spark, sf):
    """One key holds a tenth of the annotation table; it is joined in parts."""
    sample = V.variants(spark, sf).select("chrom", "start", "ref", "alt", "id")
    known = V.clinical_hot(spark, sf)
    joined = AN.annotate(sample, known, ["clnsig", "clndn"], reduction="none", heavy_rows=1000)
    return joined.select("id", "start", "alt", "clnsig", "clndn")


@query("q4_annotate_from_buckets", HOT_ORACLE)
def q4_buckets(spark, sf):
    """The annotation table is stored once in buckets of its key; only the sample moves."""
    place = new_folder(spark, "q4b")
    name = "annotation_" + place.rsplit("-", 1)[1]
    known = AN.store_in_buckets(V.clinical_hot(spark, sf), name, f"{place}/buckets", buckets=16)
    sample = V.variants(spark, sf).select("chrom", "start", "ref", "alt", "id")
    joined = AN.annotate(sample, known, ["clnsig", "clndn"], reduction="none", heavy_rows=1000)
    return joined.select("id", "start", "alt", "clnsig", "clndn")


@query(
    "q4_annotate_by_id_key",
    f"{V.WITH_BOTH} select q.id, q.start, r.clnsig from v q "
    "left join r on q.chrom = r.chrom and q.ref = r.ref and q.alt = r.alt and q.start = r.start",
)
def q4_by_other_keys(spark, sf):
    """Position columns are not among the keys: one text names the variant."""
    name = F.concat_ws(":", "chrom", F.col("start").cast("string"), "ref", "alt")
    keyed = F.when(F.col("alt").isNotNull(), name).alias("key")
    sample = V.variants(spark, sf).select(keyed, "id", "start")
    known = V.clinical(spark, sf).select(keyed, "clnsig")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        joined = AN.annotate(sample, known, ["clnsig"], keys=["key"])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    return joined.select("id", "start", "clnsig")


@query(
    "q4_annotate_exploded_one_per_key",
    f"""{V.WITH_BOTH}, x as (
      select chrom, start, ref, unnest(string_split(alt, '|')) as alt, tsa
      from v where alt is not null
      union all select chrom, start, ref, alt, tsa from v where alt is null),
    k as (select chrom, start, ref, alt, min(tsa) as known from x group by all)
    select r.clndn, k.known from r left join k
    on r.chrom = k.chrom and r.start = k.start and r.ref = k.ref and r.alt = k.alt""",
)
def q4_exploded(spark, sf):
    known = S.explode_alleles(V.variants(spark, sf), None).select(
        "chrom", "start", "ref", "alt", F.col("tsa").alias("known")
    )
    joined = AN.annotate(V.clinical(spark, sf), known, ["known"], dedupe_keys=True)
    return joined.select("clndn", "known")


@query(
    "q5_clinical_annotation",
    f"{V.WITH_BOTH} select q.id, q.start, r.clnsig, r.clndn from v q join r on {ON_KEY}",
)
def q5_clinical(spark, sf):
    sample = V.variants(spark, sf).select("chrom", "start", "ref", "alt", "id")
    found = AN.annotate_clinical(sample, V.clinical(spark, sf), significant_only=True)
    return found.select("id", "start", "clnsig", "clndn")


@query(
    "q6_id_lookup",
    f"{V.WITH_VARIANTS} select chrom, start, id, ref, alt from v "
    "where exists (select 1 from supplier where concat('rs', s_suppkey) = v.id)",
)
def q6_lookup(spark, sf):
    ids = V.table(spark, sf, "supplier").select(F.concat(F.lit("rs"), "s_suppkey").alias("id"))
    rows = V.variants(spark, sf).select("chrom", "start", "id", "ref", "alt")
    return LK.lookup_ids(rows, ids)


@query(
    "q7_frequency_annotation",
    f"{V.WITH_BOTH} select q.id, q.start, q.alt, r.af_total, r.af_half "
    f"from v q left join r on {ON_KEY}",
)
def q7_frequency(spark, sf):
    sample = V.variants(spark, sf).select("chrom", "start", "ref", "alt", "id")
    joined = AN.annotate_frequencies(sample, V.clinical(spark, sf))
    return joined.select("id", "start", "alt", "af_total", "af_half")


@query(
    "q8_one_type_one_source",
    f"{V.WITH_VARIANTS} select chrom, start, id, ref, alt from v "
    "where tsa = 'insertion' and source = 'set3'",
)
def q8_partition(spark, sf):
    table, _, _ = _split(spark, sf, "q8")
    return columnar.read_one(table, "insertion", "set3").select("chrom", "start", "id", "ref", "alt")


@query("q9_column_subset", f"{V.WITH_VARIANTS} select chrom, start, ref, alt from v where chrom = 'chr1'")
def q9_subset(spark, sf):
    stored = _stored(spark, sf, "q9")
    return columnar.scan(spark, stored, ["chrom", "start", "ref", "alt"], F.col("chrom") == "chr1")


# ---------------------------------------------------------------- composed jobs

PREPARED_SPLIT = f"""{V.WITH_VARIANTS}
select chrom, start, id, ref, unnest(string_split(alt, '|')) as alt, tsa
from v where tsa = 'SNV' and alt is not null
union all select chrom, start, id, ref, alt, tsa from v where tsa <> 'SNV' or alt is null"""


@query("p1_prepare_source", PREPARED_SPLIT)
def p1_prepare(spark, sf):
    folder = new_folder(spark, "p1")
    V.write_vcf(spark, _lines(spark, sf), f"{folder}/in", "gzip")
    done = prepare.prepare_source(
        spark,
        [f"{folder}/in/head", f"{folder}/in/body"],
        f"{folder}/out",
        with_splitting=True,
        always_variant=True,
    )
    return done.split_table.select("chrom", "start", "id", "ref", "alt", "tsa")


@query(
    "p1_status_per_file",
    f"{V.WITH_VARIANTS} select distinct source, 'converted' as status from v "
    "union all select 'empty', 'no rows'",
)
def p1_status(spark, sf):
    folder = new_folder(spark, "p1s")
    names = [r[0] for r in V.variants(spark, sf).select("source").distinct().orderBy("source").collect()]
    for name in names:
        chosen = columnar.spread(V.variants(spark, sf).filter(F.col("source") == name))
        V.write_named(spark, V.vcf_lines(chosen), f"{folder}/in", f"{name}.vcf")
    V.write_named(spark, spark.createDataFrame([("##nothing",)], "value string"), f"{folder}/in", "empty.vcf")
    done = prepare.prepare_source(spark, f"{folder}/in/*", f"{folder}/out", info_fields=["TSA"])
    return done.status.select("source", "status").distinct()


@query("p1_older_file_time", PREPARED_SPLIT)
def p1_older_time(spark, sf):
    """Files replaced by older ones: the variants and their split follow what is there now."""
    folder, older, newer = _two_forms(spark, sf, "p1o")
    for form in (newer, older):
        rename(spark, form, f"{folder}/in")
        done = prepare.prepare_source(spark, f"{folder}/in/*", f"{folder}/out", with_splitting=True)
        rename(spark, f"{folder}/in", form)
    return done.split_table.select("chrom", "start", "id", "ref", "alt", "tsa")


@query("p2_prepare_named_source", PREPARED_SPLIT)
def p2_named(spark, sf):
    folder = new_folder(spark, "p2")
    V.write_vcf(spark, _lines(spark, sf), f"{folder}/in")
    done = prepare.prepare_named(
        spark,
        presets.preset("dbsnp"),
        [f"{folder}/in/head", f"{folder}/in/body"],
        f"{folder}/out",
        pattern="[.]txt$",
        with_splitting=True,
    )
    return done.split_table.select("chrom", "start", "id", "ref", "alt", "tsa")


@query("p3_split_existing_tables", PREPARED_SPLIT)
def p3_existing(spark, sf):
    stored = _stored(spark, sf, "p3")
    table, _ = prepare.split_existing(spark, [stored], f"{stored}_split")
    return table.select("chrom", "start", "id", "ref", "alt", "tsa")


@query(
    "p3_partitioned_input",
    f"""{V.WITH_VARIANTS}, x as ({EXPLODED})
    select start, alt, tsa, 'variants' as source from x""",
)
def p3_partitioned(spark, sf):
    """A table in folders by chromosome is one source, named after the table."""
    out = f"{new_folder(spark, 'p3p')}/variants.parquet"
    rows = columnar.spread(V.variants(spark, sf).drop("source"))
    rows.write.partitionBy("chrom").parquet(out)
    table, _ = prepare.split_existing(spark, [out + "/"], f"{out}_split")
    return table.select("start", "alt", "tsa", "source")


@query(
    "p4_publish_data_set",
    f"""{V.WITH_VARIANTS}, x as ({EXPLODED})
    select tsa, count(*) as n_rows, cast(0 as bigint) as uploaded_again from x group by tsa""",
)
def p4_publish(spark, sf):
    _, _, out = _split(spark, sf, "p4")
    target = f"{new_folder(spark, 'p4')}/hub"
    publish.publish(spark, out, target)
    # Publishing again must find every file in place.
    again = publish.publish(spark, out, target).summary.first().num_uploaded
    counts = S.variant_type_counts(columnar.scan_split(spark, f"{target}/data"))
    return counts.select("tsa", F.col("n").alias("n_rows"), F.lit(again).cast("bigint").alias("uploaded_again"))


@query(
    "p5_refresh_statistics",
    f"{V.WITH_VARIANTS} select string_agg(distinct tsa, ',' order by tsa) as variant_types, "
    "true as files_agree, true as sizes_agree from v",
)
def p5_stats(spark, sf):
    """Counts and sizes are those of the files that a scan of the table reads."""
    _, manifest, out = _split(spark, sf, "p5")
    stats = publish.refresh_stats(spark, out).select(
        F.concat_ws(",", "variant_types").alias("variant_types"), "num_files", "total_size_gb"
    )
    scanned = manifest.agg(
        F.lit(None).cast("string").alias("variant_types"),
        F.count(F.lit(1)).alias("num_files"),
        (F.sum("size") / F.lit(float(1024**3))).alias("total_size_gb"),
    )
    return stats.unionByName(scanned).agg(
        F.max("variant_types").alias("variant_types"),
        (F.min("num_files") == F.max("num_files")).alias("files_agree"),
        (F.max("total_size_gb") - F.min("total_size_gb") < 1e-12).alias("sizes_agree"),
    )


# ---------------------------------------------------------------- flagship


FLAGSHIP_SQL = f"""{V.WITH_BOTH}, x as ({EXPLODED})
select q.tsa, count(*) as n_rows, cast(count(r.clnsig) as bigint) as n_annotated
from x q left join r on {ON_KEY} group by q.tsa"""


@query("flagship_split_and_annotate", FLAGSHIP_SQL)
def flagship(spark, sf):
    """Expand alleles, annotate every variant by key, and count by type."""
    rows = S.explode_alleles(V.variants(spark, sf).select(*SPLIT_COLUMNS))
    joined = AN.annotate(rows, V.clinical(spark, sf), ["clnsig"])
    return joined.groupBy("tsa").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("clnsig").alias("n_annotated")
    )
