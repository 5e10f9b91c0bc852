"""Preparing a source: list, convert, validate, split."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from varloom.functions.paths import base_name, decoded_path, folder_value, variant_stem
from varloom.operators import manifest as M
from varloom.operators.sinks import FILES_DONE, Converted, convert_listed, file_mark, finished, latest
from varloom.operators.split import merge_catalogues, split_by_type
from varloom.schema import EXPLODE_TYPES, FILE_COL, SOURCE_COL, TYPE_COL
from varloom.sources.columnar import scan
from varloom.sources.files import qualified
from varloom.sources.listing import collect_parquet, list_files
from varloom.sources.presets import Preset, preset
from varloom.sources.vcf import source_of


@dataclass(frozen=True)
class Prepared:
    """What a preparation produced; every part is a DataFrame or a plain value."""

    files: DataFrame
    passed_through: DataFrame
    converted: Converted | None
    counts: DataFrame
    split_table: DataFrame | None
    splits: DataFrame | None
    status: DataFrame
    sizes: DataFrame | None


def prepare_source(
    spark: SparkSession,
    location: str | Sequence[str],
    out: str,
    pattern: str | None = None,
    with_splitting: bool = False,
    explode_types: Sequence[str] | None = EXPLODE_TYPES,
    info_fields: Sequence[str] | None = None,
    type_col: str = TYPE_COL,
    always_variant: bool = False,
    expected: DataFrame | None = None,
    overwrite: bool = False,
    malformed: str = "reject",
    layout: str = "rebalance",
) -> Prepared:
    """Convert the variant files of a location to ``<out>/variants``; optionally split
    them to ``<out>/split``. Run again, it takes only the files that are new.

    ``expected`` (name, size) is a listing the location must agree with: a missing name
    or a differing known size is an error; ``sizes`` of the result tells how each file
    compared, also where the listing knows no size. ``status`` says what became of every
    variant file; one that was not converted is an error.
    """
    places = location if isinstance(location, str) else list(location)
    files = list_files(spark, places, pattern)
    sizes = None if expected is None else check_expected(expected, files)
    mode = "overwrite" if overwrite else "reuse"
    converted, passed = convert_listed(
        spark,
        files,
        f"{out}/variants",
        info_fields,
        mode=mode,
        always_variant=always_variant,
        malformed=malformed,
    )
    status = file_status(spark, files, converted, always_variant)
    lost = status.filter("status = 'not converted'")
    if not lost.isEmpty():
        some = [r.path for r in lost.orderBy("path").limit(20).collect()]
        raise FileNotFoundError(f"{lost.count()} files were not converted, such as {some}")
    split_table = splits = None
    if with_splitting and converted is not None:
        split_table, splits = split_by_type(
            spark,
            converted.table,
            f"{out}/split",
            explode_types,
            type_col=type_col,
            layout=layout,
            overwrite=overwrite,
            stamps=source_stamps(spark, converted.path),
        )
        M.fail_on_problems(split_problems(stored_sources(spark, converted.path), stored_sources(spark, f"{out}/split")))
    counts = inputs_and_sources(files, converted, always_variant)
    return Prepared(files, passed, converted, counts, split_table, splits, status, sizes)


def source_stamps(spark: SparkSession, converted: str) -> DataFrame:
    """(source, stamp): a number over path, size and time of each source's files as last converted."""
    forms = latest(finished(spark, converted, FILES_DONE), "path")
    marks = forms.select(SOURCE_COL, F.xxhash64("path", "modified", "size").alias("h"))
    return marks.groupBy(SOURCE_COL).agg(F.hex(F.bit_xor("h")).alias("stamp"))


def file_status(
    spark: SparkSession, files: DataFrame, converted: Converted | None, always_variant: bool = False
) -> DataFrame:
    """(path, size, source, status) of the variant files, from listings alone.

    ``converted``, ``no rows`` for a file that holds no readable variant, or ``not
    converted`` for one that the table does not name in its present form.
    """
    wanted = files.filter(F.lit(True) if always_variant else F.col("is_variant_file"))
    named = wanted.select("path", "size", "modified", source_of(F.col("path")).alias(SOURCE_COL))
    if converted is None:
        return named.drop("modified").withColumn("status", F.lit("not converted"))
    done = latest(finished(spark, converted.path, FILES_DONE), "path").select("path", "size", "modified")
    done = done.withColumn("done", F.lit(True))
    mark = F.regexp_extract("path", f"/{FILE_COL}=([^/]*)/", 1).alias("mark")
    stored = collect_parquet(spark, converted.path).select(mark).distinct().withColumn("stored", F.lit(True))
    same = (named["path"] == done["path"]) & (named["size"] == done["size"])
    met = named.join(done, same & named["modified"].eqNullSafe(done["modified"]), "left").select(
        named["path"], named["size"], SOURCE_COL, "done", file_mark(named["path"]).alias("mark")
    )
    status = (
        F.when(F.col("done").isNull(), "not converted").when(F.col("stored").isNull(), "no rows").otherwise("converted")
    )
    return met.join(stored, "mark", "left").select("path", "size", SOURCE_COL, status.alias("status"))


def prepare_named(
    spark: SparkSession,
    name: str | Preset,
    location: str | Sequence[str],
    out: str,
    release: str | None = None,
    pattern: str | None = None,
    **options,
) -> Prepared:
    """Prepare a named source. ``location`` is where its files lie for this cluster, any path
    that Hadoop can list; the public addresses of the presets are not of that kind."""
    chosen = name if isinstance(name, Preset) else preset(name, release)
    options.setdefault("type_col", chosen.type_col)
    options.setdefault("always_variant", chosen.always_variant)
    return prepare_source(
        spark, location, out, pattern or chosen.pattern, **options
    )


def check_expected(expected: DataFrame, files: DataFrame) -> DataFrame:
    """How sizes compare (see ``reconcile_sizes``); a lost name or differing size is an error."""
    lost = M.missing_by(expected, files).select("name")
    count = lost.count()
    if count:
        some = [r.name for r in lost.orderBy("name").limit(20).collect()]
        raise FileNotFoundError(f"no files for {count} names, such as {some}")
    sizes = M.reconcile_sizes(expected, files)
    wrong = sizes.filter("status = 'size_differs'")
    count = wrong.count()
    if count:
        some = [f"{r.local_path} has {r.local_size} bytes, not {r.remote_size}" for r in wrong.orderBy("name").limit(20).collect()]
        raise ValueError(f"{count} files differ in size:\n" + "\n".join(some))
    return sizes


def stored_sources(spark: SparkSession, table: str) -> DataFrame:
    """(source) of a table laid out by source, from a listing of its files."""
    return collect_parquet(spark, table).select(folder_value(F.col("path"), SOURCE_COL).alias(SOURCE_COL)).distinct()


def inputs_and_sources(
    files: DataFrame, converted: Converted | None, always_variant: bool = False
) -> DataFrame:
    """Variant inputs against converted sources (``n_variant``, ``n_parquet``,
    ``complete``). Fewer sources than inputs is a warning: a file may hold no variant."""
    wanted = F.lit(True) if always_variant else F.col("is_variant_file")
    inputs = files.agg(F.count_if(wanted).alias("n_variant"))
    if converted is None:
        return inputs.withColumn("n_parquet", F.lit(0).cast("bigint")).withColumn(
            "complete", F.col("n_variant") == 0
        )
    made = stored_sources(files.sparkSession, converted.path).count()
    return inputs.withColumn("n_parquet", F.lit(made).cast("bigint")).withColumn(
        "complete", F.col("n_parquet") >= F.col("n_variant")
    )


def split_problems(converted: DataFrame, split: DataFrame) -> DataFrame:
    """Check that every source of a table has at least one split file; both sides name their sources."""
    sources = converted.select(F.col(SOURCE_COL).alias("name"))
    made = split.select(F.col(SOURCE_COL).alias("name"), F.lit(True).alias("exists"))
    return M.check_splits(sources, sources, made)


def split_existing(
    spark: SparkSession,
    paths: Sequence[str],
    out: str,
    explode_types: Sequence[str] | None = EXPLODE_TYPES,
    **options,
) -> tuple[DataFrame, DataFrame]:
    """Split tables that exist already, all in one job; returns (table, splits).

    Files of a table without a ``source`` column are named by their own stem. Anything
    that is not Parquet is left out, as an empty result for it would be.
    """
    chosen = [p for p in paths if p.rstrip("/").endswith(".parquet")]
    if not chosen:
        raise ValueError("no .parquet input")
    table = scan(spark, chosen)
    if SOURCE_COL not in table.columns:
        table = table.withColumn(SOURCE_COL, stem_of_input(spark, chosen))
    return split_by_type(spark, table, out, explode_types, **options)


def stem_of_input(spark: SparkSession, paths: Sequence[str]) -> Column:
    """Stem of the given path a row was read from: the longest one that its file lies in."""
    uri = decoded_path(F.col("_metadata.file_path"))
    owner = uri
    for place in sorted({qualified(spark, p) for p in paths}, key=len):
        inside = (uri == place) | F.startswith(uri, F.lit(place + "/"))
        owner = F.when(inside, F.lit(place)).otherwise(owner)
    return variant_stem(base_name(owner))


__all__ = [
    "Prepared",
    "check_expected",
    "inputs_and_sources",
    "merge_catalogues",
    "prepare_named",
    "prepare_source",
    "split_existing",
    "split_problems",
    "stem_of_input",
]
