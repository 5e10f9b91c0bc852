"""Writing tables: save policies, encoding profiles, VCF conversion."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from varloom.functions.paths import plain_path, variant_stem_of
from varloom.schema import FILE_COL, SOURCE_COL
from varloom.session import new_folder
from varloom.sources import vcf
from varloom.sources.columnar import scan, scan_split, stored_schema
from varloom.sources.files import delete_tree, exists, is_complete, is_directory, modified_ms

# Encoding profiles: the codec, and whether rows are ordered for tighter encoding.
PROFILES = {"default": "snappy", "compact": "zstd"}
# Folders that a task of a partitioned write holds open before it sorts what is left by folder.
OPEN_WRITERS = 8
SAVE_MODES = ("fail", "reuse", "overwrite", "partitions")
# Hidden folder of a table naming what was written to it in full.
DONE_FOLDER = "_sources"
FILES_DONE = f"{SOURCE_COL} string, path string, size bigint, modified timestamp, run bigint"


def default_output(path: str, suffix: str = ".parquet") -> str:
    """Output next to the input: the VCF endings (or the last suffix) replaced."""
    folder, _, name = plain_path(path).rpartition("/")
    stem = variant_stem_of(name)
    return f"{folder}/{stem}{suffix}" if folder or path.startswith("/") else f"{stem}{suffix}"


def resolve_output(save_to: str | None, path: str, suffix: str = ".parquet") -> str | None:
    """The three-way save policy: ``None`` no output, ``"auto"`` beside the input, or a path."""
    if save_to is None:
        return None
    return default_output(path, suffix) if save_to == "auto" else save_to


def is_reusable(spark: SparkSession, out: str, newer_than: str | None = None) -> bool:
    """A finished output exists and, if asked, is not older than its input.

    A single file is finished; a folder is so once its committed-job marker exists.
    """
    single = exists(spark, out) and not is_directory(spark, out)
    if not single and not is_complete(spark, out):
        return False
    if newer_than is None:
        return True
    made = modified_ms(spark, out if single else f"{out}/_SUCCESS")
    return made >= changed_ms(spark, newer_than)


def changed_ms(spark: SparkSession, path: str) -> int:
    """When a file, or a folder's finished table, was written."""
    marker = f"{path}/_SUCCESS"
    return modified_ms(spark, marker if exists(spark, marker) else path)


def save(
    spark: SparkSession,
    df: DataFrame,
    out: str,
    mode: str = "fail",
    partition_by: Sequence[str] = (),
    profile: str = "default",
    file_format: str = "parquet",
    batch_size: int | None = None,
    max_file_rows: int | None = None,
    newer_than: str | None = None,
    few_folders: bool = False,
) -> bool:
    """Write a table; returns False if a finished one was reused.

    ``mode``: ``fail`` if something is there, ``reuse`` a finished output (an unfinished
    one is rewritten), ``overwrite``, or ``partitions`` to replace only the partitions
    that the rows fall into. ``batch_size`` bounds the rows of a row group. ``few_folders``
    says that the rows of a task mostly fall into few folders, in no order: they are then
    written without a sort.
    """
    if mode not in SAVE_MODES:
        raise ValueError(f"mode must be one of {SAVE_MODES}, not {mode!r}")
    if profile not in PROFILES:
        raise ValueError(f"profile must be one of {sorted(PROFILES)}, not {profile!r}")
    if mode == "reuse" and is_reusable(spark, out, newer_than):
        return False
    if mode == "fail" and exists(spark, out):
        raise FileExistsError(out)
    writer = df.write.format(file_format).mode("overwrite")
    writer = writer.option("compression", PROFILES[profile])
    writer = writer.option("partitionOverwriteMode", "dynamic" if mode == "partitions" else "static")
    if batch_size is not None and file_format == "parquet":
        writer = writer.option("parquet.block.row.count.limit", str(batch_size))
    if max_file_rows is not None:
        writer = writer.option("maxRecordsPerFile", str(max_file_rows))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    if few_folders:
        spark.conf.set(name, str(OPEN_WRITERS))
    try:
        writer.save(out)
    finally:
        spark.conf.set(name, before)
    return True


def finished(spark: SparkSession, out: str, schema: str) -> DataFrame | None:
    """What a table says was written to it, record by record; None while it says nothing.

    Records are numbered by ``run``; only the latest of each file or source counts. A job
    that died while writing has not recorded its input, so that is written again, replacing
    whatever partitions it left.
    """
    if not exists(spark, f"{out}/{DONE_FOLDER}"):
        return None
    return spark.read.schema(schema).parquet(f"{out}/{DONE_FOLDER}")


def latest(records: DataFrame, key: str) -> DataFrame:
    """The record of the last run for each value of ``key``; records without a number come first."""
    rest = [c for c in records.columns if c not in (key, "run")]
    numbered = F.struct(F.coalesce("run", F.lit(0).cast("bigint")).alias("run"), *rest)
    return records.groupBy(key).agg(F.max(numbered).alias("record")).select(key, "record.*")


def last_run(records: DataFrame | None) -> int:
    """The highest number of a record, 0 without any."""
    if records is None:
        return 0
    return int(records.agg(F.coalesce(F.max("run"), F.lit(0))).first()[0])


def mark_finished(done: DataFrame, out: str, run: int) -> None:
    done.withColumn("run", F.lit(run).cast("bigint")).write.mode("append").parquet(f"{out}/{DONE_FOLDER}")


def file_mark(path: Column) -> Column:
    """Partition value of one input file, from its whole path."""
    return F.concat(F.lit("f"), F.lower(F.hex(F.xxhash64(path))))


def with_folders(lines: DataFrame, files: DataFrame) -> DataFrame:
    """Adds the source and mark of each line's file."""
    path = F.col("path")
    return vcf.with_path_columns(lines, files, {SOURCE_COL: vcf.source_of(path), FILE_COL: file_mark(path)})


def fixed(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table of its own, so that later steps see the same rows."""
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def not_finished(files: DataFrame, done: DataFrame | None) -> DataFrame:
    """Files that the table does not hold as they are now: new ones, and those of other size or time.

    ``done`` has the latest record of each file.
    """
    if done is None:
        return files
    same = (files["path"] == done["path"]) & (files["size"] == done["size"])
    return files.join(done, same & files["modified"].eqNullSafe(done["modified"]), "left_anti")


def forget_changed(spark: SparkSession, pending: DataFrame, done: DataFrame, run: int, out: str, *others: str) -> None:
    """Remove what earlier forms of changed files left in the tables, one file at a time.

    Records first that ``out`` holds no form of them, so that a job that dies afterwards
    converts them anew even if they are put back to the form they had.
    """
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    changed = pending.join(done.select("path"), "path", "left_semi").select(
        vcf.source_of(F.col("path")).alias(SOURCE_COL), "path"
    )
    if changed.isEmpty():
        return
    nothing = changed.withColumn("size", F.lit(None).cast("bigint")).withColumn("modified", F.lit(None).cast("timestamp"))
    mark_finished(nothing, out, run)
    for row in changed.select(SOURCE_COL, file_mark(F.col("path")).alias("mark")).toLocalIterator():
        for table in (out, *others):
            delete_tree(spark, f"{table}/{SOURCE_COL}={escape(row[SOURCE_COL])}/{FILE_COL}={row.mark}")


@dataclass(frozen=True)
class Converted:
    """Outcome of a conversion: the stored table and what happened to it."""

    table: DataFrame
    path: str
    written: bool
    rejected: int
    rejects_path: str | None


def convert_vcf(
    spark: SparkSession,
    paths: vcf.Paths,
    out: str,
    info_fields: Sequence[str] | None = None,
    mode: str = "reuse",
    partition_by_source: bool = False,
    malformed: str = "reject",
    profile: str = "default",
    range_bytes: int = vcf.RANGE_BYTES,
    newer_than: str | None = None,
    rejects_out: str | None = None,
    agree_with: str | None = None,
) -> Converted:
    """Convert VCF files to one table in one pass over the text, without a shuffle.

    With ``partition_by_source`` a later run converts only files that the table does not
    hold as they are now, by path, size and time; files of one stem in several folders are
    kept apart. Unreadable lines are counted during the pass; only if there are any are
    they written apart, to ``rejects_out`` or ``<out>_rejects``, by a second pass; those of
    files not converted again stay. ``agree_with`` names a table whose columns the fields
    must fit, as those of ``out`` must where rows are added to it.
    """
    if mode not in ("fail", "reuse", "overwrite"):
        raise ValueError(f"mode must be fail, reuse or overwrite, not {mode!r}")
    files, run = vcf.listed(spark, paths), 1
    rejects_path = rejects_out or f"{out}_rejects"
    write_mode = "overwrite" if mode == "reuse" else mode
    if partition_by_source:
        records = finished(spark, out, FILES_DONE) if mode == "reuse" else None
        done = None if records is None else latest(records, "path")
        files = fixed(not_finished(files, done), "pending-files")
        if done is not None:
            write_mode = "partitions"
            if files.isEmpty():
                return Converted(scan_split(spark, out, [SOURCE_COL]), out, False, 0, None)
            run = last_run(records) + 2
            forget_changed(spark, files, done, run - 1, out, rejects_path)
    elif mode == "reuse" and is_reusable(spark, out, newer_than):
        return Converted(scan(spark, out), out, False, 0, None)

    fields = vcf.wanted_fields(spark, files, info_fields)
    if agree_with or write_mode == "partitions":
        fields = agreed_fields(spark, agree_with or out, fields)
    lines = vcf.read_lines(spark, files, range_bytes)
    keep = [SOURCE_COL, FILE_COL] if partition_by_source else [SOURCE_COL]
    placed = with_folders if partition_by_source else vcf.with_source
    rejects = Observation()
    bodies = placed(vcf.told_lines(vcf.checked_lines(lines, malformed), rejects), files)
    table = vcf.parse_bodies(bodies, fields, keep)
    parts = keep if partition_by_source else []
    # A task mostly reads few files, each with a folder of its own.
    save(spark, table, out, mode=write_mode, partition_by=parts, profile=profile, few_folders=bool(parts))
    rejected = int(rejects.get["n"])
    if rejected:
        kept_mode = write_mode if partition_by_source and exists(spark, rejects_path) else "overwrite"
        save(spark, vcf.rejected_lines(placed(lines, files)), rejects_path, mode=kept_mode, partition_by=parts, few_folders=bool(parts))
    elif write_mode == "overwrite":
        delete_tree(spark, rejects_path)
    if not partition_by_source:
        stored = scan(spark, out)
    else:
        written = vcf.source_of(F.col("path")).alias(SOURCE_COL)
        mark_finished(files.select(written, "path", "size", "modified"), out, run)
        made = table.drop(FILE_COL).schema
        first = None if write_mode == "partitions" else made
        stored = scan_split(spark, out, [SOURCE_COL], written=first, empty=made)
    return Converted(stored, out, True, rejected, rejects_path if rejected else None)


def agreed_fields(
    spark: SparkSession, out: str, fields: Sequence[vcf.InfoField]
) -> list[vcf.InfoField]:
    """Field definitions that fit the columns a table has already.

    A value becomes a list, or any type a text, where that is how the table stores the
    field. A field that would need the stored column to change is an error, raised before
    anything is written: convert the whole table again with ``mode="overwrite"``.
    """
    if not exists(spark, out):
        return list(fields)
    has = {f.name: f.dataType for f in (stored_schema(spark, out) or ())}
    names = vcf.info_column_names(fields)
    agreed, wrong = [], []
    for field in fields:
        stored = has.get(names[field.field])
        fits = [
            f
            for f in (
                field,
                vcf.InfoField(field.field, ".", field.type),
                vcf.InfoField(field.field, field.number, "String"),
                vcf.InfoField(field.field, ".", "String"),
            )
            if stored is None or vcf.column_type(f) == stored
        ]
        if fits and not (field.type == "Flag" and fits[0] != field):
            agreed.append(fits[0])
        else:
            wrong.append(f"{field.field} ({field.type}, {field.number}) against {stored.simpleString()}")
    if wrong:
        raise ValueError(f"fields that do not fit the stored table: {', '.join(wrong)}")
    return agreed


def read_vcf(
    spark: SparkSession,
    path: str,
    info_fields: Sequence[str] | None = None,
    save_to: str | None = "auto",
    save_compact: str | None = None,
    malformed: str = "reject",
    mode: str = "overwrite",
) -> DataFrame:
    """Read one VCF (or Parquet) location, storing it on the way if wanted.

    ``mode`` says what happens where an output exists: ``overwrite``, ``reuse`` it if it is
    not older than the input, or ``fail``.

    A Parquet input is scanned as it is. ``save_to`` and ``save_compact`` follow the
    three-way policy; ``save_compact="auto"`` goes beside the saved table, or beside the
    input if none is saved. With ``save_to=None`` the result stays an unexecuted plan.
    """
    if plain_path(path).endswith(".parquet"):
        return scan(spark, path)
    out = resolve_output(save_to, path)
    compact = resolve_output(save_compact, out or path, ".compact")
    if out is None:
        table = vcf.scan_vcf(spark, path, info_fields, malformed)
    else:
        table = convert_vcf(
            spark, path, out, info_fields, mode=mode, malformed=malformed, newer_than=path
        ).table
    if compact is not None:
        save(spark, table, compact, mode=mode, profile="compact", newer_than=path)
    return table


def vcf_to_parquet(
    spark: SparkSession,
    path: str,
    out: str | None = None,
    info_fields: Sequence[str] | None = None,
    overwrite: bool = False,
    check_newer: bool = False,
) -> tuple[DataFrame, str]:
    """Convert one VCF location; returns (table, path). A finished output is reused."""
    target = out or default_output(path)
    done = convert_vcf(
        spark,
        path,
        target,
        info_fields,
        mode="overwrite" if overwrite else "reuse",
        newer_than=path if check_newer else None,
    )
    return done.table, target


def convert_listed(
    spark: SparkSession,
    files: DataFrame,
    out: str,
    info_fields: Sequence[str] | None = None,
    mode: str = "reuse",
    always_variant: bool = False,
    **options,
) -> tuple[Converted | None, DataFrame]:
    """Convert the variant files of a manifest in one job.

    Returns (conversion or None, files passed through unchanged).
    """
    keep = F.lit(True) if always_variant else F.col("is_variant_file")
    chosen, passed = files.filter(keep), files.filter(~keep)
    if chosen.isEmpty():
        return None, passed
    done = convert_vcf(
        spark, chosen, out, info_fields, mode=mode, partition_by_source=True, **options
    )
    return done, passed
