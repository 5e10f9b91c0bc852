"""VCF text as typed DataFrames.

The body is parsed with built-in expressions over one ``value`` column, so any way of
obtaining lines works (files, streams, derived tables). Headers are read apart from the
body, and only as far as the header goes: discovering fields never scans the data.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from varloom.functions import alleles as A
from varloom.functions import info as I
from varloom.functions import paths as P
from varloom.schema import ALLELE_SEP, CORE_COLUMNS, HEADER_SCHEMA, SOURCE_COL
from varloom.sources import blocks
from varloom.sources.columnar import spread
from varloom.sources.listing import list_files

# A body line: eight columns at least, the second a number; comments never match.
# Quantifiers are possessive: a line that fails does so without going back.
BODY_LINE = r"^[^#\t][^\t]*+\t[0-9]{%s}+\t[^\t]*+\t[^\t]*+\t[^\t]*+\t[^\t]*+\t[^\t]*+\t[^\t]"
# A bigint holds any number of so many digits.
SAFE_DIGITS = 18
RANGE_BYTES = 64 << 20
MIN_RANGE_BYTES = 4 << 20
RANGE_TASKS_PER_CORE = 8
# Compressed bytes of whole gzip files whose lines one task gets, where lines are dealt anew.
GZIP_SHARE_BYTES = 32 << 20
# Beyond this many ranges they grow instead: each is a task, dealt out by one.
MAX_RANGES = 50_000
BLOCK_SUFFIXES = (".bgz", ".bgzf")

Paths = DataFrame | str | Sequence[str]


@dataclass(frozen=True)
class InfoField:
    """One INFO field of a header."""

    field: str
    number: str = "1"
    type: str = "String"


# ---------------------------------------------------------------- headers


def info_definitions(header: DataFrame) -> DataFrame:
    """INFO definitions (path, line_no, field, number, type) among header lines.

    The name ends at ``,`` or ``>``. Quoted descriptions are removed first, since they
    may contain anything.
    """
    text = F.regexp_replace(F.col("value"), '"[^"]*"', "")
    found = header.filter(F.startswith(F.col("value"), F.lit("##INFO=<ID="))).select(
        "path",
        "line_no",
        F.regexp_extract(text, "ID=([^,>]+)", 1).alias("field"),
        F.nullif(F.regexp_extract(text, "[,]Number=([^,>]*)", 1), F.lit("")).alias("number"),
        F.nullif(F.regexp_extract(text, "[,]Type=([^,>]*)", 1), F.lit("")).alias("type"),
    )
    return found.filter(F.col("field") != "")


def merged_definitions(definitions: DataFrame) -> DataFrame:
    """One row per field over all files; where files disagree the wider reading wins.

    A conflicting type becomes String and a conflicting number becomes a list.
    """
    merged = definitions.groupBy("field").agg(
        F.min(F.struct("path", "line_no")).alias("place"),
        F.min("type").alias("type"),
        F.max("type").alias("other_type"),
        F.min("number").alias("number"),
        F.max("number").alias("other_number"),
    )
    return merged.select(
        "place",
        "field",
        F.when(F.col("number") == F.col("other_number"), F.col("number"))
        .when(F.col("number").isNull(), F.lit("1"))
        .otherwise(F.lit("."))
        .alias("number"),
        F.when(F.col("type") == F.col("other_type"), F.col("type"))
        .otherwise(F.lit("String"))
        .alias("type"),
    )


def header_lines(spark: SparkSession, files: DataFrame) -> DataFrame:
    """Leading ``#`` lines of every listed file; each task reads only the heads."""
    return files.select("path").mapInArrow(blocks.head_lines, HEADER_SCHEMA)


def info_definitions_of(spark: SparkSession, paths: Paths) -> list[InfoField]:
    """INFO fields declared by the files, in header order (a header is small)."""
    files = listed(spark, paths)
    merged = merged_definitions(info_definitions(header_lines(spark, files))).collect()
    return [InfoField(r.field, r.number, r.type) for r in sorted(merged, key=lambda r: r.place)]


def info_fields(spark: SparkSession, paths: Paths) -> list[str]:
    """Names of the INFO fields declared by the files, in header order."""
    return [d.field for d in info_definitions_of(spark, paths)]


# ---------------------------------------------------------------- lines


def read_lines(spark: SparkSession, paths: Paths, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Text lines (value, path) of plain, gzip and block-gzip files.

    * Plain text splits by byte ranges inside Spark's own reader, and small gzip files are
      one task each. Where there are few gzip files their lines are dealt to all cores, in
      parts of bounded size.
    * ``.bgz`` files, and gzip files beyond 4 MB that turn out to be block compressed, are
      cut into ranges that tasks decode independently. Ranges are ``range_bytes`` long,
      shorter where that would leave cores idle, longer where there would be too many.
    """
    # A listing of paths is what any multi-file scan keeps on the driver.
    files = {r.path: r.size for r in listed(spark, paths).select("path", "size").collect()}
    every = sorted(files)
    to_probe = [
        (path, size)
        for path, size in files.items()
        if path.endswith(BLOCK_SUFFIXES)
        or (path.endswith(".gz") and size > min(range_bytes, MIN_RANGE_BYTES))
    ]
    ranged = [
        (r.path, r.size, r.blocked)
        for r in _probed(spark, to_probe)
        if r.blocked or not r.path.endswith(".gz")
    ]
    apart = {r[0] for r in ranged}
    text_paths = [p for p in every if p not in apart]

    if not every:
        return spark.createDataFrame([], blocks.LINES_SCHEMA)
    parts: list[DataFrame] = []
    if text_paths:
        path = P.decoded_path(F.col("_metadata.file_path")).alias("path")
        # Lines end at a line feed, and one carriage return before it goes, as in ranges.
        text = F.col("value")
        cut = F.substring(text, F.lit(1), F.length(text) - 1)
        value = F.when(F.endswith(text, F.lit("\r")), cut).otherwise(text).alias("value")
        text = spark.read.text(text_paths, lineSep="\n").select(value, path)
        # A gzip file is one task; parsing its lines is the heavier part.
        zipped = [files[p] for p in text_paths if p.endswith(".gz")]
        parts.append(spread(text, sum(zipped) // GZIP_SHARE_BYTES) if zipped else text)
    if ranged:
        parts.append(_range_lines(spark, ranged, range_bytes))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _probed(spark: SparkSession, files: list[tuple[str, int]]) -> list:
    if not files:
        return []
    found = spark.createDataFrame(files, "path string, size bigint").mapInArrow(
        blocks.probe_blocks, "path string, size bigint, blocked boolean"
    )
    return found.collect()


def _range_lines(
    spark: SparkSession, files: list[tuple[str, int, bool]], range_bytes: int
) -> DataFrame:
    total = sum(size for _, size, blocked in files if blocked)
    cores = spark.sparkContext.defaultParallelism
    share = max(MIN_RANGE_BYTES, total // cores)
    step = max(min(range_bytes, share), total // MAX_RANGES)
    # Short ranges share tasks: each core gets several tasks, or each task some megabytes.
    shared = max(RANGE_TASKS_PER_CORE * cores, total // MIN_RANGE_BYTES)
    count = min(shared, sum(-(-size // step) for _, size, blocked in files if blocked))
    count += sum(not blocked for _, _, blocked in files)
    starts = F.when(
        F.col("blocked"),
        F.sequence(F.lit(0).cast("bigint"), F.col("size") - 1, F.lit(step).cast("bigint")),
    ).otherwise(F.array(F.lit(0).cast("bigint")))
    ranges = (
        spark.createDataFrame(files, "path string, size bigint, blocked boolean")
        .withColumn("start", F.explode(starts))
        .withColumn(
            "stop",
            F.when(
                F.col("blocked"), F.least(F.col("start") + step, F.col("size"))
            ).otherwise(F.col("size")),
        )
    )
    # From one partition rows are dealt in turn, so that tasks get equal numbers of ranges.
    return ranges.coalesce(1).repartition(max(count, 1)).mapInArrow(blocks.read_ranges, blocks.LINES_SCHEMA)


def listed(spark: SparkSession, paths: Paths) -> DataFrame:
    """A files manifest as it is, or the manifest of the given locations."""
    if isinstance(paths, DataFrame):
        return paths
    return list_files(spark, [paths] if isinstance(paths, str) else list(paths), recursive=True)


# ---------------------------------------------------------------- parsing


def is_body_line(value: Column) -> Column:
    """Eight columns, and a position that a bigint holds; only a long one is cast to tell."""
    position = F.substring_index(F.substring_index(value, "\t", 2), "\t", -1)
    plain = F.regexp_like(value, F.lit(BODY_LINE % f"1,{SAFE_DIGITS}"))
    long = F.regexp_like(value, F.lit(BODY_LINE % f"{SAFE_DIGITS + 1},"))
    return plain | (long & position.try_cast("bigint").isNotNull())


def is_content_line(value: Column) -> Column:
    """Neither a comment nor blank."""
    text = F.coalesce(value, F.lit(""))
    return (F.trim(text) != "") & ~F.startswith(text, F.lit("#"))


def is_rejected_line(value: Column) -> Column:
    """A content line that is not a readable body line."""
    return is_content_line(value) & ~is_body_line(F.coalesce(value, F.lit("")))


def rejected_lines(lines: DataFrame) -> DataFrame:
    """The lines :func:`parse_lines` leaves out, with the reason."""
    cells = F.size(F.split(F.col("value"), "\t", 9))
    reason = F.when(cells < 8, F.lit("too few columns")).otherwise(F.lit("malformed position or column"))
    return lines.filter(is_rejected_line(F.col("value"))).withColumn("reason", reason)


def column_type(field: InfoField) -> T.DataType:
    """Type of a field's column; a flag is true or false whatever its number."""
    return T.BooleanType() if field.type == "Flag" else I.stored_type(field.type, field.number)


def info_column_names(fields: Sequence[InfoField]) -> dict[str, str]:
    """Output column of each field: lower case, prefixed where a name is taken."""
    taken = {*CORE_COLUMNS, SOURCE_COL}
    names: dict[str, str] = {}
    for f in fields:
        name = f.field.lower()
        while name in taken:
            name = "info_" + name
        taken.add(name)
        names[f.field] = name
    return names


def as_fields(fields: Sequence[InfoField | str | tuple]) -> list[InfoField]:
    made = []
    for f in fields:
        if isinstance(f, InfoField):
            made.append(f)
        else:
            made.append(InfoField(f) if isinstance(f, str) else InfoField(*f))
    return made


def parse_lines(
    lines: DataFrame,
    fields: Sequence[InfoField | str | tuple] = (),
    keep: Sequence[str] = (),
    malformed: str = "reject",
) -> DataFrame:
    """VCF lines (column ``value``) as core columns plus one typed column per field.

    ``malformed="reject"`` leaves unreadable lines to :func:`rejected_lines`;
    ``"fail"`` stops the job at the first one.
    """
    lines = checked_lines(lines, malformed)
    return parse_bodies(lines.filter(is_body_line(F.col("value"))), as_fields(fields), keep)


def checked_lines(lines: DataFrame, malformed: str) -> DataFrame:
    """The lines as they are; with ``malformed="fail"`` the first unreadable one stops the job."""
    if malformed not in ("reject", "fail"):
        raise ValueError(f"malformed must be 'reject' or 'fail', not {malformed!r}")
    if malformed == "reject":
        return lines
    value = F.col("value")
    bad = F.raise_error(F.concat(F.lit("malformed VCF line: "), value)).cast("boolean")
    return lines.filter(F.when(is_rejected_line(value), bad).otherwise(F.lit(True)))


def told_lines(lines: DataFrame, rejects: Observation) -> DataFrame:
    """The readable body lines; ``rejects`` tells as ``n`` how many lines :func:`rejected_lines` holds.

    One look at each line settles both.
    """
    value, told = F.col("value"), F.col("_readable")
    lost = F.count_if(~told & is_content_line(value)).alias("n")
    return lines.withColumn("_readable", is_body_line(value)).observe(rejects, lost).filter(told).drop("_readable")


def parse_bodies(lines: DataFrame, wanted: Sequence[InfoField], keep: Sequence[str] = ()) -> DataFrame:
    """The same for lines that are all known to be body lines."""
    # The ninth part holds the sample columns unsplit: they are never looked at.
    cells = lines.select(F.split(F.col("value"), "\t", 9).alias("c"), *keep)
    cell = lambda i: F.get(F.col("c"), F.lit(i))
    flat = cells.select(
        cell(0).alias("chrom"),
        cell(1).try_cast("bigint").alias("start"),
        F.nullif(cell(2), F.lit(".")).alias("id"),
        cell(3).alias("ref"),
        A.listed_alleles(cell(4), ALLELE_SEP).alias("alt"),
        F.nullif(cell(5), F.lit(".")).try_cast("double").alias("qual"),
        F.nullif(cell(6), F.lit(".")).alias("filter"),
        cell(7).alias("info"),
        *keep,
    )
    flags = [f.field for f in wanted if f.type == "Flag"]
    values = list(dict.fromkeys(["END", *[f.field for f in wanted if f.type != "Flag"]]))
    staged = flat.withColumn("i", I.fenced(F.col("info")))
    text = {k: I.value_text(F.col("i"), k) for k in values}
    is_set = {k: I.flag_set(F.col("i"), k) for k in flags}
    last = F.coalesce(text["END"].try_cast("bigint"), F.col("start") + F.length("ref") - 1)
    typed = lambda f: (
        is_set[f.field] if f.type == "Flag" else I.typed_value(text[f.field], f.type, f.number)
    )
    names = info_column_names(wanted)
    return staged.select(
        "chrom",
        "start",
        last.alias("end"),
        "id",
        "ref",
        "alt",
        "qual",
        "filter",
        *[typed(f).alias(names[f.field]) for f in wanted],
        *keep,
    )


def wanted_fields(
    spark: SparkSession, paths: Paths, names: Sequence[str] | None
) -> list[InfoField]:
    """Typed definitions of the requested fields (all declared ones for ``None``).

    A requested field that no header declares is read as text.
    """
    if names is not None and not names:
        return []
    declared = {d.field: d for d in info_definitions_of(spark, paths)}
    if names is None:
        return list(declared.values())
    return [declared.get(n, InfoField(n)) for n in names]


def scan_vcf(
    spark: SparkSession,
    paths: Paths,
    info_fields: Sequence[str] | None = None,
    malformed: str = "reject",
    range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """Variant table of VCF files, with the file's stem in column ``source``."""
    files = listed(spark, paths)
    fields = wanted_fields(spark, files, info_fields)
    lines = with_source(read_lines(spark, files, range_bytes), files)
    return parse_lines(lines, fields, [SOURCE_COL], malformed)


def source_of(path: Column) -> Column:
    return P.variant_stem(P.base_name(path))


def with_source(lines: DataFrame, files: DataFrame) -> DataFrame:
    """Adds the source of each line's file."""
    return with_path_columns(lines, files, {SOURCE_COL: source_of(F.col("path"))})


def with_path_columns(lines: DataFrame, files: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Adds columns that follow from a line's path, worked out once for each listed file.

    A path that the listing spells otherwise is worked out line by line.
    """
    known = files.select("path", *[c.alias(f"_{name}") for name, c in columns.items()]).distinct()
    met = lines.join(F.broadcast(known), "path", "left")
    return met.select("value", "path", *[F.coalesce(f"_{name}", c).alias(name) for name, c in columns.items()])
