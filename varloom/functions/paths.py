"""Column expressions over file names and paths (all evaluated inside the JVM)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Suffixes of index files and of variant files, byte units of reports.
INDEX_SUFFIXES = (".tbi", ".csi", ".idx")
VARIANT_SUFFIXES = (".vcf.gz", ".vcf.bgz", ".vcf")
BYTE_UNITS = ("B", "KB", "MB", "GB", "TB")

_VARIANT_NAME = r"^[.]*[^.].*[.]vcf([.]|$)|^[.]*[^.][.]vcf([.]|$)"
_LAST_SUFFIX = r"(?<=.)[.][^.]+$"


def plain_path(path: str) -> str:
    """Spell a path the way a scan reports it: no ``file:`` scheme, no final slash."""
    spelled = re.sub(r"^file:/+", "/", str(path))
    return spelled.rstrip("/") or "/"


def plain_path_col(path: Column) -> Column:
    """The same for a column: evaluated per row, so without patterns or decoding."""
    return (
        F.when(F.startswith(path, F.lit("file:///")), F.substring(path, 8, 2**31 - 1))
        .when(F.startswith(path, F.lit("file:/")), F.substring(path, 6, 2**31 - 1))
        .otherwise(path)
    )


def decoded_path(uri: Column) -> Column:
    """``_metadata.file_path`` is percent-encoded; ``+`` in it is a literal plus."""
    decoded = F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))
    return plain_path_col(F.when(F.contains(uri, F.lit("%")), decoded).otherwise(uri))


def base_name(path: Column) -> Column:
    """The part after the last slash."""
    return F.substring_index(path, "/", -1)


def has_suffix(path: Column, suffix: str) -> Column:
    return F.endswith(path, F.lit(suffix))


def is_index_file(name: Column) -> Column:
    return F.greatest(*[F.endswith(name, F.lit(s)) for s in INDEX_SUFFIXES])


def is_variant_file(name: Column) -> Column:
    """True for a name carrying a ``.vcf`` suffix that is not an index of one."""
    return F.regexp_like(name, F.lit(_VARIANT_NAME)) & ~is_index_file(name)


def variant_stem(name: Column) -> Column:
    """Output stem of a variant file.

    ``.vcf``, ``.vcf.gz`` and ``.vcf.bgz`` are removed as a whole; of any other name
    only the last suffix goes.
    """
    cut = lambda s: F.substring(name, F.lit(1), F.length(name) - len(s))
    stem = F.when(F.endswith(name, F.lit(VARIANT_SUFFIXES[0])), cut(VARIANT_SUFFIXES[0]))
    for suffix in VARIANT_SUFFIXES[1:]:
        stem = stem.when(F.endswith(name, F.lit(suffix)), cut(suffix))
    return stem.otherwise(F.regexp_replace(name, _LAST_SUFFIX, ""))


def variant_stem_of(name: str) -> str:
    """Driver-side twin of :func:`variant_stem` for a single output path."""
    for suffix in VARIANT_SUFFIXES:
        if name.endswith(suffix):
            return name.removesuffix(suffix)
    return re.sub(_LAST_SUFFIX, "", name)


def relative_path(path: Column, root: str) -> Column:
    """Path below ``root``, or null when the file lies elsewhere."""
    prefix = plain_path(root).rstrip("/") + "/"
    return F.when(F.startswith(path, F.lit(prefix)), F.substring(path, len(prefix) + 1, 2**31 - 1))


def target_path(path: Column, prefix: str, root: str | None = None) -> Column:
    """Where a file is published: ``prefix`` plus its place below ``root``.

    A file outside ``root`` (or any file, when no root is given) keeps its name only.
    """
    flat = base_name(path)
    inner = F.coalesce(relative_path(path, root), flat) if root is not None else flat
    return F.concat(F.lit(prefix + "/"), inner)


def first_component(relative: Column) -> Column:
    """First directory of a relative path; null for a file right under the root."""
    return F.nullif(F.regexp_extract(relative, "^([^/]+)/", 1), F.lit(""))


def partition_value(component: Column) -> Column:
    """``tsa=SNV`` -> ``SNV``; other directory names are returned as they are."""
    return unescaped(F.regexp_replace(component, "^[^=]+=", ""))


def unescaped(value: Column) -> Column:
    """The text that a folder name spells; ``+`` in it is a literal plus."""
    return F.url_decode(F.replace(value, F.lit("+"), F.lit("%2B")))


def folder_value(path: Column, column: str) -> Column:
    """What the last folder ``column=value`` in a listed path stands for; null for a null value."""
    folder = F.regexp_extract(path, f".*/{re.escape(column)}=([^/]*)/", 1)
    return F.when(folder != "__HIVE_DEFAULT_PARTITION__", unescaped(folder))


def human_bytes(size: Column) -> Column:
    """A byte count as text: whole bytes below 1 KB, one decimal above."""
    text = None
    for power, unit in enumerate(BYTE_UNITS):
        if power == 0:
            shown = F.format_string("%d B", size.cast("bigint"))
        else:
            # Half-even on the exact quotient, the usual rounding of "%.1f".
            shown = F.concat(
                F.format_string("%.1f", F.bround(size / F.lit(float(1024**power)), 1)),
                F.lit(" " + unit),
            )
        fits = size < F.lit(1024 ** (power + 1))
        if text is None:
            text = F.when(fits, shown)
        elif unit == BYTE_UNITS[-1]:
            text = text.otherwise(shown)
        else:
            text = text.when(fits, shown)
    return text


def saved_percent(before: Column, after: Column) -> Column:
    """How much smaller ``after`` is, in percent with one decimal; 0 for an empty input."""
    return F.when(
        before > 0, F.bround((F.lit(1.0) - after / before) * F.lit(100.0), 1)
    ).otherwise(F.lit(0.0))


def megabytes(size: Column) -> Column:
    return F.bround(size / F.lit(1048576.0), 2)


def batches(rows: Column, batch_size: int) -> Column:
    """Number of batches of ``batch_size`` rows needed for ``rows`` rows."""
    return F.ceil(rows / F.lit(batch_size)).cast("bigint")
