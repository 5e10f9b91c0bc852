"""Column expressions over allele lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_alleles(alleles: Column, sep: str = "|") -> Column:
    """Literal split; empty parts are kept and null stays null.

    A backslash-escaped single character avoids compiling a pattern for every row.
    """
    pattern = "".join(c if c.isalnum() else "\\" + c for c in sep)
    return F.split(alleles, pattern)


def allele_rows(
    alleles: Column,
    variant_type: Column,
    explode_types: Sequence[str] | None,
    sep: str = "|",
) -> Column:
    """The alleles a row expands to: a list for exploded types, else the text itself.

    ``explode_types=None`` expands every type. A null type is never expanded by name.
    """
    if explode_types is None:
        return split_alleles(alleles, sep)
    if not explode_types:
        return F.array(alleles)
    return F.when(
        variant_type.isin(*explode_types), split_alleles(alleles, sep)
    ).otherwise(F.array(alleles))


def allele_count(alleles: Column, sep: str = "|") -> Column:
    """Rows one allele text expands to: separators plus one, and one for null."""
    return F.coalesce(F.size(split_alleles(alleles, sep)), F.lit(1)).cast("bigint")


def listed_alleles(vcf_alt: Column, sep: str = "|") -> Column:
    """VCF ALT (comma list, ``.`` for none) as ``sep``-joined text or null."""
    return F.replace(F.nullif(vcf_alt, F.lit(".")), F.lit(","), F.lit(sep))
