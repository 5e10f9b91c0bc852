"""Named sources: where each one lies and which of its files are wanted."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varloom.functions.paths import base_name
from varloom.schema import TYPE_COL


@dataclass(frozen=True)
class Preset:
    name: str
    location: str
    pattern: str
    type_col: str = TYPE_COL
    # Files of this source are VCF even where their names do not say so.
    always_variant: bool = False


# Public locations and file-name patterns of the named sources.
PRESETS = {
    "ensembl": Preset(
        "ensembl_variations",
        "https://ftp.ensembl.org/pub/current_variation/vcf/homo_sapiens/",
        r"homo_sapiens-chr([^.]+)\.vcf\.gz$",
    ),
    "clinvar": Preset(
        "clinvar",
        "https://ftp.ncbi.nlm.nih.gov/pub/clinvar/vcf_GRCh38/",
        r"clinvar\.vcf\.gz$",
        type_col="clnvc",
    ),
    "dbsnp/GRCh38": Preset(
        "dbsnp_grch38",
        "https://ftp.ncbi.nlm.nih.gov/snp/latest_release/VCF/",
        r"GCF_000001405\.40\.gz$",
        always_variant=True,
    ),
    "dbsnp/GRCh37": Preset(
        "dbsnp_grch37",
        "https://ftp.ncbi.nlm.nih.gov/snp/latest_release/VCF/",
        r"GCF_000001405\.25\.gz$",
        always_variant=True,
    ),
    "gnomad/v4": Preset(
        "gnomad_v4",
        "https://gnomad-public-us-east-1.s3.amazonaws.com/release/4.0/vcf/",
        r"gnomad\.v4\.0\..+\.vcf\.bgz$",
    ),
    "gnomad/v3": Preset(
        "gnomad_v3",
        "https://gnomad-public-us-east-1.s3.amazonaws.com/release/3.1.2/vcf/",
        r"gnomad\.v3\.1\.2\..+\.vcf\.bgz$",
    ),
}
DEFAULT_RELEASE = {"dbsnp": "GRCh38", "gnomad": "v4"}


def preset(name: str, release: str | None = None) -> Preset:
    """Look a source up; an unknown name, build or version is an error."""
    key = name.lower()
    release = release or DEFAULT_RELEASE.get(key)
    found = PRESETS.get(f"{key}/{release}" if release else key)
    if found is None:
        raise ValueError(f"Unsupported source: {name} {release or ''}".rstrip())
    return found


def preset_of(name: Column) -> Column:
    """Names of the presets a file name belongs to, as an array.

    The table of presets is a handful of constants, so this is an expression per row
    and needs no join.
    """
    hits = [
        F.when(F.regexp_like(name, F.lit(p.pattern)), F.lit(p.name)) for p in PRESETS.values()
    ]
    return F.array_compact(F.array(*hits))


def assign_presets(files: DataFrame) -> DataFrame:
    """One row per (file, matching preset); files of no preset are left out."""
    hits = preset_of(base_name(F.col("path")))
    return files.withColumn("preset", F.explode(hits))
