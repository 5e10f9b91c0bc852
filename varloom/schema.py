"""Column names and manifest schemas shared by every module."""

from __future__ import annotations

CORE_COLUMNS = ("chrom", "start", "end", "id", "ref", "alt", "qual", "filter")
KEY_COLUMNS = ("chrom", "start", "ref", "alt")

TYPE_COL = "tsa"
LIST_COL = "alt"
SOURCE_COL = "source"
# Partition of a converted table that tells files of equal stem apart; not shown to readers.
FILE_COL = "source_file"
ALLELE_SEP = "|"
EXPLODE_TYPES = ("SNV",)

HEADER_SCHEMA = "path string, line_no bigint, value string"
