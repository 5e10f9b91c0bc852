"""Predicates of the queries that prepared tables serve."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def in_range(chrom: Column, start: Column, name: str | None, low: int, high: int) -> Column:
    """Position between two bounds, both included, optionally on one chromosome."""
    inside = start.between(low, high)
    return inside if name is None else (chrom == F.lit(name)) & inside


def text_match(text: Column, needle: str, regex: bool = False) -> Column:
    """Literal containment by default; a regular-expression search on request."""
    return F.regexp_like(text, F.lit(needle)) if regex else F.contains(text, F.lit(needle))
