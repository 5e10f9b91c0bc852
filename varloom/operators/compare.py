"""Equality of tables as bags of rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def difference_counts(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows found more often on one side: one row (left_only, right_only).

    Rows are counted per distinct value with partial aggregation before a single
    shuffle, so repeated rows, even a third of a table, collapse where they are read.
    """
    columns = left.columns
    signed = left.withColumn("_sign", F.lit(1).cast("bigint")).unionByName(
        right.select(*columns).withColumn("_sign", F.lit(-1).cast("bigint"))
    )
    balance = signed.groupBy(*columns).agg(F.sum("_sign").alias("_sign"))
    zero = F.lit(0).cast("bigint")
    return balance.agg(
        F.coalesce(F.sum(F.greatest(F.col("_sign"), zero)), zero).alias("left_only"),
        F.coalesce(F.sum(F.greatest(-F.col("_sign"), zero)), zero).alias("right_only"),
    )


def fingerprint(df: DataFrame) -> DataFrame:
    """Order-free summary of a table in one scan, without a shuffle of its rows.

    Different summaries prove different tables; equal ones make equality very likely.
    """
    digest = F.xxhash64(*[F.col(c) for c in sorted(df.columns)])
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.bit_xor(digest), F.lit(0)).alias("xor"),
        F.coalesce(F.sum(digest.cast("decimal(38,0)")), F.lit(0)).alias("total"),
    )


def same_rows(left: DataFrame, right: DataFrame) -> bool:
    """Same columns in the same order, same types, and the same rows in any order."""
    shape = [(f.name, f.dataType) for f in left.schema.fields]
    if shape != [(f.name, f.dataType) for f in right.schema.fields]:
        return False
    found = difference_counts(left, right).first()
    return found.left_only == 0 and found.right_only == 0
