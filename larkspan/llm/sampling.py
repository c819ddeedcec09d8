"""Bounded samples of labelled rows and crc32 folds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CUTS = 64


def crc_is(key: str, n: int, r: int) -> Column:
    """crc32 of the key's text, modulo n, is r; false for a null key."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % n == r, F.lit(False))


def smallest(rows: DataFrame, by: str, key: str, n: int) -> DataFrame:
    """The n rows of smallest key hash for each value of `by`, with their rank `__r`.

    First within CUTS parts of a value, then over the n x CUTS rows left, so a
    frequent value is never ranked in one task."""
    order = [F.xxhash64(key), F.col(key)]
    part = Window.partitionBy(by, "__cut").orderBy(*order)
    few = rows.withColumn("__cut", F.pmod(F.xxhash64(F.lit(1), key), F.lit(CUTS))).withColumn("__r", F.row_number().over(part)).where(F.col("__r") <= n)
    return few.withColumn("__r", F.row_number().over(Window.partitionBy(by).orderBy(*order))).where(F.col("__r") <= n).drop("__cut")
