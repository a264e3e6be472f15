"""Duplicate counting and removal.

Keep-last filters ``row_number() = 1``, which Spark turns into a group limit on both sides of the
shuffle: every map task passes on one row per key, so a key that holds a third of all rows reaches the
reducer as one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def duplicate_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: total rows, distinct keys and rows beyond the first of each key."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_total"),
        F.count(F.lit(1)).alias("keys_distinct"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("rows_duplicated"),
    )


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` tuple of each key; NULL keys form one key."""
    newest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("_rn", F.row_number().over(newest)).filter("_rn = 1").drop("_rn")


def exact_distinct(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()
