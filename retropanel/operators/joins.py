"""Panel joins. Every input is aggregated to its grain first.

Only the fixed geography carries a broadcast hint; for anything that grows, Spark compares the measured
size with ``spark.sql.autoBroadcastJoinThreshold`` and falls back to a sort-merge join, whose skewed
partitions adaptive execution splits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def left_with_suffix(left: DataFrame, right: DataFrame, keys: Sequence[str], suffix: str) -> DataFrame:
    """Left equi-join; right columns whose name is taken get the suffix."""
    taken = set(left.columns) - set(keys)
    clash = {c: c + suffix for c in right.columns if c in taken}
    return left.join(right.withColumnsRenamed(clash), list(keys), "left")


def with_geography(df: DataFrame, geo: DataFrame) -> DataFrame:
    cols = ["dept", "dept_name", "city_ref", "latitude", "longitude"]
    return df.join(F.broadcast(geo.select(*cols)), "dept", "left")


def outer_on_period(left: DataFrame, right: DataFrame, key: str = "date_id") -> DataFrame:
    return left.join(right, key, "full_outer")


def merge_series(long: DataFrame, names: Sequence[str], key: str = "period") -> DataFrame:
    """Outer merge of n series on the period: one shuffle of long rows instead of n joins."""
    cells = [F.max(F.when(F.col("series") == n, F.col("value"))).alias(n) for n in names]
    return long.groupBy(key).agg(*cells)


def resolve_conflicts(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join in which a new value wins over an old one."""
    shared = [c for c in new.columns if c in old.columns and c not in keys]
    renamed = old.withColumnsRenamed({c: c + "_old" for c in shared})
    joined = renamed.join(new, list(keys), "full_outer")
    return joined.withColumns({c: F.coalesce(c, c + "_old") for c in shared}).drop(
        *[c + "_old" for c in shared]
    )


def star_join(fact: DataFrame, time: DataFrame, geo: DataFrame, economy: DataFrame) -> DataFrame:
    """Fact with its two dimensions, and the national series where there are any."""
    return (
        fact.join(time, "date_id").join(geo, "geo_id").join(economy, "date_id", "left")
    )


def lookup_or(df: DataFrame, dim: DataFrame, key: str, value: str, default: Column) -> DataFrame:
    """Dictionary lookup with a default for unknown keys; Spark broadcasts the dictionary if it is small."""
    return df.join(dim.select(key, value), key, "left").withColumn(
        value, F.coalesce(value, default)
    )


def members(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(keys, list(on), "left_semi")


def absent(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(keys, list(on), "left_anti")


def side_by_side(tables: dict[str, DataFrame], key: str, value: str) -> DataFrame:
    """One value column per table, joined on the key."""
    out = None
    for name, df in tables.items():
        one = df.select(key, F.col(value).alias(name))
        out = one if out is None else out.join(one, key, "full_outer")
    return out
