"""Writers. Merges rewrite the touched buckets of a table, in one committed write."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retropanel.functions.expr import present
from retropanel.operators.dedup import keep_last
from retropanel.sources.readers import path_exists


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), fmt: str = "parquet") -> str:
    writer = df.write.mode("overwrite").partitionBy(*partition_by) if partition_by else df.write.mode("overwrite")
    writer.option("header", True).format(fmt).save(path)
    return path


def write_by_year(df: DataFrame, path: str, date: str) -> str:
    """Event table laid out by year, so that a year filter reads one directory.

    Rows are clustered by year at run time: a heavy year is split by its measured size, and a task opens
    few files.
    """
    return write_table(df.withColumn("year", F.year(date)).hint("rebalance", "year"), path, ["year"])


def read_by_year(spark: SparkSession, path: str, date: str, first: str, last: str) -> DataFrame:
    """Date filter that also states the years, so whole directories are pruned."""
    lo, hi = F.lit(first).cast("date"), F.lit(last).cast("date")
    return spark.read.parquet(path).filter(
        (F.col("year") >= int(first[:4]))
        & (F.col("year") <= int(last[:4]))
        & (F.col(date).cast("date") >= lo)
        & (F.col(date).cast("date") <= hi)
    )


def write_bucketed(df: DataFrame, path: str, keys: Sequence[str], buckets: int | None = None) -> DataFrame:
    """A table bucketed and sorted by its keys: tables of the same buckets join on these keys without moving a
    row. As many buckets as the session's shuffles have partitions, if not said otherwise; one file for each."""
    spark = df.sparkSession
    n, name = buckets or int(spark.conf.get("spark.sql.shuffle.partitions")), f"bucketed_{uuid.uuid4().hex}"
    df.repartition(n, *keys).write.bucketBy(n, *keys).sortBy(*keys).option("path", path).format("parquet").saveAsTable(name)
    return spark.table(name)


#: Rows a bucket of a merged table holds at most; one task rewrites one bucket.
BUCKET_ROWS = 1 << 20


def _layouts(spark: SparkSession, path: str) -> list[int]:
    """The bucket counts of a merged table's complete layouts, ascending. A layout counts from its commit on."""
    if not path_exists(spark, path):
        return []
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(root)]
    found = sorted(int(n.removeprefix("buckets=")) for n in names if n.startswith("buckets="))
    return [n for n in found if path_exists(spark, f"{path}/buckets={n}/_SUCCESS")]


def _folder(path: str, buckets: int) -> str:
    return f"{path}/buckets={buckets}"


def _bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _power(rows: int, most: int) -> int:
    """The smallest power of two of buckets that leaves each at most so many rows on average."""
    return 1 << max(0, -(-rows // most) - 1).bit_length()


def merge_buckets(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    merge: Callable[[DataFrame | None, DataFrame], DataFrame],
    batch: int | None = None,
    bucket_rows: int = BUCKET_ROWS,
) -> None:
    """Merge a batch into a table laid out by a hash of its keys; only the buckets it touches are rewritten.

    ``merge(current, fresh)`` gets the rows of those buckets (None for a new table) and the batch. Touched
    partitions are replaced at the commit of one write, so readers see each bucket before or after it. With
    a ``batch`` number every rewritten bucket is stamped with it, and a bucket that has it already is left
    alone: a batch that failed half way can be run again. A table whose largest bucket has come to more than
    ``bucket_rows`` rows moves to twice as many buckets (or more), so tables of any size are rewritten in
    tasks of one size.
    """
    spark = df.sparkSession
    done = _layouts(spark, path)
    buckets = done[-1] if done else _power(df.count(), bucket_rows)
    fresh = df.withColumn("_bucket", _bucket_of(keys, buckets))
    touched = [r["_bucket"] for r in fresh.select("_bucket").distinct().collect()]  # at most ``buckets``
    current = None
    if done:
        current = spark.read.parquet(_folder(path, buckets)).filter(F.col("_bucket").isin(touched))
        if batch is not None:
            stamped = current.groupBy("_bucket").agg(F.max("_batch").alias("b")).filter(F.col("b") >= batch).collect()
            stamped = [r["_bucket"] for r in stamped]
            current, fresh = (x.filter(~F.col("_bucket").isin(stamped)) for x in (current, fresh))
        current = current.drop("_bucket", "_batch")
    merged = merge(current, fresh.drop("_bucket"))
    if batch is not None:
        merged = merged.withColumn("_batch", F.lit(batch))
    _write_layout(merged, path, keys, buckets, "dynamic" if done else "static")
    _grow(spark, path, keys, buckets, bucket_rows)


def _write_layout(rows: DataFrame, path: str, keys: Sequence[str], buckets: int, mode: str) -> None:
    """Replace the buckets that the rows belong to (dynamic) or write a whole layout (static), one task and one
    file for each bucket."""
    laid = rows.withColumn("_bucket", _bucket_of(keys, buckets)).repartition("_bucket")
    laid.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy("_bucket").parquet(_folder(path, buckets))


def _grow(spark: SparkSession, path: str, keys: Sequence[str], buckets: int, bucket_rows: int) -> None:
    """Move to more buckets until none holds over ``bucket_rows`` rows, for as long as splitting helps.

    The wider layout is written beside the present one and takes its place when its write commits, so a
    failure on the way changes nothing for readers. Over a table's life all moves together write about as
    many rows as its last size. The layout before stays for those who still read it.
    """
    while True:
        rows = spark.read.parquet(_folder(path, buckets))
        most = rows.groupBy("_bucket").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
        if most <= bucket_rows:
            return
        wider = 2 * buckets * _power(most, 2 * bucket_rows)
        now = rows.withColumn("_bucket", _bucket_of(keys, wider)).groupBy("_bucket").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
        if now == most:  # equal keys, which no layout parts
            return
        _write_layout(rows.drop("_bucket"), path, keys, wider, "static")  # replaces what an earlier move left unfinished
        for older in _layouts(spark, path)[:-2]:
            _drop_folder(spark, _folder(path, older))
        buckets = wider


def _drop_folder(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def read_merged(spark: SparkSession, path: str) -> DataFrame | None:
    """The rows of a table kept by ``merge_buckets``, or None before its first batch."""
    done = _layouts(spark, path)
    return spark.read.parquet(_folder(path, done[-1])).drop("_bucket", "_batch") if done else None


def incremental_save(df: DataFrame, path: str, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Append to a table and drop exact duplicates."""

    def merge(current: DataFrame | None, fresh: DataFrame) -> DataFrame:
        return (fresh if current is None else current.unionByName(fresh, allowMissingColumns=True)).dropDuplicates()

    merge_buckets(df, path, df.columns, merge, bucket_rows=bucket_rows)
    return read_merged(df.sparkSession, path)


def keyed_upsert(
    df: DataFrame, path: str, keys: Sequence[str], batch: int, order: Sequence[str] = (), bucket_rows: int = BUCKET_ROWS
) -> DataFrame:
    """Merge a batch into a table, the latest batch winning on the key."""

    def merge(current: DataFrame | None, fresh: DataFrame) -> DataFrame:
        rows = fresh if current is None else current.unionByName(fresh, allowMissingColumns=True)
        return keep_last(rows, keys, ["batch_no", *order])

    merge_buckets(df.withColumn("batch_no", F.lit(batch)), path, keys, merge, bucket_rows=bucket_rows)
    return read_merged(df.sparkSession, path)


def load_frame(df: DataFrame, path: str, if_exists: str = "append") -> int:
    """Append to or replace a stored table; returns how many rows the table gained or now holds."""
    spark = df.sparkSession
    append = if_exists == "append"
    before = spark.read.parquet(path).count() if append and path_exists(spark, path) else 0
    df.write.mode("append" if append else "overwrite").parquet(path)
    return spark.read.parquet(path).count() - before


def insert_absent(new: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Existing rows plus the new ones whose key is not there yet."""
    fresh = new.join(existing.select(*keys), list(keys), "left_anti")
    return existing.unionByName(fresh.select(*existing.columns))


def refresh_columns(
    existing: DataFrame, new: DataFrame, keys: Sequence[str], how: str = "full_outer"
) -> DataFrame:
    """Replace named columns of a table by joined values, keeping the old value where no new one is."""
    values = [c for c in new.columns if c not in keys]
    fresh = new.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in values])
    joined = existing.join(fresh, list(keys), how)
    kept = present(existing, values)
    merged = {c: F.coalesce(f"_new_{c}", c) if c in kept else F.col(f"_new_{c}") for c in values}
    return joined.withColumns(merged).drop(*[f"_new_{c}" for c in values])


def write_report(df: DataFrame, path: str) -> str:
    """Report rows as JSON lines."""
    return write_table(df, path, fmt="json")
