"""Incremental twins of ingest and aggregation on Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from retropanel.operators.aggregates import merge_counts
from retropanel.operators.dedup import keep_last
from retropanel.sources.sinks import BUCKET_ROWS, merge_buckets


def file_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None) -> DataFrame:
    """New files of a folder; files already processed are remembered by the query's checkpoint."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def run_available(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None]) -> int:
    """Process what has arrived, then stop; returns the number of batches run."""
    done: list[int] = []

    def counted(batch: DataFrame, number: int) -> None:
        each(batch, number)
        done.append(number)

    query = (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(counted)
        .start()
    )
    query.awaitTermination()
    return len(done)


def upsert_latest(table: str, keys: Sequence[str], order: Sequence[str], bucket_rows: int = BUCKET_ROWS) -> Callable[[DataFrame, int], None]:
    """Batch writer keeping the last row per key; a batch rewrites the buckets of its keys only."""

    def merge(current: DataFrame | None, fresh: DataFrame) -> DataFrame:
        return keep_last(fresh if current is None else current.unionByName(fresh), keys, order)

    return lambda batch, number: merge_buckets(batch, table, keys, merge, number, bucket_rows)


def accumulate_counts(
    table: str,
    count: Callable[[DataFrame], DataFrame],
    keys: Sequence[str],
    merge: Callable[[list[DataFrame]], DataFrame] = merge_counts,
) -> Callable[[DataFrame, int], None]:
    """Batch writer keeping period counts (one row for ``keys``) current: counts of the batch added to the
    stored ones. A replayed batch adds nothing to buckets that have it."""

    def added(current: DataFrame | None, fresh: DataFrame) -> DataFrame:
        return merge([fresh] if current is None else [current, fresh])

    return lambda batch, number: merge_buckets(count(batch), table, keys, added, number)


def distinct_within(stream: DataFrame, keys: Sequence[str], ts: str, delay: str) -> DataFrame:
    """Each key's first row; the same key again, in any later batch, is dropped.

    A key is remembered until the watermark (the latest ``ts`` less ``delay``) has passed its first row by
    ``delay``, so the state holds the keys of about that much time however long the stream runs. Repeats must
    arrive within ``delay`` of each other; rows behind the watermark are dropped.
    """
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def closed_months(stream: DataFrame, ts: str, entity: str, measures: Sequence[str], delay: str | None = None) -> DataFrame:
    """(date_id, entity, n, one sum per measure) of every month once it is over, each month once.

    A group of state is a month's running sums for one entity. It is read and written by the batches that
    bring rows of that month only, and a timer at the month's end gives its row and frees it: nothing that was
    emitted is rewritten, and the state holds the open months. Late rows count as long as they are not behind
    the watermark of the batch before, later ones are dropped; a month that the batch's own watermark has passed
    is given at once with them. ``delay`` sets the watermark where the stream has none yet.
    Measures are whole numbers, null as 0; rows without ``ts`` or entity are left out.
    """
    stream = stream.withWatermark(ts, delay) if delay else stream
    month = (F.year(ts) * 100 + F.month(ts)).cast("int")
    end = F.unix_millis(F.add_months(F.trunc(F.col(ts).cast("date"), "month"), 1).cast("timestamp"))
    sums = [F.coalesce(F.col(m), F.lit(0)).cast("bigint").alias(m) for m in measures]
    rows = stream.filter(F.col(ts).isNotNull() & F.col(entity).isNotNull()).select(ts, month.alias("date_id"), F.col(entity).cast("string").alias(entity), end.alias("month_end"), *sums)
    totals = ", ".join(["n bigint", *(f"`{m}` bigint" for m in measures)])

    def closed(key: tuple, found: Sequence[int]) -> pd.DataFrame:
        return pd.DataFrame({"date_id": [key[0]], entity: [key[1]], **{k: [v] for k, v in zip(["n", *measures], found)}})

    def add(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            found = state.get
            state.remove()
            yield closed(key, found)
            return
        now, ends = list(state.get) if state.exists else [0] * (1 + len(measures)), None
        for batch in batches:
            now = [a + int(b) for a, b in zip(now, [len(batch), *(batch[m].sum() for m in measures)])]
            ends = int(batch["month_end"].iloc[0])
        if ends < state.getCurrentWatermarkMs():  # no timer can be set there; the next batch drops the month's rows
            if state.exists:
                state.remove()
            yield closed(key, now)
            return
        state.update(tuple(now))
        state.setTimeoutTimestamp(ends)

    schema = f"date_id int, `{entity}` string, {totals}"
    return rows.groupBy("date_id", entity).applyInPandasWithState(add, schema, totals, "append", GroupStateTimeout.EventTimeTimeout)


def append_available(rows: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Process what has arrived into a folder of parquet files, each row once whatever fails; the finished query."""
    query = rows.writeStream.outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).format("parquet").start(out)
    query.awaitTermination()
    return query


def daily_windows(events: DataFrame, ts: str, keys: Sequence[str], value: str, delay: str = "1 day") -> DataFrame:
    """Tumbling day windows per key; works on streams (append after the watermark) and on tables."""
    return (
        events.withWatermark(ts, delay)
        .groupBy(F.window(ts, "1 day").alias("w"), *keys)
        .agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))
        .select(F.col("w.start").cast("date").alias("day"), *keys, "n", "total")
    )


def unseen_entities(wanted: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Entities still to be collected."""
    return wanted.join(stored.select(*keys).distinct(), list(keys), "left_anti")


def refresh_if_new(stream: DataFrame, checkpoint: str, refresh: Callable[[], None]) -> bool:
    """Run a downstream refresh only where new input arrived."""
    seen = []

    def each(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            seen.append(number)

    run_available(stream, checkpoint, each)
    if seen:
        refresh()
    return bool(seen)
