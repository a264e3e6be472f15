"""Line deduplication over levelled sorted runs of line hashes (operator 5).

A run is a table of line hashes, bucketed and sorted by hash. Documents come in batches of ascending doc_id:
each batch anti-joins the runs held so far, bucket by bucket, keeps what is new as a run of its own, and
level by level FANOUT runs are merged into one of the next level. Whatever a run holds was first seen in an
earlier batch, so its lines go from every later document.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retropanel.llm import ragged
from retropanel.llm.common import bounded_batches, fields, release, stored
from retropanel.session import scratch_path

BATCHES = 4
FANOUT = 3
SHORTEST = 10
#: Rows without a doc_id are numbered from here.
_NAMELESS = (1 << 63) - (1 << 56)


def lines(rows: ragged.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end) of every line, cut at each newline; an empty text is one empty line."""
    n = len(rows.offsets) - 1
    breaks = np.flatnonzero(rows.data == 10)
    row_of = np.searchsorted(rows.offsets, breaks, "right") - 1
    starts = np.concatenate([rows.offsets[:-1], breaks + 1])
    ends = np.concatenate([breaks, rows.offsets[1:]])
    row = np.concatenate([np.arange(n), row_of])
    order = np.lexsort((starts, row))
    row, starts = row[order], starts[order]
    row_ends = np.concatenate([row_of, np.arange(n)])
    return row, starts, ends[np.lexsort((ends, row_ends))]


def line_keys(rows: ragged.Texts, starts: np.ndarray, ends: np.ndarray, shortest: int = SHORTEST) -> list[bytes | None]:
    """The 128-bit hash of each line's key, None for a key below ``shortest`` code points.

    A key is the line without ASCII white space at its ends, A-Z in lower case.
    """
    low = ragged.lowered(rows.data)
    found = ragged.words(rows)
    a, b = np.searchsorted(found.starts, starts), np.searchsorted(found.starts, ends)
    some = b > a
    first = np.where(some, found.starts[np.minimum(a, max(len(found.starts) - 1, 0))] if len(found.starts) else 0, 0)
    last = np.where(some, found.ends[b - 1] if len(found.starts) else 0, 0)
    points = np.concatenate([[0], np.cumsum((rows.data & 0xC0) != 0x80)])
    long = some & (points[last] - points[first] >= shortest)
    raw = low.tobytes()
    return [xxhash.xxh3_128_digest(raw[s:e]) if k else None for s, e, k in zip(first.tolist(), last.tolist(), long.tolist())]


def keyed_lines(docs: DataFrame) -> DataFrame:
    """(doc, h): the distinct keys of every row of (doc, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            doc = batch.column(0).to_numpy(zero_copy_only=False)
            for at, chunk in ragged.chunks(ragged.texts(batch.column(1))):
                row, starts, ends = lines(chunk)
                own = {(r, k) for r, k in zip(row.tolist(), line_keys(chunk, starts, ends)) if k is not None}
                yield pa.RecordBatch.from_arrays([pa.array(doc[[at + r for r, _ in own]], pa.int64()) if own else pa.array([], pa.int64()), pa.array([k for _, k in own], pa.binary())], ["doc", "h"])

    return bounded_batches(docs).mapInArrow(run, "doc bigint, h binary")


class Runs:
    """The levels of runs in the shared folder. ``unseen`` anti-joins a batch, ``add`` keeps a run.

    Runs have as many buckets as the session's shuffles have partitions: a task writes one bucket, and an
    anti-join shuffles the batch only.
    """

    def __init__(self, spark: SparkSession, fanout: int = FANOUT, buckets: int | None = None) -> None:
        self.spark, self.fanout = spark, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []
        self.tables: list[str] = []

    def unseen(self, hashes: DataFrame) -> DataFrame:
        """Rows whose ``h`` no run holds: one merge anti-join for each run, largest level first."""
        for level in reversed(self.levels):
            for name in level:
                hashes = hashes.join(self.spark.table(name), "h", "left_anti")
        return hashes

    def add(self, hashes: DataFrame, level: int = 0) -> None:
        """Keep the distinct ``h`` as a run; a full level is compacted into one run of the next."""
        name = f"line_run_{uuid.uuid4().hex}"
        path = scratch_path(self.spark, "line-run")
        hashes.select("h").repartition(self.buckets, "h").write.bucketBy(self.buckets, "h").sortBy("h").option("path", path).saveAsTable(name)
        self.tables.append(name)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) >= self.fanout:
            full, self.levels[level] = self.levels[level], []
            merged = self.spark.table(full[0])
            for other in full[1:]:
                merged = merged.unionByName(self.spark.table(other))  # runs are disjoint
            self.add(merged, level + 1)

    def close(self) -> None:
        """Forget the tables' names; the files stay until the shared folder is cleaned."""
        for name in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.levels, self.tables = [], []


def absorb(runs: Runs, batch: DataFrame) -> DataFrame:
    """(doc, h) of the batch's lines to drop; the batch's new hashes become a run.

    A line stays where its key is new to the runs and the document is the smallest of the batch that has it.
    """
    first = batch.groupBy("h").agg(F.min("doc").alias("doc"))
    fresh = stored(runs.unseen(first), "fresh-lines")
    runs.add(fresh)
    # (h, doc) has no hot key: a line that fills the corpus is spread by its documents
    return stored(batch.join(fresh, ["h", "doc"], "left_anti").select("doc", "h"), "dropped-lines")


def drop_repeated_lines(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", batches: int = BATCHES) -> DataFrame:
    """All columns of ``docs``, ``text`` without its repeated lines, and ``n_lines`` (before) and ``n_dropped``.

    A key of at least 10 code points that several documents hold stays in the smallest doc_id only, with all
    its lines there. Null or empty text: one empty line, kept, and null becomes empty. Rows with one doc_id
    count as one document, so both keep a line it owns; each row with a null doc_id is a document of its own,
    after all others in stored order. An empty table gives an empty result; input columns named n_lines or n_dropped are replaced.
    """
    spark = docs.sparkSession
    docs = docs.drop("n_lines", "n_dropped")
    names, schema = docs.columns, docs.schema
    nameless = docs.filter(F.col(f"`{doc_id}`").isNull()).withColumn("__doc__", F.lit(_NAMELESS) + F.monotonically_increasing_id())
    docs = docs.filter(F.col(f"`{doc_id}`").isNotNull()).withColumn("__doc__", F.col(f"`{doc_id}`").cast("bigint")).unionByName(stored(nameless, "nameless"))
    keyed = stored(keyed_lines(docs.select(F.col("__doc__").alias("doc"), F.col(f"`{text}`").cast("string").alias("text"))), "lines")
    cuts = keyed.agg(F.percentile_approx("doc", [k / batches for k in range(1, batches)], 10_000)).first()[0] or []
    bounds = [None, *sorted(set(cuts)), None]
    runs, dropped = Runs(spark), None
    try:
        for low, high in zip(bounds, bounds[1:]):
            part = keyed if low is None else keyed.filter(F.col("doc") > low)
            part = part if high is None else part.filter(F.col("doc") <= high)
            gone = absorb(runs, part)
            dropped = gone if dropped is None else dropped.unionByName(gone)
    finally:
        runs.close()
    gone = dropped.groupBy("doc").agg(F.collect_list("h").alias("__gone__"))
    rows = docs.join(gone.withColumnRenamed("doc", "__doc__"), "__doc__", "left").select(*[f"`{c}`" for c in names], "__gone__")
    at_text = names.index(text)
    schema = T.StructType([T.StructField(text, T.StringType()) if f.name == text else f for f in schema.fields] + fields(n_lines="bigint", n_dropped="bigint").fields)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in parts:
            for at, chunk in ragged.chunks(ragged.texts(batch.column(at_text))):
                n = len(chunk.offsets) - 1
                own = batch.slice(at, n)
                gone = own.column(len(names)).to_pylist()
                row, starts, ends = lines(chunk)
                borders = np.searchsorted(row, np.arange(n + 1))
                kept, lost = [], []
                hit = np.isin(row, [i for i, g in enumerate(gone) if g])
                keys: list[bytes | None] = [None] * len(row)
                for k, key in zip(np.flatnonzero(hit).tolist(), line_keys(chunk, starts[hit], ends[hit])):
                    keys[k] = key
                raw = chunk.data.tobytes()
                for i in range(n):
                    a, b = int(borders[i]), int(borders[i + 1])
                    if not gone[i]:
                        kept.append(raw[starts[a] : ends[b - 1]])
                        lost.append(0)
                        continue
                    away = set(gone[i])
                    stay = [k for k in range(a, b) if keys[k] not in away]
                    kept.append(b"\n".join([raw[starts[k] : ends[k]] for k in stay]))
                    lost.append(b - a - len(stay))
                columns = [*own.columns[:-1], pa.array(np.diff(borders)), pa.array(lost, pa.int64())]
                columns[at_text] = pa.array([x.decode() for x in kept], pa.string())
                yield pa.RecordBatch.from_arrays(columns, [*names, "n_lines", "n_dropped"])

    return bounded_batches(rows).mapInArrow(run, schema)
