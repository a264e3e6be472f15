"""Best-fit-decreasing packing of token pieces into fixed-length sequences (operator 8).

Lengths are whole numbers up to the capacity, so the pieces of one length are interchangeable: the packing
is planned on the counts per length (at most ``capacity`` numbers, however many documents) and every piece
finds its place by its rank among the pieces of its length.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retropanel.llm import bpe, ragged
from retropanel.llm.common import bounded_batches, bytes_of, fields, release, stored


class CapacityTree:
    """A segment tree over remaining capacities: a leaf per capacity, a node knows if any bin below is open.

    A leaf holds intervals of bins (first number, how many) with that capacity left.
    """

    def __init__(self, capacity: int) -> None:
        self.size = 1 << (capacity + 1).bit_length()
        self.open = np.zeros(2 * self.size, np.int64)
        self.bins: list[deque[tuple[int, int]]] = [deque() for _ in range(capacity + 1)]

    def _count(self, leaf: int, more: int) -> None:
        node = leaf + self.size
        while node:
            self.open[node] += more
            node >>= 1

    def add(self, left: int, first: int, n: int) -> None:
        if n and left:
            self.bins[left].append((first, n))
            self._count(left, 1)

    def take(self, left: int) -> tuple[int, int]:
        self._count(left, -1)
        return self.bins[left].popleft()

    def tightest(self, need: int) -> int | None:
        """The smallest capacity of at least ``need`` that an open bin has left."""
        node = need + self.size
        if self.open[node]:
            return need
        while node > 1:
            if node % 2 == 0 and self.open[node + 1]:
                node += 1
                while node < self.size:
                    node = 2 * node if self.open[2 * node] else 2 * node + 1
                return node - self.size
            node >>= 1
        return None


def best_fit_plan(counts: dict[int, int], capacity: int) -> tuple[np.ndarray, int]:
    """Best fit, longest first, for so many pieces of each length.

    Rows (length, first rank, bin, offset, per bin): the piece of rank r goes to bin + (r - first) // per at
    offset + (r - first) % per * length. Pieces of one length fill the tightest bin up before the next, as
    best fit would place them one by one. The second result is the number of bins.
    """
    tree, plan, bins = CapacityTree(capacity), [], 0
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            room = tree.tightest(length)
            if room is None:
                per = capacity // length
                first, n, room = bins, -(-left // per), capacity
                bins += n
            else:
                first, n = tree.take(room)
                per = room // length
            placed = min(left, n * per)
            plan.append((length, rank, first, capacity - room, per))
            full, rest = divmod(placed, per)
            tree.add(room - per * length, first, full)
            if rest:
                tree.add(room - rest * length, first + full, 1)
            used = full + (rest > 0)
            if room < capacity:
                tree.add(room, first + used, n - used)
            rank, left = rank + placed, left - placed
    return np.array(plan, np.int64).reshape(-1, 5), bins


def cut(docs: DataFrame, vocabulary: str, capacity: int = 2048, end_id: int = 0, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Token pieces of every document: doc_id, piece, start, length and ``ids`` (little-endian unsigned 32-bit).

    A document's ids (by the tokenizers library) end with ``end_id``; one longer than the capacity is cut
    into full pieces behind a first piece that takes the rest. A null or empty text is the end id alone.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    made = fields(piece="int", start="bigint", length="bigint", ids="binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe.library_encoder(shared.value)
        for batch in batches:
            for at, chunk in ragged.chunks(ragged.texts(batch.column(1))):
                ids, bounds = encoder.ids(chunk)
                n = len(bounds) - 1
                ids = np.insert(ids, bounds[1:], end_id)
                sizes = np.diff(bounds) + 1
                pieces = -(-sizes // capacity)
                row = np.repeat(np.arange(n), pieces)
                piece = ragged.spread(np.zeros(n, np.int64), pieces)
                head = sizes - (pieces - 1) * capacity
                length = np.where(piece == 0, head[row], capacity)
                start = np.where(piece == 0, 0, head[row] + (piece - 1) * capacity)
                borders = np.concatenate([[0], np.cumsum(length)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, n).take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(bytes_of(ids, borders), pa.binary())],
                    ["doc_id", "piece", "start", "length", "ids"],
                )

    return bounded_batches(rows).mapInArrow(run, T.StructType([rows.schema["doc_id"], *made.fields]))


def _numbered(pieces: DataFrame, capacity: int) -> DataFrame:
    """Each piece's task and its number among the task's pieces of its length."""
    names = pieces.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        task, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            length = batch.column(names.index("length")).to_numpy(zero_copy_only=False)
            order = np.argsort(length, kind="stable")
            ascending = length[order]
            firsts = np.searchsorted(ascending, ascending)
            number = np.empty(len(length), np.int64)
            number[order] = seen[ascending] + np.arange(len(length)) - firsts
            seen += np.bincount(length, minlength=capacity + 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(length), task, np.int32)), pa.array(number)], [*names, "task__", "number__"])

    return pieces.mapInArrow(run, T.StructType([*pieces.schema.fields, *fields(task__="int", number__="bigint").fields]))


def pack(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """Pieces (any columns, with ``length`` from 1 to the capacity) with ``sequence_id`` and ``offset``.

    The numbered pieces are stored once, so that their numbers hold for every later reader. Only the counts
    per (task, length) are gathered, and only their sums (one per length) reach the driver; the plan that
    comes back has a bounded size. Ties of length go by task and place in the task; repeated rows are
    pieces of their own; no pieces give no sequences. Input columns named like the results are replaced.
    """
    pieces = pieces.drop("sequence_id", "offset")
    rows = stored(_numbered(pieces, capacity), "pieces")
    spark = rows.sparkSession
    by_task = rows.groupBy("task__", "length").agg(F.count("*").alias("n__"))
    before = Window.partitionBy("length").orderBy("task__").rowsBetween(Window.unboundedPreceding, -1)
    bases = by_task.select("task__", "length", F.coalesce(F.sum("n__").over(before), F.lit(0)).alias("base__"))
    counts = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n__").alias("n")).collect()}
    plan, _ = best_fit_plan(counts, capacity)
    shared = spark.sparkContext.broadcast(plan)
    names = pieces.columns
    ranked = rows.join(bases, ["task__", "length"]).select(*[f"`{c}`" for c in names], (F.col("base__") + F.col("number__")).alias("rank__"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        length_of, first, bin_of, offset_of, per = shared.value.T if len(shared.value) else np.zeros((5, 0), np.int64)
        keys = (capacity - length_of) * (1 << 44) + first  # ascending: the plan goes by falling length, rising rank
        for batch in batches:
            length = batch.column(names.index("length")).to_numpy(zero_copy_only=False)
            rank = batch.column(len(names)).to_numpy(zero_copy_only=False)
            if not len(rank):
                continue
            at = np.searchsorted(keys, (capacity - length) * (1 << 44) + rank, "right") - 1
            over = rank - first[at]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(bin_of[at] + over // per[at]), pa.array(offset_of[at] + over % per[at] * length)], [*names, "sequence_id", "offset"])

    return ranked.mapInArrow(place, T.StructType([*pieces.schema.fields, *fields(sequence_id="bigint", offset="bigint").fields]))
