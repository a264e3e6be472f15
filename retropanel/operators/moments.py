"""Moments of many columns and all their pairs from one scan, in parts that merge.

A task adds up its rows around centres of its own (the means of its first rows), so large offsets cost no
accuracy; parts are moved to a common centre when they merge. A part has one row for each column, so parts
merge column by column in many tasks, and nothing larger than columns x columns ever exists.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: For column i against every column j, over rows that have both: count, sums of x_i and x_j, of their squares, of x_i x_j.
SUMS = ("n", "own", "other", "own2", "other2", "cross")
#: Parts that one task merges at a time.
FAN_IN = 256
_ROWS = 8192


class Part:
    """Sums of one group of rows around ``centre`` (NaN where no value was seen)."""

    def __init__(self, width: int) -> None:
        self.centre = np.full(width, np.nan)
        self.n, self.s, self.q, self.x = np.zeros((4, width, width))

    def add(self, values: np.ndarray) -> None:
        """Add rows (NaN: no value)."""
        seen = ~np.isnan(values)
        counts = seen.sum(axis=0)
        fresh = np.isnan(self.centre) & (counts > 0)
        if fresh.any():  # nothing has been added in these columns yet
            self.centre[fresh] = np.where(seen, values, 0.0).sum(axis=0)[fresh] / counts[fresh]
        x, m = np.where(seen, values - np.nan_to_num(self.centre), 0.0), seen.astype(float)
        self.n += m.T @ m
        self.s += x.T @ m
        self.q += (x * x).T @ m
        self.x += x.T @ x

    def rows(self) -> list[np.ndarray]:
        """For each column the centres and the six sums, (7, columns)."""
        return [np.stack([self.centre, self.n[i], self.s[i], self.s[:, i], self.q[i], self.q[:, i], self.x[i]]) for i in range(len(self.centre))]


def merged(i: int, parts: Sequence[np.ndarray]) -> np.ndarray:
    """Column i's rows of several parts as one, around the mean of the parts' centres."""
    centres = np.stack([p[0] for p in parts])
    known = ~np.isnan(centres)
    centre = np.full(centres.shape[1], np.nan)
    some = known.any(axis=0)
    centre[some] = np.where(known, centres, 0.0).sum(axis=0)[some] / known.sum(axis=0)[some]
    total = np.zeros((6, centres.shape[1]))
    for p in parts:
        by = np.nan_to_num(p[0] - centre)
        n, s, t, q, u, x = p[1:]
        total += np.stack([n, s + by[i] * n, t + by * n, q + 2 * by[i] * s + by[i] ** 2 * n, u + 2 * by * t + by**2 * n, x + by[i] * t + by * s + by[i] * by * n])
    return np.vstack([centre, total])


def _merge(parts: DataFrame, keys: Sequence[str], step: Sequence[str]) -> DataFrame:
    """One part for each (keys, i, step)."""
    names = parts.columns

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        i = key[len(keys)].as_py()
        found = [np.frombuffer(b.as_buffer(), "<f8").reshape(7, -1) for b in table.column("sums")]
        raw = merged(i, found).astype("<f8").tobytes()
        return pa.table({n: pa.array([raw], pa.binary()) if n == "sums" else table.column(n).slice(0, 1) for n in names})

    return parts.groupBy(*keys, "i", *step).applyInArrow(run, parts.schema)


def pair_moments(df: DataFrame, values: Column, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, i, centre_i, centre, n, own, other, own2, other2, cross): for each component i of the array
    ``values`` its centre, all centres, and arrays over the components j of the sums in SUMS, around them.

    One scan. Components may be null or NaN: a sum covers the rows that have both components. Arrays have one
    length; groups are few (a task holds a part for each of its own).
    """
    rows = df.select(*keys, values.cast("array<double>").alias("values__"))
    key_fields = [rows.schema[k] for k in keys]
    schema = T.StructType([*key_fields, T.StructField("i", T.IntegerType()), T.StructField("task", T.IntegerType()), T.StructField("sums", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, parts, shown = TaskContext.get().partitionId() // FAN_IN, {}, {}
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                some = batch.slice(at, _ROWS)
                x = some.column(len(keys)).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(some.num_rows, -1)
                if keys:
                    codes = pa.StructArray.from_arrays(some.columns[: len(keys)], list(keys)).to_pylist()
                    labels = [tuple(c.values()) for c in codes]
                    own: dict[tuple, list[int]] = {}
                    for r, label in enumerate(labels):
                        own.setdefault(label, []).append(r)
                else:
                    own = {(): slice(None)}
                for label, r in own.items():
                    if label not in parts:
                        parts[label] = Part(x.shape[1])
                    parts[label].add(x[r])
        for label, part in parts.items():
            raw = [r.astype("<f8").tobytes() for r in part.rows()]
            columns = [pa.array([v] * len(raw)) for v in label]
            fixed = [pa.array(np.arange(len(raw), dtype=np.int32)), pa.array(np.full(len(raw), task, np.int32)), pa.array(raw, pa.binary())]
            yield pa.RecordBatch.from_arrays([*columns, *fixed], [*keys, "i", "task", "sums"]).cast(target)

    from pyspark.sql.pandas.types import to_arrow_schema

    target = to_arrow_schema(schema)
    parts = rows.mapInArrow(run, schema)
    whole = _merge(_merge(parts, keys, ["task"]).withColumn("task", F.lit(0)), keys, [])
    arrays = T.StructType([*key_fields, T.StructField("i", T.IntegerType()), T.StructField("centre_i", T.DoubleType()), *(T.StructField(n, T.ArrayType(T.DoubleType())) for n in ("centre", *SUMS))])

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("i")
            found = [np.frombuffer(b.as_buffer(), "<f8").reshape(7, -1) for b in batch.column("sums")]
            own = [float(f[0, i]) for f, i in zip(found, batch.column(at).to_pylist())]
            lists = [pa.array([f[k].tolist() for f in found], pa.list_(pa.float64())) for k in range(7)]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keys), batch.column(at), pa.array(own), *lists], arrays.fieldNames())

    return whole.mapInArrow(unpack, arrays)
