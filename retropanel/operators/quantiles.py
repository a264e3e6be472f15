"""Exact order statistics and ranks without gathering a column in one task."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retropanel.operators.reshape import unpivot_values
from retropanel.session import materialize


#: Rows inside a bracket that are ordered at once.
FEW_ROWS = 1 << 16
#: Rows of a sorted range partition that are ranked at once.
CHUNK_ROWS = 1 << 17
#: Columns up to which whole-table brackets are aggregates side by side; more of them become rows.
WIDE_ROW = 16


def quantile_name(p: float) -> str:
    return f"q{round(p * 100):02d}"


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    accuracy: int = 10000,
) -> DataFrame:
    """Linearly interpolated quantiles of every column, per group if ``by`` is given.

    Rows: ``by`` + ``column``, ``n``, one ``qNN`` per probability; columns without values have none.
    A mergeable sketch first brackets each wanted rank. Values below and above a bracket are then only
    counted; values inside are counted per value. Whole-table brackets are narrowed by further sketch
    passes until few rows are left inside; group brackets are ranked over range partitions. So neither a
    column nor a group is sorted in one task, and the result is exact.
    """
    if by or len(columns) > WIDE_ROW:
        return _grouped_quantiles(df, columns, probs, list(by), accuracy)
    return _table_quantiles(df, columns, probs, accuracy)


def _marks(probs: Sequence[float], accuracy: int) -> list[float]:
    slack = 4.0 / accuracy
    return [m for p in probs for m in (max(p - slack, 0.0), min(p + slack, 1.0))]


@dataclass
class _Bracket:
    """Values that hold one wanted rank: ``below`` rows lie under ``lo``, ``inside`` from lo to hi."""

    column: str
    q: str
    pos: float
    n: int
    lo: float
    hi: float
    below: int = 0
    inside: int = 0
    under: float | None = None
    over: float | None = None


def _measure(wide: DataFrame, brackets: Sequence[_Bracket]) -> None:
    """Count around the brackets: one aggregate row."""
    row = wide.agg(
        *[
            e.alias(f"{name}{i}")
            for i, b in enumerate(brackets)
            for c in (F.col(b.column),)
            for name, e in (
                ("below", F.count_if(c < b.lo)),
                ("inside", F.count_if(c.between(b.lo, b.hi))),
                ("under", F.max(F.when(c < b.lo, c))),
                ("over", F.min(F.when(c > b.hi, c))),
            )
        ]
    ).first()
    for i, b in enumerate(brackets):
        b.below, b.inside, b.under, b.over = (row[f"{k}{i}"] for k in ("below", "inside", "under", "over"))


def _narrow(wide: DataFrame, brackets: Sequence[_Bracket], accuracy: int) -> None:
    """Sketch the values inside the brackets only: each pass leaves about a thousandth of the rows.

    A bracket that doesn't shrink holds one or two values that fill it, and few others.
    """
    wide_ones = [b for b in brackets if b.inside > FEW_ROWS and b.lo < b.hi]
    while wide_ones:
        row = wide.agg(
            *[
                F.percentile_approx(
                    F.when(F.col(b.column).between(b.lo, b.hi), F.col(b.column)),
                    _marks([min(max((b.pos - b.below) / max(b.inside - 1, 1), 0.0), 1.0)], accuracy),
                    accuracy,
                ).alias(f"b{i}")
                for i, b in enumerate(wide_ones)
            ]
        ).first()
        before = [(b.lo, b.hi) for b in wide_ones]
        for i, b in enumerate(wide_ones):
            b.lo, b.hi = row[f"b{i}"]
        _measure(wide, wide_ones)
        wide_ones = [b for b, old in zip(wide_ones, before) if b.inside > FEW_ROWS and b.lo < b.hi and (b.lo, b.hi) != old]


def _groups(items: Sequence, size: int = 64) -> list[Sequence]:
    """Aggregates of one stage stay few enough for generated code."""
    return [items[i : i + size] for i in range(0, len(items), size)]


def _table_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], accuracy: int
) -> DataFrame:
    """Whole-table quantiles; brackets and counts are one row each, kept on the driver."""
    wide = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    marks = _marks(probs, accuracy)
    brackets: list[_Bracket] = []
    for part in _groups(columns):
        sketch = wide.agg(
            *[F.count(c).alias(f"n{i}") for i, c in enumerate(part)],
            *[F.percentile_approx(c, marks, accuracy).alias(f"b{i}") for i, c in enumerate(part)],
        ).first()
        brackets += [
            _Bracket(c, quantile_name(p), float(p * (sketch[f"n{i}"] - 1)), sketch[f"n{i}"], *sketch[f"b{i}"][2 * k : 2 * k + 2])
            for i, c in enumerate(part)
            if sketch[f"n{i}"]
            for k, p in enumerate(probs)
        ]
    fields = [f"{quantile_name(p)} double" for p in probs]
    if not brackets:
        return df.sparkSession.createDataFrame([], ", ".join(["column string", "n bigint", *fields]))
    for part in _groups(brackets):
        _measure(wide, part)
        _narrow(wide, part, accuracy)
    hits = []
    for c in dict.fromkeys(b.column for b in brackets):
        near = F.lit(False)
        for b in brackets:
            if b.column == c:
                near = near | F.col(c).between(b.lo, b.hi)
        hits.append(F.when(near, F.struct(F.lit(c).alias("column"), F.col(c).alias("v"))))
    near_values = (
        wide.select(F.explode(F.array_compact(F.array(*hits))).alias("h"))
        .groupBy(F.col("h.column").alias("column"), F.col("h.v").alias("v"))
        .agg(F.count(F.lit(1)).alias("c"))
    )
    table = df.sparkSession.createDataFrame(
        [(i, b.column, b.q, b.pos, b.n, b.lo, b.hi, b.below, b.under, b.over) for i, b in enumerate(brackets)],
        "s int, column string, q string, pos double, n bigint, lo double, hi double, below bigint, under double, over double",
    )
    inside = near_values.join(F.broadcast(table), "column").filter(F.col("v").between(F.col("lo"), F.col("hi")))
    w = Window.partitionBy("s").orderBy("v")  # FEW_ROWS rows or hardly more of each bracket
    upto = F.col("below") + F.sum("c").over(w.rowsBetween(Window.unboundedPreceding, 0))
    placed = inside.withColumn("upto", upto).withColumn("start", F.col("upto") - F.col("c"))

    def at(k):
        return F.coalesce(
            F.max(F.when((F.col("start") <= k) & (k < F.col("upto")), F.col("v"))),
            F.max(F.when(k == F.col("below") - 1, F.col("under"))),
            F.max(F.when(k >= F.col("below"), F.col("over"))),
        )

    picked = placed.groupBy("column", "n", "q", "pos").agg(
        at(F.floor("pos")).alias("a"), at(F.ceil("pos")).alias("z")
    )
    return _spread(picked, ["column"], probs)


def _spread(picked: DataFrame, keys: list[str], probs: Sequence[float]) -> DataFrame:
    """Interpolate between the two order statistics and put the probabilities side by side."""
    share = F.col("pos") - F.floor("pos")
    value = F.col("a") + (F.col("z") - F.col("a")) * share
    return picked.groupBy(*keys, "n").agg(
        *[
            F.max(F.when(F.col("q") == quantile_name(p), value)).alias(quantile_name(p))
            for p in probs
        ]
    )


def _grouped_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: list[str], accuracy: int
) -> DataFrame:
    keys = [*by, "column"]
    long = unpivot_values(df, by, columns, "column", "value")
    sketch = long.groupBy(*keys).agg(
        F.count("value").alias("n"),
        F.percentile_approx("value", _marks(probs, accuracy), accuracy).alias("b"),
    )
    wanted = F.array(
        *[
            F.struct(
                F.lit(quantile_name(p)).alias("q"),
                (F.lit(float(p)) * (F.col("n") - 1)).alias("pos"),
                F.col("b")[2 * i].alias("lo"),
                F.col("b")[2 * i + 1].alias("hi"),
            )
            for i, p in enumerate(probs)
        ]
    )
    brackets = sketch.select(*keys, "n", wanted.alias("w"))
    if not by:
        brackets = F.broadcast(brackets)  # one row per column
    zone = F.when(F.col("value") < F.col("b.lo"), 0).when(F.col("value") > F.col("b.hi"), 2).otherwise(1)
    tally = (
        long.join(brackets, keys)
        .select(*keys, "n", "value", F.explode("w").alias("b"))
        .select(*keys, "n", "b.q", "b.pos", "value", zone.alias("zone"))
        .groupBy(*keys, "n", "q", "pos", "zone", F.when(F.col("zone") == 1, F.col("value")).alias("v"))
        .agg(F.count(F.lit(1)).alias("c"), F.min("value").alias("mn"), F.max("value").alias("mx"))
    )
    end = F.lit(float("inf"))
    placed = average_ranks(
        tally.withColumn("x", F.when(F.col("zone") == 0, -end).when(F.col("zone") == 2, end).otherwise(F.col("v"))),
        [*keys, "q"],
        "x",
        "c",
    ).withColumn("start", (F.col("rank") - (F.col("c") + 1) / 2.0).cast("bigint"))
    placed = placed.withColumn("upto", F.col("start") + F.col("c"))

    def at(k):
        hit = (F.col("start") <= k) & (k < F.col("upto"))
        value = (
            F.when(F.col("zone") == 1, F.col("mn"))
            .when((F.col("zone") == 0) & (k == F.col("upto") - 1), F.col("mx"))
            .when((F.col("zone") == 2) & (k == F.col("start")), F.col("mn"))
            .otherwise(F.raise_error(F.lit("rank outside its bracket")).cast("double"))
        )
        return F.max(F.when(hit, value))

    picked = placed.groupBy(*keys, "n", "q", "pos").agg(
        at(F.floor("pos")).alias("a"), at(F.ceil("pos")).alias("z")
    )
    return _spread(picked, keys, probs)


def average_ranks(counts: DataFrame, keys: Sequence[str], value: str, count: str) -> DataFrame:
    """Average rank of each distinct value inside its key, over any number of distinct values.

    ``counts`` holds one row per (key, value). Rows are range-partitioned by (key, value) and written
    once, which fixes the partition borders; each partition then adds the totals of the partitions
    before it. No window spans more than one partition of the range.
    """
    keys = list(keys)
    sorted_once = materialize(
        counts.repartitionByRange(*keys, value).withColumn("_part", F.spark_partition_id())
    )
    inside = Window.partitionBy(*keys, "_part").orderBy(value)
    totals = sorted_once.groupBy(*keys, "_part").agg(F.sum(count).alias("_t"))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *keys, "_part", F.coalesce(F.sum("_t").over(earlier), F.lit(0)).alias("_offset")
    )
    ranked = sorted_once.withColumn(
        "_upto", F.sum(count).over(inside.rowsBetween(Window.unboundedPreceding, 0))
    ).join(offsets, [*keys, "_part"])
    start = F.col("_offset") + F.col("_upto") - F.col(count)
    return ranked.withColumn("rank", start + (F.col(count) + 1) / 2.0).drop(
        "_part", "_upto", "_offset"
    )


def attach_ranks(rows: DataFrame, key: str | None, value: str, weight: str | Sequence[str], name: str | Sequence[str], centred: bool = False, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """The rows with ``name``, the average rank of ``value`` inside ``key``, a row counting ``weight`` times.

    Several weights give a rank each from one sort. ``centred`` ranks are less their key's mean rank. Rows are
    sorted in range partitions and read there in chunks, each of which finds what weighs before a row in it; the
    totals of earlier chunks come by (key, chunk). A value whose rows span chunks is the last one of each chunk
    but the last, so its weight is summed up from one number a chunk. No row is looked up by its value: a value
    that fills a third of the rows is spread over partitions like any other, by the tasks its rows come from.
    """
    keys = [key] if key else []
    weights, names = ([weight], [name]) if isinstance(weight, str) else (list(weight), list(name))
    spread = rows.withColumn("tie__", F.spark_partition_id()).repartitionByRange(*keys, value, "tie__")
    placed = spread.sortWithinPartitions(*keys, value).drop("tie__")
    at_key, at_value, *at_weights = (rows.columns.index(c) if c else None for c in (key, value, *weights))
    mids = [f"mid{i}__" for i in range(len(weights))]
    schema = T.StructType([*rows.schema.fields, *T.StructType.fromDDL(", ".join(["part__ bigint", *(f"{m} double" for m in mids)])).fields])

    def ranked(held: list[pa.RecordBatch], part: int) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held).combine_chunks()
        new_key = np.zeros(table.num_rows, bool)
        if at_key is not None:
            keys = table.column(at_key).combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
            new_key[1:] = keys[1:] != keys[:-1]
        v = table.column(at_value).to_numpy()
        new_run = new_key.copy()
        new_run[1:] |= (v[1:] != v[:-1]) & ((v[1:] == v[1:]) | (v[:-1] == v[:-1]))  # NaN equals NaN
        new_key[0] = new_run[0] = True
        starts, which = np.flatnonzero(new_run), np.cumsum(new_run) - 1
        of_key = np.flatnonzero(new_key[starts])[np.cumsum(new_key[starts]) - 1]  # the first run of a run's key
        columns = [*table.columns, pa.array(np.full(table.num_rows, part))]
        for at in at_weights:
            sums = np.add.reduceat(table.column(at).to_numpy().astype(float), starts)
            before = np.cumsum(sums) - sums
            columns.append(pa.array((before - before[of_key] + (sums + 1) / 2.0)[which]))
        yield from pa.Table.from_arrays(columns, schema.fieldNames()).to_batches(max_chunksize=10_000)

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, part = [], TaskContext.get().partitionId() << 32
        for batch in batches:
            for k in range(0, batch.num_rows, chunk_rows):
                held.append(batch.slice(k, chunk_rows))
                if sum(b.num_rows for b in held) >= chunk_rows:
                    yield from ranked(held, part)
                    held, part = [], part + 1
        if held:
            yield from ranked(held, part)

    placed = materialize(placed.mapInArrow(inside, schema))
    # ranks don't fall as values rise: a chunk's least and greatest belong to its first and last value
    cells = {"low__": F.min(value), "high__": F.max(value)}
    for i, w in enumerate(weights):
        cells |= {f"total{i}__": F.sum(w).cast("double"), f"first{i}__": F.min(mids[i]), f"last{i}__": F.max(mids[i])}
    parts = placed.groupBy(*keys, "part__").agg(*[c.alias(n) for n, c in cells.items()])
    by = Window.partitionBy(*keys).orderBy("part__").rowsBetween(Window.unboundedPreceding, -1)  # one row a chunk
    mean = (lambda i: (F.sum(f"total{i}__").over(Window.partitionBy(*keys)) + 1) / 2.0) if centred else lambda i: F.lit(0.0)
    parts = parts.withColumns({n: c for i in range(len(weights)) for n, c in ((f"offset{i}__", F.coalesce(F.sum(f"total{i}__").over(by), F.lit(0.0))), (f"mean{i}__", mean(i)))})
    # the runs at the borders, each with all its weight and where it begins
    first, last = [F.col("low__").alias("v__")], [F.col("high__").alias("v__")]
    for i in range(len(weights)):
        total, offset, own = F.col(f"total{i}__"), F.col(f"offset{i}__"), F.col(f"last{i}__")
        first += [(F.col(f"first{i}__") * 2 - 1).alias(f"w{i}__"), offset.alias(f"s{i}__")]
        last += [((total - own) * 2 + 1).alias(f"w{i}__"), (offset + own * 2 - total - 1).alias(f"s{i}__")]
    ends = F.when(F.col("low__") == F.col("high__"), F.array(F.struct(*first))).otherwise(F.array(F.struct(*first), F.struct(*last)))
    shifts = [f"{k}{i}__" for i in range(len(weights)) for k in ("offset", "mean")]
    edges = parts.select(*keys, "part__", *shifts, F.inline(ends))
    whole = Window.partitionBy(*keys, "v__")
    edges = edges.withColumns({f"r{i}__": F.min(f"s{i}__").over(whole) + (F.sum(f"w{i}__").over(whole) + 1) / 2.0 for i in range(len(weights))})
    end = F.struct("v__", *[f"r{i}__" for i in range(len(weights))])
    borders = edges.groupBy(*keys, "part__").agg(F.min(end).alias("low__"), F.max(end).alias("high__"), *[F.max(c).alias(c) for c in shifts])
    joined = placed.join(F.broadcast(borders), [*keys, "part__"])  # one row for ``chunk_rows`` rows

    def rank(i: int) -> Column:
        own = F.col(f"offset{i}__") + F.col(mids[i])
        return F.when(F.col(value) == F.col("low__.v__"), F.col(f"low__.r{i}__")).when(F.col(value) == F.col("high__.v__"), F.col(f"high__.r{i}__")).otherwise(own) - F.col(f"mean{i}__")

    return joined.select(*rows.columns, *[rank(i).alias(n) for i, n in enumerate(names)])
