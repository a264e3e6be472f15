"""What the operators share: reading tables, per-batch columns, stored stages."""

from __future__ import annotations

import gc
import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retropanel.llm import ragged
from retropanel.session import scratch_path

Columns = Callable[[ragged.Texts], Sequence]
_TEXT = "__text__"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(path: str) -> str:
    """A tokenizer file's text, read by the driver and sent to the tasks (a few MB, fixed by the file)."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write once to the shared folder and read back: later plans start from files no executor owns."""
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


BATCH_BYTES = 8 << 20


def bounded_batches(df: DataFrame) -> DataFrame:
    """The same rows; from now on the session hands them to tasks in Arrow batches of about 8 MB at most,
    however long the texts are. A smaller setting stays."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if not 0 < int(re.match(r"\d*", conf.get(name))[0] or 0) <= BATCH_BYTES:
        conf.set(name, str(BATCH_BYTES))
    return df


_HELD: list[tuple[str, object]] = []


def release() -> None:
    """Give back what this Python worker keeps; tasks that keep nothing call it before they start."""
    if _HELD:
        _HELD.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()


def worker_object(key: str, make: Callable[[], object]) -> object:
    """What a Python worker keeps from task to task: one object, the last one's memory is given back first."""
    if not _HELD or _HELD[0][0] != key:
        release()
        _HELD.append((key, make()))
    return _HELD[0][1]


def arrow_type(kind: T.DataType) -> pa.DataType:
    plain = {T.LongType(): pa.int64(), T.IntegerType(): pa.int32(), T.BooleanType(): pa.bool_(), T.DoubleType(): pa.float64(), T.StringType(): pa.string(), T.BinaryType(): pa.binary()}
    return plain[kind]


def fields(**kinds: str) -> T.StructType:
    return T.StructType.fromDDL(", ".join(f"`{k}` {v}" for k, v in kinds.items()))


def with_text_columns(docs: DataFrame, text: str, new: T.StructType, make: Callable[[], Columns], keep: Sequence[str], chunk_bytes: int = ragged.CHUNK_BYTES, held: bool = False) -> DataFrame:
    """Columns computed from the texts beside the kept input columns, chunk by chunk in Arrow batches.

    ``make()`` runs once in each task and gives a function from a chunk to one array per new field; it is
    ``held`` if it works with a worker's object. A kept column that has the name of a new one gives way to it.
    """
    keep = [c for c in keep if c not in new.fieldNames()]
    # a kept text column travels once
    kept_text = text in keep and docs.schema[text].dataType == T.StringType()
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], *([] if kept_text else [F.col(f"`{text}`").cast("string").alias(_TEXT)]))
    at_text = keep.index(text) if kept_text else len(keep)
    kinds = [arrow_type(f.dataType) for f in new.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not held:
            release()
        columns = make()
        for batch in batches:
            for at, chunk in ragged.chunks(ragged.texts(batch.column(at_text)), chunk_bytes):
                n = len(chunk.offsets) - 1
                made = [pa.array(c, k) for c, k in zip(columns(chunk), kinds)]
                yield pa.RecordBatch.from_arrays([batch.column(i).slice(at, n) for i in range(len(keep))] + made, [*keep, *new.fieldNames()])

    return bounded_batches(rows).mapInArrow(run, T.StructType([*rows.schema.fields[: len(keep)], *new.fields]))


def bytes_of(ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """Each row's ids as little-endian unsigned 32-bit integers."""
    raw = ids.astype("<u4").tobytes()
    at = (bounds * 4).tolist()
    return [raw[a:b] for a, b in zip(at, at[1:])]
