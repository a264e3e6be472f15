"""Token files in Simple-8b word-aligned coding (operator 4).

A folder of Parquet files is the container, so that Spark writes and commits it wherever the cluster stores
data. A row is a segment: whole documents in ascending doc_id order, ``shard`` and ``segment`` giving the
order of all rows, ``before`` the ids of earlier segments of its shard, ``nameless`` the number of documents
without a doc_id (they come first, and ``doc_ids`` has 0 for them), and two coded arrays, ``lengths``
(ids per document) and ``ids``. A coded array is little-endian:

    "S8B1", u32 values, u32 words, u32 escapes, u32 blocks, 0 (u32)
    u32 first word of each block of 4096 values   (padded to 8 bytes)
    u64 words: selector in the top 4 bits, then values from the lowest bits up
    u64 escaped values

Selector 0 stands for 240 zeros, 1 for an escaped value whose number fills the word; 2 to 15 pack 60 down to
1 values of equal width. Words don't cross blocks.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retropanel.llm import bpe, ragged
from retropanel.llm.common import bounded_batches, bytes_of

#: Fixed values of the published format: values a word holds, and bits of each, for selectors 2 to 15.
PACKS = ((60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60))
ZERO_RUN = 240
BLOCK = 4096
SEGMENT_IDS = 1 << 16
_HOLDS = np.array([ZERO_RUN, 1] + [n for n, _ in PACKS], np.int64)
_BITS = np.array([0, 0] + [b for _, b in PACKS], np.uint64)
_LIMITS = np.array([1 << b for _, b in PACKS], np.uint64)
#: The first of PACKS that each small value fits.
_WIDTHS = np.searchsorted(_LIMITS, np.arange(1 << 17, dtype=np.uint64), "right").astype(np.int8)


def _runs(fits: np.ndarray, holds: int) -> np.ndarray:
    """The places from which ``holds`` fitting values follow in the same block."""
    n = len(fits)
    edge = np.empty(n + 1, bool)
    edge[0] = edge[n] = True
    np.not_equal(fits[1:], fits[:-1], out=edge[1:n])
    edge[:n:BLOCK] = True
    at = np.flatnonzero(edge)
    own = fits[at[:-1]] & (at[1:] - at[:-1] >= holds)
    starts, ends = at[:-1][own], at[1:][own]
    return ragged.spread(starts, ends - starts - holds + 1)


def _selectors(values: np.ndarray) -> np.ndarray:
    """The selector of the word that would begin at each place: the densest that fits."""
    n = len(values)
    out = np.full(n, 1, np.int8)
    if not n:
        return out
    top = int(values.max())
    width = _WIDTHS[values] if top < len(_WIDTHS) else np.searchsorted(_LIMITS, values, "right").astype(np.int8)
    all_fit = [k for k, (_, bits) in enumerate(PACKS) if not top >> bits]
    for k in range(len(PACKS) - 1, -1, -1):
        holds = PACKS[k][0]
        if k in all_fit[1:]:  # a denser word fits everywhere but at the end of a block
            for end in [*range(BLOCK, n, BLOCK), n]:
                out[max(end - PACKS[all_fit[0]][0] + 1, end - BLOCK, 0) : max(end - holds + 1, 0)] = k + 2
        else:
            out[_runs(width <= k, holds)] = k + 2
    out[_runs(values == 0, ZERO_RUN)] = 0
    return out


def _word_starts(holds: np.ndarray) -> np.ndarray:
    """Where the words begin if a word at each place holds so many values: pointer jumps of 16 words are
    composed from single ones, walked, and filled in."""
    n = len(holds)
    one = np.append(np.minimum(np.arange(n) + holds, n), n)
    far = one
    for _ in range(4):
        far = far[far]
    jump, heads, at = memoryview(np.ascontiguousarray(far)), [], 0
    while at < n:
        heads.append(at)
        at = jump[at]
    steps = np.empty((len(heads), 16), np.int64)
    steps[:, 0] = heads
    for k in range(1, 16):
        steps[:, k] = one[steps[:, k - 1]]
    starts = steps.ravel()
    return starts[starts < n]


def encode(values: np.ndarray) -> bytes:
    values = np.ascontiguousarray(values, np.uint64)
    n = len(values)
    selector = _selectors(values)
    starts = _word_starts(_HOLDS[selector])
    chosen = selector[starts].astype(np.int64)
    words = chosen.astype(np.uint64) << np.uint64(60)
    for k in np.unique(chosen[chosen > 1]).tolist():
        own = np.flatnonzero(chosen == k)
        parts = values[starts[own][:, None] + np.arange(_HOLDS[k])]
        words[own] |= np.bitwise_or.reduce(parts << (np.arange(_HOLDS[k]).astype(np.uint64) * _BITS[k]), axis=1)
    away = np.flatnonzero(chosen == 1)
    words[away] |= np.arange(len(away)).astype(np.uint64)
    escaped = values[starts[away]] if n else values
    blocks = np.searchsorted(starts, np.arange(0, n, BLOCK)).astype("<u4")
    head = struct.pack("<4sIIIII", b"S8B1", n, len(words), len(escaped), len(blocks), 0) + blocks.tobytes()
    return head + b"\0" * (-len(head) % 8) + words.astype("<u8").tobytes() + escaped.astype("<u8").tobytes()


def _parts(raw: bytes) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    magic, n, words, escapes, blocks, _ = struct.unpack_from("<4sIIIII", raw)
    if magic != b"S8B1":
        raise ValueError("not a Simple-8b array")
    at = -(-(24 + 4 * blocks) // 8) * 8
    return n, np.frombuffer(raw, "<u4", blocks, 24), np.frombuffer(raw, "<u8", words, at), np.frombuffer(raw, "<u8", escapes, at + 8 * words)


def _values(words: np.ndarray, escaped: np.ndarray) -> np.ndarray:
    """All values of whole words at once."""
    selector = (words >> np.uint64(60)).astype(np.int64)
    holds = _HOLDS[selector]
    word = np.repeat(np.arange(len(words)), holds)
    slot = ragged.spread(np.zeros(len(words), np.int64), holds).astype(np.uint64)
    bits = _BITS[selector][word]
    out = (words[word] >> (slot * bits)) & ((np.uint64(1) << bits) - np.uint64(1))
    away = selector[word] == 1
    if away.any():
        out[away] = escaped[(words[word[away]] & np.uint64((1 << 60) - 1)).astype(np.int64)]
    return out


def decode(raw: bytes) -> np.ndarray:
    """All values of a coded array."""
    _, _, words, escaped = _parts(raw)
    return _values(words, escaped)


def decode_block(raw: bytes, block: int) -> np.ndarray:
    """The values of one block, by its offset, without touching the rest."""
    _, blocks, words, escaped = _parts(raw)
    return _values(words[int(blocks[block]) : int(blocks[block + 1]) if block + 1 < len(blocks) else None], escaped)


SEGMENTS = "shard int, segment int, before bigint, n_ids bigint, nameless bigint, doc_ids binary, lengths binary, ids binary"


def write(docs: DataFrame, vocabulary: str, path: str, end_id: int = 0, doc_id: str = "doc_id", text: str = "text") -> None:
    """Encode every text with the tokenizers library, add ``end_id`` to each and write the folder ``path``.

    The only shuffle deals the rows out by ranges of doc_id (ties: by a hash of the text); every task codes
    its sorted rows as they stream by. A null or empty text is the end id alone; rows with an equal doc_id
    stay separate documents beside each other; those without a doc_id come before all others; an empty table
    gives a folder without rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    rows = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    tie = F.xxhash64("text")
    ordered = rows.repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard, segment, before = bpe.library_encoder(shared.value), TaskContext.get().partitionId(), 0, 0
        keys, sizes, parts, held, nameless = [], [], [], 0, 0

        def flush() -> pa.RecordBatch:
            values = np.concatenate(parts)
            columns = [[shard], [segment], [before], [len(values)], [nameless], [np.concatenate(keys).astype("<i8").tobytes()], [encode(np.concatenate(sizes))], [encode(values)]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["shard", "segment", "before", "n_ids", "nameless", "doc_ids", "lengths", "ids"])

        for batch in batches:
            numbers = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False)
            for at, chunk in ragged.chunks(ragged.texts(batch.column(1)), 8 * SEGMENT_IDS):
                ids, bounds = encoder.ids(chunk)
                parts.append(np.insert(ids, bounds[1:], end_id))
                sizes.append(np.diff(bounds) + 1)
                keys.append(numbers[at : at + len(bounds) - 1])
                nameless += batch.column(0).slice(at, len(bounds) - 1).null_count
                held += len(parts[-1])
                if held >= SEGMENT_IDS:
                    yield flush()
                    segment, before = segment + 1, before + held
                    keys, sizes, parts, held, nameless = [], [], [], 0, 0
        if held:
            yield flush()

    bounded_batches(ordered).mapInArrow(run, SEGMENTS).write.option("compression", "zstd").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Documents of a folder: doc_id, start (ids of all documents before it), n_tokens and ``ids``
    (little-endian unsigned 32-bit, with the end id). Segments decode independently; only the totals per
    shard, one number for each writing task, pass through the driver."""
    segments = spark.read.schema(SEGMENTS).parquet(path)
    totals = segments.groupBy("shard").agg(F.sum("n_ids").alias("n")).collect()
    shards = sorted((r["shard"], r["n"]) for r in totals)
    bases = dict(zip((s for s, _ in shards), np.concatenate([[0], np.cumsum([n for _, n in shards])]).astype(int).tolist()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, before, nameless, keys, lengths, ids in zip(*(batch.column(c).to_pylist() for c in ("shard", "before", "nameless", "doc_ids", "lengths", "ids"))):
                bounds = np.concatenate([[0], np.cumsum(decode(lengths).astype(np.int64))])
                values = decode(ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.frombuffer(keys, "<i8"), mask=np.arange(len(bounds) - 1) < nameless), pa.array(bases[shard] + before + bounds[:-1]), pa.array(np.diff(bounds)), pa.array(bytes_of(values, bounds), pa.binary())],
                    ["doc_id", "start", "n_tokens", "ids"],
                )

    return bounded_batches(segments).mapInArrow(run, T.StructType.fromDDL("doc_id bigint, start bigint, n_tokens bigint, ids binary"))
