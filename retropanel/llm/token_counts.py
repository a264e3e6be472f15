"""Token counts by rank-synchronous array merging (operator 10)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from retropanel.llm import bpe, ragged
from retropanel.llm.common import fields, with_text_columns


def token_counts(docs: DataFrame, vocabulary: str, text: str = "text", limit: int = 512, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Kept columns with ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens) per row.

    The unseen pre-tokens of a chunk lie in one ragged array; each round merges every sequence's own
    lowest-ranked pair, and the symbols left are counted. ``vocabulary`` is the text of a byte-level
    tokenizer file; special strings inside texts count as one token, as the library has it. One narrow
    pass, no shuffle. A null or empty text has 0 bytes and 0 tokens; repeated rows are counted each;
    an empty table gives an empty result; input columns of the same names give way to the new ones.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(vocabulary)

    def make():
        encoder = bpe.merging_encoder(shared.value)

        def columns(chunk: ragged.Texts):
            n = encoder.counts(chunk)
            return [np.diff(chunk.offsets), n, n > limit]

        return columns

    return with_text_columns(docs, text, fields(n_bytes="bigint", n_tokens="bigint", over_limit="boolean"), make, keep, held=True)
