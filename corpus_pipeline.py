"""From raw documents to packed sequences: five stages, each stored before the next reads it.

A stage hands the operators the documents under column names of its own, so whatever else the documents
hold, under whatever name, comes out as it went in.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retropanel.llm import language_id, line_dedup, packing, simhash, toxicity
from retropanel.llm.common import stored, table, vocabulary
from retropanel.llm.queries import check_sum


def aside(docs: DataFrame) -> dict[str, str]:
    """A name that no operator uses for every column."""
    return {c: f"__own_{i}__" for i, c in enumerate(docs.columns)}


def put_aside(docs: DataFrame, names: dict[str, str]) -> DataFrame:
    return docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])


def given_back(rows: DataFrame, names: dict[str, str]) -> DataFrame:
    return rows.select(*[F.col(n).alias(c) for c, n in names.items()])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that operator 6 does not predict to be toxic. It learns from the labelled documents outside
    the fold its query holds out; a null text has no words and stays."""
    names = aside(docs)
    model = toxicity.fit(docs.select("doc_id", "text"), table(spark, sf_dir, "labels").filter(check_sum(5) != 0))
    rows = toxicity.toxicity_scores(put_aside(docs, names), model, names["text"], tuple(names.values()))
    return given_back(rows.filter("predicted = 0"), names)


def drop_foreign(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that operator 2 has learned from the others' ``lang``; those without letters
    (null included) or beyond the limit calibrated on all documents learned from go."""
    names = aside(docs)
    models = language_id.fit(docs.select("doc_id", "text", "lang").filter(check_sum(4) != 2))
    rows = language_id.identify(put_aside(docs, names), models, names["text"], tuple(names.values()))
    return given_back(rows.filter("NOT rejected"), names)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that a smaller doc_id holds (operator 5); ``n_chars`` follows the text."""
    names = aside(docs)
    rows = line_dedup.drop_repeated_lines(put_aside(docs, names), names["text"], names["doc_id"])
    out = given_back(rows, names)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in names else out


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that operator 7 links (three-word shingles, two bits): the smallest doc_id."""
    names = aside(docs)
    return given_back(simhash.one_of_each(put_aside(docs, names), names["text"], names["doc_id"]), names)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token pieces with their places in sequences of 2048 tokens (operator 8)."""
    pieces = packing.cut(docs.select("doc_id", "text"), vocabulary(public_tokenizers.path("byte_bpe_50k.json")))
    return packing.pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("language_id", drop_foreign),
    ("line_dedup", drop_lines),
    ("near_duplicates", drop_copies),
    ("packing", pack_sequences),
]

#: Trained models and iterated components are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
