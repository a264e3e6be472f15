"""Quality rules with host verdicts (operator 3)."""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retropanel.llm import ragged
from retropanel.llm.common import fields, stored, with_text_columns

SYMBOLS = b"#*$%&|<>"
WINDOW = 3
LEAST_WORDS = 50
REPEAT_PERCENT = 50
#: What counts against a host, on the base measures: failing the base rules; over a tenth as many symbols as
#: words; over one repeated line for 20 words; words of under 3 or over 15 code points on average.
RULES = {
    "base": "base_failed",
    "symbols": "10 * n_symbols > n_words",
    "lines": "20 * n_dup_lines > n_words",
    "words": "word_chars < 3 * n_words OR word_chars > 15 * n_words",
}
#: A host goes if the shrunk rate of any rule says that over half of its documents fail it.
HOST_LIMIT = 0.5
SALTS = 16


def repeat_words(found: ragged.Words, h: np.ndarray) -> np.ndarray:
    """Words of each row that lie in a 3-word window found twice or more in the row, first ones included."""
    n = np.diff(found.bounds)
    windows = np.maximum(n - WINDOW + 1, 0)
    at = ragged.spread(found.bounds[:-1], windows)
    row = np.repeat(np.arange(len(n)), windows)
    with np.errstate(over="ignore"):
        key = row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for k in range(WINDOW):
            key = ragged.mix(key ^ h[at + k])
    which, own, _ = ragged.distinct(key)
    twice = np.bincount(which, minlength=len(own))[which] > 1
    inside = np.zeros(len(h), bool)
    for k in range(WINDOW):
        inside[at[twice] + k] = True
    return ragged.row_sums(inside.astype(np.int64), found.bounds)


def dup_lines(rows: ragged.Texts, found: ragged.Words) -> np.ndarray:
    """Lines with a word that equal an earlier line of their row."""
    n = len(rows.offsets) - 1
    out = np.zeros(n, np.int64)
    breaks = ragged.row_sums((rows.data == 10).astype(np.int64), rows.offsets)
    for i in np.flatnonzero(breaks).tolist():
        lines = rows.row(i).split(b"\n")
        if len(set(lines)) < len(lines):
            seen: set[bytes] = set()
            for line in lines:
                if line in seen and line.strip(b" \t\n\x0b\x0c\r"):
                    out[i] += 1
                seen.add(line)
    return out


def base_measures(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id", "source")) -> DataFrame:
    """Kept columns, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed. One narrow pass."""
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True

    def columns(chunk: ragged.Texts):
        found = ragged.words(chunk)
        n = np.diff(found.bounds)
        points = np.concatenate([[0], np.cumsum((chunk.data & 0xC0) != 0x80)])
        chars = ragged.row_sums(points[found.ends] - points[found.starts], found.bounds)
        symbols = ragged.row_sums(symbol[chunk.data].astype(np.int64), chunk.offsets)
        repeated = repeat_words(found, ragged.hashes(chunk.data, found.starts, found.ends))
        return [n, chars, symbols, dup_lines(chunk, found), repeated, (n < LEAST_WORDS) | (100 * repeated > REPEAT_PERCENT * n)]

    made = fields(n_words="bigint", word_chars="bigint", n_symbols="bigint", n_dup_lines="bigint", n_repeat_words="bigint", base_failed="boolean")
    return with_text_columns(docs, text, made, lambda: columns, keep)


def host_rates(measures: DataFrame, host: str = "source", rules: Mapping[str, str] = RULES) -> DataFrame:
    """(host, n, and for each rule ``rate_<rule>``): the share of a host's documents that fail the rule, shrunk
    by a beta prior fitted to all hosts' shares of that rule.

    A prior's mean m is the rule's overall rate; its weight w is m(1 - m) / v - 1 by the method of moments, v
    being the variance of the hosts' rates (weighted by rows) less what chance gives, (hosts - 1) m (1 - m)
    / rows; no spread left means the largest weight. The shrunk rate is (failed + m w) / (n + w).
    """
    failed = [F.sum(F.expr(f"cast({test} AS bigint)")).alias(f"failed_{r}") for r, test in rules.items()]
    hosts = measures.filter(F.col(host).isNotNull()).groupBy(F.col(host).alias("host")).agg(F.count("*").alias("n"), *failed)
    sums = [x for r in rules for x in (F.sum(f"failed_{r}").alias(f"failed_{r}"), F.sum(F.expr(f"failed_{r} * failed_{r} / n")).alias(f"squares_{r}"))]
    got = hosts.agg(F.sum("n").alias("n"), F.count("*").alias("hosts"), *sums).first()
    rates = []
    for r in rules:
        mean, weight = 0.0, 1.0
        if got["n"]:
            mean = got[f"failed_{r}"] / got["n"]
            unit = mean * (1 - mean)
            between = got[f"squares_{r}"] / got["n"] - mean * mean - (got["hosts"] - 1) * unit / got["n"]
            weight = min(max(unit / between - 1, 1.0), 1e6) if between > 0 else 1e6
        rates.append(((F.col(f"failed_{r}") + F.lit(mean * weight)) / (F.col("n") + F.lit(weight))).alias(f"rate_{r}"))
    return hosts.select("host", "n", *rates)


def quality_verdicts(docs: DataFrame, text: str = "text", host: str = "source", limit: float = HOST_LIMIT, keep: tuple[str, ...] = ("doc_id",), rules: Mapping[str, str] = RULES) -> DataFrame:
    """Kept columns, the base measures, base_failed, ``host_rate`` (the host's highest shrunk rate), ``host_rule``
    (the rule it belongs to) and ``kept``.

    A document is kept if it passes the base rules and none of its host's shrunk rates is over ``limit``: a
    host most of whose documents are short, repetitive, full of symbols or of repeated lines, or made of
    words of odd length, goes as a whole. The measures are stored once; hosts are partial aggregates.
    Verdicts meet their documents on (host, salt), so that a host with a third of the rows is dealt to many
    tasks. A null host has no verdict (null rate, base rules alone); a null or empty text has no words and
    fails; repeated rows count each; an empty table gives an empty result; input columns named like the
    results are replaced.
    """
    rows = stored(base_measures(docs, text, tuple(dict.fromkeys((*keep, host)))), "measures")
    worst = F.array_max(F.array(*[F.struct(F.col(f"rate_{r}").alias("rate"), F.lit(r).alias("rule")) for r in rules]))
    rates = host_rates(rows, host, rules).withColumn("worst", worst)
    rates = rates.select("host", F.col("worst.rate").alias("host_rate"), F.col("worst.rule").alias("host_rule"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salted = rows.drop("host_rate", "host_rule", "kept").withColumn("salt", F.pmod(F.xxhash64(*[f"`{c}`" for c in rows.columns]), F.lit(SALTS)).cast("int"))
    joined = salted.join(rates, (salted[host] == rates["host"]) & (salted["salt"] == rates["salt"]), "left").drop(rates["salt"], rates["host"]).drop("salt")
    names = [c for c in dict.fromkeys((*keep, *joined.columns)) if c != host or host in keep]
    return joined.select(*[f"`{c}`" for c in names]).withColumn("kept", ~F.col("base_failed") & (F.coalesce("host_rate", F.lit(0.0)) <= limit))
