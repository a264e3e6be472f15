"""Language identification by interpolated Kneser-Ney character models (operator 2).

A model predicts each letter of a word, and the word's end, from up to four characters before it in the
word. Spark counts the n-grams of all training texts and derives the continuation counts, and every n-gram is
kept. Tables of at most CELLS numbers go to the tasks as sorted arrays of n-gram hashes; larger ones stay
tables and are joined to the distinct n-grams of the texts, with the same result. A text takes the language
with the lowest cross-entropy per character. The score's temperature and the limit of rejection are taken over
all training texts.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retropanel.llm import ragged
from retropanel.llm.common import bounded_batches, fields, release, stored, with_text_columns, worker_object
from retropanel.llm.letters import code_points, letters
from retropanel.operators.quantiles import exact_quantiles, quantile_name

ORDER = 5
#: N-grams times languages up to which models are arrays in every task.
CELLS = 1 << 22
SALTS = 16
#: The limit of rejection: MARGIN times this quantile of the training texts' cross-entropies.
MARGIN, RANK = 1.5, 0.999
TEMPERATURES = tuple(2.0**k for k in range(-6, 5))
#: A character takes some hundred bytes on the way.
CHUNK_BYTES = 1 << 19
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0xD6E8FEB86659FD93], np.uint64)


class Models(NamedTuple):
    """Of each order (1 to ORDER) the sorted hashes of n-grams with a column of discounted shares for each
    language, and the sorted hashes of contexts with a column of back-off weights for each language."""

    langs: list[str]
    grams: list[np.ndarray]
    shares: list[np.ndarray]
    contexts: list[np.ndarray]
    backoffs: list[np.ndarray]
    alphabet: int
    temperature: float
    worst: float


class TableModels(NamedTuple):
    """The same as tables: of each order (g, shares), the discounted shares of an n-gram in every language, and
    (context, backoffs); ``backoff`` has the weights of order 1, whose context is empty."""

    langs: list[str]
    shares: list[DataFrame]
    backoffs: list[DataFrame]
    backoff: list[float]
    alphabet: int
    temperature: float
    worst: float


def gram_hashes(columns: list[np.ndarray]) -> np.ndarray:
    """A hash for each n-gram, given as code points from the last one backwards."""
    out = np.full(len(columns[0]), len(columns), np.uint64) if columns else np.zeros(1, np.uint64)
    with np.errstate(over="ignore"):
        for k, c in enumerate(columns):
            out = out + c.astype(np.uint64) * _MULTIPLIERS[k] * np.uint64(2 * k + 1)
    return ragged.mix(out)


def events(rows: ragged.Texts) -> tuple[list[np.ndarray], np.ndarray]:
    """The characters to predict: arrays of the character itself and of the 1st to 4th one before it (a
    space before and behind a word), and the bounds of each row's events."""
    points, offsets = code_points(rows)
    alpha = letters(points)
    edge = np.ones(len(points) + 1, bool)
    edge[1:-1] = alpha[1:] != alpha[:-1]
    edge[offsets] = True
    at = np.flatnonzero(edge)
    inside = alpha[at[:-1]] if len(at) > 1 else np.zeros(0, bool)
    starts, ends = at[:-1][inside], at[1:][inside]
    length = ends - starts + 1
    place = ragged.spread(np.zeros(len(starts), np.int64), length)
    source = np.repeat(starts, length) + place
    wide = np.concatenate([points, np.full(1, 0x20, np.uint32)])
    last = np.repeat(ends, length) == source
    columns = [np.where(last, np.uint32(0x20), wide[source])]
    for k in range(1, ORDER):
        columns.append(np.where(place >= k, wide[np.maximum(source - k, 0)], np.uint32(0x20)))
    per_word = np.concatenate([[0], np.cumsum(length)])
    return columns, per_word[np.searchsorted(starts, offsets)]


def gram_counts(docs: DataFrame) -> DataFrame:
    """(lang, g, n): the highest-order n-grams of all rows of (text, lang), as strings. Every task sums its
    own before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            langs, found = np.array(batch.column(1).to_pylist(), object), {}
            for at, chunk in ragged.chunks(ragged.texts(batch.column(0)), CHUNK_BYTES):
                columns, bounds = events(chunk)
                own = langs[at : at + len(bounds) - 1]
                for lang in sorted(set(own)):
                    where = np.flatnonzero(own == lang)
                    pick = ragged.spread(bounds[where], (bounds[1:] - bounds[:-1])[where])
                    which, keys, first = ragged.distinct(gram_hashes([c[pick] for c in columns]))
                    points = np.stack([c[pick[first]] for c in reversed(columns)], 1)
                    found.setdefault(lang, []).append((keys, points, np.bincount(which, minlength=len(keys))))
            for lang, parts in found.items():
                keys, points, n = (np.concatenate(x) for x in zip(*parts))
                which, _, first = ragged.distinct(keys)
                text = points[first].astype("<u4").tobytes().decode("utf-32-le", "replace")
                counts = np.bincount(which, n, len(first)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(first), pa.string()), pa.array([text[i : i + ORDER] for i in range(0, len(text), ORDER)], pa.string()), pa.array(counts)],
                    ["lang", "g", "n"],
                )

    return bounded_batches(docs.select("text", "lang")).mapInArrow(run, "lang string, g string, n bigint").groupBy("lang", "g").agg(F.sum("n").alias("n"))


def tables(counts: DataFrame) -> tuple[list[DataFrame], list[dict], int]:
    """Of each order the n-grams (lang, g, n, context, total of the context) and each language's discount, and
    the number of n-grams of all orders.

    Lower orders count how many different characters come before (continuation counts). Every n-gram is kept.
    """
    kept, discounts, level, size = [], [], counts, 0
    for order in range(ORDER, 0, -1):
        level = stored(level.groupBy("lang", F.expr("substring(g, 2)").alias("g")).agg(F.count("*").alias("n")) if order < ORDER else level, f"grams-{order}")
        stats = level.groupBy("lang").agg(F.count("*").alias("all"), F.sum((F.col("n") == 1).cast("bigint")).alias("once"), F.sum((F.col("n") == 2).cast("bigint")).alias("twice")).collect()
        discounts.append({r["lang"]: r["once"] / (r["once"] + 2 * r["twice"]) if r["once"] else 0.5 for r in stats})
        context = F.expr(f"substring(g, 1, {order - 1})").alias("context")
        totals = level.groupBy("lang", context).agg(F.sum("n").alias("total"))
        kept.append(level.select("lang", "g", "n", context).join(totals, ["lang", "context"]).select("lang", "g", "n", "context", "total"))
        size += sum(r["all"] for r in stats)
    return kept[::-1], discounts[::-1], size


def as_tables(kept: list[DataFrame], discounts: list[dict]) -> TableModels:
    langs = sorted({x for d in discounts for x in d})

    def in_columns(rows: DataFrame, key: str, value: Column, empty: float, name: str) -> DataFrame:
        """One row for each key with the value of every language."""
        columns = [F.coalesce(F.max(F.when(F.col("lang") == x, value)), F.lit(empty)) for x in langs]
        return rows.groupBy(key).agg(F.array(*columns).alias(name))

    shares, backoffs = [], []
    for order, (rows, discount) in enumerate(zip(kept, discounts), 1):
        less = F.create_map(*[F.lit(x) for pair in discount.items() for x in pair])[F.col("lang")]
        rows = stored(rows.withColumn("share", F.greatest(F.col("n") - less, F.lit(0.0)) / F.col("total")), f"shares-{order}")
        given = rows.groupBy("lang", "context").agg(F.sum("share").alias("given"))
        shares.append(stored(in_columns(rows, "g", F.col("share"), 0.0, "shares"), f"model-{order}"))
        backoffs.append(stored(in_columns(given, "context", F.least(F.greatest(1 - F.col("given"), F.lit(1e-6)), F.lit(1.0)), 1.0, "backoffs"), f"backoffs-{order}"))
    first = backoffs[0].first()
    return TableModels(langs, shares, backoffs, first["backoffs"] if first else [], shares[0].count() + 1, 1.0, np.inf)


def _columns(strings: list[str], order: int) -> list[np.ndarray]:
    """Code points of equally long strings from the last one backwards."""
    points = np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), "<u4").reshape(-1, order) if strings else np.zeros((0, order), np.uint32)
    return [points[:, order - 1 - k] for k in range(order)]


def _sorted_rows(keys: np.ndarray, column: np.ndarray, values: np.ndarray, width: int, empty: float) -> tuple[np.ndarray, np.ndarray]:
    own, place = np.unique(keys, return_inverse=True)
    out = np.full((len(own), width), empty)
    out[place, column] = values
    return own, out


def assemble(kept: list, discounts: list) -> Models:
    langs = sorted({x for d in discounts for x in d})
    number = {x: i for i, x in enumerate(langs)}
    grams, shares, contexts, backoffs = [], [], [], []
    for order, (rows, discount) in enumerate(zip(kept, discounts), 1):
        column = np.array([number[x] for x in rows["lang"].to_pylist()], np.int64)
        n, total = rows["n"].to_numpy().astype(float), rows["total"].to_numpy().astype(float)
        less = np.array([discount[x] for x in langs])[column] if len(column) else np.zeros(0)
        share = np.maximum(n - less, 0) / total
        points = _columns(rows["g"].to_pylist(), order)
        keys, table = _sorted_rows(gram_hashes(points), column, share, len(langs), 0.0)
        grams.append(keys), shares.append(table)
        # what the n-grams kept of a context leave to the next lower order
        context = gram_hashes(points[1:]) if order > 1 else np.zeros(len(column), np.uint64)
        own, place = np.unique(context, return_inverse=True)
        given, seen = np.zeros((len(own), len(langs))), np.zeros((len(own), len(langs)), bool)
        np.add.at(given, (place, column), share)
        seen[place, column] = True
        contexts.append(own), backoffs.append(np.where(seen, np.clip(1 - given, 1e-6, 1), 1.0))
    letters_seen = len(grams[0]) + 1
    return Models(langs, grams, shares, contexts, backoffs, letters_seen, 1.0, np.inf)


def _find(keys: np.ndarray, table: np.ndarray, wanted: np.ndarray, empty: float) -> np.ndarray:
    if not len(keys):
        return np.full((len(wanted), table.shape[1]), empty)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where((keys[at] == wanted)[:, None], table[at], empty)


def log_shares(models: Models, columns: list[np.ndarray]) -> np.ndarray:
    """The log probability of each event in every language, interpolated from the lowest order up."""
    p = np.full((len(columns[0]), len(models.langs)), 1.0 / models.alphabet)
    for order in range(1, ORDER + 1):
        context = gram_hashes(columns[1:order]) if order > 1 else np.zeros(len(columns[0]), np.uint64)
        p = _find(models.grams[order - 1], models.shares[order - 1], gram_hashes(columns[:order]), 0.0) + _find(models.contexts[order - 1], models.backoffs[order - 1], context, 1.0) * p
    return np.log(p)


def row_grams(rows: DataFrame) -> DataFrame:
    """The distinct highest-order n-grams of every row's ``text``, the last column: (others, g, n)."""
    keys = rows.columns[:-1]
    schema = T.StructType([*rows.schema.fields[:-1], *fields(g="string", n="bigint").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            for at, chunk in ragged.chunks(ragged.texts(batch.column(len(keys))), CHUNK_BYTES):
                columns, bounds = events(chunk)
                row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
                key = gram_hashes(columns)
                with np.errstate(over="ignore"):
                    which, _, first = ragged.distinct(ragged.mix(key ^ ragged.mix(row.astype(np.uint64) + np.uint64(1))))
                text = np.stack([c[first] for c in reversed(columns)], 1).astype("<u4").tobytes().decode("utf-32-le", "replace")
                grams = pa.array([text[i : i + ORDER] for i in range(0, len(text), ORDER)], pa.string())
                own = [batch.column(i).take(pa.array(at + row[first])) for i in range(len(keys))]
                yield pa.RecordBatch.from_arrays([*own, grams, pa.array(np.bincount(which, minlength=len(first)))], schema.fieldNames())

    return bounded_batches(rows).mapInArrow(run, schema)


def table_entropies(rows: DataFrame, models: TableModels) -> DataFrame:
    """(num, others, h, n): the mean cross-entropy in every language and the number of events of each row of
    (num, others, text) that has any. Every distinct n-gram of the texts is worked out once, then joined back;
    each goes to SALTS parts of the rows, as texts share their common n-grams."""
    found = stored(row_grams(rows), "row-grams")
    each = found.select("g").distinct().withColumn("p", F.array(*[F.lit(1.0 / models.alphabet)] * len(models.langs)))
    for order in range(1, ORDER + 1):
        shares, suffix = models.shares[order - 1], F.expr(f"substring(g, {ORDER + 1 - order})")
        each = each.withColumn("suffix", suffix).join((F.broadcast(shares) if order == 1 else shares).withColumnRenamed("g", "suffix"), "suffix", "left")
        if order > 1:
            each = each.withColumn("context", F.expr(f"substring(g, {ORDER + 1 - order}, {order - 1})")).join(models.backoffs[order - 1], "context", "left").drop("context")
        else:
            each = each.withColumn("backoffs", F.array(*map(F.lit, models.backoff)))
        lower = F.when(F.col("backoffs").isNull(), F.col("p")).otherwise(F.zip_with("p", "backoffs", lambda p, b: p * b))
        each = each.withColumn("p", F.when(F.col("shares").isNull(), lower).otherwise(F.zip_with(lower, "shares", lambda p, x: p + x))).drop("suffix", "shares", "backoffs")
    logs = stored(each.select("g", F.transform("p", lambda x: F.log(x)).alias("logs")), "log-shares")
    logs = logs.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    met = found.withColumn("salt", F.pmod(F.xxhash64("num"), F.lit(SALTS)).cast("int")).join(logs, ["g", "salt"])
    sums = [-F.sum(F.col("n") * F.col("logs")[k]) / F.sum("n") for k in range(len(models.langs))]
    return met.groupBy(*rows.columns[:-1]).agg(F.array(*sums).alias("h"), F.sum("n").alias("n"))


class Identifier:
    """Cross-entropies of texts; an n-gram is looked up once while remembered."""

    def __init__(self, models: Models) -> None:
        self.models, self.memo = models, ragged.Memo(len(models.langs))

    def entropies(self, chunk: ragged.Texts) -> tuple[np.ndarray, np.ndarray]:
        """(mean cross-entropy of each row in each language, number of events of each row)."""
        columns, bounds = events(chunk)
        n = np.diff(bounds)
        out = np.zeros((len(n), len(self.models.langs)))
        if len(columns[0]) and self.models.langs:
            which, keys, first = ragged.distinct(gram_hashes(columns))
            values = self.memo.get(keys, lambda new: log_shares(self.models, [c[first[new]] for c in columns]))
            for k in range(out.shape[1]):
                out[:, k] = -ragged.row_sums(values[:, k][which], bounds)
        return out / np.maximum(n, 1)[:, None], n

    def decide(self, chunk: ragged.Texts) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(language, score, rejected) of each row."""
        h, n = self.entropies(chunk)
        if not self.models.langs:
            return ["und"] * len(n), np.zeros(len(n)), np.ones(len(n), bool)
        best = h.argmin(1)
        odds = np.exp(-(h - h.min(1, keepdims=True)) * np.sqrt(n)[:, None] / self.models.temperature)
        none = n == 0
        lang = ["und" if e else self.models.langs[b] for e, b in zip(none.tolist(), best.tolist())]
        return lang, np.where(none, 0.0, 1 / odds.sum(1)), none | (h.min(1) > self.models.worst)


def own_and_losses(h: np.ndarray, n: np.ndarray, own: pa.Array, langs: list[str]) -> pa.RecordBatch:
    """One row of what rows with cross-entropies ``h`` and the languages ``own`` give to the calibration: their
    own languages' cross-entropies, and their summed loss (cross-entropy of the score) at each temperature."""
    truth = pc.fill_null(pc.index_in(own, pa.array(langs, pa.string())), -1).to_numpy(zero_copy_only=False)
    use = (n > 0) & (truth >= 0)
    h, n, truth = h[use], n[use], truth[use]
    own_h = h[np.arange(len(h)), truth]
    losses = []
    for temperature in TEMPERATURES:
        z = -(h - own_h[:, None]) * np.sqrt(n)[:, None] / temperature
        top = z.max(1)
        losses.append(float((top + np.log(np.exp(z - top[:, None]).sum(1))).sum()))
    return pa.RecordBatch.from_arrays([pa.array([own_h.tolist()], pa.list_(pa.float64())), pa.array([losses], pa.list_(pa.float64()))], ["own", "losses"])


def calibrate(rows: DataFrame, models: Models | TableModels) -> Models | TableModels:
    """The models with the temperature of the lowest loss and the limit of rejection, over all ``rows`` (text,
    lang). One pass; what it gives, a number a row, is stored."""
    schema, spark = "own array<double>, losses array<double>", rows.sparkSession
    if isinstance(models, TableModels):
        langs = models.langs

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            release()
            for batch in batches:
                h = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(langs))
                yield own_and_losses(h, batch.column(2).to_numpy(), batch.column(0), langs)

        numbered = rows.select(F.monotonically_increasing_id().alias("num"), "lang", "text")
        found = stored(table_entropies(numbered, models).select("lang", "h", "n").mapInArrow(run, schema), "calibration")
    else:
        shared, key = spark.sparkContext.broadcast(tuple(models)), f"languages {uuid.uuid4().hex}"

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            identifier = worker_object(key, lambda: Identifier(Models(*shared.value)))
            for batch in batches:
                for at, chunk in ragged.chunks(ragged.texts(batch.column(1)), CHUNK_BYTES):
                    h, n = identifier.entropies(chunk)
                    yield own_and_losses(h, n, batch.column(0).slice(at, len(n)), identifier.models.langs)

        found = stored(bounded_batches(rows.select("lang", "text")).mapInArrow(run, schema), "calibration")
        shared.unpersist()
    count, *losses = found.agg(F.sum(F.size("own")), *[F.sum(F.col("losses")[k]) for k in range(len(TEMPERATURES))]).first()
    if not count:
        return models
    limit = exact_quantiles(found.select(F.explode("own").alias("own")), ["own"], [RANK]).first()[quantile_name(RANK)]
    return models._replace(temperature=TEMPERATURES[int(np.argmin(losses))], worst=MARGIN * limit)


def fit(training: DataFrame, text: str = "text", lang: str = "lang") -> Models | TableModels:
    """Models of the languages of ``training``, calibrated.

    Counts cover every training row, and all n-grams are kept. Models of over CELLS numbers are tables. All
    training rows, whole, set the score's temperature by cross-entropy and the rejection limit: MARGIN times the
    99.9th percentile of their own language's cross-entropy.
    """
    rows = training.select(F.col(f"`{text}`").cast("string").alias("text"), F.col(f"`{lang}`").alias("lang")).filter("lang IS NOT NULL AND text IS NOT NULL")
    kept, discounts, size = tables(gram_counts(rows))
    if size * max(map(len, discounts)) <= CELLS:
        models = assemble([x.select("lang", "g", "n", "total").toArrow() for x in kept], discounts)
    else:
        models = as_tables(kept, discounts)
    return calibrate(rows, models) if models.langs else models


def identify(docs: DataFrame, models: Models | TableModels, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Kept columns, ``lang_pred``, ``score`` and ``rejected``. One narrow pass over whole texts.

    A text that is null or has no letters is ``und`` with score 0 and rejected, as is every text if no
    language was learned; a text is also rejected if even its best language fits it worse than the limit.
    Ties go to the language that sorts first; repeated rows come out alike; an empty table gives an empty
    result; input columns with the names of results are replaced. Models that are tables are joined instead.
    """
    if isinstance(models, TableModels):
        return _identify_by_tables(docs, models, text, keep)
    shared, key = docs.sparkSession.sparkContext.broadcast(tuple(models)), f"languages {uuid.uuid4().hex}"

    def make():
        return worker_object(key, lambda: Identifier(Models(*shared.value))).decide

    return with_text_columns(docs, text, fields(lang_pred="string", score="double", rejected="boolean"), make, keep, CHUNK_BYTES, held=True)


def _identify_by_tables(docs: DataFrame, models: TableModels, text: str, keep: tuple[str, ...]) -> DataFrame:
    """``identify`` for models that are tables: rows get a stored number to meet their sums by."""
    keep = [c for c in keep if c not in ("lang_pred", "score", "rejected")]
    columns = [F.col(f"`{c}`").alias(f"__kept_{i}__") for i, c in enumerate(keep)]
    rows = stored(docs.select(F.monotonically_increasing_id().alias("num"), *columns, F.col(f"`{text}`").cast("string").alias("text")), "numbered")
    decided = rows.drop("text").join(table_entropies(rows.select("num", "text"), models), "num", "left").withColumn("least", F.array_min("h"))
    odds = F.aggregate("h", F.lit(0.0), lambda s, x: s + F.exp(-(x - F.col("least")) * F.sqrt("n") / models.temperature))
    best = F.element_at(F.array(*map(F.lit, models.langs)), F.array_position("h", F.col("least")).cast("int"))
    none = F.col("n").isNull()
    return decided.select(
        *[F.col(f"__kept_{i}__").alias(c) for i, c in enumerate(keep)],
        F.when(none, "und").otherwise(best).alias("lang_pred"),
        F.when(none, 0.0).otherwise(1 / odds).alias("score"),
        (none | F.coalesce(F.col("least") > models.worst, F.lit(False))).alias("rejected"),
    )
