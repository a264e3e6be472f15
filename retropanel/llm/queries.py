"""One registered query for each operator of the subpackage, over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retropanel.llm import exact_knn, filter_audit, host_rules, language_id, lexicon, line_dedup, merkle, packing, page_text, simhash, token_counts, token_files, toxicity
from retropanel.llm.common import table, vocabulary
from retropanel.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with the SQL for its rows where SQL can express it."""

    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def tokenizer(name: str) -> str:
    return vocabulary(public_tokenizers.path(name))


def check_sum(modulus: int) -> Column:
    """The CRC-32 of doc_id's decimal text, modulo; what the folds of operators 2 and 6 are defined by."""
    return F.crc32(F.col("doc_id").cast("string")) % modulus


TOP_K_SQL = """
WITH e AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x) OR abs(x) >= 262144)) = 0
), s AS (
  SELECT q.vec_id AS query_id, e.vec_id, CAST(list_inner_product(q.v, e.v) AS BIGINT) AS score
  FROM e AS q JOIN e ON q.vec_id <> e.vec_id AND len(q.v) = len(e.v) WHERE q.vec_id % 50 = 0
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM s)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM r WHERE r <= 5
"""


@query(TOP_K_SQL)
def op1_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_knn.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query()
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    models = language_id.fit(docs.filter(check_sum(4) != 2))
    rows = language_id.identify(docs.select("doc_id", "text"), models)
    return rows.select("doc_id", (check_sum(4) == 2).alias("held_out"), "lang_pred", "score", "rejected")


QUALITY_SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT doc_id, unnest(words) AS w, generate_subscripts(words, 1) AS i
  FROM (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM d)
), v AS (SELECT *, lead(w, 1) OVER t AS b, lead(w, 2) OVER t AS c FROM w WINDOW t AS (PARTITION BY doc_id ORDER BY i)),
f AS (SELECT *, c IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, w, b, c) > 1 AS twice FROM v),
g AS (SELECT *, twice OR lag(twice, 1, false) OVER t OR lag(twice, 2, false) OVER t AS inside FROM f WINDOW t AS (PARTITION BY doc_id ORDER BY i)),
n AS (SELECT doc_id, count(*) AS n_words, sum(length(w)) AS word_chars, count_if(inside) AS n_repeat_words FROM g GROUP BY doc_id),
l AS (
  SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id, line) AS k
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), u AS (SELECT doc_id, count_if(k > 1) AS n_dup_lines FROM l GROUP BY doc_id),
m AS (
  SELECT d.doc_id, source, CAST(coalesce(n_words, 0) AS BIGINT) AS n_words, CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN u ON d.doc_id = u.doc_id
), b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
r AS (
  SELECT source, 'base' AS rule, base_failed AS x FROM b UNION ALL SELECT source, 'symbols', 10 * n_symbols > n_words FROM b
  UNION ALL SELECT source, 'lines', 20 * n_dup_lines > n_words FROM b
  UNION ALL SELECT source, 'words', word_chars < 3 * n_words OR word_chars > 15 * n_words FROM b
), h AS (SELECT source, rule, count(*) AS n, count_if(x) AS x FROM r WHERE source IS NOT NULL GROUP BY source, rule),
a AS (SELECT rule, sum(x) / sum(n) AS mean, sum(CAST(x * x AS DOUBLE) / n) / sum(n) AS squares, (count(*) - 1) / sum(n) AS chance FROM h GROUP BY rule),
p AS (SELECT rule, mean, CASE WHEN squares - mean * mean - chance * mean * (1 - mean) > 0
  THEN least(greatest(mean * (1 - mean) / (squares - mean * mean - chance * mean * (1 - mean)) - 1, 1), 1e6) ELSE 1e6 END AS weight FROM a),
verdict AS (SELECT source, max((h.x + mean * weight) / (h.n + weight)) AS rate FROM h JOIN p ON h.rule = p.rule GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND coalesce(rate, 0) <= 0.5 AS kept
FROM b LEFT JOIN verdict AS v ON b.source = v.source
"""


@query(QUALITY_SQL)
def op3_host_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules.quality_verdicts(table(spark, sf_dir, "documents")).drop("host_rate", "host_rule")


@query()
def op4_simple8b_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), path)
    return token_files.read(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


LINES_SQL = """
WITH l AS (
  SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents)
), k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), o AS (SELECT *, length(key) >= 10 AND min(doc_id) OVER (PARTITION BY key) < doc_id AS gone FROM k)
SELECT doc_id, count(*) AS n_lines, count_if(gone)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM o GROUP BY doc_id
"""


@query(LINES_SQL)
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query()
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").filter(check_sum(5) != 0))
    rows = toxicity.toxicity_scores(docs.select("doc_id", "text"), model)
    return rows.select("doc_id", (check_sum(5) == 0).alias("held_out"), "score", "predicted")


@query()
def op7_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query()
def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.cut(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))
    return packing.pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


@query()
def op9_transducer_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexicon.encode_decode(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), digests=True)


@query()
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


AUDIT_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) < doc_id AS copied FROM d),
m AS (
  SELECT doc_id, part, {'A': len(words) < 50, 'B': 100 * len(list_distinct(words)) < 65 * len(words),
    'C': 100 * len(regexp_extract_all(text, '[A-Z]')) > 5 * length(text), 'D': regexp_matches(text, '[#$%&*|]'), 'E': coalesce(copied, false)} AS fails FROM w
), l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
f AS (
  SELECT part, CASE WHEN fails['A'] THEN 16 ELSE 0 END + CASE WHEN fails['B'] THEN 8 ELSE 0 END + CASE WHEN fails['C'] THEN 4 ELSE 0 END
    + CASE WHEN fails['D'] THEN 2 ELSE 0 END + CASE WHEN fails['E'] THEN 1 ELSE 0 END AS mask, count(*) AS n, count_if(good) AS good, count_if(toxic) AS toxic
  FROM m LEFT JOIN l ON m.doc_id = l.doc_id GROUP BY 1, 2
), x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([16, 8, 4, 2, 1]) AS bit),
o AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM x AS a JOIN x AS b ON b.f <> a.f JOIN x AS c ON c.f NOT IN (a.f, b.f) JOIN x AS d ON d.f NOT IN (a.f, b.f, c.f) JOIN x AS e ON e.f NOT IN (a.f, b.f, c.f, d.f)
), s AS (
  SELECT filter_order, CAST(step AS INTEGER) AS step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0) AS before
  FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
), r AS (
  SELECT part, filter_order, step, bit,
    CAST(sum(CASE WHEN mask & CAST(bit + before AS INTEGER) = 0 THEN n ELSE 0 END) AS BIGINT) AS kept,
    CAST(sum(CASE WHEN mask & bit > 0 AND mask & CAST(before AS INTEGER) = 0 THEN n ELSE 0 END) AS BIGINT) AS removed,
    CAST(sum(CASE WHEN mask & bit > 0 AND mask & CAST(before AS INTEGER) > 0 THEN n ELSE 0 END) AS BIGINT) AS redundant,
    CAST(sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
    CAST(sum(CASE WHEN mask & bit > 0 AND mask & CAST(before AS INTEGER) = 0 THEN good ELSE 0 END) AS BIGINT) AS good_lost,
    CAST(sum(CASE WHEN mask & bit > 0 AND mask & CAST(before AS INTEGER) = 0 THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost
  FROM f, s GROUP BY ALL
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley FROM r
"""


@query(AUDIT_SQL)
def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = filter_audit.failures(table(spark, sf_dir, "documents"))
    return filter_audit.audit(filter_audit.tensors(rows, table(spark, sf_dir, "labels")))


@query()
def op12_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return page_text.extract(pages, page_text.fit(pages))


#: DuckDB has no CRC-32; ``bits`` makes its table of byte remainders.
MERKLE_SQL = """
WITH RECURSIVE d AS (
  SELECT doc_id, lang, n_chars,
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS head,
    coalesce(strlen(text) || ':' || text, '-') AS tail
  FROM documents
), bits AS (
  SELECT i AS c, 0 AS k, i AS v FROM range(256) t(i)
  UNION ALL SELECT c, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM bits WHERE k < 8
), crc AS (
  SELECT doc_id, CAST(doc_id AS VARCHAR) AS s, 0 AS i, CAST(4294967295 AS BIGINT) AS v FROM (SELECT DISTINCT doc_id FROM d WHERE doc_id IS NOT NULL)
  UNION ALL SELECT doc_id, s, i + 1, xor(crc.v >> 8, b.v) FROM crc JOIN bits AS b ON b.k = 8 AND b.c = xor(crc.v & 255, ascii(s[i + 1])) WHERE i < length(s)
), tampered AS (SELECT doc_id FROM crc WHERE i = length(s) AND xor(v, 4294967295) % 7 = 0),
leaf AS (
  SELECT doc_id, lang, sha256(head || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || tail) AS h,
    sha256(head || coalesce(strlen(CAST(n_chars + CASE WHEN t THEN 1 ELSE 0 END AS VARCHAR)) || ':' || (n_chars + CASE WHEN t THEN 1 ELSE 0 END), '-') || tail) AS now
  FROM (SELECT *, doc_id IN (SELECT doc_id FROM tampered) AS t FROM d)
), placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, h) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM leaf),
tree AS (
  SELECT lang, 0 AS level, i, n, h FROM placed
  UNION ALL SELECT lang, level + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM tree WHERE n > 1 GROUP BY lang, level, i // 2, n
), sub AS (SELECT lang, level AS height, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM tree WHERE n = 1),
top AS (
  SELECT 0 AS level, i, n, h FROM sub
  UNION ALL SELECT level + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM top WHERE n > 1 GROUP BY level, i // 2, n
), walk AS (
  SELECT p.doc_id, p.h AS leaf, s.h AS subroot, p.lang, s.height, s.i AS j, p.i, 0 AS level, p.now AS f, '' AS proof FROM placed AS p JOIN sub AS s ON p.lang IS NOT DISTINCT FROM s.lang
  UNION ALL
  SELECT w.doc_id, w.leaf, w.subroot, w.lang, w.height, CASE WHEN level < height THEN j ELSE j // 2 END, CASE WHEN level < height THEN i // 2 ELSE 0 END, level + 1,
    sha256(CASE WHEN odd THEN coalesce(sibling, '') || f ELSE f || coalesce(sibling, '') END), proof || coalesce(sibling, '')
  FROM (
    SELECT w.*, CASE WHEN w.level < w.height THEN w.i % 2 = 1 ELSE w.j % 2 = 1 END AS odd, coalesce(t.h, u.h) AS sibling
    FROM walk AS w
    LEFT JOIN tree AS t ON w.level < w.height AND t.lang IS NOT DISTINCT FROM w.lang AND t.level = w.level AND t.i = xor(w.i, 1)
    LEFT JOIN top AS u ON w.level >= w.height AND u.level = w.level - w.height AND u.i = xor(w.j, 1)
  ) AS w WHERE level < height + (SELECT max(level) FROM top)
)
SELECT doc_id, leaf, subroot, (SELECT h FROM top WHERE n = 1) AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = (SELECT h FROM top WHERE n = 1) AS verified
FROM walk WHERE level = height + (SELECT max(level) FROM top)
"""


@query(MERKLE_SQL)
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    more = F.when(check_sum(7) == 0, F.col("n_chars").cast("decimal(20,0)") + 1).otherwise(F.col("n_chars"))
    return merkle.manifest(docs, changed={"n_chars": more}).withColumn("proof_sha256", merkle.proof_hash(F.col("path"))).drop("path")
