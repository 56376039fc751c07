"""The queries of this subpackage, over whole tables, and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftvault.llm import exact_dedup, filter_audit, language_id, line_dedup, packing, piece_bpe, prefix_bpe, quality_rules, sharding, simhash_dedup, toxicity, warc_revisits, whitening


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    return language_id.identify(documents(spark, sf_dir), held_out)


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup_exact(documents(spark, sf_dir))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(documents(spark, sf_dir))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.dedup_near(documents(spark, sf_dir))


def op5_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc_revisits.write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return warc_revisits.read_archives(manifest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = prefix_bpe.SharedVocabulary(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    digests = prefix_bpe.digest_column(F.col("text"), vocabulary, public_tokenizers.PATTERN)
    return documents(spark, sf_dir).select("doc_id", digests.alias("d")).select("doc_id", "d.n_tokens", "d.ids_sha256", "d.decoded_sha256")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(documents(spark, sf_dir))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.score_quality(documents(spark, sf_dir))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_filters(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op12_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = piece_bpe.SharedPieces(spark, public_tokenizers.path("piece_bpe_32k.model"))
    digests = documents(spark, sf_dir).select("doc_id", piece_bpe.digest_column(F.col("text"), pieces).alias("d"))
    return digests.select("doc_id", "d.n_tokens", "d.ids_sha256", "d.decoded_sha256")


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten_embeddings(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_sharding": op3_sharding,
    "op4_simhash_near_dedup": op4_simhash_near_dedup,
    "op5_warc_revisits": op5_warc_revisits,
    "op6_prefix_bpe": op6_prefix_bpe,
    "op7_line_dedup": op7_line_dedup,
    "op8_quality_rules": op8_quality_rules,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_toxicity": op10_toxicity,
    "op11_filter_audit": op11_filter_audit,
    "op12_piece_bpe": op12_piece_bpe,
    "op13_whitening": op13_whitening,
}

_STOP = ", ".join(f"'{w}'" for w in dict.fromkeys(quality_rules.STOP_WORDS))
_COVERED = ", ".join(f"'{x}'" for x in quality_rules.COVERED)
_RULES = " AND ".join(f"{r.metric} BETWEEN {r.low} AND '{r.high}'::DOUBLE" for r in quality_rules.RULES)

ORACLE_SQL = {
    "op2_exact_dedup": r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id) = 1 AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)""",
    "op5_warc_revisits": """
WITH p AS (SELECT page_id, coalesce(html, '') AS body, strlen(coalesce(html, '')) AS payload_bytes FROM pages),
w AS (SELECT *, sha1(body) AS payload_digest, max(page_id) OVER (PARTITION BY body) AS winner FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> winner THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> winner THEN winner END AS refers_to
FROM w""",
    "op7_line_dedup": r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rid, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
p AS (SELECT rid, doc_id, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS pos FROM d),
k AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line_key
  FROM p),
f AS (SELECT line_key, min(doc_id) AS first_doc FROM k WHERE length(line_key) >= 10 GROUP BY 1 HAVING count(DISTINCT doc_id) >= 2),
m AS (SELECT k.*, f.first_doc IS NOT NULL AND k.doc_id <> f.first_doc AS dropped FROM k LEFT JOIN f USING (line_key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM m GROUP BY rid, doc_id""",
    "op8_quality_rules": rf"""
WITH w AS (
  SELECT doc_id, lang, coalesce(text, '') AS body,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
g AS (
  SELECT *, row_number() OVER () AS rid FROM w),
windows AS (
  SELECT rid, i, array_to_string(words[i : i + 7], ' ') AS win
  FROM (SELECT rid, words, unnest(range(1, len(words) - 6)) AS i FROM g WHERE len(words) >= 8)),
twice AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, win) AS n FROM windows) WHERE n > 1),
covered AS (
  SELECT rid, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest(range(0, 8)) AS k) GROUP BY rid),
m AS (
  SELECT doc_id, lang, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
         length(regexp_replace(body, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
         len(lines) AS n_lines,
         len(list_filter(words, lambda x: length(x) > 1 AND regexp_matches(x, '^[^a-z]*[A-Z][^a-z]*$'))) AS n_upper,
         len(list_filter(words, lambda x: rtrim(lower(x), '.,;:!?') IN ({_STOP}))) AS n_stop
  FROM g LEFT JOIN covered USING (rid)),
s AS (
  SELECT *, CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0 END AS mean_word_chars,
         CASE WHEN n_words > 0 THEN n_symbols / n_words ELSE 0 END AS symbols_per_word,
         CASE WHEN lang NOT IN ({_COVERED}) THEN 1 WHEN n_words > 0 THEN n_stop / n_words ELSE 0 END AS stop_word_share,
         CASE WHEN n_words > 0 THEN n_upper / n_words ELSE 0 END AS upper_word_share,
         CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0 END AS dup_line_share,
         n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {_RULES} AS kept
FROM s""",
    "op11_filter_audit": r"""
WITH d AS (
  SELECT doc_id, coalesce(doc_id, -9223372036854775808) AS doc, coalesce(lang, '') AS part, coalesce(text, '') AS body,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY 1),
f AS (
  SELECT part, len(words) < 100 AS a, 100 * len(list_distinct(words)) < 80 * len(words) AS b,
         100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > 10 * length(body) AS c, regexp_matches(body, '[#$%&*|]') AS d,
         doc > min(doc) OVER (PARTITION BY body) AS e, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
  FROM d LEFT JOIN l USING (doc_id)),
cells AS (
  SELECT part, concat(CASE WHEN a THEN 'A' ELSE '' END, CASE WHEN b THEN 'B' ELSE '' END, CASE WHEN c THEN 'C' ELSE '' END,
                      CASE WHEN d THEN 'D' ELSE '' END, CASE WHEN e THEN 'E' ELSE '' END) AS failed,
         count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM f GROUP BY 1, 2),
x AS (SELECT * FROM (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) AS t(k)),
orders AS (
  SELECT concat(x1.k, x2.k, x3.k, x4.k, x5.k) AS filter_order FROM x x1, x x2, x x3, x x4, x x5
  WHERE x1.k NOT IN (x2.k, x3.k, x4.k, x5.k) AND x2.k NOT IN (x3.k, x4.k, x5.k) AND x3.k NOT IN (x4.k, x5.k) AND x4.k <> x5.k),
steps AS (
  SELECT filter_order, step::INT AS step, substr(filter_order, step::INT, 1) AS k, substr(filter_order, 1, (step - 1)::INT) AS before
  FROM (SELECT filter_order, unnest(range(1, 6)) AS step FROM orders)),
s AS (
  SELECT *, contains(failed, k) AS fails, translate(failed, before, '') <> failed AS earlier FROM cells, steps),
r AS (
  SELECT part, filter_order, step, k, coalesce(sum(n) FILTER (NOT fails AND NOT earlier), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (fails AND NOT earlier), 0)::BIGINT AS removed, coalesce(sum(n) FILTER (fails AND earlier), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (failed = k), 0)::BIGINT AS unique_fails, coalesce(sum(good) FILTER (fails AND NOT earlier), 0)::BIGINT AS good_lost,
         coalesce(sum(toxic) FILTER (fails AND NOT earlier), 0)::BIGINT AS toxic_lost
  FROM s GROUP BY 1, 2, 3, 4)
SELECT * EXCLUDE (k), (sum(removed) OVER (PARTITION BY part, k))::BIGINT AS shapley FROM r""",
}
