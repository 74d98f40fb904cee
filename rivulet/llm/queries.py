"""Registered queries of this subpackage: each applies one operator, with its
production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from rivulet.llm import (bpe, chat_repair, decontaminate, hard_negatives, host_quality, html_wrappers, licenses, packing,
                         pii, simhash, substring_dedup, toxicity, whitening)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _ranks_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_superkmer_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.remove_repeats(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept"), 256).alias("kept_sha256"))


OP1_SQL = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
words AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS p FROM docs),
windows AS (
  SELECT doc_id, s, array_to_string(w[s + 1:s + 20], ' ') AS seq
  FROM (SELECT doc_id, w, unnest(range(len(w) - 19)) AS s FROM docs WHERE len(w) >= 20)),
repeats AS (
  SELECT doc_id, s FROM (
    SELECT doc_id, s, row_number() OVER (PARTITION BY seq ORDER BY doc_id, s) AS nth FROM windows) WHERE nth > 1),
marks AS (
  SELECT w.doc_id, w.p, w.word,
         max(r.s) OVER (PARTITION BY w.doc_id ORDER BY w.p ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS near
  FROM words w LEFT JOIN repeats r ON r.doc_id = w.doc_id AND r.s = w.p)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(m.gone, 0) AS n_removed, sha256(coalesce(m.kept, '')) AS kept_sha256
FROM docs d LEFT JOIN (
  SELECT doc_id, CAST(count(near) AS BIGINT) AS gone,
         string_agg(word, ' ' ORDER BY p) FILTER (WHERE near IS NULL) AS kept
  FROM marks GROUP BY doc_id) m USING (doc_id)
"""


def op2_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = host_quality.judge(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                      "kept", "host_docs", "host_failed", "host_short", "host_repeats", "host_symbols", "host_dup_lines")


OP2_SQL = r"""
WITH docs AS (
  SELECT doc_id, source, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
grams AS (
  SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM (
    SELECT doc_id, p, w[p] || ' ' || w[p + 1] || ' ' || w[p + 2] AS gram FROM (
      SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS p FROM docs WHERE len(w) >= 3))),
repeats AS (
  SELECT doc_id, count(DISTINCT q) AS n_repeat_words FROM (
    SELECT doc_id, unnest([p, p + 1, p + 2]) AS q FROM grams WHERE n > 1) GROUP BY doc_id),
lines AS (
  SELECT doc_id, count(*) - count(DISTINCT l) AS n_dup_lines, count(*) AS n_lines FROM (
    SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM docs)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id),
base AS (
  SELECT d.doc_id, d.source, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_lines, 0) AS n_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words,
         len(w) < 50 OR 100 * coalesce(n_repeat_words, 0) > 50 * len(w) AS base_failed
  FROM docs d LEFT JOIN lines USING (doc_id) LEFT JOIN repeats USING (doc_id)),
rules AS (
  SELECT *, n_words < 50 AS r_short, 100 * n_repeat_words > 50 * n_words AS r_repeats,
         100 * n_symbols > 10 * n_words AS r_symbols, 100 * n_dup_lines > 30 * n_lines AS r_dup_lines FROM base),
hosts AS (
  SELECT source, count(*) AS host_docs, CAST(count(*) FILTER (WHERE base_failed) AS BIGINT) AS host_failed,
         CAST(count(*) FILTER (WHERE r_short) AS BIGINT) AS host_short,
         CAST(count(*) FILTER (WHERE r_repeats) AS BIGINT) AS host_repeats,
         CAST(count(*) FILTER (WHERE r_symbols) AS BIGINT) AS host_symbols,
         CAST(count(*) FILTER (WHERE r_dup_lines) AS BIGINT) AS host_dup_lines
  FROM rules GROUP BY source),
by_rule AS (
  SELECT source, host_docs, unnest(['base', 'short', 'repeats', 'symbols', 'dup_lines']) AS rule,
         unnest([host_failed, host_short, host_repeats, host_symbols, host_dup_lines]) AS n FROM hosts),
moments AS (
  SELECT rule, avg(n / host_docs) AS m, var_pop(n / host_docs) AS v, avg(1 / host_docs) AS inv FROM by_rule GROUP BY rule),
priors AS (
  SELECT rule, m, CASE WHEN v - m * (1 - m) * inv <= 0 THEN 1000.0
                       ELSE least(1000.0, greatest(2.0, m * (1 - m) / (v - m * (1 - m) * inv) - 1)) END AS s FROM moments),
shrunk AS (
  SELECT source, rule, host_docs, m, s, (n + m * s) / (host_docs + s) AS q FROM by_rule JOIN priors USING (rule)),
verdicts AS (
  SELECT source, bool_or(CASE WHEN rule = 'base' THEN q > 0.5
    ELSE q - 2 * sqrt(q * (1 - q) / (host_docs + s + 1)) > greatest(0.3, m + 2 * sqrt(m * (1 - m) / (s + 1))) END) AS rejected
  FROM shrunk GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT rejected AS kept, host_docs, host_failed, host_short, host_repeats, host_symbols, host_dup_lines
FROM rules JOIN hosts ON rules.source IS NOT DISTINCT FROM hosts.source
JOIN verdicts ON rules.source IS NOT DISTINCT FROM verdicts.source
"""


def op3_noisy_or_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    out = toxicity.score(docs, model)
    where = F.array_join(F.transform("offending", lambda x: F.concat_ws(":", x["start"].cast("string"),
                                                                        x["end"].cast("string"))), ",")
    return out.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"), where.alias("offending"))


def op4_chat_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_repair.format_chats(_table(spark, sf_dir, "conversations"))


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.matches(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "item_id", F.col("start").cast("bigint").alias("start_word"), "similarity")


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe.encode(_table(spark, sf_dir, "documents"), _ranks_path(), decoded=True)
    return out.select("doc_id", (F.length("ids") / 4).cast("bigint").alias("n_tokens"),
                      F.sha2("ids", 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256"))


def op8_weak_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.find(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    n = lambda k: F.size(F.filter("__base", lambda x: x["k"] == k)).cast("bigint")
    return out.select("doc_id", *[n(k).alias(f"n_{kind}") for k, kind in enumerate(pii.KINDS)],
                      F.sha2(pii.written(F.col("__base")), 256).alias("base_sha256"),
                      pii.written(F.col("__spans")).alias("spans"))


def op9_html_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = html_wrappers.extract(_table(spark, sf_dir, "pages"))
    return out.withColumn("n_chars", F.char_length("text").cast("bigint"))


def op10_license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


def _tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def op11_nnls_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = packing.pack(_table(spark, sf_dir, "documents"), _tokenizer_path())
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op12_bond_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings").withColumn(
        "label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0)


OP12_SQL = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, c -> CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, c -> c IS NULL OR NOT isfinite(c))) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS other_id, a.label = r.label AS same,
         CAST(list_sum(list_transform(list_zip(a.x, r.x), p -> p[1] * p[2])) AS BIGINT) AS score
  FROM rows a, rows r WHERE a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score, positive_rank FROM (
    SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) AS positive_rank
    FROM scores WHERE same)
  WHERE positive_rank <= 5)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score,
       CAST(positive_rank AS INTEGER) AS positive_rank
FROM (
  SELECT p.*, s.other_id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) AS rank
  FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score)
WHERE rank <= 5
"""


def op13_multiplicity_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_superkmer_dedup": op1_superkmer_dedup,
    "op2_host_quality": op2_host_quality,
    "op3_noisy_or_toxicity": op3_noisy_or_toxicity,
    "op4_chat_repair": op4_chat_repair,
    "op5_simhash_near_dedup": op5_simhash_near_dedup,
    "op6_decontaminate": op6_decontaminate,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_weak_pii": op8_weak_pii,
    "op9_html_wrappers": op9_html_wrappers,
    "op10_license_rules": op10_license_rules,
    "op11_nnls_packing": op11_nnls_packing,
    "op12_bond_negatives": op12_bond_negatives,
    "op13_multiplicity_whitening": op13_multiplicity_whitening,
}
ORACLE_SQL: dict[str, str] = {
    "op1_superkmer_dedup": OP1_SQL,
    "op2_host_quality": OP2_SQL,
    "op10_license_rules": licenses.oracle_sql(),
    "op12_bond_negatives": OP12_SQL,
}
