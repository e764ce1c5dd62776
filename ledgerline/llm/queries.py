"""The registered queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontam, langid, packing, quality, simhash, suffixdedup, tokencount, toxicity, urlfilter, warc
from .common import stash

#: Action, host and path of the url rules.
URL_RULES = [
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.matches(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, index = warc.write(_table(spark, sf_dir, "pages"))
    return warc.read(spark, folder, index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.predict(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predict(_table(spark, sf_dir, "documents"))


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixdedup.spans(_table(spark, sf_dir, "documents"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as tokenizers

    path, pattern = tokenizers.path("byte_bpe_50k.tiktoken"), tokenizers.PATTERN
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    first = tokencount.recount(tokencount.trees(docs, path, pattern).withColumn("edits", tokencount.edit_finder()("text")), path, pattern)
    kept = stash(first.withColumnsRenamed({c: f"{c}_first" for c in tokencount.COUNTS}), "token-trees")
    again = tokencount.recount(kept.withColumn("edits", tokencount.edit_finder(tokencount.tidyings)("text")), path, pattern)
    return again.select(
        "doc_id", F.col("n_tokens_first").alias("n_tokens"), F.col("n_edits_first").alias("n_edits"), F.col("n_tokens_after_first").alias("n_tokens_after"),
        F.col("n_edits").alias("n_edits_second"), F.col("n_tokens_after").alias("n_tokens_last"), (F.col("n_pretokens_encoded_first") + F.col("n_pretokens_encoded")).alias("n_pretokens_encoded"),
    )


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), word_tokenizer())


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(_table(spark, sf_dir, "pages"), URL_RULES)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_decontamination": op2_decontamination,
    "op3_warc": op3_warc,
    "op4_toxicity": op4_toxicity,
    "op5_language_id": op5_language_id,
    "op6_simhash_near_dedup": op6_simhash_near_dedup,
    "op7_suffix_array_dedup": op7_suffix_array_dedup,
    "op8_token_counts": op8_token_counts,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_url_filters": op10_url_filters,
}

#: The same counts, sketches, quantiles, fences and fallbacks.
_OP1 = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
lines AS (
  SELECT r, unnest(string_split(text, chr(10))) AS line FROM d),
dup AS (
  SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
win AS (
  SELECT r, i, array_to_string(ws[i : i + 7], ' ') AS w
  FROM (SELECT r, ws, unnest(generate_series(1, len(ws) - 7)) AS i FROM d WHERE len(ws) >= 8)),
hit AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, w) AS n FROM win) WHERE n > 1),
rep AS (
  SELECT r, count(DISTINCT i + k) AS n_repeat_words FROM hit, generate_series(0, 7) AS g(k) GROUP BY r),
c AS (
  SELECT d.r, doc_id, lang, source, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines
  FROM d LEFT JOIN dup USING (r) LEFT JOIN rep USING (r)),
m AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
         CASE WHEN n_words > 0 THEN word_chars * 1000 // n_words ELSE 0 END AS m1,
         CASE WHEN n_words > 0 THEN n_symbols * 1000 // n_words ELSE 0 END AS m2,
         CASE WHEN n_lines > 0 THEN n_dup_lines * 1000 // n_lines ELSE 0 END AS m3,
         CASE WHEN n_words > 0 THEN n_repeat_words * 1000 // n_words ELSE 0 END AS m4
  FROM c),
v AS (
  SELECT r, lang, source, unnest([1, 2, 3, 4]) AS metric, unnest([m1, m2, m3, m4]) AS v FROM m WHERE NOT base_failed),
b AS (
  SELECT r, lang, source, metric, (v >> greatest(length(bin(v)) - 6, 0)) << greatest(length(bin(v)) - 6, 0) AS b FROM v),
q2 AS (
  SELECT lang, source, metric, count(*) AS t, quantile_disc(b, [0.25, 0.75, 0.02, 0.98, 0.9, 0.01, 0.99]) AS q FROM b GROUP BY ALL),
q1 AS (
  SELECT lang, metric, count(*) AS t, quantile_disc(b, [0.25, 0.75, 0.02, 0.98, 0.9, 0.01, 0.99]) AS q FROM b GROUP BY ALL),
q0 AS (
  SELECT metric, quantile_disc(b, [0.25, 0.75, 0.02, 0.98, 0.9, 0.01, 0.99]) AS q FROM b GROUP BY ALL),
p AS (
  SELECT q2.lang, q2.source, q2.metric, CASE WHEN q2.t >= 50 THEN q2.q WHEN q1.t >= 50 THEN q1.q ELSE q0.q END AS q
  FROM q2 JOIN q1 ON q1.lang IS NOT DISTINCT FROM q2.lang AND q1.metric = q2.metric JOIN q0 ON q0.metric = q2.metric),
o AS (
  SELECT DISTINCT b.r FROM b JOIN p
    ON p.lang IS NOT DISTINCT FROM b.lang AND p.source IS NOT DISTINCT FROM b.source AND p.metric = b.metric
  WHERE b.b > greatest(q[2] + 3 * (q[2] - q[1]), CASE b.metric WHEN 1 THEN q[4] WHEN 2 THEN q[5] ELSE q[7] END)
     OR b.metric = 1 AND b.b < least(q[1] - 3 * (q[2] - q[1]), q[3]))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND o.r IS NULL AS kept
FROM m LEFT JOIN o USING (r)
"""

_OP10 = r"""
WITH u AS (
  SELECT page_id,
         CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) END AS rest
  FROM pages),
p AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM u),
r AS (
  SELECT *, CASE
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/7') THEN 'example.com/en/7'
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/de/8') THEN 'example.net/de/8'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/en/') THEN 'com/en/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/de/') THEN 'net/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/es/') THEN 'org/es/'
  END AS rule FROM p)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('com/en/', 'example.net/de/8', 'org/es/') THEN 'block' ELSE 'allow' END AS verdict
FROM r
"""

ORACLE_SQL: dict[str, str] = {"op1_quality_rules": _OP1, "op10_url_filters": _OP10}
