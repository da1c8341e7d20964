"""The registered query of each corpus operator, and its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from factloom.llm import conversations, decontaminate, extraction, language, language_model, mixing, neardup, quality, resampling, rules, shards, simhash, toxicity
from factloom.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": lambda spark, d: quality.quality_scores(table(spark, d, "documents"), table(spark, d, "labels")),
    "op2_mixing": lambda spark, d: mixing.mix(table(spark, d, "documents")).select("doc_id", "size", "source_size", "target", "taken"),
    "op3_near_duplicates": lambda spark, d: neardup.near_duplicates(table(spark, d, "documents")),
    "op4_toxicity": lambda spark, d: toxicity.toxicity_scores(table(spark, d, "documents"), table(spark, d, "labels")),
    "op5_language": lambda spark, d: language.language_predictions(table(spark, d, "documents")),
    "op6_language_model": lambda spark, d: language_model.text_scores(table(spark, d, "documents")),
    "op7_quality_rules": lambda spark, d: rules.rule_verdicts(table(spark, d, "documents")),
    "op8_sharding": lambda spark, d: shards.shard_membership(table(spark, d, "documents")),
    "op9_decontamination": lambda spark, d: decontaminate.leaks(table(spark, d, "documents"), table(spark, d, "benchmark")),
    "op10_main_text": lambda spark, d: extraction.main_texts(table(spark, d, "pages")),
    "op11_resampling": lambda spark, d: resampling.resample(table(spark, d, "documents"), table(spark, d, "benchmark")),
    "op12_simhash": lambda spark, d: simhash.near_duplicates(table(spark, d, "documents")),
    "op13_conversations": lambda spark, d: conversations.repair_digest(table(spark, d, "conversations")),
}

SQL: dict[str, str] = {
    "op2_mixing": mixing.SQL,
    "op11_resampling": resampling.SQL,
    "op13_conversations": conversations.SQL,
    # the synthetic pages mark their article; SQL takes it by that mark
    "op10_main_text": r"""
WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)(?:</article>|$)', 1) AS a FROM pages),
b AS (SELECT page_id, url, regexp_replace(regexp_replace(regexp_replace(a, '</?(?:p|h1)>', chr(10), 'g'), '<br>', ' ', 'g'), '<[^>]+>', '', 'g') AS b FROM a),
c AS (SELECT page_id, url, list_filter(list_transform(string_split(b, chr(10)), lambda x: trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(x, '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&quot;?', '"', 'g'), '&#x27;?', '''', 'g'), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))), lambda x: x <> '') AS c FROM b)
SELECT page_id, url, array_to_string(c, chr(10)) AS text, CAST(length(array_to_string(c, chr(10))) AS BIGINT) AS n_chars FROM c
""",
    # links on exact sets, then the closure over them
    "op3_near_duplicates": r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) END AS g FROM d),
c AS (SELECT doc_id, len(g) AS n, g FROM s),
reps AS (SELECT min(doc_id) AS rep, any_value(n) AS n, any_value(g) AS g, md5(array_to_string(list_sort(g), '|')) AS h FROM c WHERE n > 0 GROUP BY md5(array_to_string(list_sort(g), '|'))),
u AS (SELECT rep, n, unnest(g) AS x FROM reps),
l AS (SELECT a.rep AS p, b.rep AS q FROM u a JOIN u b ON a.x = b.x AND a.rep < b.rep AND 100 * least(a.n, b.n) >= 75 * greatest(a.n, b.n)
  GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
e AS (SELECT p, q FROM l UNION SELECT q, p FROM l),
r(v, m) AS (SELECT rep, rep FROM reps UNION SELECT e.q, r.m FROM r JOIN e ON e.p = r.v),
k AS (SELECT v, min(m) AS comp FROM r GROUP BY v)
SELECT c.doc_id, CAST(c.n AS BIGINT) AS n_shingles, coalesce(k.comp, c.doc_id) AS component_id, c.doc_id = coalesce(k.comp, c.doc_id) AS kept
FROM c LEFT JOIN reps ON c.n > 0 AND md5(array_to_string(list_sort(c.g), '|')) = reps.h LEFT JOIN k ON k.v = reps.rep
""",
}
