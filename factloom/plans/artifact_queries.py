"""Evidence from JSON, versions, overlapping intervals, sections and page families over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.operators import artifacts, overlap, sections
from factloom.plans.catalog import query, table


@query(
    "json_evidence",
    """
WITH c AS (SELECT conv_id, turn, role, text, conv_id % 3 AS shape FROM conversations WHERE conv_id % 10 <> 9 AND text <> '')
SELECT conv_id, 'ok' AS status, 'structured_repair_action' AS field, text FROM c WHERE shape = 0
UNION ALL SELECT conv_id, 'ok', 'diagnostic_note', role FROM c WHERE shape = 0
UNION ALL SELECT conv_id, 'ok', CASE turn WHEN 0 THEN 'special_notes_ocr' ELSE 'repairs_region_ocr' END, text FROM c WHERE shape = 1 AND turn < 2
UNION ALL SELECT conv_id, 'ok', CASE turn WHEN 0 THEN 'approved_customer_complaint' ELSE 'approved_repair_action' END, text FROM c WHERE shape = 2
UNION ALL SELECT DISTINCT conv_id, 'unreadable', NULL, NULL FROM conversations WHERE conv_id % 10 = 9
""",
)
def json_evidence(spark: SparkSession, d: str) -> DataFrame:
    """Each conversation as a JSON file of one of three shapes, a tenth of them cut off, and the evidence rows of all."""
    turns = table(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))
    text = lambda k: F.get(F.filter("t", lambda x: x["turn"] == k), F.lit(0))["text"]
    entries = F.to_json(F.struct(F.lit("ok").alias("status"), F.transform("t", lambda x: F.struct(F.struct(x["text"].alias("description"), x["role"].alias("notes")).alias("literal_fields"))).alias("entries")))
    region = lambda k: F.struct(text(k).alias("selected_text"))
    regions = F.to_json(F.struct(F.struct(region(0).alias("special_notes"), region(1).alias("repairs_replacements")).alias("regions")))
    approved = F.to_json(F.struct(F.struct(F.struct(text(0).alias("value")).alias("customer_complaint"), F.transform(F.filter("t", lambda x: x["turn"] > 0), lambda x: F.struct(x["text"].alias("value"))).alias("repair_actions")).alias("approved_fields")))
    shape = F.col("conv_id") % 3
    content = F.when(shape == 0, entries).when(shape == 1, regions).otherwise(approved)
    name = F.when(shape == 0, "repair_entries_v1_3_4_4.json").when(shape == 1, "Traveler_Regions.json").otherwise("approved_repair_fields.json")
    cut = F.when(F.col("conv_id") % 10 == 9, F.expr("left(c, length(c) - 2)")).otherwise(F.col("c"))
    files = turns.withColumn("c", content).select(F.concat(F.lit("out/"), "conv_id", F.lit("/"), name).alias("path"), cut.alias("content"))
    found = artifacts.json_evidence(files)
    return found.select(F.split_part("path", F.lit("/"), F.lit(2)).cast("long").alias("conv_id"), "status", "field", "text")


@query(
    "newest_complete",
    """
WITH v AS (SELECT *, p_size AS a, p_partkey % 12 AS b, p_retailprice > 1200 AND p_size < 40 AS complete FROM part),
r AS (SELECT *, row_number() OVER (PARTITION BY p_brand, p_type ORDER BY complete DESC, a DESC, b DESC, p_partkey DESC) AS n FROM v)
SELECT p_brand, p_type, p_partkey, 'v' || a || '.' || b AS version FROM r WHERE n = 1
""",
)
def newest_complete(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").withColumn("version", F.concat(F.lit("v"), "p_size", F.lit("."), F.col("p_partkey") % 12))
    best = artifacts.newest_complete(p, ["p_brand", "p_type"], artifacts.version_order("version"), (F.col("p_retailprice") > 1200) & (F.col("p_size") < 40), "p_partkey")
    return best.select("p_brand", "p_type", "p_partkey", "version")


@query(
    "interval_overlaps",
    """
WITH a AS (SELECT l_suppkey AS g, epoch(l_shipdate)::BIGINT // 86400 AS s, epoch(l_shipdate)::BIGINT // 86400 + CASE WHEN l_orderkey % 50 = 0 THEN 2000 ELSE CAST(l_quantity AS BIGINT) END AS e FROM lineitem),
b AS (SELECT o_custkey % 100 AS g, epoch(o_orderdate)::BIGINT // 86400 AS s, epoch(o_orderdate)::BIGINT // 86400 + o_orderkey % 9 AS e FROM orders)
SELECT a.g, count(*) AS pairs, CAST(sum(least(a.e, b.e) - greatest(a.s, b.s)) AS BIGINT) AS days FROM a JOIN b ON a.g = b.g AND a.s < b.e AND b.s < a.e AND a.s < a.e AND b.s < b.e GROUP BY a.g
""",
)
def interval_overlaps(spark: SparkSession, d: str) -> DataFrame:
    """Spans of shipments and of orders that overlap, some of them years long."""
    day = lambda c: F.unix_date(F.to_date(c)).cast("long")
    a = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("g"), day("l_shipdate").alias("s"), (day("l_shipdate") + F.when(F.col("l_orderkey") % 50 == 0, 2000).otherwise(F.col("l_quantity").cast("long"))).alias("e"))
    b = table(spark, d, "orders").select((F.col("o_custkey") % 100).alias("g"), day("o_orderdate").alias("s2"), (day("o_orderdate") + F.col("o_orderkey") % 9).alias("e2"))
    a = a.join(F.broadcast(b.select("g").distinct()), "g", "left_semi")  # 100 groups
    a, b = a.groupBy("g", "s", "e").agg(F.count("*").alias("n")), b.groupBy("g", "s2", "e2").agg(F.count("*").alias("n2"))  # equal spans meet once
    both = F.col("n") * F.col("n2")
    return overlap.overlap_join(a, b, ["g"], ("s", "e"), ("s2", "e2"), width=16).groupBy("g").agg(F.sum(both).alias("pairs"), F.sum(F.col("overlap") * both).alias("days"))


@query(
    "text_sections",
    r"""
WITH l AS (SELECT doc_id, trim(regexp_replace(u.x, '\s+', ' ', 'g')) AS text, u.i AS line FROM documents, LATERAL (SELECT unnest(string_split(text, chr(10))) AS x, generate_subscripts(string_split(text, chr(10)), 1) AS i) u),
h AS (SELECT *, length(text) BETWEEN 1 AND 24 AS heading FROM l),
s AS (SELECT *, CAST(sum(CASE WHEN heading THEN 1 ELSE 0 END) OVER w AS BIGINT) AS section, last_value(CASE WHEN heading THEN text END IGNORE NULLS) OVER w AS section_heading FROM h WINDOW w AS (PARTITION BY doc_id ORDER BY line ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT doc_id, section, section_heading, count(*) AS notes, CAST(min(line) AS INTEGER) AS first_line FROM s WHERE NOT heading AND length(text) BETWEEN 5 AND 300 GROUP BY ALL
""",
)
def text_sections(spark: SparkSession, d: str) -> DataFrame:
    """Note lines by the short line that heads them."""
    lines = sections.text_lines(table(spark, d, "documents"), "doc_id", "text")
    cut = sections.with_sections(lines, "doc_id", "line", F.length("text").between(1, 24))
    return sections.note_lines(cut.where(~F.col("is_heading"))).groupBy("doc_id", "section", "section_heading").agg(F.count("*").alias("notes"), F.min("line").alias("first_line"))


@query(
    "page_families",
    """
WITH p AS (SELECT conv_id, turn, text, CASE role WHEN 'system' THEN 'internal_checklist' WHEN 'assistant' THEN CASE WHEN length(text) % 3 = 0 THEN 'acceptance_test_report' END END AS told, turn % 4 = 0 AS first FROM conversations),
r AS (SELECT *, sum(CASE WHEN first THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn) AS run FROM p),
c AS (SELECT *, coalesce(last_value(told IGNORE NULLS) OVER (PARTITION BY conv_id, run ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 'unknown_document') AS family, row_number() OVER (PARTITION BY conv_id, run ORDER BY turn) AS n FROM r)
SELECT conv_id, turn, family AS document_family, CASE WHEN family = 'unknown_document' THEN 'unknown_page' WHEN family = 'internal_checklist' THEN CASE WHEN n = 1 THEN 'checklist_event_header_and_initial_checkout' ELSE 'checklist_continuation' END
  WHEN n = 1 THEN 'test_report_front_matter_and_event_header' ELSE 'test_report_continuation' END AS page_type, family <> 'unknown_document' AND told IS NULL AS inherited FROM c
""",
)
def page_families(spark: SparkSession, d: str) -> DataFrame:
    """Turns as pages: some tell a family, which holds until the next document begins."""
    told = F.when(F.col("role") == "system", "internal_checklist").when((F.col("role") == "assistant") & (F.length("text") % 3 == 0), "acceptance_test_report")
    found = sections.page_families(table(spark, d, "conversations"), "conv_id", "turn", "text", told, F.col("turn") % 4 == 0)
    return found.select("conv_id", "turn", "document_family", "page_type", F.col("family_inherited").alias("inherited"))
