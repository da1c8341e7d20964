"""Numbering, shares, layout rows, coverage and texts of groups over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.operators import intervals, parts, records, recurrence, spans, vectors
from factloom.plans.catalog import query, table


@query(
    "numbered_orders",
    """
SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS number,
  round(sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / sum(o_totalprice) OVER (PARTITION BY o_custkey), 6) AS share FROM orders
""",
)
def numbered_orders(spark: SparkSession, d: str) -> DataFrame:
    """A customer's orders numbered by date, and the share of all that the largest ones make."""
    rows = records.numbered(table(spark, d, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return parts.running_share(rows, ["o_custkey"], [F.desc("o_totalprice"), "o_orderkey"], "o_totalprice").select("o_orderkey", F.col("number").cast("long").alias("number"), F.round("running_share", 6).alias("share"))


@query(
    "smoothed_marks",
    """
WITH m AS (SELECT l_orderkey, l_linenumber, sum(l_quantity) AS q, min(l_discount) AS x, min(l_tax) AS y FROM lineitem GROUP BY ALL)
SELECT l_orderkey, l_linenumber, round(avg(q) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING), 6) AS smooth, CAST(least(greatest(round(x * 1000), 0), 1000) AS INTEGER) AS "left", CAST(least(greatest(round(y * 800), 0), 800) AS INTEGER) AS top,
  CAST(least(greatest(round((x + 0.95::DOUBLE) * 1000), 0), 1000) AS INTEGER) AS "right", CAST(least(greatest(round((y + 0.5::DOUBLE) * 800), 0), 800) AS INTEGER) AS bottom FROM m
""",
)
def smoothed_marks(spark: SparkSession, d: str) -> DataFrame:
    """Lines of an order as rows of marks: a moving average, and boxes of fractions in pixels, clipped to the page."""
    m = table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.sum("l_quantity").alias("q"), F.min("l_discount").alias("x"), F.min("l_tax").alias("y"))
    rows = intervals.moving_average(m, ["l_orderkey"], "l_linenumber", "q", 2).withColumns({"box": F.struct("x", "y", F.lit(0.95).alias("w"), F.lit(0.5).alias("h")), "width": F.lit(1000), "height": F.lit(800)})
    return rows.select("l_orderkey", "l_linenumber", F.round("smooth", 6).alias("smooth"), intervals.pixels("box", "width", "height").alias("p")).select("l_orderkey", "l_linenumber", "smooth", "p.*")


@query(
    "line_coverage",
    """
WITH g AS (SELECT l_orderkey, list(DISTINCT l_linenumber) AS s FROM lineitem GROUP BY 1)
SELECT l_orderkey, len(s) AS found, array_to_string(list_filter(range(1, 8), lambda i: NOT list_contains(s, CAST(i AS INTEGER))), ',') AS missing, len(s) >= 7 AS complete FROM g
""",
)
def line_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Which of seven lines each order has."""
    return intervals.coverage(table(spark, d, "lineitem"), 7, ["l_orderkey"], "l_linenumber").select("l_orderkey", "found", F.concat_ws(",", F.col("missing").cast("array<string>")).alias("missing"), "complete")


@query(
    "grid_gaps",
    """
WITH p AS (SELECT DISTINCT o_custkey AS g, CAST(o_orderkey % 40 AS BIGINT) * 10 AS y FROM orders),
l AS (SELECT g, y, y - lag(y) OVER (PARTITION BY g ORDER BY y) AS gap, lag(y) OVER (PARTITION BY g ORDER BY y) AS b FROM p),
k AS (SELECT g, b, CAST(gap // 10 AS BIGINT) AS k FROM l WHERE gap >= 20)
SELECT g, CAST(b + 10 * unnest(range(1, k)) AS DOUBLE) AS position FROM k
""",
)
def grid_gaps(spark: SparkSession, d: str) -> DataFrame:
    """Positions that a grid of ten has between a customer's marks."""
    rows = table(spark, d, "orders").select(F.col("o_custkey").alias("g"), (F.col("o_orderkey") % 40 * 10).alias("y")).distinct()
    return intervals.missing_lines(rows, rows.select("g").distinct().withColumn("pitch", F.lit(10.0)), ["g"], "y").select("g", F.col("position").cast("double").alias("position"))


@query(
    "group_texts",
    """
SELECT p_partkey, left('Pattern: ' || p_name || chr(10) || 'Areas: ' || p_type || ', ' || p_brand || chr(10) || p_name || ' worn' || chr(10) || 'size ' || p_size, 60) AS text,
  CASE WHEN p_size % 3 = 0 AND p_size % 2 = 1 THEN 'conflicts_with_approved_repair_actions' WHEN p_size % 3 = 0 THEN 'conflicts_with_approved_repair_actions,conflicts_with_approved_parts_replaced' ELSE '' END AS flags FROM part
""",
)
def group_texts(spark: SparkSession, d: str) -> DataFrame:
    """Texts for embeddings, and results that approved rows contradict."""
    p = table(spark, d, "part").withColumn("areas", F.array("p_type", "p_brand"))
    said = F.when(F.col("p_size") % 3 == 0, "No Trouble Found.").otherwise("Repaired")
    found = vectors.embedding_text("p_name", "areas", F.array(F.concat("p_name", F.lit(" worn")), F.concat(F.lit("size "), "p_size")), 60)
    return p.select("p_partkey", found.alias("text"), F.concat_ws(",", spans.conflict_flags(said, F.col("p_size"), F.when(F.col("p_size") % 2 == 0, 1).otherwise(0))).alias("flags"))


@query(
    "mention_windows",
    r"""
WITH d AS (SELECT doc_id, text, instr(text, ' the ') AS s FROM documents WHERE instr(text, ' the ') > 0)
SELECT doc_id, md5(coalesce(regexp_extract(left(text, s), '(?:[^ \t\n\f\r]+[ \t\n\f\r]+){0,6}[^ \t\n\f\r]*$'), '') || 'the' || coalesce(regexp_extract(substr(text, s + 4), '^[^ \t\n\f\r]*(?:[ \t\n\f\r]+[^ \t\n\f\r]+){0,6}'), '')) AS around FROM d
""",
)
def mention_windows(spark: SparkSession, d: str) -> DataFrame:
    """The first "the" of each document with six words beside it."""
    found = table(spark, d, "documents").withColumn("s", F.instr("text", " the ")).where("s > 0")
    return found.select("doc_id", F.md5(spans.word_window("text", F.col("s"), F.col("s") + 3).cast("binary")).alias("around"))


@query(
    "engine_overlap",
    """
WITH a AS (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_quantity > 45), b AS (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_discount > 0.08), c AS (SELECT count(*) AS covered FROM (SELECT k FROM a UNION SELECT k FROM b))
SELECT (SELECT count(*) FROM a JOIN b USING (k)) AS shared, (SELECT count(*) FROM a) AS left_keys, (SELECT count(*) FROM b) AS right_keys, covered FROM c
""",
)
def engine_overlap(spark: SparkSession, d: str) -> DataFrame:
    """Parts that two filters find, one and both."""
    rows = table(spark, d, "lineitem").withColumnRenamed("l_partkey", "k")
    a, b = rows.where("l_quantity > 45").select("k"), rows.where("l_discount > 0.08").select("k")
    return vectors.overlap(a, b, "k").join(recurrence.union_coverage(a.unionByName(b), "k"))
