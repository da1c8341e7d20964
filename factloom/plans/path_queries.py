"""Path, role and mention queries over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.functions import paths
from factloom.operators import spans
from factloom.plans.catalog import query, table

# folders and file names made from order rows
_PATH = "concat('Units/Unit ', o_custkey % 50, ' SN 8', lpad(cast(o_custkey as string), 7, '0'), '/', case when o_orderkey % 4 = 0 then 'x' else concat(date_format(o_orderdate, 'yyMMdd'), lpad(cast(o_orderkey % 1000 as string), 3, '0')) end, case o_orderkey % 3 when 0 then ' Line Card (2).jpg' when 1 then ' Incoming photo.png' else ' notes.txt' end)"
_PATH_SQL = "concat('Units/Unit ', o_custkey % 50, ' SN 8', lpad(CAST(o_custkey AS VARCHAR), 7, '0'), '/', CASE WHEN o_orderkey % 4 = 0 THEN 'x' ELSE concat(strftime(o_orderdate, '%y%m%d'), lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0')) END, CASE o_orderkey % 3 WHEN 0 THEN ' Line Card (2).jpg' WHEN 1 THEN ' Incoming photo.png' ELSE ' notes.txt' END)"


def _files(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select("o_orderkey", F.expr(_PATH).alias("path"))


@query(
    "path_identities",
    f"""
WITH p AS (SELECT o_orderkey, o_custkey, o_orderdate, {_PATH_SQL} AS path FROM orders)
SELECT o_orderkey, 'Unit ' || o_custkey % 50 AS family, '8' || lpad(CAST(o_custkey AS VARCHAR), 7, '0') AS serial, CAST(CASE WHEN o_orderkey % 3 = 0 THEN 2 END AS INTEGER) AS card,
  CASE WHEN o_orderkey % 4 <> 0 AND o_orderkey % 1000 <> 0 THEN 'log_' || strftime(o_orderdate, '%y%m%d') || lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0') WHEN o_orderkey % 3 = 0 AND o_orderkey % 4 <> 0 THEN 'legacy_' || strftime(o_orderdate, '%y%m%d') || '000_' || sha256('Units' || chr(10) || strftime(o_orderdate, '%y%m%d') || '000')[1:8] ELSE 'record_' || sha256(path)[1:16] END AS event_id FROM p
""",
)
def path_identities(spark: SparkSession, d: str) -> DataFrame:
    folder = F.get(F.split("path", "/"), F.lit(1))
    return _files(spark, d).select("o_orderkey", paths.family_from_folder(folder).alias("family"), paths.serial_from_path("path").alias("serial"), paths.card_sequence("path").alias("card"), paths.event_identity("path", F.lit("Units")).alias("event_id"))


@query(
    "assignment_scopes",
    "SELECT CASE WHEN o_orderkey % 4 = 0 THEN 'unit_level' ELSE 'repair_event' END AS scope, count(*) AS files, count(DISTINCT CASE WHEN o_orderkey % 4 <> 0 THEN concat(strftime(o_orderdate, '%y%m%d'), o_orderkey % 1000) END) AS logs FROM orders GROUP BY 1",
)
def assignment_scopes(spark: SparkSession, d: str) -> DataFrame:
    a = _files(spark, d).select(paths.assignment("path").alias("a"))
    return a.groupBy("a.scope").agg(F.count("*").alias("files"), F.countDistinct("a.log_number").alias("logs"))


@query(
    "evidence_roles",
    "SELECT CASE o_orderkey % 3 WHEN 0 THEN CASE WHEN o_orderkey % 4 = 0 THEN 'photo' ELSE 'traveler' END WHEN 1 THEN 'receiving_photo' ELSE 'document' END AS role, count(*) AS files FROM orders GROUP BY 1",
)
def evidence_roles(spark: SparkSession, d: str) -> DataFrame:
    return _files(spark, d).groupBy(paths.evidence_role("path").alias("role")).agg(F.count("*").alias("files"))


_LEXICON = {"ring": ("rings",), "bolt": ("bolts",)}


@query(
    "lexicon_mentions",
    "SELECT p_partkey, unnest(CASE WHEN p_name LIKE '% ring' THEN ['ring'] WHEN p_name LIKE '% bolt' THEN ['bolt'] ELSE [] END) AS canonical, CAST(length(p_name) - 4 AS INTEGER) AS \"start\", CAST(length(p_name) AS INTEGER) AS \"end\" FROM part",
)
def lexicon_mentions(spark: SparkSession, d: str) -> DataFrame:
    found = spans.mentions(table(spark, d, "part"), "p_partkey", "p_name", _LEXICON, "lexicon", 50)
    return spans.resolve_overlaps(found, ["p_partkey"]).select("p_partkey", "canonical", "start", "end")


@query("statement_similarity")
def statement_similarity(spark: SparkSession, d: str) -> DataFrame:
    """Consecutive turns of a conversation that say much the same."""
    c = table(spark, d, "conversations")
    a = c.select("conv_id", F.col("turn").alias("t"), F.col("text").alias("a"))
    b = c.select("conv_id", (F.col("turn") - 1).alias("t"), F.col("text").alias("b"))
    return a.join(b, ["conv_id", "t"]).select("conv_id", "t", spans.text_similarity("a", "b").alias("similarity")).where(F.col("similarity") > 0)
