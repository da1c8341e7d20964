"""Folder names and resumable acquisition over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.operators import grammar
from factloom.plans.catalog import query, table
from factloom.sources.acquire import Acquisition
from factloom.storage import new_path


@query(
    "folder_names",
    """
WITH p AS (SELECT p_partkey, p_partkey % 6 <> 5 AS cut, p_size % 7 <> 3 AS oem, p_partkey % 5 <> 0 AS sn, p_partkey % 4 <> 0 AS tech, p_partkey % 3 <> 0 AS site, p_size, p_name, p_type, p_brand FROM part)
SELECT p_partkey, CASE WHEN cut THEN p_type END AS equipment_type, CASE WHEN cut AND oem THEN p_name END AS model, CASE WHEN cut AND oem THEN upper(p_brand) || '-' || p_size END AS oem, CASE WHEN cut AND oem AND sn THEN CAST(80000000 + p_partkey AS VARCHAR) END AS serial_number,
  CASE WHEN cut AND oem AND sn THEN 'Acme ' || p_size END AS customer, CASE WHEN cut AND oem AND sn AND site THEN 'S' || p_partkey % 10 END AS site_code, CASE WHEN cut AND oem AND sn AND site THEN 'Site ' || p_partkey % 10 END AS site_name, CASE WHEN cut AND oem AND sn AND tech THEN 'T' || p_partkey % 8 END AS technician,
  CASE WHEN NOT (cut AND oem AND sn) THEN 'low' WHEN tech AND site THEN 'high' ELSE 'medium' END AS confidence, CASE WHEN NOT cut OR NOT oem OR NOT sn THEN 1 ELSE CASE WHEN tech THEN 0 ELSE 1 END + CASE WHEN site THEN 0 ELSE 1 END END AS notes FROM p
""",
)
def folder_names(spark: SparkSession, d: str) -> DataFrame:
    """Folder names made from parts, some of them incomplete; OEMs, sites and technicians are tables."""
    p = table(spark, d, "part")
    key = F.col("p_partkey")
    oem = F.concat(F.upper("p_brand"), F.lit("-"), "p_size")
    word = lambda on, *parts: F.when(on, F.concat(*parts)).otherwise("")
    name = F.concat("p_type", F.when(key % 6 != 5, " - ").otherwise(" "), "p_name", F.lit("  "), oem, word(key % 5 != 0, F.lit(" sn "), (key + 80000000).cast("string")), F.lit(" Acme "), "p_size", word(key % 3 != 0, F.lit(" s"), key % 10), word(key % 4 != 0, F.lit(" t"), key % 8))
    refs = p.where(F.col("p_size") % 7 != 3).select(F.lit("oem").alias("kind"), oem.alias("token"), F.lit(None).cast("string").alias("label")).distinct()
    refs = refs.unionByName(p.select(F.lit("site").alias("kind"), F.concat(F.lit("S"), key % 10).alias("token"), F.concat(F.lit("Site "), key % 10).alias("label")).distinct())
    refs = refs.unionByName(p.select(F.lit("technician").alias("kind"), F.concat(F.lit("T"), key % 8).alias("token"), F.lit(None).cast("string").alias("label")).distinct())
    found = grammar.parse_folder_names(p.withColumn("folder", name), "p_partkey", "folder", refs)
    return found.withColumn("notes", F.size("notes"))


@query(
    "acquired_items",
    "SELECT doc_id, CASE WHEN doc_id % 11 = 0 THEN 'failed' ELSE 'ok' END AS status, CASE WHEN doc_id % 11 = 0 THEN 3 WHEN doc_id % 7 = 0 THEN 2 ELSE 1 END AS attempts, CASE WHEN doc_id % 11 <> 0 THEN md5(text) END AS result FROM documents",
)
def acquired_items(spark: SparkSession, d: str) -> DataFrame:
    """A digest of each text by a provider that fails at times: one half is asked before, as if a run had ended there."""
    from hashlib import md5

    docs = table(spark, d, "documents").select("doc_id", "text")

    def ask(row: dict) -> str:
        if row["doc_id"] % 11 == 0 or (row["doc_id"] % 7 == 0 and row["attempt"] == 1):
            raise TimeoutError("no answer")
        return md5(row["text"].encode()).hexdigest()

    work = Acquisition(spark, new_path(spark, "acquired"))
    work.part(docs, "doc_id", ask, 0, 2)
    return work.run(docs, "doc_id", ask, 2).select(F.col("item").cast("long").alias("doc_id"), "status", F.col("attempts").cast("int").alias("attempts"), "result")
