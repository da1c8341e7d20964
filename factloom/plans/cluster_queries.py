"""Iterative clustering over the driver's tables, with proposals that depend on the rows alone."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.operators import clustering, similar
from factloom.plans.catalog import query, table
from factloom.storage import new_path


def _by(name):
    """A proposer that groups the rows of a batch by a function of them."""
    def run(batch: list[dict]) -> list[dict]:
        groups: dict[str, list] = {}
        for row in batch:
            groups.setdefault(name(row), []).append(row["id"])
        return [{"label": k, "key": k, "members": v} for k, v in groups.items()]

    return run


def _parts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select(F.col("p_brand").alias("lane"), F.col("p_partkey").alias("id"), F.col("p_name").alias("raw"), (F.col("p_partkey") % 97).cast("string").alias("log"))


def _first_of(members: DataFrame, cluster: str) -> DataFrame:
    least = members.groupBy(cluster).agg(F.min(F.col("member").cast("long")).alias("cluster"))
    return members.join(least, cluster).select(F.col("member").cast("long").alias("p_partkey"), "cluster")


@query("concept_clusters", "SELECT p_partkey, min(p_partkey) OVER (PARTITION BY p_brand, left(string_split(p_name, ' ')[-1], 1)) AS cluster FROM part")
def concept_clusters(spark: SparkSession, d: str) -> DataFrame:
    """Parts of a brand by the last word of their name; rounds of merging then join the words of one initial. Named by the smallest part."""
    first, merge = _by(lambda r: r["raw"].split(" ")[-1]), _by(lambda r: f"words in {r['key'].removeprefix('words_in_')[:1]}")
    _, members, _ = clustering.cluster(_parts(spark, d), first, merge, new_path(spark, "clusters"))
    return _first_of(members, "cluster_id")


@query("signal_families", "SELECT p_partkey, min(p_partkey) OVER (PARTITION BY string_split(p_name, ' ')[-1]) AS cluster FROM part")
def signal_families(spark: SparkSession, d: str) -> DataFrame:
    """Families of parts: by the last word within a brand, in batches of 500, then over all brands."""
    first, merge = _by(lambda r: r["raw"].split(" ")[-1]), _by(lambda r: r["label"])
    found = clustering.families(_parts(spark, d), first, merge, new_path(spark, "families"), most=500)
    return _first_of(found.select("family_id", "member"), "family_id")


@query(
    "descriptor_families",
    """
WITH RECURSIVE k AS (SELECT p_name || ' ' || lower(p_type) AS raw, min(p_partkey) AS id FROM part GROUP BY 1),
u AS (SELECT id, unnest(list_distinct(string_split(raw, ' '))) AS w, len(list_distinct(string_split(raw, ' '))) AS n FROM k),
e AS (SELECT a.id AS a, b.id AS b FROM u a JOIN u b ON a.w = b.w AND a.id <> b.id GROUP BY a.id, b.id, a.n, b.n HAVING count(*) >= 0.65 * (a.n + b.n - count(*))),
r(v, m) AS (SELECT id, id FROM k UNION SELECT e.b, r.m FROM r JOIN e ON e.a = r.v)
SELECT v AS p_partkey, min(m) AS cluster FROM r GROUP BY v
""",
)
def descriptor_families(spark: SparkSession, d: str) -> DataFrame:
    """Descriptors (name and type) that words connect, as a proposer that accepts whole components groups them."""
    raw = F.concat_ws(" ", "p_name", F.lower("p_type"))
    descriptors = table(spark, d, "part").groupBy(raw.alias("raw")).agg(F.min("p_partkey").alias("id")).withColumn("log", F.lit("1"))
    pairs = similar.similar_pairs(descriptors, "id", "raw", 0.65, n=1)
    found = clustering.normalized_descriptors(descriptors, pairs, _by(lambda r: r["candidate_component"]), most=10_000)
    return _first_of(found.select("family_id", "member"), "family_id")
