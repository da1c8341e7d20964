"""Replaceable model calls. The deterministic part around a call is the library's; the defaults call no model."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Transcriber = Callable[[bytes], str]
Clusterer = Callable[[Sequence[dict]], list[dict]]
Composer = Callable[[dict], dict]


@dataclass
class Providers:
    """No transcriber: images stay unread. No clusterer: every candidate is a group of its own. No composer: the deterministic answer."""

    transcribe: Transcriber | None = None
    cluster: Clusterer = field(default=lambda batch: [])
    compose: Composer | None = None


def signature(*parts: str) -> Column:
    """Cache key of a call: source hash, model, prompt hash and settings."""
    return F.sha2(F.concat_ws("\n", *[F.coalesce(F.col(p).cast("string"), F.lit("")) for p in parts]), 256)


def uncached(rows: DataFrame, cache: DataFrame, key: str = "signature") -> DataFrame:
    """Rows whose signature has no cached result yet."""
    return rows.join(cache.select(key), key, "left_anti")


def valid_clusters(proposals: DataFrame, known: DataFrame, cluster: str = "cluster_id", member: str = "candidate_id") -> DataFrame:
    """(cluster, member) of a proposal: known members only, each in its first cluster, clusters of one dropped; members left over become singletons."""
    from factloom.operators.events import first_by_key

    rows = proposals.select(cluster, member).join(known.select(member), member, "left_semi")
    once = first_by_key(rows, [member], [cluster])
    size = once.groupBy(cluster).agg(F.count("*").alias("k")).where(F.col("k") >= 2).select(cluster)
    kept = once.join(size, cluster, "left_semi").select(cluster, member)
    rest = known.select(member).join(kept, member, "left_anti").select(F.concat(F.lit("single:"), F.col(member).cast("string")).alias(cluster), member)
    return kept.select(F.col(cluster).cast("string").alias(cluster), member).unionByName(rest)


def valid_citations(statements: DataFrame, allowed: DataFrame, cited: str = "cited_ids", key: str = "id", most: int = 5) -> DataFrame:
    """Statements with the allowed part of their citations; those that cite nothing allowed are dropped, the first ``most`` stay."""
    each = statements.withColumn("_c", F.explode(cited)).join(allowed.select(F.col(key).alias("_c")).distinct(), "_c", "left_semi")
    good = each.groupBy("position").agg(F.array_sort(F.collect_set("_c")).alias("valid_ids"))
    return statements.join(good, "position").orderBy("position").limit(most)


def fallback_answer(hits: DataFrame, most: int = 5) -> DataFrame:
    """The answer without a model: the leading hits by fused score, each citing itself."""
    return hits.orderBy(F.desc("score"), "group_id").limit(most).select(F.col("concept_label").alias("statement"), F.array("group_id").alias("cited_ids"))


def assert_counts(found: DataFrame, expected: dict[str, int], column: str) -> None:
    """Fail unless a frozen baseline has exactly the expected rows by kind."""
    got = {r[0]: r[1] for r in found.groupBy(column).agg(F.count("*")).collect()}
    if got != expected:
        raise ValueError(f"the baseline has {got}, not {expected}")


def assert_version(manifest: DataFrame, expected: str) -> None:
    versions = [r[0] for r in manifest.select("version").distinct().collect()]
    if versions != [expected]:
        raise ValueError(f"version {versions}, not {expected}")
