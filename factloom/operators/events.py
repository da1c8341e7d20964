"""Deterministic samples, event grouping and rollups, selection with reasons."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factloom.functions.ids import sample_key
from factloom.functions.rules import first_match


def deterministic_sample(rows: DataFrame, key: str, percent: float, seed: str, range_rows: int = 50_000) -> DataFrame:
    """The ceil(n * percent / 100) rows with the smallest keyed hashes, as (key, sample_hash, sample_rank).

    Hashes are uniform, so their leading digits are ranges of about equal size. The sizes of the ranges give the rank of each
    range's first row; only ranges below the cut are sorted, each on its own.
    """
    hashed = rows.select(key).distinct().withColumn("sample_hash", sample_key(key, seed))
    total = hashed.count()
    n = math.ceil(total * percent / 100)
    digits = max(1, math.ceil(math.log(max(total / range_rows, 1), 16)))
    hashed = hashed.withColumn("_range", F.substring("sample_hash", 1, digits))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = hashed.groupBy("_range").agg(F.count("*").alias("k")).select("_range", F.coalesce(F.sum("k").over(before), F.lit(0)).alias("_ahead")).where(F.col("_ahead") < n)
    place = F.row_number().over(Window.partitionBy("_range").orderBy("sample_hash", key))
    out = hashed.join(ranges, "_range").withColumn("sample_rank", (F.col("_ahead") + place).cast("int" if total < 2**31 else "long"))
    return out.where(F.col("sample_rank") <= n).select(key, "sample_hash", "sample_rank")


def with_reason(rows: DataFrame, rules: list[tuple[str, Column]], name: str = "exclusion_reason") -> DataFrame:
    """Rows with the name of the first rule that excludes them; null: kept."""
    return rows.withColumn(name, first_match(rules))


def reason_counts(rows: DataFrame, name: str = "exclusion_reason") -> DataFrame:
    return rows.groupBy(F.coalesce(name, F.lit("kept")).alias(name)).agg(F.count("*").alias("n"))


def group_events(rows: DataFrame, key: list[str], order: list[str], primary: Column) -> DataFrame:
    """An event for each key: its numbers of primary and supporting rows and its first and last order value."""
    first = order[0]
    return rows.withColumn("_p", F.coalesce(primary, F.lit(False))).groupBy(*key).agg(
        F.count("*").alias("documents"), F.count_if("_p").alias("primary_documents"), F.count_if(~F.col("_p")).alias("supporting_documents"), F.min(first).alias("first_value"), F.max(first).alias("last_value")
    )


def rollup(rows: DataFrame, key: str, role: str, roles: list[str]) -> DataFrame:
    """Rows of each role by key, and their total."""
    return rows.groupBy(key).agg(F.count("*").alias("total"), *[F.count_if(F.col(role) == r).alias(f"n_{r}") for r in roles])


def completeness(counts: DataFrame, weights: dict[str, int]) -> DataFrame:
    """Score (sum of the weights of roles present) and the roles that are missing, joined by a comma."""
    score = sum(F.when(F.col(f"n_{r}") > 0, w).otherwise(0) for r, w in weights.items())
    gaps = F.array_join(F.array_compact(F.array(*[F.when(F.col(f"n_{r}") == 0, F.lit(r)) for r in weights])), ",")
    return counts.withColumns({"completeness": score.cast("long"), "gaps": gaps})


def first_by_key(rows: DataFrame, key: list[str], order: list[Column | str]) -> DataFrame:
    """The first row of each key in a stated order."""
    w = Window.partitionBy(*key).orderBy(*order)
    return rows.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") == 1).drop("_rank")


def top_per_group(rows: DataFrame, group: list[str], order: list[Column | str], n: int, rank: str = "rank") -> DataFrame:
    """The first n rows of each group in a stated order, with their rank."""
    return rows.withColumn(rank, F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col(rank) <= n)


def mode(rows: DataFrame, group: list[str], value: str, order: str) -> DataFrame:
    """Most frequent value of each group; of equals the one seen first in ``order``."""
    counted = rows.groupBy(*group, value).agg(F.count("*").alias("n"), F.min(order).alias("_first"))
    return first_by_key(counted, group, [F.desc("n"), F.asc("_first")]).drop("_first")
