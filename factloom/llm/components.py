"""Connected components by alternating large-star and small-star steps.

Links live in tables throughout; nothing but a checksum reaches the driver.  Each step is written to the shared
folder, so that a lost executor costs a step at most and the lineage stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.storage import drop_materialized, materialize


def _large_star(links: DataFrame) -> DataFrame:
    """Each vertex hands the smallest of its neighbours and itself to its larger neighbours."""
    both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))  # at most one a link; repeated ones go in the small star


def _small_star(links: DataFrame) -> DataFrame:
    """Each vertex hands its smallest neighbour to its smaller neighbours and itself."""
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where(F.col("u") != F.col("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, rounds: int = 50) -> DataFrame:
    """(vertex, component) of every vertex with a link (u, v); component is the smallest vertex of its component.

    Links of a vertex to itself, repeated links and null ends change nothing. An empty table gives an empty result.
    """
    now = materialize(links.select("u", "v").where(F.col("u") != F.col("v")).distinct(), "star")
    mark = None
    for _ in range(rounds):
        new = materialize(_small_star(_large_star(now)), "star")
        drop_materialized(now)
        now = new
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == mark:
            break
        mark = seen
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return now.groupBy(F.col("u").alias("vertex")).agg(F.min("v").alias("component")).unionByName(now.select(F.col("v").alias("vertex"), F.col("v").alias("component")).distinct())
