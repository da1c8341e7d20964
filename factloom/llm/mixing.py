"""Mixing sources to target weights, with DataFrame operations only.

Every document gets a hash-random key.  Within a source, documents are taken in key order until the source's budget of words
is used up; a budget above the source's size repeats whole epochs first.  Keys are uniform, so the leading bits of a key
are a range partition that needs no sampling: (source, range) pairs are sorted each in its own
task, and the sums of the ranges give each range the words before it.  A source of any size is thus spread over
many tasks.

Sources in code-point order, null last, weigh ``weights`` in turn.  Together they share ``share`` of all
words; a target stops at ``epochs`` times its source's size and the excess goes to the others by
weight.  With targets t = min(epochs * size, weight * level), the level follows from running sums over the
sources in order of epochs * size / weight.  The table of sources (one row each) is sorted in one task.

A document is in the last, partial epoch if its middle lies within the budget, so a source misses its target by half a
document at most.  Defined results: null text has size 0 and is taken 0 times; rows equal in id and text are ordered arbitrarily
among themselves, which changes no result; an empty table gives an empty result.  Input columns named as an output are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factloom.llm.common import WORD
from factloom.storage import materialize

WEIGHTS, SHARE, EPOCHS, SEED = (5, 2, 1), 1.5, 2, 11
#: Rows of a (source, range) pair at most, about, and the least number of ranges.
RANGE_ROWS, LEAST_BITS = 50_000, 8
_OWN = ["size", "source_size", "target", "taken"]


def word_count(text: str | Column = "text") -> Column:
    c = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(c, F.lit(WORD)), F.lit(0)).cast("long")


def random_key(seed: int = SEED) -> Column:
    """60 hash-random bits of id and text, in hexadecimal."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), part("doc_id"), part("text"))), 1, 15)


def _targets(sizes: DataFrame, weights: tuple[int, ...], share: float, epochs: int) -> DataFrame:
    """source, source_size and target from (source, source_size)."""
    order = Window.orderBy(F.col("source").isNull(), "source")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1)
    t = sizes.withColumn("w", w).withColumn("cap", float(epochs) * F.col("source_size"))
    t = t.withColumn("ratio", F.col("cap") / F.col("w"))
    by = Window.orderBy("ratio", F.col("source").isNull(), "source")
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    budget = F.lit(share) * F.sum("source_size").over(everything)
    spent = F.coalesce(F.sum("cap").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    level = (budget - spent) / F.sum("w").over(by.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    t = t.withColumn("level", level)
    free = F.when(F.col("ratio") > F.col("level"), F.struct("ratio", F.col("source").isNull(), "source", "level"))
    t = t.withColumn("level", F.min(free).over(everything)["level"])
    return t.select("source", "source_size", F.when(F.col("ratio") > F.col("level"), F.col("w") * F.col("level")).otherwise(F.col("cap")).alias("target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS, seed: int = SEED) -> DataFrame:
    """``docs`` with size, source_size, target and taken."""
    names = [c for c in docs.columns if c not in _OWN]
    bits = min(40, max(LEAST_BITS, math.ceil(math.log2(max(docs.count(), 1) / RANGE_ROWS))))
    rows = docs.select(*names, word_count().alias("size"), random_key(seed).alias("__key"))
    rows = rows.withColumn("__range", F.shiftright(F.conv("__key", 16, 10).cast("long"), 60 - bits))
    ranges = materialize(rows.groupBy("source", "__range").agg(F.sum("size").alias("words")), "ranges")
    before = Window.partitionBy("source").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    ranges_before = ranges.select("source", "__range", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("__ahead"))
    targets = _targets(ranges.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, epochs)
    plan = ranges_before.alias("r").join(targets.alias("t"), F.col("r.source").eqNullSafe(F.col("t.source"))).select(F.col("r.source").alias("__source"), F.col("__range").alias("__r"), "__ahead", F.col("source_size").alias("__size"), F.col("target").alias("__target"))
    plan = materialize(plan, "mix-plan")
    local = Window.partitionBy("source", "__range").orderBy("__key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("__within", F.coalesce(F.sum("size").over(local), F.lit(0)))
    rows = rows.join(plan, F.col("source").eqNullSafe(F.col("__source")) & (F.col("__range") == F.col("__r")))
    full = F.when(F.col("__size") > 0, F.floor(F.col("__target") / F.col("__size"))).otherwise(0)
    rest = F.col("__target") - full * F.col("__size")
    part = F.when(2.0 * (F.col("__ahead") + F.col("__within")) + F.col("size") <= 2.0 * rest, 1).otherwise(0)
    return rows.select(*names, "size", F.col("__size").alias("source_size"), F.col("__target").alias("target"), (F.col("size") * F.least(full + part, F.lit(epochs))).cast("long").alias("taken"))


def mixture(docs: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` that the mix takes, each as often as it takes it, with the columns of ``docs``."""
    held = docs.select("doc_id", "text", "source", F.struct(*docs.columns).alias("__row"))
    took = mix(held, **how).where(F.col("taken") > 0)
    again = F.explode(F.array_repeat(F.col("__row"), (F.col("taken") / F.col("size")).cast("int"))).alias("__row")
    return took.select(again).select("__row.*")


#: The rows of mix() on the table documents, for DuckDB.
SQL = r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    substr(md5(concat('11', ':', coalesce(CAST(doc_id AS VARCHAR), ''), ':', coalesce(text, ''))), 1, 15) AS k FROM documents),
s AS (SELECT source, CAST(sum(size) AS DOUBLE) AS z, 2.0 * CAST(sum(size) AS DOUBLE) AS cap FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS w FROM s),
v AS (SELECT *, cap / w AS ratio FROM w),
l AS (SELECT *, (1.5::DOUBLE * (SELECT sum(z) FROM v) - coalesce(sum(cap) OVER (ORDER BY ratio, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(w) OVER (ORDER BY ratio, source IS NULL, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM v),
f AS (SELECT level FROM l WHERE ratio > level ORDER BY ratio, source IS NULL, source LIMIT 1),
t AS (SELECT source, z, CASE WHEN ratio > (SELECT level FROM f) THEN w * (SELECT level FROM f) ELSE cap END AS target FROM l),
p AS (SELECT d.*, t.z, t.target, coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead,
    CASE WHEN t.z > 0 THEN floor(t.target / t.z) ELSE 0 END AS full_epochs FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, CAST(z AS BIGINT) AS source_size, target,
  CAST(size * least(full_epochs + CASE WHEN 2.0 * ahead + size <= 2.0 * (target - full_epochs * z) THEN 1 ELSE 0 END, 2) AS BIGINT) AS taken
FROM p
"""
