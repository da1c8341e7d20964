"""Gaps and islands of positions, robust pitch, moving averages and boxes: the geometry behind page layouts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factloom.storage import materialize


def islands(rows: DataFrame, group: list[str], position: str, tolerance: int = 1, parts: int | None = None, span: int = 1 << 16, distinct: bool = False) -> DataFrame:
    """Runs of positions whose neighbours are at most ``tolerance`` apart: first, last, members. distinct: equal rows count once.

    Each group is cut into stretches of ``span`` tolerances, which are numbered on their own; a row a stretch then tells how many islands lie before it and whether its first
    goes on from the stretch before. parts: partitions of the stretches, the session's number if None.
    """
    at = F.coalesce(F.floor(F.col(position) / (max(tolerance, 1) * span)).cast("long"), F.lit(-(1 << 62)))  # null positions come first
    cut = rows.select(*group, position).withColumn("_at", at)
    keys = [*group, "_at"]
    cut = cut.repartition(parts, *keys) if parts else cut.repartition(*keys)
    cut = cut.distinct() if distinct else cut
    w = Window.partitionBy(*keys).orderBy(position)
    new = F.when(F.col(position) - F.lag(position).over(w) <= tolerance, 0).otherwise(1)
    numbered = cut.withColumn("_new", new).withColumn("_local", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    local = materialize(numbered.groupBy(*keys, "_local").agg(F.min(position).alias("first"), F.max(position).alias("last"), F.count("*").alias("members")), "islands")
    stretches = local.groupBy(*keys).agg(F.max("_local").alias("_k"), F.min("first").alias("_f"), F.max("last").alias("_l"))
    w = Window.partitionBy(*group).orderBy("_at")
    joins = lambda a, b: F.coalesce((a - b <= tolerance).cast("int"), F.lit(0))
    stretches = stretches.withColumns({"_joins": joins(F.col("_f"), F.lag("_l").over(w)), "_joined": joins(F.lead("_f").over(w), F.col("_l"))})
    ahead = F.coalesce(F.sum("_k").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) - F.sum("_joins").over(w.rowsBetween(Window.unboundedPreceding, 0))
    known = stretches.select(*[F.col(c).alias(f"_{c}_") for c in keys], "_k", "_joins", "_joined", ahead.alias("_ahead"))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}_")) for c in keys]
    edge = ((F.col("_joins") == 1) & (F.col("_local") == 1)) | ((F.col("_joined") == 1) & (F.col("_local") == F.col("_k")))
    placed = local.join(known, same).select(*group, (F.col("_local") + F.col("_ahead")).alias("island"), "first", "last", "members", edge.alias("_edge"))
    whole = placed.where("_edge").groupBy(*group, "island").agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("members").alias("members"))
    return placed.where("not _edge").drop("_edge").unionByName(whole)


def pitch(rows: DataFrame, group: list[str], position: str, share: float = 0.6) -> DataFrame:
    """Median of the smallest ``share`` of the gaps between neighbours."""
    w = Window.partitionBy(*group)
    gaps = rows.withColumn("gap", F.col(position) - F.lag(position).over(w.orderBy(position))).where(F.col("gap").isNotNull())
    ranked = gaps.withColumns({"_r": F.row_number().over(w.orderBy("gap")), "_n": F.count("*").over(w)})
    return ranked.where(F.col("_r") <= F.greatest(F.lit(1), F.ceil(F.col("_n") * share))).groupBy(*group).agg(F.percentile("gap", 0.5).alias("pitch"))


def missing_lines(rows: DataFrame, pitches: DataFrame, group: list[str], position: str, tolerance: float = 0.2) -> DataFrame:
    """Positions that a regular grid has between two neighbours whose gap is about a multiple of the pitch."""
    w = Window.partitionBy(*group).orderBy(position)
    gaps = rows.withColumn("_before", F.lag(position).over(w)).where(F.col("_before").isNotNull()).join(pitches, group)
    k = F.round((F.col(position) - F.col("_before")) / F.col("pitch"))
    fits = (k >= 2) & (F.abs((F.col(position) - F.col("_before")) / k - F.col("pitch")) <= tolerance * F.col("pitch"))
    step = (F.col(position) - F.col("_before")) / F.col("k")
    return gaps.withColumn("k", k.cast("int")).where(fits).select(*group, F.explode(F.transform(F.sequence(F.lit(1), F.col("k") - 1), lambda i: F.col("_before") + i * step)).alias("position"))


def moving_average(rows: DataFrame, group: list[str], position: str, value: str, half: int = 4) -> DataFrame:
    return rows.withColumn("smooth", F.avg(value).over(Window.partitionBy(*group).orderBy(position).rowsBetween(-half, half)))


def pixels(box: str, width: str, height: str) -> Column:
    """struct(left, top, right, bottom) in pixels of a fractional box struct(x, y, w, h), clipped to the page."""
    clip = lambda v, most: F.least(F.greatest(F.round(v).cast("int"), F.lit(0)), F.col(most).cast("int"))
    b = F.col(box)
    return F.struct(clip(b["x"] * F.col(width), width).alias("left"), clip(b["y"] * F.col(height), height).alias("top"), clip((b["x"] + b["w"]) * F.col(width), width).alias("right"), clip((b["y"] + b["h"]) * F.col(height), height).alias("bottom"))


def text_lines(words: DataFrame, group: list[str]) -> DataFrame:
    """Lines of OCR words (left, top, width, height, text, word_num): their text in word order and bounding box."""
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("word_num", "text"))), lambda x: x["text"]), " ")
    return words.groupBy(*group).agg(joined.alias("text"), F.min("left").alias("left"), F.min("top").alias("top"), F.max(F.col("left") + F.col("width")).alias("right"), F.max(F.col("top") + F.col("height")).alias("bottom"))


def coverage(found: DataFrame, expected: int, group: list[str], row: str) -> DataFrame:
    """Rows found of those expected: counts, missing numbers and whether the group is complete."""
    g = found.groupBy(*group).agg(F.countDistinct(row).alias("found"), F.collect_set(row).alias("_s"))
    return g.select(*group, "found", F.array_except(F.sequence(F.lit(1), F.lit(expected)), F.col("_s").cast("array<int>")).alias("missing"), (F.col("found") >= expected).alias("complete"))
