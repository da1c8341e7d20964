"""Joins of intervals that overlap, and what is read off them: runs of ink in bands, rules in boxes.

Intervals are half open, [start, stop).  An interval lives on the level whose bins are at least as wide as it is, so it lies in at most two of them, however long it is; on higher levels
as well.  Two intervals meet on the level of the longer one, once, in the first bin that they share: no bin is filled by copies of long intervals, and rows
grow by the number of levels at most, the logarithm of the longest interval.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.storage import materialize


def _level(width: int) -> Column:
    length = (F.col("_stop") - F.col("_start")).cast("double")
    return F.greatest(F.lit(0), F.ceil(F.log2(F.greatest(length, F.lit(1.0)) / width))).cast("int")


def overlap_join(left: DataFrame, right: DataFrame, group: list[str], bounds: tuple[str, str], other: tuple[str, str], width: int = 64) -> DataFrame:
    """Columns of ``left`` and ``right`` (the group's once) and ``overlap`` for each pair of one group whose intervals share more than an end.

    Bounds are whole numbers; an empty interval, and null bounds or groups, overlap nothing.
    """
    def side(df: DataFrame, ends: tuple[str, str], mark: str) -> DataFrame:
        s = df.withColumns({"_start": F.col(ends[0]).cast("long"), "_stop": F.col(ends[1]).cast("long")}).where("_start < _stop").withColumn("_level", _level(width))
        keep = [c for c in df.columns if c not in group]
        return materialize(s.select(*group, F.struct(*[F.col(c) for c in keep]).alias(f"_{mark}"), F.col("_start").alias(f"_{mark}0"), F.col("_stop").alias(f"_{mark}1"), F.col("_level").alias(f"_{mark}l")), "intervals")

    a, b = side(left, bounds, "a"), side(right, other, "b")
    tops = [df.agg(F.array_sort(F.collect_set(f"_{m}l")).alias("x")).first()["x"] for df, m in ((a, "a"), (b, "b"))]  # levels that there are, some 60 at most

    def on(df: DataFrame, m: str, levels: list[int], above: bool) -> DataFrame:
        """The bins of each interval on its own level, or on the other side's levels from its own (``above``: beyond it) up."""
        own = F.array(F.col(f"_{m}l")) if levels is None else F.filter(F.array(*[F.lit(x) for x in levels]).cast("array<int>"), lambda x: x > F.col(f"_{m}l") if above else x >= F.col(f"_{m}l"))
        placed = df.withColumn("_on", F.explode(own))
        size = width * F.pow(F.lit(2.0), F.col("_on"))
        first, last = F.floor(F.col(f"_{m}0") / size), F.floor((F.col(f"_{m}1") - 1) / size)
        return placed.withColumn(f"_{m}f", first).withColumn("_bin", F.explode(F.sequence(first, last)))

    join = lambda x, y: x.join(y, [*group, "_on", "_bin"]).where((F.col("_bin") == F.greatest("_af", "_bf")) & (F.col("_a0") < F.col("_b1")) & (F.col("_b0") < F.col("_a1")))
    pairs = join(on(a, "a", None, False), on(b, "b", tops[0], False)).unionByName(join(on(a, "a", tops[1], True), on(b, "b", None, False)))
    return pairs.select(*group, "_a.*", "_b.*", (F.least("_a1", "_b1") - F.greatest("_a0", "_b0")).alias("overlap"))


def bands_with_runs(bands: DataFrame, runs: DataFrame, group: list[str], band: str, top: str, bottom: str, start: str, end: str) -> DataFrame:
    """group, band, runs, ink_start, ink_end, has_ink of each band [top, bottom), from runs whose ``end`` still belongs to them; a band without ink has null ends."""
    r = runs.select(*group, F.col(start).alias("_run0"), F.col(end).alias("_run1"), (F.col(end) + 1).alias("_run2"))
    met = overlap_join(bands.select(*group, band, top, bottom), r, group, (top, bottom), ("_run0", "_run2"))
    found = met.groupBy(*group, band).agg(F.count("*").alias("runs"), F.min("_run0").alias("ink_start"), F.max("_run1").alias("ink_end"))
    return bands.select(*group, band).join(found, [*group, band], "left").withColumn("runs", F.coalesce("runs", F.lit(0).cast("long"))).withColumn("has_ink", F.col("runs") > 0)


def box_overlaps(boxes: DataFrame, rules: DataFrame, group: list[str], box: tuple[str, str, str, str], rule: tuple[str, str, str, str]) -> DataFrame:
    """Pairs of boxes and rules (x0, y0, x1, y1, half open) that overlap in both directions, with ``overlap`` along y and ``across`` along x."""
    met = overlap_join(boxes, rules, group, (box[1], box[3]), (rule[1], rule[3]))
    across = F.least(box[2], rule[2]) - F.greatest(box[0], rule[0])
    return met.withColumn("across", across).where(F.col("across") > 0)
