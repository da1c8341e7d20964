"""File index: metadata rows, incremental refresh, substring search and counts."""

from __future__ import annotations

import shlex
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.functions.evidence import extension, file_kind
from factloom.functions.ids import detect_log
from factloom.functions.text import fold, path_form


def file_rows(files: DataFrame, path: str = "path", root: str = "") -> DataFrame:
    """Index columns from a path column: relative path, name, parent, extension, kind, log number, search text."""
    relative = F.regexp_replace(F.translate(F.col(path), "\\", "/"), "^" + root.replace("\\", "/").rstrip("/") + "/?", "")
    name = F.substring_index(relative, "/", -1)
    return files.withColumns(
        {
            "relative_path": relative,
            "filename": name,
            "parent_path": F.regexp_replace(relative, "/?[^/]*$", ""),
            "extension": extension(relative),
            "file_kind": file_kind(relative),
            "detected_log": detect_log(name, relative),
            "search_text": path_form(relative),
        }
    )


def refresh(old: DataFrame, new: DataFrame, key: str, compare: list[str], errors: int = 0) -> DataFrame:
    """State of each key after a scan: added, changed, unchanged or deleted. After a scan with errors nothing counts as deleted (kept)."""
    o = old.select(F.col(key), F.struct(*compare).alias("_old"))
    n = new.select(F.col(key), F.struct(*compare).alias("_new"))
    state = F.when(F.col("_old").isNull(), "added").when(F.col("_new").isNull(), F.lit("kept" if errors else "deleted")).when(F.col("_old").eqNullSafe(F.col("_new")), "unchanged").otherwise("changed")
    return o.join(n, key, "full_outer").select(key, state.alias("state"))


def apply_refresh(old: DataFrame, new: DataFrame, key: str, compare: list[str], scan: int, errors: int = 0) -> DataFrame:
    """The next snapshot: new rows, first_seen_scan kept, last_changed_scan moved; missing rows stay only after a scan with errors."""
    o = old.select(F.col(key), F.struct(*compare).alias("_old"), F.col("first_seen_scan").alias("_first"), F.col("last_changed_scan").alias("_last"))
    same = F.col("_old").eqNullSafe(F.struct(*compare))
    out = new.join(o, key, "left").withColumns({"first_seen_scan": F.coalesce("_first", F.lit(scan)), "last_changed_scan": F.when(same, F.col("_last")).otherwise(F.lit(scan))}).drop("_old", "_first", "_last")
    return out.unionByName(old.join(new.select(key), key, "left_anti").select(out.columns)) if errors else out


def missing(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    return old.select(key).join(new.select(key), key, "left_anti")


def search_terms(query: str) -> list[str]:
    """Terms of a query; quotes keep blanks together, unbalanced quotes are ordinary characters."""
    try:
        return [t for t in shlex.split(query) if t]
    except ValueError:
        return query.split()


def matches(query: str, column: str = "search_text") -> Column:
    """Every term of the query is a substring of the (folded) column."""
    return reduce(lambda a, b: a & b, [F.contains(F.col(column), fold(F.lit(t.replace("\\", "/")))) for t in search_terms(query)], F.lit(True))


def search(files: DataFrame, query: str, extensions: tuple[str, ...] = (), kinds: tuple[str, ...] = (), limit: int | None = None) -> DataFrame:
    """Matching files in path order, each with the number of all matches."""
    hits = files.where(matches(query))
    if extensions:
        hits = hits.where(F.col("extension").isin(*[e.lower().lstrip(".") for e in extensions]))
    if kinds:
        hits = hits.where(F.col("file_kind").isin(*kinds))
    hits = hits.join(F.broadcast(hits.agg(F.count("*").alias("total_matches"))))  # one row
    hits = hits.orderBy("search_text")
    return hits.limit(limit) if limit else hits


def statistics(files: DataFrame) -> DataFrame:
    """(metric, name, n): totals, bytes, rows with a log number, and histograms of extension and kind."""
    total = files.agg(F.count("*").alias("files"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"), F.count("detected_log").alias("with_log"))
    wide = total.select(F.inline(F.array(*[F.struct(F.lit("total").alias("metric"), F.lit(c).alias("name"), F.col(c).cast("long").alias("n")) for c in ("files", "bytes", "with_log")])))
    for c in ("extension", "file_kind"):
        wide = wide.unionByName(files.groupBy(F.col(c).alias("name")).agg(F.count("*").alias("n")).select(F.lit(c).alias("metric"), "name", "n"))
    return wide


def stale(stored: DataFrame, current: DataFrame, key: str, modified: str) -> DataFrame:
    """Sources that changed after they were indexed, or that are gone."""
    c = current.select(key, F.col(modified).alias("_now"))
    return stored.join(c, key, "left").where(F.col("_now").isNull() | (F.col("_now") > F.col(modified))).select(key, F.when(F.col("_now").isNull(), "missing").otherwise("changed").alias("reason"))
