"""Recurring groups, keyword rollups, repeated lines and sanitised views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.functions.rules import all_matches, contains_any
from factloom.functions.text import compact, text
from factloom.operators.events import top_per_group

# Service areas and their keywords, in order; they match the label only.
SERVICE_AREAS = {
    "Belts & tension": ("belt", "belts", "tension", "retension"),
    "A1/A2 arms & geometry": ("a1", "a2", "arm", "arms", "elbow", "wrist", "b/roll", "b/r", "sweep", "swoop", "linearity"),
    "Motors & harmonics": ("motor", "motors", "harmonic", "harmonics", "brush", "brushes", "commutator", "comm life", "suck motors", "blew out motors"),
    "Z-axis mechanics": ("lead screw", "lead screws", "leadscrew", "z-axis", "z axis", "z1", "z2", "z3", "z motor", "z motors", "z slide", "z rail"),
    "Vacuum system": ("vacuum", "vac ", "vac_", "vac solenoid", "vac solenoids", "vac line", "vac lines", "vacuum line", "vacuum lines", "43um", "43 um"),
    "Sensors / scanner / connectors": ("sensor", "sensors", "scanner", "connector", "connectors", "encoder", "encoders", "home flag", "home sensor", "protrusion"),
    "Cleaning / lubrication": ("clean", "cleaned", "regreas", "grease", "lub", "sucked", "blew out", "contact cleaner"),
    "Refurbishment / rebuild": ("refurb", "refurbish", "rebuild", "rebuilt", "refreshed", "complete refurb"),
    "Servo / drift / homing": ("servo", "drift", "drifting", "home", "homing", "maximum axis", "max axis"),
}
# Stocking items, their keywords and kinds.
STOCKING = {
    "Belts": (("belt", "belts"), "wear item"),
    "Bearings": (("bearing", "bearings", " bears", "bers", "r8zz", "r6zz", "nmb"), "rebuild item"),
    "Motor brushes": (("brush", "brushes"), "motor rebuild item"),
    "Vacuum lines / tubing": (("vac line", "vac lines", "vacuum line", "vacuum lines", "vac lanes"), "wear/service item"),
    "Vacuum solenoids": (("vac solenoid", "vac solenoids", "vacuum solenoid", "vacuum solenoids"), "vacuum component"),
    "Vacuum filters": (("43 um", "43um", "vac filter", "vacuum filter"), "vacuum component"),
    "Lubricants / grease": (("grease", "regreas", "lubric"), "service consumable"),
    "Shims / spacers": (("shim", "shims", "spacer", "spacers"), "mechanical setup item"),
    "Sensors": (("sensor", "sensors", "scanner", "protrusion"), "electromechanical component"),
    "Connector pins / contacts": (("connector pin", "connector pins", "connectors", " pin ", "pins"), "electrical service item"),
    "Encoders": (("encoder", "encoders"), "motion component"),
    "Motor assemblies / rebuild parts": (("motor", "motors", "harmonic", "harmonics"), "major rebuild attention"),
}
# Words of an action on a part.
ACTION_CUES = ("replace", "replaced", "new ", "rebuilt", "rebuild", "refurb", "changed", "installed", "machined", "renewed", "cleaned", "regreased", "relubed", "serviced", "repaired")
OTHER_AREA = "Other technician signal"


def recurring(candidates: DataFrame, group: list[str], log: str, source: str, serial: str | None = None, least: int = 2, parts: int | None = None) -> DataFrame:
    """Groups with at least ``least`` distinct logs and distinct sources; copies of one source under two logs do not recur.

    Values are counted by shares of each group, dealt by value to ``parts`` partitions (the session's number if None), so no task holds a group's values.
    """
    names = {"distinct_logs": log, "distinct_sources": source} | ({"distinct_serials": serial} if serial else {})
    none = F.lit(None).cast("long")
    rows = None
    for name, c in names.items():
        pairs = candidates.select(*group, F.col(c).alias("_v"))
        dealt = pairs.repartition(parts, *group, "_v") if parts else pairs.repartition(*group, "_v")
        one = dealt.groupBy(*group, "_v").agg(F.count("*").alias("_n")).groupBy(*group).agg(F.sum("_n").alias("_n"), F.count("_v").alias("_k"))
        one = one.select(*group, (F.col("_n") if name == "distinct_logs" else none).alias("candidates"), *[(F.col("_k") if x == name else none).alias(x) for x in names])
        rows = one if rows is None else rows.unionByName(one)
    out = rows.groupBy(*group).agg(*[F.sum(c).alias(c) for c in ("candidates", *names)])
    return out.where((F.col("distinct_logs") >= least) & (F.col("distinct_sources") >= least))


def service_areas(label: Column, rules: dict[str, tuple[str, ...]] = SERVICE_AREAS, other: str = OTHER_AREA) -> Column:
    """Every area with a keyword in the (lower-case) label; the other area alone if there is none."""
    return all_matches([(area, contains_any(label, words)) for area, words in rules.items()], other)


def area_rollup(rows: DataFrame, label: Column, group: str, log: str, serial: str, rules: dict[str, tuple[str, ...]] = SERVICE_AREAS) -> DataFrame:
    """Distinct groups, logs and serials, and candidate rows, of each area. ``rows``: the evidence rows of the groups; a group counts in each of its areas."""
    tagged = rows.withColumn("service_area", F.explode(service_areas(label, rules)))
    return tagged.groupBy("service_area").agg(F.countDistinct(group).alias("groups"), F.count("*").alias("candidate_sum"), F.countDistinct(log).alias("logs"), F.countDistinct(serial).alias("serials"))


def area_patterns(groups: DataFrame, label: Column, order: list[Column | str], n: int = 8, rules: dict[str, tuple[str, ...]] = SERVICE_AREAS) -> DataFrame:
    """The leading groups of each area."""
    return top_per_group(groups.withColumn("service_area", F.explode(service_areas(label, rules))), ["service_area"], order, n)


def stocking(rows: DataFrame, group: str, lane: str, label: Column, log: str, serial: str, body: str, rules: dict = STOCKING, cues: tuple[str, ...] = ACTION_CUES) -> DataFrame:
    """Items worth stocking, with their coverage, from the evidence rows of the groups.

    A group counts for an item if its label names it, with all its rows; or, in the lane of repairs, if rows of two logs or more
    both name the item and an action, with these rows alone.
    """
    items = F.array(*[F.struct(F.lit(k).alias("item"), F.lit(kind).alias("kind"), F.array(*[F.lit(w) for w in words]).alias("words")) for k, (words, kind) in rules.items()])
    holds = lambda s, words: F.exists(words, lambda w: F.contains(s, w))
    known = rows.where(F.col(lane).isin("components", "repairs")).select(F.col(group).alias("_g"), lane, label.alias("_label"), F.col(log).alias("_log"), F.col(serial).alias("_serial"), F.lower(compact(body)).alias("_t"))
    acted = contains_any(F.col("_t"), cues) & (F.col(lane) == "repairs")
    found = known.withColumn("_acted", acted).select("_g", "_label", "_log", "_serial", "_t", F.explode(F.filter(items, lambda i: holds(F.col("_label"), i["words"]) | (F.col("_acted") & holds(F.col("_t"), i["words"])))).alias("_i"))
    hit = found.select("_g", "_log", "_serial", F.col("_i.item").alias("item"), F.col("_i.kind").alias("kind"), holds(F.col("_label"), F.col("_i.words")).alias("_by_label"))
    repeated = hit.where(~F.col("_by_label")).groupBy("item", "_g").agg(F.countDistinct("_log").alias("_k")).where(F.col("_k") >= 2).select("item", "_g")
    hit = hit.where("_by_label").unionByName(hit.where(~F.col("_by_label")).join(repeated, ["item", "_g"], "left_semi").select(hit.columns))
    return hit.groupBy("item", "kind").agg(
        F.countDistinct("_g").alias("groups"), F.countDistinct("_log").alias("logs"), F.countDistinct(F.when(F.col("_serial").cast("string") != "?", F.col("_serial"))).alias("serials"), F.countDistinct(F.when(F.col("_by_label"), F.col("_g"))).alias("by_label")
    )


def evidence_of(groups: DataFrame, variants: str = "raw_variants") -> DataFrame:
    """The evidence rows of groups that carry them in an array of structs; a group without rows gives one empty row."""
    return groups.withColumn("_v", F.explode_outer(variants)).select(*[c for c in groups.columns if c != variants], "_v.*")


def repeated_lines(docs: DataFrame, key: str, body: str, shortest: int = 18, least: int = 2) -> DataFrame:
    """Lines of ``shortest`` characters or more, white space and case folded, that stand in ``least`` documents or more."""
    lines = docs.select(key, F.explode(F.split(body, "\n")).alias("_l")).select(key, F.trim("_l").alias("_l")).where(F.length("_l") >= shortest)
    return lines.select(key, F.lower(compact("_l")).alias("line")).groupBy("line").agg(F.countDistinct(key).alias("documents"), F.count("*").alias("occurrences")).where(F.col("documents") >= least)


def sanitised(docs: DataFrame, key: str, body: str, drop: list[tuple[str, str]], prefixes: list[str] = []) -> DataFrame:  # noqa: B006
    """A working view of each text: lines that match a pattern as a whole become empty, known prefixes go; the source is left alone.

    The view keeps the line order; dropped counts the emptied lines.
    """
    line = lambda x: F.trim(x)

    def noisy(x: Column) -> Column:
        out = F.lit(False)
        for _, p in drop:
            out = out | compact(x).rlike(f"^(?:{p})$")
        return out

    def stripped(x: Column) -> Column:
        for p in prefixes:
            x = F.regexp_replace(x, f"^(?:{p})", "")
        return x

    lines = F.split(text(body), "\n")
    view = F.transform(lines, lambda x: F.when(noisy(x), F.lit("")).otherwise(stripped(x) if prefixes else x))
    dropped = F.size(F.filter(lines, lambda x: (line(x) != "") & noisy(x)))
    return docs.select(key, F.array_join(view, "\n").alias("view"), dropped.cast("long").alias("dropped"))


def union_coverage(members: DataFrame, ids: str) -> DataFrame:
    """Distinct ids over all groups, from their members as rows (or as arrays)."""
    kind = members.schema[ids].dataType.typeName()
    x = F.explode(ids) if kind == "array" else F.col(ids)
    return members.select(x.alias("x")).distinct().agg(F.count("x").alias("covered"))


def consolidate(clusters: DataFrame, lane: str, key: str, members: str, label: str, generic: tuple[str, ...] = ("", "unknown", "other")) -> DataFrame:
    """Clusters of one lane with the same key become one; generic keys stay apart."""
    k = F.when(F.lower(F.col(key)).isin(*generic) | F.col(key).isNull(), F.concat(F.lit("#"), F.col("cluster_id"))).otherwise(F.lower(F.col(key)))
    return clusters.groupBy(lane, k.alias("group_key")).agg(F.min("cluster_id").alias("cluster_id"), F.array_sort(F.array_distinct(F.flatten(F.collect_list(members)))).alias(members), F.min(label).alias(label))
