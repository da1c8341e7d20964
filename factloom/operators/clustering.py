"""Clusters by replaceable proposals: batches, validation, merging by key, and rounds of merging up to a fixpoint.

Proposals come from a function of a batch, run in the tasks; all that is done with them is relational.  A batch is bounded by a budget, so no task sees more
than it.  Every round is written before the next begins (``sources.versions.Stages``), so an interrupted run goes on at its round.

Groups of a proposal are dicts with ``members`` and, where it has them, ``label`` and ``key``.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from factloom.functions.text import compact, text
from factloom.operators.similar import components
from factloom.sources.versions import Stages, rows_signature
from factloom.storage import materialize

Proposer = Callable[[list[dict]], list[dict]]

#: Keys that say too little to merge by.
GENERIC_KEYS = (
    "repair", "repairs", "service", "component", "components", "part", "parts", "failure", "failures", "diagnostic", "diagnostics", "test", "testing", "process", "term", "terms",
    "other", "misc", "miscellaneous", "unknown", "general", "robot", "equipment",
)
LEAST_KEY = 4

#: Families of a batch that the next one of a round sees again.
CARRIED = 3

_PROPOSED = "lane string, batch long, grp int, at int, member string, label string, key string, failed boolean"


def concept_key(c: Column | str, longest: int = 72) -> Column:
    """Lower-case letters and digits with underscores between; ``cluster`` if there are none."""
    s = F.regexp_replace(F.regexp_replace(F.lower(text(c)), "[^a-z0-9]+", "_"), "^_+|_+$", "")
    s = F.regexp_replace(F.substring(s, 1, longest), "_+$", "")
    return F.when(s == "", F.lit("cluster")).otherwise(s)


def running_totals(rows: DataFrame, lane: str, order: list[str], size: str) -> DataFrame:
    """``rows`` with ``before``, the sum of ``size`` over the rows that stand before a row in its lane.

    Rows are cut into ranges of (lane, order), whose sums are a small table; no lane is one task's.
    """
    ranged = materialize(rows.repartitionByRange(lane, *order).withColumn("_range", F.spark_partition_id()), "ranges")
    sums = ranged.groupBy("_range", lane).agg(F.sum(size).alias("_sum"))
    earlier = Window.partitionBy(lane).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row a lane and range
    offsets = sums.select("_range", lane, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_range", lane).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return ranged.withColumn("_inside", F.coalesce(F.sum(size).over(inside), F.lit(0))).join(offsets, ["_range", lane]).withColumn("before", F.col("_offset") + F.col("_inside")).drop("_range", "_inside", "_offset")


def fill_batches(rows: DataFrame, lane: str, order: list[str], size: str, budget: int) -> DataFrame:
    """``rows`` with ``batch``: a lane's rows in order, a new batch whenever their sizes have passed another ``budget``. A batch exceeds the budget by less than its last row."""
    return running_totals(rows, lane, order, size).withColumn("batch", F.floor(F.col("before") / budget)).drop("before")


def propose(batches: DataFrame, proposer: Proposer, retries: int = 1) -> DataFrame:
    """Proposed groups of each (lane, batch) as rows, one a member; a batch whose proposals fail after the retries has one row with ``failed``.

    batches: lane, batch, id and what else the proposer reads.
    """
    columns = [c for c in batches.columns if c not in ("lane", "batch")]

    def run(p: pd.DataFrame) -> pd.DataFrame:
        lane, batch = p["lane"].iloc[0], int(p["batch"].iloc[0])
        items = p.sort_values("id")[columns].to_dict("records")
        for left in range(retries, -1, -1):
            try:
                groups = proposer(items)
                break
            except Exception:  # noqa: BLE001  a model's failure leaves single items
                if not left:
                    return pd.DataFrame([(lane, batch, None, None, None, None, None, True)], columns=[c.split()[0] for c in _PROPOSED.split(", ")])
        found = [(lane, batch, i, at, str(m), g.get("label"), g.get("key"), False) for i, g in enumerate(groups) if isinstance(g, dict) for at, m in enumerate(g.get("members") or [])]
        return pd.DataFrame(found, columns=[c.split()[0] for c in _PROPOSED.split(", ")])

    return batches.groupBy("lane", "batch").applyInPandas(run, _PROPOSED)


def content_of(kind: str, member: str = "member") -> Column:
    """An aggregate: the identity of a set of members of a lane. It adds up hashes, so that the members are not gathered."""
    total = F.sum(F.xxhash64(member).cast("decimal(38,0)")).cast("string")
    return F.concat(F.lit("cl_"), F.substring(F.sha2(F.concat_ws("\n", F.first("lane"), F.lit(kind), F.count("*").cast("string"), total, F.bit_xor(F.xxhash64(member, F.lit(1))).cast("string")), 256), 1, 16))


def valid_groups(proposed: DataFrame, batches: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clusters, members) of proposals: known members only, each in the first group that names it; every other item is a cluster of its own.

    clusters: cluster_id, lane, label, key; members: cluster_id, member. batches: lane, batch, id (text), raw.
    """
    items = batches.select("lane", "batch", F.col("id").cast("string").alias("member"), compact("raw").alias("raw"))
    known = proposed.where(~F.col("failed")).join(items, ["lane", "batch", "member"])
    first = known.withColumn("n", F.row_number().over(Window.partitionBy("lane", "batch", "member").orderBy("grp", "at"))).where(F.col("n") == 1).drop("n")
    label = F.coalesce(F.nullif(compact(F.max("label")), F.lit("")), F.substring(F.min_by("raw", "at"), 1, 80))
    grouped = first.groupBy("lane", "batch", "grp").agg(content_of("group").alias("cluster_id"), label.alias("label"), F.max("key").alias("given"))
    named = grouped.select("lane", "batch", "grp", "cluster_id", "label", concept_key(F.coalesce(F.nullif("given", F.lit("")), F.col("label"))).alias("key"))
    single = items.join(first.select("lane", "batch", "member"), ["lane", "batch", "member"], "left_anti").select("lane", "member", F.when(F.col("raw") == "", F.col("member")).otherwise(F.col("raw")).alias("raw"))
    single = single.withColumn("cluster_id", F.concat(F.lit("cl_"), F.substring(F.sha2(F.concat_ws("\n", "lane", "member"), 256), 1, 16)))
    clusters = named.select("cluster_id", "lane", "label", "key").unionByName(single.select("cluster_id", "lane", F.substring("raw", 1, 80).alias("label"), concept_key("raw").alias("key")))
    members = first.join(named.select("lane", "batch", "grp", "cluster_id"), ["lane", "batch", "grp"]).select("cluster_id", "member").unionByName(single.select("cluster_id", "member"))
    return clusters, members


def rejected_members(proposed: DataFrame, batches: DataFrame) -> DataFrame:
    """(lane, batch, grp, member, reason) of what a proposal names in vain: unknown, or assigned to a group before."""
    items = batches.select("lane", "batch", F.col("id").cast("string").alias("member"), F.lit(True).alias("known"))
    seen = proposed.where(~F.col("failed")).join(items, ["lane", "batch", "member"], "left")
    at = F.row_number().over(Window.partitionBy("lane", "batch", "member").orderBy("grp", "at"))
    reason = F.when(F.col("known").isNull(), "unknown").when(at > 1, "assigned")
    return seen.withColumn("reason", reason).where(F.col("reason").isNotNull()).select("lane", "batch", "grp", "member", "reason")


def _most_common(rows: DataFrame, by: list[str], value: str) -> DataFrame:
    """The most frequent non-empty value, the smallest of equally frequent ones."""
    counted = rows.where(F.col(value) != "").groupBy(*by, value).agg(F.count("*").alias("n"))
    return counted.groupBy(*by).agg(F.min_by(value, F.struct(-F.col("n"), value)).alias(value))


def join_clusters(clusters: DataFrame, members: DataFrame, root: DataFrame, names: DataFrame, kind: str) -> tuple[DataFrame, DataFrame]:
    """(clusters, members) after clusters of one root became one. root: cluster_id, root; names: root, label, key, where there are any."""
    placed = clusters.join(root, "cluster_id", "left").withColumn("joined", F.col("root").isNotNull()).withColumn("root", F.coalesce("root", "cluster_id"))
    moved = members.join(placed.select("cluster_id", "root", "joined", "lane"), "cluster_id").select("root", "member", "joined", "lane")
    new_ids = moved.where("joined").groupBy("root").agg(content_of(kind).alias("new_id"))
    own = [_most_common(placed.where("joined"), ["root"], c).withColumnRenamed(c, f"own_{c}") for c in ("label", "key")]
    named = new_ids.join(names, "root", "left").join(own[0], "root", "left").join(own[1], "root", "left").select("root", "new_id", F.coalesce("label", "own_label").alias("label"), F.coalesce("key", "own_key").alias("key"))
    lanes = placed.where("joined").groupBy("root").agg(F.min("lane").alias("lane"))
    new_clusters = placed.where(~F.col("joined")).select("cluster_id", "lane", "label", "key").unionByName(named.join(lanes, "root").select(F.col("new_id").alias("cluster_id"), "lane", "label", "key"))
    new_members = moved.where(~F.col("joined")).select(F.col("root").alias("cluster_id"), "member").unionByName(moved.where("joined").join(new_ids, "root").select(F.col("new_id").alias("cluster_id"), "member"))
    return new_clusters, new_members


def merge_by_key(clusters: DataFrame, members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Clusters of one lane and key become one; generic keys and those under LEAST_KEY characters merge nothing."""
    telling = clusters.where(~F.col("key").isin(*GENERIC_KEYS) & (F.length("key") >= LEAST_KEY))
    shared = telling.groupBy("lane", "key").agg(F.count("*").alias("n"), F.min("cluster_id").alias("root")).where(F.col("n") > 1)
    root = telling.join(shared.select("lane", "key", "root"), ["lane", "key"]).select("cluster_id", "root")
    names = shared.select("root", F.lit(None).cast("string").alias("label"), "key")
    return join_clusters(clusters, members, root, names, "exact_key")


def cluster_summaries(clusters: DataFrame, members: DataFrame, items: DataFrame, examples: int = 3) -> DataFrame:
    """What a merge proposal reads of a cluster: lane, id, label, key, candidates, logs and up to three texts, with ``size``, about its characters.

    items: id (text), raw, log.
    """
    each = members.join(items.select(F.col("id").cast("string").alias("member"), compact("raw").alias("raw"), "log"), "member")
    counts = each.groupBy("cluster_id").agg(F.count("*").alias("candidates"), F.count_distinct("log").alias("logs"))
    texts = each.where(F.col("raw") != "").groupBy("cluster_id", F.lower("raw").alias("folded")).agg(F.min(F.substring("raw", 1, 300)).alias("raw"))
    first = texts.withColumn("n", F.row_number().over(Window.partitionBy("cluster_id").orderBy("folded"))).where(F.col("n") <= examples)
    shown = first.groupBy("cluster_id").agg(F.array_sort(F.collect_list("raw")).alias("examples"))
    out = clusters.join(counts, "cluster_id").join(shown, "cluster_id", "left").withColumnRenamed("cluster_id", "id")
    return out.withColumn("size", F.length("label") + F.length("key") + F.length(F.concat_ws(" ", "examples")) + 80)


def overlap_batches(summaries: DataFrame, budget: int, overlap: int) -> DataFrame:
    """fill_batches() by key and label, where each batch also has the last ``overlap`` rows of the one before, so that neighbours across a border can merge."""
    batches = materialize(fill_batches(summaries.withColumn("order", concept_key("key")), "lane", ["order", "label", "id"], "size", budget), "batches")
    last = F.row_number().over(Window.partitionBy("lane", "batch").orderBy(F.desc("order"), F.desc("label"), F.desc("id")))
    there = batches.select("lane", "batch").distinct()
    after = there.select("lane", F.lead("batch").over(Window.partitionBy("lane").orderBy("batch")).alias("next"), "batch")  # a row a batch
    carried = batches.withColumn("n", last).where(F.col("n") <= overlap).drop("n").join(after.where("next IS NOT NULL"), ["lane", "batch"]).withColumn("batch", F.col("next")).drop("next")
    return batches.unionByName(carried).drop("order")


def valid_merges(proposed: DataFrame, batches: DataFrame) -> DataFrame:
    """Proposed merges that name known clusters only, and two at least: lane, batch, grp, at, member, label, key."""
    items = batches.select("lane", "batch", F.col("id").alias("member"), F.lit(1).alias("known")).distinct()
    each = proposed.where(~F.col("failed")).dropDuplicates(["lane", "batch", "grp", "member"]).join(items, ["lane", "batch", "member"], "left")
    good = each.groupBy("lane", "batch", "grp").agg(F.count("*").alias("n"), F.count("known").alias("k")).where((F.col("n") == F.col("k")) & (F.col("n") >= 2))
    return each.join(good.select("lane", "batch", "grp"), ["lane", "batch", "grp"], "left_semi").drop("known", "failed")


def apply_merges(clusters: DataFrame, members: DataFrame, merges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clusters, members) after the components of the merges became one each, named by their most frequent proposal, else by their clusters."""
    first = merges.groupBy("lane", "batch", "grp").agg(F.min_by("member", "at").alias("a"))
    links = merges.join(first, ["lane", "batch", "grp"]).where(F.col("member") != F.col("a")).select("a", F.col("member").alias("b"))
    root = materialize(components(links).select(F.col("vertex").alias("cluster_id"), F.col("component").alias("root")), "roots")
    groups = merges.groupBy("lane", "batch", "grp").agg(F.min("member").alias("cluster_id"), compact(F.max("label")).alias("label"), concept_key(F.coalesce(F.nullif(F.max("key"), F.lit("")), F.max("label"), F.lit("merged"))).alias("key")).join(root, "cluster_id")
    names = _most_common(groups, ["root"], "label").join(_most_common(groups, ["root"], "key"), "root", "full")
    return join_clusters(clusters, members, root, names, "merge")


def cluster(items: DataFrame, first: Proposer, merge: Proposer, folder: str, budget: int = 22_000, overlap: int = 3, rounds: int = 3, settings: str = "") -> tuple[DataFrame, DataFrame, list[dict]]:
    """(clusters, members, statistics of the rounds) of items (lane, id, raw, log).

    Items are proposed to ``first`` in batches of about ``budget`` characters, ordered by text; the valid groups are merged by key, and then by ``merge`` over summaries of clusters, round by round,
    until a round merges nothing or ``rounds`` are done.  ``settings`` names the proposers' versions: results under ``folder`` of equal items and settings are used again.
    """
    spark = items.sparkSession
    stages = Stages(spark, folder, rows_signature(items, budget, overlap, settings))
    items = items.withColumn("id", F.col("id").cast("string"))
    order = items.withColumn("order", F.lower(compact("raw"))).withColumn("size", F.length(compact("raw")) + F.length("id") + 40)
    batches = stages.table("batches", lambda: fill_batches(order, "lane", ["order", "log", "id"], "size", budget).drop("order"))
    proposed = stages.table("proposed", lambda: propose(batches.select("lane", "batch", "id", "raw", "log"), first))
    grouped = valid_groups(proposed, batches)
    start = merge_by_key(stages.table("grouped-clusters", lambda: grouped[0]), stages.table("grouped-members", lambda: grouped[1]))
    clusters, members = stages.table("clusters-0", lambda: start[0]), stages.table("members-0", lambda: start[1])
    statistics = []
    for k in range(1, rounds + 1):
        now = (clusters, members)
        batch = stages.table(f"batches-{k}", lambda now=now: overlap_batches(cluster_summaries(*now, items), budget, overlap))
        answers = stages.table(f"proposed-{k}", lambda batch=batch: propose(batch.drop("size"), merge))
        merges = stages.table(f"merges-{k}", lambda answers=answers, batch=batch: valid_merges(answers, batch))
        done = merges.isEmpty()
        if not done:
            new = apply_merges(clusters, members, merges)
            clusters, members = stages.table(f"clusters-{k}", lambda new=new: new[0]), stages.table(f"members-{k}", lambda new=new: new[1])
        statistics.append({"round": k, "clusters_before": now[0].count(), "batches": batch.select("lane", "batch").distinct().count(), "merges": merges.select("lane", "batch", "grp").distinct().count(), "failed": answers.where("failed").count(), "clusters_after": clusters.count()})
        if done:
            break
    return clusters, members, statistics


def families(signals: DataFrame, first: Proposer, merge: Proposer, folder: str, most: int = 60, settings: str = "") -> DataFrame:
    """(family_id, label, member): signals (lane, id, raw, log) grouped in batches of ``most`` within their class, and the groups once more over all classes.

    A group of one stays a family. The merge reads summaries in batches of ``most`` as well, ordered by key, and names known groups; what it leaves out stays as it is. Where that takes
    several batches, rounds follow in which a batch has the last CARRIED families of the one before, until a round merges nothing, so that a border parts no family.
    """
    stages = Stages(signals.sparkSession, folder, rows_signature(signals, "families", most, settings))
    signals = signals.withColumn("id", F.col("id").cast("string"))
    batches = stages.table("batches", lambda: fill_batches(signals.withColumn("size", F.lit(1)).withColumn("order", F.lower("raw")), "lane", ["order", "id"], "size", most).drop("order", "size"))
    proposed = stages.table("proposed", lambda: propose(batches, first))
    made = valid_groups(proposed, batches)
    clusters, members = stages.table("clusters", lambda: made[0]), stages.table("members", lambda: made[1])
    summaries = cluster_summaries(clusters, members, signals).withColumn("lane", F.lit("all")).withColumn("size", F.lit(1))
    again = stages.table("merge-batches", lambda: fill_batches(summaries, "lane", ["key", "id"], "size", most).drop("size"))
    answers = stages.table("merge-proposed", lambda: propose(again, merge))
    merged = valid_groups(answers, again.withColumn("raw", F.col("label")))
    top, parts = stages.table("merge-clusters", lambda: merged[0]), stages.table("merge-members", lambda: merged[1])
    inside = stages.table("merge-inside", lambda: parts.withColumnRenamed("cluster_id", "grp").withColumnRenamed("member", "cluster_id").join(members, "cluster_id").select(F.col("grp").alias("cluster_id"), "member"))
    k, split = 0, again.select("batch").distinct().count() > 1
    while split:  # every round has fewer families than the one before, or is the last
        k += 1
        now = (top, inside)
        summary = cluster_summaries(*now, signals).withColumn("size", F.lit(1))
        batch = stages.table(f"merge-batches-{k}", lambda summary=summary: overlap_batches(summary, max(1, most - CARRIED), CARRIED))
        said = stages.table(f"merge-proposed-{k}", lambda batch=batch: propose(batch.drop("size"), merge))
        merges = stages.table(f"merge-merges-{k}", lambda said=said, batch=batch: valid_merges(said, batch))
        split = not merges.isEmpty()
        if split:
            new = apply_merges(*now, merges)
            top, inside = stages.table(f"merge-clusters-{k}", lambda new=new: new[0]), stages.table(f"merge-inside-{k}", lambda new=new: new[1])
    named = inside.withColumn("lane", F.lit("all")).groupBy("cluster_id").agg(F.concat(F.lit("ff_"), F.substring(content_of("family"), 4, 16)).alias("family_id")).join(top.select("cluster_id", "label"), "cluster_id")
    return inside.join(named, "cluster_id").select("family_id", "label", "member")


def normalized_descriptors(descriptors: DataFrame, pairs: DataFrame, proposer: Proposer, most: int = 40) -> DataFrame:
    """(family_id, label, member): descriptors (id, raw, log) grouped within the components of candidate pairs (a, b), of which whole ones fill batches of ``most``.

    A descriptor without a pair, or left out by the proposer, is a family of its own.
    """
    from factloom.operators.packing import pack_components

    ids = descriptors.select(F.col("id").cast("string").alias("id"), "raw", "log")
    label = components(pairs.select(F.col("a").cast("string").alias("a"), F.col("b").cast("string").alias("b")))
    placed = materialize(label.select(F.lit("all").alias("lane"), "component", F.col("vertex").alias("id")), "components")
    batches = materialize(pack_components(placed, "lane", "component", "id", most).select("lane", F.col("batch").cast("long").alias("batch"), "id", F.col("component").alias("candidate_component")).join(ids, "id"), "batches")
    alone = ids.join(placed, "id", "left_anti").select(F.lit("all").alias("lane"), F.lit(-1).cast("long").alias("batch"), "id", F.col("id").alias("candidate_component"), "raw", "log")
    none = propose(batches, proposer)
    clusters, members = valid_groups(none, batches.unionByName(alone))
    members = materialize(members, "members")
    named = members.withColumn("lane", F.lit("all")).groupBy("cluster_id").agg(F.concat(F.lit("pf_"), F.substring(content_of("family"), 4, 16)).alias("family_id"))
    return members.join(named, "cluster_id").join(clusters.select("cluster_id", "label"), "cluster_id").select("family_id", "label", "member")
