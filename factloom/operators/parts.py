"""Part families: frequency over distinct events, product tables, descriptors and part-number groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factloom.functions.ids import content_id
from factloom.functions.text import alnum_upper, compact, fold, text
from factloom.operators.events import first_by_key, mode, top_per_group


def frequency(mentions: DataFrame, family: str, event: str, quantity: str, uncertain: Column | None = None) -> DataFrame:
    """Usage of each family: distinct events, pieces of stated quantity, mentions without one and uncertain mentions.

    Mentions of one event add their pieces but count the event once; an unstated quantity is not zero.
    """
    return mentions.withColumn("_u", F.coalesce(uncertain, F.lit(False)) if uncertain is not None else F.lit(False)).groupBy(family).agg(
        F.countDistinct(event).alias("repairs"), F.coalesce(F.sum(quantity), F.lit(0)).cast("long").alias("pieces"), F.count_if(F.col(quantity).isNull()).alias("unstated"), F.count_if("_u").alias("uncertain"), F.count("*").alias("mentions")
    )


def examples(mentions: DataFrame, family: str, event: str, n: int = 20) -> DataFrame:
    """The n smallest events of each family, as rows."""
    return top_per_group(mentions.select(family, event).distinct(), [family], [event], n)


def component_key(part_number: str, description: str) -> Column:
    """pn: and the part number's letters and digits; else text: and the first 96 of the description; else its SHA-1."""
    pn = alnum_upper(part_number)
    words = F.substring(F.regexp_replace(fold(compact(description)), "[^a-z0-9]+", ""), 1, 96)
    return F.when(compact(part_number) != "", F.concat(F.lit("pn:"), pn)).when(words != "", F.concat(F.lit("text:"), words)).otherwise(F.concat(F.lit("text:"), F.substring(F.sha1(compact(description)), 1, 16)))


def product_parts(mentions: DataFrame, family: str, event: str, part_number: str, description: str, quantity: str, order: str) -> DataFrame:
    """Usage of each component of a family with its most frequent part number and description."""
    keyed = mentions.withColumn("component_key", component_key(part_number, description))
    use = frequency(keyed.withColumn("_k", F.struct(family, "component_key")), "_k", event, quantity).select(F.col(f"_k.{family}").alias(family), F.col("_k.component_key").alias("component_key"), "repairs", "pieces", "unstated")
    group = [family, "component_key"]
    pn = mode(keyed.where(compact(part_number) != ""), group, part_number, order).select(*group, F.col(part_number).alias("likely_part_number"))
    words = mode(keyed.where(compact(description) != ""), group, description, order).select(*group, F.col(description).alias("likely_description"))
    return use.join(pn, group, "left").join(words, group, "left").withColumn("display_name", F.coalesce("likely_part_number", "likely_description", "component_key"))


def product_families(parts: DataFrame, family: str, top: int = 15) -> DataFrame:
    """Components and pieces of each family, and its leading components in order."""
    best = top_per_group(parts, [family], [F.desc("repairs"), F.desc("pieces"), F.lower("display_name"), "component_key"], top)
    lead = best.groupBy(family).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "display_name"))), lambda x: x["display_name"]), " | ").alias("top_parts"))
    return parts.groupBy(family).agg(F.count("*").alias("components"), F.sum("pieces").alias("pieces")).join(lead, family)


def descriptor_key(part_number: str, description: str, quote: str) -> Column:
    """PN: and letters and digits of a part number, else DESC: and the description's words (or the quote's beginning)."""
    pn, d = compact(part_number), F.trim(F.regexp_replace(F.lower(compact(description)), "[^a-z0-9]+", " "))
    by_pn = F.concat(F.lit("PN:"), F.when(alnum_upper(part_number) != "", alnum_upper(part_number)).otherwise(F.upper(pn)))
    return F.when(pn != "", by_pn).otherwise(F.concat(F.lit("DESC:"), F.when(d != "", d).otherwise(F.substring(F.lower(compact(quote)), 1, 140))))


def descriptors(mentions: DataFrame, mention: str, event: str, part_number: str, description: str, quote: str) -> DataFrame:
    """One row a descriptor key, with its id, spellings, and numbers of mentions and events."""
    keyed = mentions.withColumn("canonical_key", descriptor_key(part_number, description, quote))
    some = lambda c: F.array_sort(F.collect_set(F.when(compact(c) != "", compact(c))))  # noqa: E731  the distinct spellings of one key
    out = keyed.groupBy("canonical_key").agg(some(part_number).alias("part_numbers"), some(description).alias("descriptions"), F.count(mention).alias("mentions"), F.countDistinct(event).alias("events"))
    return out.withColumn("descriptor_id", content_id("d", "canonical_key"))


def descriptor_members(mentions: DataFrame, mention: str, part_number: str, description: str, quote: str) -> DataFrame:
    """(descriptor_id, mention) as rows: a descriptor of any number of mentions is never one row."""
    return mentions.select(content_id("d", descriptor_key(part_number, description, quote)).alias("descriptor_id"), mention)


def usage_by_group(mentions: DataFrame, members: DataFrame, member: str, group: str, event: str, quantity: str) -> DataFrame:
    """frequency() of groups through their membership rows (group, member)."""
    bridge = members.select(group, F.col(member).alias("_m")).distinct()
    return frequency(mentions.join(bridge, mentions[member] == F.col("_m")), group, event, quantity)


def pn_observations(mentions: DataFrame, part_number: str, event: str, quantity: str) -> DataFrame:
    """Each observed spelling of a part number, its compact form and usage."""
    seen = mentions.where(compact(part_number) != "").withColumn("observed_pn", compact(part_number))
    return frequency(seen, "observed_pn", event, quantity).withColumn("compact_pn", alnum_upper("observed_pn"))


def same_likely_pn(groups: DataFrame, likely: str, members: str, generic: tuple[str, ...] = ()) -> DataFrame:
    """Groups with the same likely part number become one; generic or missing numbers stay apart."""
    key = alnum_upper(likely)
    own = (key == "") | key.isin(*generic) if generic else key == ""
    k = F.when(own, F.concat(F.lit("#"), F.col("group_id"))).otherwise(key)
    return groups.groupBy(k.alias("group_key")).agg(F.min("group_id").alias("group_id"), F.array_sort(F.array_distinct(F.flatten(F.collect_list(members)))).alias(members), F.min(likely).alias(likely))


def likely_grounded(likely: str, members: str) -> Column:
    """Whether a proposed part number is, holds, or is held by one of its members' observed numbers."""
    a = alnum_upper(likely)
    return (a != "") & F.exists(members, lambda m: F.contains(F.upper(F.regexp_replace(m, "[^A-Za-z0-9]+", "")), a) | ((F.regexp_replace(m, "[^A-Za-z0-9]+", "") != "") & F.contains(a, F.upper(F.regexp_replace(m, "[^A-Za-z0-9]+", "")))))


def most_supported(observations: DataFrame, group: list[str], value: str = "observed_pn") -> DataFrame:
    """The observed value with most repairs, then pieces, then the smallest spelling."""
    return first_by_key(observations, group, [F.desc("repairs"), F.desc("pieces"), value])


def running_share(rows: DataFrame, group: list[str], order: list[Column | str], value: str) -> DataFrame:
    """Share of a group's total up to each row in order."""
    w = Window.partitionBy(*group)
    up = w.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn("running_share", F.sum(value).over(up) / F.sum(value).over(w))


def unknown_text(c: str) -> Column:
    """not_established for nothing written."""
    return F.when(compact(c) == "", "not_established").otherwise(text(c))
