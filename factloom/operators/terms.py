"""Terminology review: candidate terms, known terms, priorities and scope."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factloom.functions.rules import first_match
from factloom.functions.text import acronym_bonus, text


@dataclass
class TermRules:
    """Limits, weights and lists of the queue; the lists are upper-case."""

    shortest: int = 2
    longest_alpha: int = 5
    longest_mixed: int = 10
    common: tuple[str, ...] = ("THE", "AND", "FOR", "NOT", "ALL", "NEW", "OLD", "WAS", "ARE", "BUT", "OUT", "ONE", "TWO", "OFF", "ON", "OK", "NO", "YES", "TO", "IN", "OF", "IS", "IT", "AT", "BY", "AS", "OR", "AN", "IF", "BE", "WITH", "FROM", "THIS", "THAT")
    ignored: tuple[str, ...] = ()
    metadata: tuple[str, ...] = ()
    patterns: tuple[str, ...] = (r"[0-9]+",)
    event_weight: int = 11
    serial_weight: int = 7
    model_weight: int = 3
    raw_weight: int = 1
    raw_cap: int = 2
    field_weights: dict[str, int] = field(default_factory=dict)
    high_events: int = 12
    high_score: int = 125
    medium_events: int = 3
    medium_score: int = 45
    shape: tuple[int, int, int] = (0, 0, 0)


def occurrences(docs: DataFrame, key: str, body: str, rules: TermRules) -> DataFrame:
    """(key columns, term, reason): every upper-case token; reason names the rule that suppresses it, null: a candidate."""
    t = F.col("term")
    alpha = t.rlike("^[A-Z]+$")
    ignore = first_match([("ignore_pattern", t.rlike("^(?:" + "|".join(rules.patterns) + ")$"))]) if rules.patterns else F.lit(None)
    reason = first_match(
        [
            ("too_short", F.length(t) < rules.shortest),
            ("alpha_token_too_long_for_acronym", alpha & (F.length(t) > rules.longest_alpha)),
            ("mixed_token_too_long", ~alpha & (F.length(t) > rules.longest_mixed)),
            ("common_english_word", t.isin(*rules.common)),
            ("known_metadata_identifier", t.isin(*rules.metadata) if rules.metadata else F.lit(False)),
            ("fixed_ignore_term", t.isin(*rules.ignored) if rules.ignored else F.lit(False)),
        ]
    )
    found = docs.withColumn("term", F.explode(F.regexp_extract_all(text(body), F.lit(r"\b([A-Z][A-Z0-9]*)\b"), F.lit(1))))
    return found.withColumn("reason", F.coalesce(reason, ignore))


def suppression(found: DataFrame) -> DataFrame:
    """Occurrences and distinct terms by suppression reason."""
    return found.where(F.col("reason").isNotNull()).groupBy("reason").agg(F.count("*").alias("occurrences"), F.countDistinct("term").alias("terms"))


def queue(found: DataFrame, event: str, serial: str, model: str, rules: TermRules, fields: str | None = None, consequential: tuple[str, ...] = ()) -> DataFrame:
    """Priority of each candidate term: distinct events, serials and models, capped raw occurrences, and the best field weight of each event."""
    kept = found.where(F.col("reason").isNull())
    weight = F.lit(1) if fields is None else F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in rules.field_weights.items() for x in kv]), F.col(fields)), F.lit(1)) if rules.field_weights else F.lit(1)
    per = kept.groupBy("term", event, *([fields] if fields else [])).agg(F.max(weight).alias("w")).groupBy("term").agg(F.sum("w").alias("field_score"))
    used = F.max(F.col(fields).isin(*consequential)).alias("consequential") if fields and consequential else F.lit(False).alias("consequential")
    out = kept.groupBy("term").agg(F.count("*").alias("occurrences"), F.countDistinct(event).alias("events"), F.countDistinct(serial).alias("serials"), F.countDistinct(model).alias("models"), used).join(per, "term")
    capped = F.least(F.col("occurrences"), F.col("events") * rules.raw_cap)
    score = F.col("events") * rules.event_weight + F.col("serials") * rules.serial_weight + F.col("models") * rules.model_weight + capped * rules.raw_weight + F.col("field_score") + acronym_bonus("term", *rules.shape)
    out = out.withColumn("score", score.cast("long"))
    label = first_match([("HIGH", (F.col("events") >= rules.high_events) | (F.col("score") >= rules.high_score)), ("MEDIUM", (F.col("events") >= rules.medium_events) | (F.col("score") >= rules.medium_score))], "LOW")
    out = out.withColumn("priority", label)
    return out.withColumn("recommendation", F.when((F.col("priority") == "HIGH") & F.col("consequential"), "ask_now").otherwise("queue")).drop("field_score")


def scope(found: DataFrame, event: str, oem: str, model: str) -> DataFrame:
    """Suggested scope of each term over its distinct events: a model (share of 0.85 or more), an OEM (the same), the shop (two OEMs or more, none with 0.65), or nothing."""
    one = found.where(F.col("reason").isNull()).groupBy("term", event).agg(F.min(oem).alias("oem"), F.min(model).alias("model"))

    def top(c: str) -> DataFrame:
        n = one.where(F.col(c).isNotNull() & (F.col(c) != "")).groupBy("term", c).agg(F.count("*").alias("n"))
        w = Window.partitionBy("term")
        place = F.row_number().over(w.orderBy(F.desc("n"), c))
        out = n.withColumns({"share": F.col("n") / F.sum("n").over(w), "values": F.count("*").over(w), "place": place}).where(F.col("place") == 1)
        return out.select("term", F.col(c).alias(f"top_{c}"), F.col("share").alias(f"{c}_share"), F.col("values").alias(f"{c}_values"))

    out = one.groupBy("term").agg(F.count("*").alias("events")).join(top("oem"), "term", "left").join(top("model"), "term", "left")
    by = first_match(
        [
            ("fewer_than_3_unique_repair_events", F.col("events") < 3),
            ("model_concentration", F.col("top_oem").isNotNull() & (F.col("model_share") >= 0.85)),
            ("oem_concentration", F.col("oem_share") >= 0.85),
            ("cross_oem_usage", (F.col("oem_values") >= 2) & (F.col("oem_share") < 0.65)),
        ],
        "scope_not_concentrated_enough",
    )
    out = out.withColumn("reason", by)
    suggested = first_match([])
    suggested = F.when(F.col("reason") == "model_concentration", F.concat(F.lit("OEM="), "top_oem", F.lit(";model="), "top_model")).when(F.col("reason") == "oem_concentration", F.concat(F.lit("OEM="), "top_oem")).when(F.col("reason") == "cross_oem_usage", "shop")
    return out.select("term", "events", "reason", suggested.alias("suggested_scope"))


def template_share(found: DataFrame, signature: str) -> DataFrame:
    """Share of each term's most frequent context."""
    n = found.groupBy("term", signature).agg(F.count("*").alias("n"))
    return n.groupBy("term").agg((F.max("n") / F.sum("n")).alias("template_share"), F.sum("n").alias("occurrences"))


def shadowed(rows: DataFrame, higher: DataFrame, key: list[str]) -> tuple[DataFrame, DataFrame]:
    """(kept, shadowed) rows: those with a row of higher authority of the same key are shadowed."""
    k = higher.select(*key).distinct()
    return rows.join(k, key, "left_anti"), rows.join(k, key, "left_semi")


def flexible(term: str) -> str:
    """Pattern of a term between word boundaries: any white space, any apostrophe, plus plural s where the term has none."""
    import re

    parts = [re.escape(p).replace("'", "['’]?") for p in term.split()]
    return r"(?<![A-Za-z0-9])" + r"\s+".join(parts) + r"(?![A-Za-z0-9])"


def known_terms(docs: DataFrame, key: str, body: str, glossary: dict[str, tuple[str, ...]]) -> DataFrame:
    """(key, term, hits) of glossary terms, by any alias, longest alias first. The glossary is a literal: each alias is one pattern."""
    found = F.array(*[F.struct(F.lit(term).alias("term"), F.regexp_count(text(body), F.lit("(?i)(?:" + "|".join(flexible(a) for a in sorted((term, *aliases), key=len, reverse=True)) + ")")).alias("hits")) for term, aliases in glossary.items()])
    return docs.select(key, F.inline(F.filter(found, lambda x: x["hits"] > 0)))


def known_counts(matches: DataFrame, key: str) -> DataFrame:
    return matches.groupBy("term").agg(F.countDistinct(key).alias("documents"), F.sum("hits").cast("long").alias("hits"))


def effective_glossary(base: DataFrame, decisions: DataFrame) -> DataFrame:
    """Base terms overridden by the latest approved decision of the same folded term."""
    k = lambda c: F.lower(F.col(c))
    w = Window.partitionBy(k("raw_term")).orderBy(F.desc("reviewed_at"), F.desc("decision_id"))
    latest = decisions.withColumn("_r", F.row_number().over(w)).where((F.col("_r") == 1) & (F.col("decision") == "approve"))
    mine = latest.select("raw_term", F.col("meaning").alias("normalized_meaning"), F.lit("decision").alias("origin"))
    rest = base.select("raw_term", "normalized_meaning", F.lit("base").alias("origin")).join(mine.select(k("raw_term").alias("_k")), k("raw_term") == F.col("_k"), "left_anti")
    return rest.unionByName(mine)


def low_support(q: DataFrame, short: int = 3, least_events: int = 2) -> Column:
    """Short terms that few events support wait for more evidence."""
    return (F.length("term") <= short) & (F.col("events") < least_events)
