"""Which candidates and groups are worked on, where they go, and which search a query text gets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.functions.evidence import query_mode
from factloom.functions.rules import first_match
from factloom.functions.text import ColumnOrName, col, compact, path_form, text
from factloom.operators import search

# The kinds of each lane.
LANES = {
    "customer_requirements": ("customer_requirement",),
    "repairs": ("repair_or_service",),
    "components": ("component_or_part", "part_number_or_identifier"),
    "diagnostics": ("diagnostic_or_failure",),
    "testing_process": ("testing_or_process",),
    "terminology": ("shop_term_or_abbreviation",),
    "other": ("other",),
}
TECHNICIAN_LANES = ("repairs", "components", "diagnostics", "testing_process")

# Phrases of empty forms, and of forms and presentations that are no signal.
TEMPLATE_PHRASES = (
    "repaired replaced detailed description of repairs/replacements",
    "detailed description of repairs/replacements (including any costs for new parts)",
    "repaired replaced inits. date",
    "repaired replaced date inits",
    "repaired replaced date (m/d/yy)",
    "repaired replaced inits. date (m/d/yy)",
    "repaired replaced date inits. (m/d/yy)",
)
PRESENTATION_PHRASES = (
    "repaired replaced detailed description of repairs/replacements",
    "detailed description of repairs/replacements (including any costs for new parts)",
    "repaired replaced inits. date",
    "repaired replaced date inits",
    "head crash fails seeks d.o.a.",
    "head crash ☐ fails seeks ☐ d.o.a. ☐",
    "hours of work",
)


def metadata_patterns(house: str = "") -> list[str]:
    """Beginnings of identity and administration lines; ``house`` is the name that a shop puts before its own numbers and people."""
    own = rf"(?:{house}\s+)" if house else ""
    # fixed values
    return [
        rf"(?i)^\s*(?:{own}part\s*#|Serial\s*#|Frame\s+Serial\s*#|Board\s+Serial\s*#)(?:\s|:|$)",
        rf"(?i)^\s*(?:RMA\s+Number|Cust(?:omer)?\s*RMA|Customer\s+PO|Cust\s+PO|POC\s+Phone|Point\s+of\s+Contact|{own}Rep|Sales\s+Rep)\b",
        r"(?i)^\s*(?:Warranty\s+Date|Warranty\s+Type|Date\s+Shipped|SHIPPED\b|Serial\s+Check|Q\.C\.\s*By)\b",
        r"(?i)^\s*(?:Saved \(in shipping area\)|Saved \(in warehouse\)|Unusable \(discarded\))(?:\s|:|$)",
        r"(?i)^\s*(?:pricing approved|needs quote)\b",
        r"(?i)^\s*(?:Cleaned|Aligned|Adjusted|Latest Firmware|Appearance|All Screws|Warranty Sticker Applied)\b.*[✓☐X\[\]]",
    ]


def lane_of(kind: ColumnOrName) -> Column:
    """Lane of a candidate's kind; null for unclear text, which waits for a second reading."""
    k = text(kind)
    lanes = first_match([(lane, k.isin(*kinds)) for lane, kinds in LANES.items()], "other")
    return F.when(k != "unclear_ocr", lanes)


def prepare(candidates: DataFrame, kind: str, body: str, house: str = "", models: str | None = None) -> DataFrame:
    """Candidates with reasoning_lane (null: excluded) and reasoning_exclusion_reason.

    models: a pattern of whole texts that only name an equipment model, for part-number candidates.
    """
    s = compact(body)
    rules = [("unclear_ocr_preserved_for_human_or_secondary_vision_review", lane_of(kind).isNull())]
    rules += [(f"generic_identity_or_admin_pattern_{i}", s.rlike(p)) for i, p in enumerate(metadata_patterns(house), 1)]
    if models:
        rules.append(("equipment_model_identity_not_repair_part", (text(kind) == "part_number_or_identifier") & s.rlike(f"(?i)^(?:{models})$")))
    reason = first_match(rules)
    return candidates.withColumns({"reasoning_lane": F.when(reason.isNull(), lane_of(kind)), "reasoning_exclusion_reason": reason})


def kind_override(body: ColumnOrName, kind: ColumnOrName, patterns: dict[str, str]) -> Column:
    """struct(kind, reason): the first pattern that the text matches sets the kind; the text never changes."""
    found = first_match([(k, compact(body).rlike(p)) for k, p in patterns.items()])
    changed = found.isNotNull() & (found != text(kind))
    return F.struct(F.coalesce(found, col(kind)).alias("kind"), F.when(changed, F.concat(F.lit("deterministic_"), found, F.lit("_pattern"))).alias("reason"))


def is_template(c: ColumnOrName) -> Column:
    """Whether a text is an empty form: one of its phrases, or a form's heading with less than 12 other characters."""
    s = F.lower(compact(c))
    words = r"repaired replaced|detailed description of repairs/replacements|including any costs for new parts|date|inits|m/d/yy|\(|\)|\.|/"
    heading = s.startswith("repaired replaced") & s.rlike("inits|date|detailed description")
    left = F.trim(F.regexp_replace(F.regexp_replace(s, words, " "), r"\s+", " "))
    phrase = F.exists(F.array(*[F.lit(p) for p in TEMPLATE_PHRASES]), lambda p: F.contains(s, p))
    return (s != "") & (phrase | (heading & (F.length(left) < 12)))


def template_noise(label: ColumnOrName, variants: ColumnOrName, first: int = 8) -> Column:
    """Reason why a group is template noise, else null: its label, or all of its first variants (an array of texts)."""
    some = F.slice(col(variants), 1, first)
    return F.when(is_template(label), "template_like_label").when((F.size(some) > 0) & F.forall(some, is_template), "all_sample_evidence_template_like")


def route(label: ColumnOrName, key: ColumnOrName, lane: ColumnOrName, identities: str | None = None) -> Column:
    """struct(audience, reason): technician or reference. identities: a pattern of labels that only name equipment."""
    s = F.lower(F.concat_ws(" ", F.nullif(compact(label), F.lit("")), F.nullif(compact(key), F.lit(""))))
    noise = F.exists(F.array(*[F.lit(p) for p in PRESENTATION_PHRASES]), lambda p: F.contains(s, p))
    own = compact(label).rlike(f"(?i)^(?:{identities})$") if identities else F.lit(False)
    reason = first_match([("equipment_identity_not_service_signal", own), ("form_or_presentation_noise", noise), ("technician_lane", text(lane).isin(*TECHNICIAN_LANES))], "reference_lane")
    return F.struct(F.when(reason == "technician_lane", "technician").otherwise("reference").alias("audience"), reason.alias("reason"))


def photo_manager_noise(item_type: ColumnOrName, path: ColumnOrName) -> Column:
    """Files that a photo manager leaves beside the pictures; only items of type file are hidden."""
    p = path_form(path)
    return (text(item_type) == "file") & (F.contains(p, F.lit("/.picasaoriginals/")) | (F.substring_index(p, "/", -1) == ".picasa.ini"))


def searchable(label: ColumnOrName, key: ColumnOrName, areas: ColumnOrName, evidence: ColumnOrName | None = None) -> Column:
    """Lower-cased text of a group for searching: label, key, areas and, if given, its evidence texts."""
    parts = [compact(label), compact(key), F.array_join(col(areas), " ")] + ([F.array_join(col(evidence), " ")] if evidence is not None else [])
    return F.lower(F.concat_ws(" ", *[F.nullif(p, F.lit("")) for p in parts]))


def mode_of(groups: DataFrame, query: str, mode: str = "auto") -> str:
    """The search that a query text gets: the given mode, or the one of its form."""
    return mode if mode != "auto" else groups.sparkSession.range(1).select(query_mode(F.lit(query))).first()[0]


def dispatch(groups: DataFrame, query: str, mode: str = "auto", top: int = 10, label: str = "concept_label", evidence: str = "evidence", areas: str = "areas", serials: str = "serials", logs: str = "logs") -> DataFrame:
    """Groups that answer a query: those of a serial or log number, those with the most stocking matches, the service areas, or a pattern search.

    groups has arrays serial_numbers, log_numbers and service_areas, and stocking_matches.
    """
    kind = mode_of(groups, query, mode)
    if kind in ("serial", "log"):
        digits = F.regexp_extract(F.lit(query), r"[0-9]{8,9}", 0)
        return groups.where(F.array_contains("serial_numbers" if kind == "serial" else "log_numbers", digits)).orderBy(F.desc(serials), label).limit(top)
    if kind == "stocking":
        return groups.where("stocking_matches > 0").orderBy(F.desc("stocking_matches"), F.desc(serials), label).limit(top)
    if kind == "service-areas":
        return groups.select(F.explode("service_areas").alias("area"), serials).groupBy("area").agg(F.count("*").alias("groups"), F.sum(serials).alias("serials")).orderBy(F.desc("serials"), "area").limit(top)
    return search.pattern_search(groups, query, label, evidence, areas, serials, logs, top)
