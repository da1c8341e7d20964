"""Evidence from JSON artifacts of several shapes in one column, notes in model answers, and the newest complete version."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.functions.text import compact, text

# File names of the three shapes.
SHAPES = {
    "regions": ("traveler_regions.json",),
    "entries": ("repair_entries_v1_3_4_4.json",),
    "approved": ("approved_repair_fields.json", "approved_repair_fields_with_terminology.json", "approved_repair_fields_with_parts.json"),
}
# Words of a note that say nothing.
EMPTY_NOTES = ("", "none", "null", "n/a", "na")

_META = ("log_number", "repair_date", "equipment_type", "oem", "model", "serial_number")


def shape_of(path: Column | str) -> Column:
    """The shape that a file's name tells, null for other files."""
    name = F.lower(F.substring_index(F.translate(text(path), "\\", "/"), "/", -1))
    out = F.lit(None).cast("string")
    for shape, names in SHAPES.items():
        out = F.when(name.isin(*names), F.lit(shape)).otherwise(out)
    return out


def _at(v: Column, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(v, f"$.{path}", kind)


def _row(value: Column, field: str, source: str, meta: dict[str, Column]) -> Column:
    """A struct of evidence, null without text."""
    known = [meta.get(k, F.lit(None)).cast("string").alias(k) for k in _META]
    return F.when(F.length(value) > 0, F.struct(value.alias("text"), F.lit(field).alias("field"), F.lit(source).alias("source_type"), *known))


def json_evidence(files: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    """Evidence rows of JSON files: path, shape, status, text, field, source_type and what is known of the event.

    Files of other names give nothing.  Of a readable file each non-empty text is a row with status ``ok``; a file without any is one row with status ``empty``, and one that is no JSON object
    one row with status ``unreadable``, so no file is lost.  Entries of a detect-only or failed extraction do not count.  A part of another type than expected is as if it were absent.
    """
    v = F.col("_v")
    known = files.select(F.col(path).alias("path"), shape_of(path).alias("shape"), F.try_parse_json(F.col(content)).alias("_v")).where(F.col("shape").isNotNull())
    known = known.withColumn("_object", F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False)))
    none = F.array().cast("array<variant>")
    entries = F.when(_at(v, "status").eqNullSafe(F.lit("ok")) & ~F.coalesce(_at(v, "detect_only", "boolean"), F.lit(False)), F.coalesce(_at(v, "entries", "array<variant>"), none)).otherwise(none)
    log = {"log_number": _at(v, "log_number")}
    structured = "structured_traveler_reader"
    of_entries = F.flatten(F.transform(entries, lambda e: F.array(_row(_at(e, "literal_fields.description"), "structured_repair_action", structured, log), _row(_at(e, "literal_fields.notes"), "diagnostic_note", structured, log))))
    from_name = F.nullif(F.regexp_extract(F.substring_index(F.translate(text(_at(v, "source_path")), "\\", "/"), "/", -1), r"^(\d{9})", 1), F.lit(""))
    of_regions = F.array(*[_row(_at(v, f"regions.{r}.selected_text"), field, "traveler_region_ocr", {"log_number": from_name}) for r, field in (("special_notes", "special_notes_ocr"), ("repairs_replacements", "repairs_region_ocr"))])
    identity = {k: _at(v, f"repair_identity.{k}") for k in _META}
    actions = F.coalesce(_at(v, "approved_fields.repair_actions", "array<variant>"), none)
    of_approved = F.concat(
        F.array(_row(_at(v, "approved_fields.customer_complaint.value"), "approved_customer_complaint", "human_approved_field", identity)),
        F.transform(actions, lambda a: _row(_at(a, "value"), "approved_repair_action", "human_approved_field", identity)),
    )
    found = F.when(F.col("shape") == "entries", of_entries).when(F.col("shape") == "regions", of_regions).otherwise(of_approved)
    rows = known.select("path", "shape", "_object", F.explode_outer(F.when(F.col("_object"), F.filter(found, lambda x: x.isNotNull()))).alias("x"))
    status = F.when(~F.col("_object"), "unreadable").when(F.col("x").isNull(), "empty").otherwise("ok")
    return rows.select("path", "shape", status.alias("status"), "x.text", "x.field", "x.source_type", *[F.col(f"x.{k}") for k in _META])


def model_note(raw: Column | str) -> Column:
    """The notes of a model's answer: of the JSON object from its first to its last brace; null if there is none or it says nothing."""
    found = F.try_parse_json(F.regexp_extract(text(raw), r"(?s)(\{.*\})", 1))
    note = F.try_variant_get(found, "$.notes", "string")
    clean = compact(note)
    return F.when(note.isNotNull() & ~F.lower(clean).isin(*EMPTY_NOTES), clean)


def version_order(version: Column | str) -> Column:
    """The numbers in a version as an array, which orders 1.10 after 1.9; no number is before every number."""
    return F.transform(F.regexp_extract_all(text(version), F.lit(r"\d+"), F.lit(0)), lambda n: F.substring(n, -38, 38).cast("decimal(38,0)"))


def newest_complete(rows: DataFrame, group: list[str], version: Column, complete: Column, tie: str) -> DataFrame:
    """One row a group: the newest of the complete ones, else the newest; of equal versions the one with the largest ``tie``.  version: an array of version_order()."""
    others = [c for c in rows.columns if c not in group]
    order = F.struct(F.coalesce(complete, F.lit(False)).alias("c"), version.alias("v"), F.col(tie).alias("t"))
    best = rows.groupBy(*group).agg(F.max_by(F.struct(*others), order).alias("_best"))
    return best.select(*group, *[F.col(f"_best.{c}") for c in others])
