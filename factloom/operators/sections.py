"""State along ordered lines and pages: sections under headings, fields of one region, families that pages inherit, and what a mark on a checklist means.

A document's lines or pages are ordered in a window of that document; documents are spread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from factloom.functions.text import compact, compare_form, text

# What tells the type of a page, in this order, by family; the first page has a type of its own, and a page without any is a continuation.
PAGE_TYPES = {
    "internal_checklist": {
        "first": "checklist_event_header_and_initial_checkout",
        "rules": (("checklist_final_checkout", ("final checkout", "final check")), ("checklist_functional_test", ("functional test", "functional testing")), ("checklist_visual_inspection", ("visual inspection",)), ("checklist_completion", ("completion", "final o.k"))),
        "rest": "checklist_continuation",
    },
    "acceptance_test_report": {
        "first": "test_report_front_matter_and_event_header",
        "rules": (("test_report_visual_inspection", ("visual inspection",)), ("test_report_functional_test", ("functional test",)), ("test_report_completion", ("completion", "signature")), ("test_report_appendix", ("appendix",))),
        "rest": "test_report_continuation",
    },
}
UNKNOWN_FAMILY = "unknown_document"


def text_lines(docs: DataFrame, key: str, body: str) -> DataFrame:
    """(key, line, text): the lines of a text, counted from 1, white space compacted; a null text has none."""
    return docs.where(F.col(body).isNotNull()).select(key, F.posexplode(F.split(F.regexp_replace(F.col(body), "\r\n?", "\n"), "\n")).alias("line", "text")).select(key, (F.col("line") + 1).alias("line"), compact("text").alias("text"))


def note_lines(lines: DataFrame, shortest: int = 5, longest: int = 300) -> DataFrame:
    """Lines that can be a note by their length."""
    return lines.where(F.length("text").between(shortest, longest))


def with_sections(lines: DataFrame, key: str, line: str, heading: Column) -> DataFrame:
    """``lines`` with section, the number of headings down to the line, and section_heading, the heading's text; null and 0 before the first. ``heading`` is true for heading lines; null counts as false."""
    down = Window.partitionBy(key).orderBy(line).rowsBetween(Window.unboundedPreceding, 0)
    is_heading = F.coalesce(heading, F.lit(False))
    return lines.withColumns({"section": F.sum(is_heading.cast("int")).over(down), "section_heading": F.last(F.when(is_heading, F.col("text")), ignorenulls=True).over(down), "is_heading": is_heading})


def region_fields(lines: DataFrame, key: str, region: Column, patterns: dict[str, list[str]], authority: Column, least_words: int = 2) -> DataFrame:
    """(key, field, value, authority, line, place): values of the fields' patterns (first group) in the lines of a region only.

    Of values with the same letters and digits the first stays; place ranks a field's values by authority, the smallest first, then by line.  Values of fewer than ``least_words`` words do not count.
    """
    found = None
    for field, forms in patterns.items():
        each = F.flatten(F.array(*[F.regexp_extract_all("text", F.lit(p), F.lit(1)) for p in forms]))
        rows = lines.where(region).select(key, "line", F.lit(field).alias("field"), authority.alias("authority"), F.posexplode(each).alias("at", "value"))
        found = rows if found is None else found.unionByName(rows)
    clean = found.withColumn("value", compact("value")).withColumn("form", compare_form("value")).where(F.size(F.filter(F.split("form", " "), lambda w: w != "")) >= least_words)
    order = [F.col("authority").asc_nulls_last(), "line", "at"]
    first = clean.withColumn("n", F.row_number().over(Window.partitionBy(key, "field", "form").orderBy(*order))).where(F.col("n") == 1)
    return first.withColumn("place", F.row_number().over(Window.partitionBy(key, "field").orderBy(*order))).select(key, "field", "value", "authority", "line", "place")


def inherited(rows: DataFrame, key: str, order: str, value: Column, reset: Column) -> DataFrame:
    """``rows`` with run, the number of resets so far, and carried, the last value since the latest reset; null before a first value."""
    down = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    runs = rows.withColumns({"_value": value, "run": F.sum(F.coalesce(reset, F.lit(False)).cast("int")).over(down)})
    within = Window.partitionBy(key, "run").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return runs.withColumn("carried", F.last("_value", ignorenulls=True).over(within)).drop("_value")


def page_types(pages: DataFrame, family: str, body: str, number: str, types: dict[str, dict] = PAGE_TYPES) -> DataFrame:
    """``pages`` with page_type, by the family's rules; families without rules have ``unknown_page``."""
    lower = F.lower(text(body))
    out = F.lit("unknown_page")
    for name, rules in types.items():
        kind = F.lit(rules["rest"])
        for page_type, needles in reversed(rules["rules"]):
            holds = F.lit(False)
            for n in needles:
                holds |= F.contains(lower, F.lit(n))
            kind = F.when(holds, F.lit(page_type)).otherwise(kind)
        out = F.when(F.col(family) == name, F.when(F.col(number) == 1, F.lit(rules["first"])).otherwise(kind)).otherwise(out)
    return pages.withColumn("page_type", out)


def page_families(pages: DataFrame, document: str, page: str, body: str, family: Column, first: Column) -> DataFrame:
    """``pages`` with document_family, page_in_family, family_inherited and page_type: a family, once told, holds until a new first page.

    family: what a page itself tells, or null; first: whether it begins a document.  Pages before any family are of the unknown one.
    """
    carried = inherited(pages, document, page, family, first)
    numbered = carried.withColumn("page_in_family", F.row_number().over(Window.partitionBy(document, "run").orderBy(page)))
    named = numbered.withColumns({"document_family": F.coalesce("carried", F.lit(UNKNOWN_FAMILY)), "family_inherited": F.col("carried").isNotNull() & family.isNull()})
    return page_types(named, "document_family", body, "page_in_family").drop("carried", "run")


def marked_result(mark: Column | str, model_result: Column | str, selected: Column | str, basis: Column | str, asks_result: Column) -> Column:
    """struct(accepted, result, correction, reason) of a test item.

    A check or an X on an ordinary step means that it was done, whatever the model read; where a step asks for pass or fail, that counts only if one of them was selected.
    """
    c = lambda x: F.lower(text(x))
    asks = F.coalesce(asks_result, F.lit(False))
    done = c(mark).isin("checkmark", "x_mark") & ~asks & c(model_result).isin("pass", "fail", "unknown")
    decided = asks & c(model_result).isin("pass", "fail")
    chosen = c(selected).isin("pass", "fail")
    refused = decided & ~chosen & (c(basis) != "selected_option")
    result = F.when(done, F.lit("completed")).when(decided & chosen, c(selected)).otherwise(c(model_result))
    return F.struct(
        (~refused).alias("accepted"), F.when(~refused, result).alias("result"),
        F.when(done, F.lit("x_or_checkmark_on_checklist_step_means_completed_not_pass_fail")).alias("correction"),
        F.when(refused, F.lit("pass_fail_result_not_unambiguously_selected")).alias("reason"),
    )
