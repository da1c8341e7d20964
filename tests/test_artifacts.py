import itertools
import json
import random

import pytest
from pyspark.sql import functions as F

from factloom.operators import artifacts, overlap, sections


def test_three_shapes_and_bad_documents(spark):
    entries = {"status": "ok", "log_number": 130000001, "entries": [{"literal_fields": {"description": "Replaced fuse", "notes": ""}}, {"literal_fields": {"notes": "Loose wire"}}, {"literal_fields": None}, {}]}
    files = [
        ("a/repair_entries_v1_3_4_4.json", json.dumps(entries)),
        ("a/b/REPAIR_ENTRIES_v1_3_4_4.json", json.dumps(entries | {"detect_only": True})),
        ("c\\traveler_regions.json", json.dumps({"source_path": "x/130000002 card.jpg", "regions": {"special_notes": {"selected_text": "No start"}, "repairs_replacements": None}})),
        ("d/approved_repair_fields.json", json.dumps({"repair_identity": {"log_number": "130000003", "model": "M1"}, "approved_fields": {"customer_complaint": {"value": "Noisy"}, "repair_actions": [{"value": "Cleaned"}, {"value": ""}, "text", None]}})),
        ("e/approved_repair_fields.json", json.dumps({"approved_fields": {"customer_complaint": "text", "repair_actions": {"value": "no list"}}})),
        ("f/traveler_regions.json", '{"regions": {'), ("g/traveler_regions.json", None), ("h/traveler_regions.json", "[1]"), ("i/other.json", "{}"), (None, "{}"),
    ]
    got = artifacts.json_evidence(spark.createDataFrame([(*f, 1) for f in files], "path string, content string, shape int").repartition(3)).collect()
    assert sorted(((r["path"][0], r["status"], r["field"], r["text"], r["log_number"], r["model"]) for r in got), key=str) == sorted([
        ("a", "ok", "structured_repair_action", "Replaced fuse", "130000001", None), ("a", "ok", "diagnostic_note", "Loose wire", "130000001", None), ("a", "empty", None, None, None, None),
        ("c", "ok", "special_notes_ocr", "No start", "130000002", None), ("d", "ok", "approved_customer_complaint", "Noisy", "130000003", "M1"), ("d", "ok", "approved_repair_action", "Cleaned", "130000003", "M1"),
        ("e", "empty", None, None, None, None), ("f", "unreadable", None, None, None, None), ("g", "unreadable", None, None, None, None), ("h", "unreadable", None, None, None, None),
    ], key=str)
    assert artifacts.json_evidence(spark.createDataFrame([], "path string, content string")).count() == 0


@pytest.mark.parametrize(("raw", "note"), [('Sure: {"notes": " Loose\\n wire "} done', "Loose wire"), ('{"notes": "N/A"}', None), ('{"notes": null}', None), ('{"other": 1}', None), ("no json", None), (None, None), ('{"notes": 12}', "12"), ('{"notes": "x"', None)])
def test_model_notes(spark, raw, note):
    assert spark.createDataFrame([(raw,)], "r string").select(artifacts.model_note("r").alias("n")).first()["n"] == note


def test_newest_complete_version(spark):
    rows = [("a", "v1.9", True, 1), ("a", "v1.10", True, 2), ("a", "v2.0", False, 3), ("b", "1.2", False, 4), ("b", "1.2.1", None, 5), ("b", None, False, 6), ("c", "x", True, 7), ("c", "x", True, 8), (None, "1", True, 9)]
    df = spark.createDataFrame(rows, "g string, v string, ok boolean, k int")
    got = {r["g"]: r["k"] for r in artifacts.newest_complete(df, ["g"], artifacts.version_order("v"), F.col("ok"), "k").collect()}
    assert got == {"a": 2, "b": 5, "c": 8, None: 9}
    assert artifacts.newest_complete(df.limit(0), ["g"], artifacts.version_order("v"), F.col("ok"), "k").count() == 0


@pytest.mark.parametrize("width", [1, 16, 1000])
def test_overlaps_equal_the_plain_join(spark, width):
    rng = random.Random(width)
    span = lambda most: (s := rng.randint(-200, 200), s + rng.choice([0, 1, 2, 5, most]))
    a = [(i, rng.choice("xy"), *span(3000)) for i in range(150)] + [(150, "x", None, 3), (151, None, 0, 9), (0, "x", -5, 5), (0, "x", -5, 5)]
    b = [(i, rng.choice("xy"), *span(700)) for i in range(120)] + [(120, "y", 4, None)]
    got = overlap.overlap_join(spark.createDataFrame(a, "i int, g string, s int, e int").repartition(3), spark.createDataFrame(b, "j int, g string, t int, u int"), ["g"], ("s", "e"), ("t", "u"), width)
    want = sorted((g, i, j, min(e, u) - max(s, t)) for (i, g, s, e), (j, h, t, u) in itertools.product(a, b) if g == h and g and None not in (s, e, t, u) and s < e and t < u and s < u and t < e)
    assert sorted((r["g"], r["i"], r["j"], r["overlap"]) for r in got.collect()) == want


def test_long_intervals_make_no_hot_bin(spark):
    long = spark.range(400).select(F.col("id").alias("i"), F.lit(1).alias("g"), F.lit(0).alias("s"), F.lit(1 << 30).alias("e"))
    short = spark.range(50).select(F.col("id").alias("j"), F.lit(1).alias("g"), (F.col("id") * (1 << 24)).alias("t"), (F.col("id") * (1 << 24) + 1).alias("u"))
    out = overlap.overlap_join(long, short, ["g"], ("s", "e"), ("t", "u"), 16)
    assert out.count() == 400 * 50
    assert overlap.overlap_join(long.limit(0), short, ["g"], ("s", "e"), ("t", "u")).count() == 0


def test_runs_in_bands_and_rules_in_boxes(spark):
    bands = spark.createDataFrame([("p", 1, 0, 10), ("p", 2, 10, 20), ("p", 3, 20, 30)], "page string, band int, top int, bottom int")
    runs = spark.createDataFrame([("p", 2, 4), ("p", 9, 10), ("p", 10, 12), ("q", 25, 26)], "page string, start int, end int")
    got = overlap.bands_with_runs(bands, runs, ["page"], "band", "top", "bottom", "start", "end").orderBy("band").collect()
    assert [tuple(r)[1:] for r in got] == [(1, 2, 2, 10, True), (2, 2, 9, 12, True), (3, 0, None, None, False)]
    boxes = spark.createDataFrame([("p", 0, 0, 10, 10), ("p", 20, 0, 30, 10)], "page string, x0 int, y0 int, x1 int, y1 int")
    rules = spark.createDataFrame([("p", 5, 3, 22, 4), ("p", 12, 3, 18, 4)], "page string, a int, b int, c int, d int")
    assert sorted((r["x0"], r["a"], r["overlap"], r["across"]) for r in overlap.box_overlaps(boxes, rules, ["page"], ("x0", "y0", "x1", "y1"), ("a", "b", "c", "d")).collect()) == [(0, 5, 1, 5), (20, 5, 1, 2)]


def test_sections_and_fields(spark):
    docs = [(1, "intro\r\nNOTES\nComplaint: no start at all\nComplaint:  No start, at all!\nPARTS\nComplaint: not this one\nNOTES\nComplaint: noise again\nComplaint: one"), (2, None), (3, "")]
    lines = sections.text_lines(spark.createDataFrame(docs, "k int, t string"), "k", "t")
    cut = sections.with_sections(lines, "k", "line", F.col("text").rlike("^[A-Z]+$"))
    assert [(r["line"], r["section"], r["section_heading"]) for r in cut.where("k = 1").orderBy("line").collect()] == [(1, 0, None), (2, 1, "NOTES"), (3, 1, "NOTES"), (4, 1, "NOTES"), (5, 2, "PARTS"), (6, 2, "PARTS"), (7, 3, "NOTES"), (8, 3, "NOTES"), (9, 3, "NOTES")]
    got = sections.region_fields(cut, "k", F.col("section_heading") == "NOTES", {"complaint": ["^Complaint: (.*)$"]}, -F.col("section"))
    assert [(r["value"], r["place"]) for r in got.orderBy("place").collect()] == [("noise again", 1), ("no start at all", 2)]
    assert [r["text"] for r in sections.note_lines(lines, 5, 5).collect()] == ["intro", "NOTES", "PARTS", "NOTES"]


def test_page_state_equals_a_loop(spark):
    rng = random.Random(12)
    rows = [(d, p, rng.choice(["Final check", "Functional test", "appendix", "x", None]), rng.choice([None, None, "internal_checklist", "acceptance_test_report", "letter"]), rng.choice([True, False, False, False, None])) for d in range(20) for p in range(1, 12)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "d int, p int, t string, told string, first boolean, run string").repartition(4)
    got = {(r["d"], r["p"]): (r["document_family"], r["page_in_family"], r["family_inherited"], r["page_type"]) for r in sections.page_families(df.drop("run"), "d", "p", "t", F.col("told"), F.col("first")).collect()}
    state, n, last = None, 0, None
    for d, p, t, told, first in rows:
        if d != last or first:
            state, n, last = None, 0, d
        n, inherited = n + 1, told is None and state is not None
        state = told or state
        family, kind = state or "unknown_document", "unknown_page"
        if family in sections.PAGE_TYPES:
            rules = sections.PAGE_TYPES[family]
            kind = rules["first"] if n == 1 else next((k for k, needles in rules["rules"] if any(x in (t or "").lower() for x in needles)), rules["rest"])
        assert got[d, p] == (family, n, inherited, kind)
    assert len(got) == len(rows)


@pytest.mark.parametrize(("item", "want"), [
    (("x_mark", "fail", None, None, False), (True, "completed", True)), (("checkmark", "completed", None, None, False), (True, "completed", False)), (("x_mark", "fail", None, None, True), (False, None, False)),
    (("x_mark", "fail", "pass", None, True), (True, "pass", False)), (("circle", "pass", None, "selected_option", True), (True, "pass", False)), (("text", "fail", None, None, False), (True, "fail", False)), ((None, None, None, None, None), (True, "", False)),
])
def test_marks_on_checklists(spark, item, want):
    df = spark.createDataFrame([item], "m string, r string, s string, b string, a boolean")
    got = df.select(sections.marked_result("m", "r", "s", "b", F.col("a")).alias("x")).first()["x"]
    assert (got["accepted"], got["result"], got["correction"] is not None) == want and (got["reason"] is None) == got["accepted"]
