import difflib
import random

import pytest
from pyspark.sql import functions as F

from factloom.functions import evidence
from factloom.operators import packing, records, routing, similar
from factloom.sources import files, ledger
from factloom.storage import filesystem


def value(spark, c):
    return spark.range(1).select(c.alias("v")).first().v


def test_candidates_get_a_lane_or_a_reason(spark):
    rows = [(1, "repair_or_service", "replaced the belt"), (2, "unclear_ocr", "??"), (3, "repair_or_service", "Serial #: 12"), (4, "other", "Customer PO 77"), (5, "part_number_or_identifier", "RBT-X8"), (6, "part_number_or_identifier", "QX-100"), (7, None, None), (8, "odd", "ACME Part # 5")]
    out = {r.k: (r.reasoning_lane, r.reasoning_exclusion_reason) for r in routing.prepare(spark.createDataFrame(rows, "k int, kind string, t string"), "kind", "t", "ACME", r"RBT\s*-?\s*X8").collect()}
    assert out[1] == ("repairs", None) and out[2] == (None, "unclear_ocr_preserved_for_human_or_secondary_vision_review") and out[3][1] == "generic_identity_or_admin_pattern_1"
    assert out[4][1] == "generic_identity_or_admin_pattern_2" and out[5][1] == "equipment_model_identity_not_repair_part" and out[6] == ("components", None) and out[7] == ("other", None) and out[8][1] == "generic_identity_or_admin_pattern_1"


def test_kinds_templates_and_routes(spark):
    over = lambda t, k: tuple(value(spark, routing.kind_override(F.lit(t), F.lit(k), {"customer_requirement": r"(?i)\bcustomer requests\b"})))
    assert over("Customer requests  new belts", "other") == ("customer_requirement", "deterministic_customer_requirement_pattern")
    assert over("customer requests it", "customer_requirement") == ("customer_requirement", None) and over("belt", "other") == ("other", None)
    noise = lambda label, v: value(spark, routing.template_noise(F.lit(label), F.array(*[F.lit(x) for x in v]).cast("array<string>")))
    assert noise("Repaired Replaced Date Inits", []) == "template_like_label" and noise("Belts", []) is None
    assert noise("x", ["repaired replaced (date)", "Repaired replaced inits. date (m/d/yy)"]) == "all_sample_evidence_template_like"
    assert noise("x", ["repaired replaced date: all four belts of the arm"]) is None
    assert noise("x", ["repaired replaced (date)"] * 8 + ["a real note"]) == "all_sample_evidence_template_like"
    go = lambda label, lane: tuple(value(spark, routing.route(F.lit(label), F.lit("k"), F.lit(lane), "x8(?:-mt)?")))
    assert go("Belts", "repairs") == ("technician", "technician_lane") and go("Belts", "terminology") == ("reference", "reference_lane")
    assert go("Hours of work", "repairs") == ("reference", "form_or_presentation_noise") and go("X8-MT", "repairs") == ("reference", "equipment_identity_not_service_signal")
    hide = lambda kind, p: value(spark, routing.photo_manager_noise(F.lit(kind), F.lit(p)))
    assert hide("file", "A\\.picasaoriginals\\b.jpg") and hide("file", "a/.Picasa.ini") and not hide("event", "a/.picasa.ini") and not hide("file", "a/b.jpg")


def test_dispatch(spark):
    g = spark.createDataFrame([("Y Axis Drift", "drifts", "", 9, 12, ["80050608"], ["130130006"], ["Belts"], 0), ("Belt wear", "new belts", "Belts", 4, 5, ["80050609"], [], ["Belts", "Arms"], 3)], "concept_label string, evidence string, areas string, serials int, logs int, serial_numbers array<string>, log_numbers array<string>, service_areas array<string>, stocking_matches int")
    first = lambda q, **how: [r[0] for r in routing.dispatch(g, q, **how).collect()]
    assert first("80050609") == ["Belt wear"] and first("log 130130006") == ["Y Axis Drift"] and first("what normally gets replaced") == ["Belt wear"]
    assert first("common service areas") == ["Belts", "Arms"] and first("drifting")[0] == "Y Axis Drift" and first("belt", mode="search") == ["Belt wear"]


def test_cues_and_cleaners(spark):
    assert [tuple(x) for x in value(spark, evidence.cue_hits(F.lit("It may fail, may be due to heat"), ("may", "due to")))] == [("may", 3, 6), ("may", 13, 16), ("due to", 20, 26)]
    note = lambda t: value(spark, evidence.note_class(F.lit(t)))
    assert note("We have concrete proof that X caused it") == "root_cause_candidate" and note("there is no concrete proof that X caused it") == "diagnostic_hypothesis" and note("We don't have any concrete proof") == "diagnostic_hypothesis"
    c = lambda f, t: value(spark, f(F.lit(t).cast("string")))
    assert c(evidence.clean_complaint, " <Robot  drifts> [x] more;") == "Robot drifts" and c(evidence.clean_complaint, " | ") is None and c(evidence.clean_complaint, None) is None
    assert c(evidence.clean_action, " [unclear] ") is None and c(evidence.clean_action, "N/A") is None and c(evidence.clean_action, "{Replaced   belts.}") == "Replaced belts"
    assert [c(evidence.semantic_role, t) for t in ("Check vacuum", "Home the robot", "Sign here", "")] == ["inspection", "test", "unknown", "unknown"]
    facts = F.array(*[F.struct(F.lit(a).alias("text"), F.lit(b).alias("evidence_quote"), F.lit(p).alias("part_number")) for a, b, p in (("belt", "new  belt", "B1"), ("belt", "", "B2"))])
    assert value(spark, evidence.fact_text(facts)) == "belt | new belt | B1 | B2"


def brute_pairs(rows, threshold):
    m = lambda a, b: difflib.SequenceMatcher(None, a, b).ratio()
    return sorted((a, b) for a, x in rows for b, y in rows if a < b and x and y and m(x, y) >= threshold)


def test_fuzzy_pairs_lose_none(spark):
    rng = random.Random(9)
    for threshold in (0.72, 0.4):
        rows = [(0, "abc"), (1, "axbyc"), (2, "AB"), (3, "A1B"), (4, "ABCD"), (5, "A1B2C3D"), (6, ""), (7, None), (8, "abc")]
        rows += [(10 + i, "".join(rng.choice("ab1XY") for _ in range(rng.randint(1, 9)))) for i in range(70)]
        got = sorted((r.a, r.b) for r in similar.fuzzy_pairs(spark.createDataFrame(rows, "k int, v string"), "k", "v", threshold).collect())
        assert got == brute_pairs([(k, v) for k, v in rows], threshold)
        assert (0, 1) in got


def ratings(t):
    import re

    return {re.sub(r"\s+", "", x) for x in re.findall(r"\b[0-9]+(?:\.[0-9]+)?\s*(?:AMPS|AMP|A|V|UF|PF|NF|OHMS|OHM)\b", t.upper())}


def test_part_number_pairs_equal_all_pairs(spark):
    rng = random.Random(4)
    base = ["QX100A", "QX10OA", "IXFX24N100", "FDH44N50", "LM5110", "15A-600V", "15A-250V"]
    rows = []
    for i in range(45):
        w = list(rng.choice(base))
        for _ in range(rng.randint(0, 2)):
            w[rng.randrange(len(w))] = rng.choice("01OIZ-")
        rows.append((i, "".join(w), rng.choice(["fuse 15A 600V", "fuse 15A", "600V", "mosfet", None]), rng.sample(["f1", "f2", "f3", "f4"], rng.choice([0, 0, 1, 2]))))
    code = lambda s: "".join(c for c in s.upper() if c.isascii() and c.isalnum())
    expected = {}
    for a, x, ta, fa in rows:
        for b, y, tb, fb in rows:
            if a >= b:
                continue
            p, q = code(x), code(y)
            common = next((i for i in range(min(len(p), len(q))) if p[i] != q[i]), min(len(p), len(q)))
            ra, rb = ratings(f"{x} {ta or ''}"), ratings(f"{y} {tb or ''}")
            conflict, shared = bool(ra and rb and not ra & rb), bool(set(fa) & set(fb))
            s = (difflib.SequenceMatcher(None, p, q).ratio() if p and q else 0) + (min(0.18, common / max(len(p), len(q)) * 0.25) if common >= 4 else 0) + 0.16 * shared - 0.28 * conflict
            if (shared and not conflict) or s >= 0.64 + 1e-9:
                expected[a, b] = round(s, 6)
    got = {(r.a, r.b): round(r.score, 6) for r in similar.part_number_pairs(spark.createDataFrame(rows, "k int, pn string, d string, f array<string>"), "k", "pn", "d", "f").collect()}
    assert {k: v for k, v in got.items() if abs(v - 0.64) > 1e-6} == {k: v for k, v in expected.items() if abs(v - 0.64) > 1e-6} and len(got) > 20


def test_descriptor_pairs_equal_all_pairs(spark):
    import re

    rng = random.Random(8)
    rows = [(i, rng.choice(["power mosfet", "mosfet n-channel", "fuse 15A 600V", "fuse 15A 250V", "fan", "cooling fan 24V"]) + rng.choice(["", " new", " x2"]), rng.choice(["", "for arm", "24V"]), rng.choice([[], ["QX100A"], ["QX10OA"], ["LM5110", "Z"]])) for i in range(40)]
    code = lambda n, p: "".join(c for c in (p[0] if p else n).upper() if c.isascii() and c.isalnum())
    expected = set()
    for a, na, ta, pa in rows:
        for b, nb, tb, pb in rows:
            if a < b:
                x, y = code(na, pa), code(nb, pb)
                wa, wb = ({w for w in re.findall("[a-z0-9]+", f"{n} {t}".lower()) if len(w) > 1} for n, t in ((na, ta), (nb, tb)))
                ra, rb = ratings(f"{na} {ta}"), ratings(f"{nb} {tb}")
                rated = 0.12 if ra and ra == rb else -0.30 if ra and rb and not ra & rb else 0
                s = max(difflib.SequenceMatcher(None, x, y).ratio() + 0.10 * bool(pa and pb) + rated, len(wa & wb) / len(wa | wb) + rated)
                if s >= 0.72:
                    expected.add((a, b))
    got = {(r.a, r.b) for r in similar.descriptor_pairs(spark.createDataFrame(rows, "k int, n string, t string, p array<string>"), "k", "n", "t", "p").collect()}
    assert got == expected and got


def test_components_are_packed_whole(spark):
    sizes = [1, 2, 9, 3, 3, 1, 5]
    rows, k = [], 0
    for c, n in enumerate(sizes):
        for _ in range(n):
            rows.append(("l", c, k))
            k += 1
    got = packing.pack_components(spark.createDataFrame(rows, "lane string, c int, k int"), "lane", "c", "k", 4).collect()
    first = {c: min(k for _, x, k in rows if x == c) for c in range(len(sizes))}
    batches, now = [], []
    for c in sorted(range(len(sizes)), key=lambda c: (-sizes[c], first[c])):
        members = [k for _, x, k in rows if x == c]
        if len(members) > 4:
            batches += ([now] if now else []) + [members[i : i + 4] for i in range(0, len(members), 4)]
            now = []
        else:
            if now and len(now) + len(members) > 4:
                batches.append(now)
                now = []
            now = now + members
    batches += [now] if now else []
    assert {r.k: r.batch for r in got} == {k: i for i, b in enumerate(batches) for k in b}


def test_a_swap_that_was_cut_short_loses_nothing(spark, tmp_path):
    at = f"file://{tmp_path}/t"
    files.replace_table(spark.range(3), at)
    spark.range(5).write.parquet(f"{at}.staged")
    fs, p = filesystem(spark, at)
    _, old = filesystem(spark, f"{at}.old")
    fs.rename(p, old)  # the driver died between the two renames
    assert files.recover(spark, at) and spark.read.parquet(at).count() == 5
    fs.rename(p, old)  # and again, with a staged table that was not written whole
    (tmp_path / "t.staged").mkdir()
    assert files.recover(spark, at) and sorted(r.id for r in spark.read.parquet(at).collect()) in ([0, 1, 2], [0, 1, 2, 3, 4])
    files.replace_table(spark.range(7), at)
    assert spark.read.parquet(at).count() == 7 and not fs.exists(old) and not files.recover(spark, f"{at}-none")


def test_scans_roots_and_samples(spark, tmp_path):
    scans = ledger.Scans(spark, f"file://{tmp_path}/scans")
    a = scans.begin("//share", "t1")
    b = scans.begin("//share", "t2")
    scans.finish(b, "completed", "t3", seen=4, added=4, errors=0)
    c = scans.begin("//share", "t4")
    scans.finish(c, "failed", "t5", errors=2)
    assert [r["status"] for r in scans.runs()] == ["interrupted", "completed", "failed"] and scans.last_completed()["seen"] == 4 and (a, b, c) == (1, 2, 3)
    assert scans.table().count() == 3
    with pytest.raises(ValueError):
        scans.finish(c, "running", "t")
    table = f"file://{tmp_path}/index"
    ledger.bind_root(spark, table, "\\\\Share\\A\\")
    ledger.bind_root(spark, table, "//share/a")
    with pytest.raises(RuntimeError):
        ledger.bind_root(spark, table, "//share/b")
    drawn = []
    draw = lambda: drawn.append(1) or spark.range(len(drawn) * 3)
    once = lambda **how: ledger.sample_once(spark, f"file://{tmp_path}/s", how.pop("version", "1"), draw, seed="x", **how).count()
    assert once(persist=False) == 3 and once() == 6 and once() == 6 and once(force=True) == 9 and once() == 9
    with pytest.raises(RuntimeError):
        once(version="2")


def test_rows_filled_merged_and_numbered(spark):
    rows = spark.createDataFrame([("e1", None, " "), ("e1", "L9", "fam"), ("e9", "", None), (None, None, None)], "event string, log string, family string")
    events = spark.createDataFrame([("e1", "L1", "arms"), ("e2", "L2", "belts")], "event string, log string, family string")
    got = records.fill_from_event(rows, events, "event", ["log", "family"], {"family": "[unknown equipment]"}).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, [("e1", "L1", "arms"), ("e1", "L9", "fam"), ("e9", None, "[unknown equipment]"), (None, None, "[unknown equipment]")]))
    plan = spark.createDataFrame([("e1", ["old"]), ("e2", ["old"])], "event string, rma array<string>")
    tracking = spark.createDataFrame([("e1", "R2"), ("e1", "R1"), ("e1", "R2"), ("e1", " "), ("e1", None)], "event string, rma string")
    assert {r.event: r.rma for r in records.merge_tracking(plan, tracking, "event", ["rma"]).collect()} == {"e1": ["R1", "R2"], "e2": []}
    assert [r.number for r in records.numbered(rows, ["event"], [F.col("log")]).orderBy("event", "log").collect()] == [1, 1, 2, 1]
