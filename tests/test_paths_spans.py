from pyspark.sql import functions as F

from factloom.functions import paths
from factloom.operators import spans


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_names(spark):
    v = lambda f, *a: value(spark, f(*map(F.lit, a)))
    assert v(paths.family_from_folder, "15450 - 10 SN 3011900D") == "15450 - 10" and v(paths.family_from_folder, "Robots") == "Robots"
    assert v(paths.serial_from_path, "a/RBT SN 80010732 x/b/c.jpg") == "80010732" and v(paths.serial_from_path, "SN  GB8-MT-80110451") == "80110451" and v(paths.serial_from_path, "x/y") is None
    assert v(paths.card_sequence, "x/130130006 Line Card (2).jpg") == 2 and v(paths.card_sequence, "x (a).jpg") is None
    assert v(paths.legacy_token, "12345678 2000000001 Line Card.jpg") == "2000000001"
    assert v(paths.event_identity, "f/130130006 Line Card.jpg", "f") == "log_130130006" and v(paths.event_identity, "f/20000001 Traveler.jpg", "f").startswith("legacy_20000001_") and v(paths.event_identity, "f/x.jpg", "f").startswith("record_")
    assert tuple(v(paths.assignment, "a/130130006 x/b.jpg")) == ("repair_event", "130130006") and v(paths.assignment, "a/b")["scope"] == "unit_level"
    assert v(paths.assignment, "130130006/130813004.jpg")["scope"] == v(paths.assignment, "139930006.jpg")["scope"] == "unresolved"
    assert [v(paths.evidence_role, p) for p in ("a/Thumbs.db", "130130006 Line Card.jpg", "Incoming photo 1.jpg", "x.png", "x.zzz", "x")] == ["system_metadata", "traveler", "receiving_photo", "photo", "technical_file", "unknown"]
    assert v(paths.display_statement, "Belts wear, seen across 5 serials and 9 logs (5 serials / 9 logs).") == "Belts wear"


LEXICON = {"belt": ("belts", "drive belt"), "bearing": ("bearings",)}


def test_mentions_have_positions(spark):
    d = spark.createDataFrame([(1, "New drive  belt and 2 Belts; bearings, belted"), (2, "nothing"), (3, None)], "k int, t string")
    found = spans.mentions(d, "k", "t", LEXICON, "lexicon", 50).orderBy("start").collect()
    text = "New drive  belt and 2 Belts; bearings, belted"
    assert [(r.canonical, r.raw) for r in found] == [("belt", "drive  belt"), ("belt", "Belts"), ("bearing", "bearings")]
    assert all(text[r.start : r.end] == r.raw for r in found)
    both = spans.mentions(d, "k", "t", LEXICON, "lexicon", 50).unionByName(spans.mentions(d, "k", "t", {"belt": ()}, "glossary", 100))
    kept = spans.resolve_overlaps(both, ["k"]).orderBy("start").collect()
    assert [(r.canonical, r.raw) for r in kept] == [("belt", "drive  belt"), ("belt", "Belts"), ("bearing", "bearings")]


def test_word_window(spark):
    t = "a b c d  BELT  e f g h"
    at = t.index("BELT")
    assert value(spark, spans.word_window(F.lit(t), F.lit(at), F.lit(at + 4), 2, 2)) == "c d  BELT  e f"
    assert value(spark, spans.word_window(F.lit("BELT"), F.lit(0), F.lit(4))) == "BELT"


def test_support_and_similarity(spark):
    a = spark.createDataFrame([("e", "Replaced Y axis drive belt")], "e string, action string")
    n = spark.createDataFrame([("e", "replaced y-axis drive belt today and tested"), ("e", "cleaned"), ("f", "Replaced Y axis drive belt")], "e string, note string")
    assert [(r.note, r.similarity) for r in spans.supported_actions(a, n, "e", "action", "note").collect()] == [("replaced y-axis drive belt today and tested", 0.95)]
    assert value(spark, spans.text_similarity(F.lit("Vacuum leak"), F.lit("vacuum  LEAK."))) == 1.0 and value(spark, spans.text_similarity(F.lit(""), F.lit("x"))) == 0.0


def test_anchors(spark):
    w = [(1, i, t, 10 * i, 5, 8, 4) for i, t in enumerate(["Final", "O.K.", "By:", "JK"])] + [(2, i, t, 10 * i, 25, 8, 4) for i, t in enumerate(["Serial", "Nurnber", "12"])]
    words = spark.createDataFrame(w, "line int, word_num int, text string, left int, top int, width int, height int")
    got = {r.label: r for r in spans.anchors(words, ["line"], {"serial": ("serial number",), "final": ("final ok by",), "none": ("warranty date",)}).collect()}
    assert set(got) == {"serial", "final"} and (got["serial"].line, got["serial"].left, got["serial"].right, got["serial"].top) == (2, 0, 18, 25)
    assert value(spark, spans.conflict_flags(F.lit("No Trouble Found"), F.lit(2), F.lit(0))) == ["conflicts_with_approved_repair_actions"]
