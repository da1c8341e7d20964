import hashlib
import uuid

import duckdb
from pyspark.sql import functions as F

from factloom.functions import evidence, ids, text
from factloom.plans import QUERIES, SQL


def one(spark, *columns, **row):
    df = spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} {'int' if isinstance(v, int) else 'string'}" for k, v in row.items())) if row else spark.range(1)
    return df.select(*columns).first()


def value(spark, column, **row):
    return one(spark, column.alias("v"), **row)["v"]


def test_text_forms(spark):
    t = "  Straße\t\\Foo-Bar_1 "
    assert one(spark, text.compact("t"), text.search_form("t"), text.path_form(F.lit("A\\B")), text.alnum_lower("t"), text.alnum_upper(F.lit("a-b 1")), text.query_form(F.lit("Z_axis, 43um!  a+b")), t=t)[:] == ("Straße \\Foo-Bar_1", "strasse \\foo-bar_1", "a/b", "straefoobar1", "AB1", "z axis 43um a+b")
    assert value(spark, text.tokens(F.lit("The belt, of a Z axis and the belt"))) == ["belt", "axis"]
    assert value(spark, text.duplicate_form(F.lit("Page 3 [unclear] Foo--Bar"))) == "foo bar"
    assert value(spark, text.compare_form(F.lit("It’s – “fine”"))) == "it s fine"
    assert value(spark, text.human_bytes(F.lit(None).cast("long"))) == "n/a" and value(spark, text.human_bytes(F.lit(512))) == "512 B" and value(spark, text.human_bytes(F.lit(1536))) == "1.5 KB"
    assert value(spark, text.shorten(F.lit("abcdef"), 4)) == "abc…" and value(spark, text.slug(F.lit("a b/c"))) == "a_b_c"
    assert value(spark, text.strip_rtf(F.lit("{\\rtf1\\b Hello\\par World}"))) == "Hello\nWorld"


def test_shingles_and_jaccard(spark):
    assert value(spark, text.shingles(F.lit("a b c d"))) == ["a b c", "b c d"]
    assert value(spark, text.shingles(F.lit("a b"))) == ["a b"] and value(spark, text.shingles(F.lit(" "))) == []
    empty = F.array().cast("array<string>")
    assert value(spark, text.jaccard(empty, empty)) == 1.0 and value(spark, text.jaccard(F.array(F.lit("x")), empty)) == 0.0
    assert value(spark, text.jaccard(F.array(F.lit("x"), F.lit("y")), F.array(F.lit("y"), F.lit("z")))) == 1 / 3


def test_grounding(spark):
    assert value(spark, text.is_bound(F.lit("New  BELT"), F.lit("a new belt was put in"))) and value(spark, text.is_bound(F.lit("QX-100"), F.lit("part qx 100 used")))
    assert not value(spark, text.is_bound(F.lit(""), F.lit("x"))) and not value(spark, text.is_bound(F.lit("pump"), F.lit("belt")))
    assert value(spark, text.holds_identifier(F.lit("ref dgk-52102."), F.lit("DGK52102"))) and not value(spark, text.holds_identifier(F.lit("x"), F.lit("-")))
    s = lambda q: value(spark, text.supported_slice(F.lit("Replaced  belt (A1) today"), F.lit(q)))
    assert s("belt (A1)")["mode"] == "exact" and s("Replaced belt")["slice"] == "Replaced  belt" and s("today!")["mode"] == "punctuation" and s("elt") is None and s("") is None


def test_log_numbers(spark):
    assert value(spark, ids.detect_log(F.lit("serial 80050608"))) is None and value(spark, ids.detect_log(F.lit("991332001 x 130130006"))) == "130130006"
    assert value(spark, ids.detect_log(F.lit("no"), F.lit("130813004 Line Card.JPG"))) == "130813004" and value(spark, ids.detect_log(F.lit("130130000"))) is None
    assert str(value(spark, ids.log_date(F.lit("130130006")))) == "2013-01-30" and value(spark, ids.log_sequence(F.lit("130130006"))) == 6
    assert value(spark, ids.pivot_log_date(F.lit("990231001"))) == "1999-02-31" and value(spark, ids.pivot_log_date(F.lit("691301001"))) is None
    f = lambda raw: value(spark, ids.form_date(F.lit(raw), F.lit("130130006")))
    assert f("2/3/13")["status"] == "plausible" and f("2/3/13")["days_from_log"] == 4 and f("")["status"] == "blank" and f("x")["status"] == "no_date"
    assert f("1/1/13 and 2/2/13")["status"] == "several_dates" and f("2/30/13")["status"] == "invalid_date" and f("2/3/71")["status"] == "implausible"
    assert value(spark, ids.initials(F.lit("j. k.")))["value"] == "JK" and value(spark, ids.initials(F.lit("J2")))["status"] == "invalid"


def test_identities(spark):
    assert value(spark, ids.content_id("c", F.lit("a"), F.lit("b"))) == "c_" + hashlib.sha256(b"a\nb").hexdigest()[:16]
    assert value(spark, ids.uuid5(uuid.NAMESPACE_DNS, F.lit("group-7"))) == str(uuid.uuid5(uuid.NAMESPACE_DNS, "group-7"))
    assert value(spark, ids.sample_key(F.lit("x"), "s")) == hashlib.sha256(b"s\0x").hexdigest()
    a, b = "f" * 64, "e" * 64
    assert value(spark, ids.hamming(ids.hash_pieces(F.lit(a)), ids.hash_pieces(F.lit(b)))) == 64
    assert [value(spark, ids.quantity(F.lit(x))) for x in ("3", "0", "10001", "several")] == [3, None, None, None]


def test_references(spark):
    ok = [value(spark, evidence.is_order_ref(F.lit(x))) for x in ("DGK52102", "MSR-123456", "NWK56548", "DSK520117", "LM5110", "IXFX24N100Q3")]
    assert ok == [True] * 4 + [False] * 2
    assert [value(spark, evidence.supplier_of(F.lit(x))) for x in ("DGK52102", "MSR-12345", "NWK56548")] == ["Digi-Key", "Mouser", None]
    assert value(spark, evidence.rma_number(F.lit("RMA # 53434"))) == value(spark, evidence.rma_number(F.lit("53434"))) == "53434"
    v = lambda e: value(spark, evidence.visible_order(F.lit(e)))
    assert v("Parts ordered DigiKey 55516")["ref"] == "55516" and v("see MSR 56889.")["ref"] == "MSR56889" and v("Mouser parts") is None and v("nothing") is None
    only = lambda pn, order, t, e: value(spark, evidence.procurement_only(F.lit(pn), F.lit(order), F.lit(t), F.lit(e)))
    assert only("56889", "", "MSR 56889", "MSR 56889") and only("DGK52102", "", "", "") and only("52102", "DGK52102", "", "") and not only("314-2GT", "", "belt 314-2GT", "MSR 1000")
    assert evidence.identifier_query("MSR 56889") and evidence.identifier_query("1526990") and evidence.identifier_query("314-2GT") and not evidence.identifier_query("vacuum leak")


def test_quantities(spark):
    q = lambda left, right: tuple(value(spark, evidence.quantity_near(F.lit(left), F.lit(right))))
    assert q("Replaced 2 ", " belts") == (2, "numeric_prefix") and q("x3 ", "") == (3, "explicit_x_quantity") and q("", " 4 for A1, 2 for B and 3 for C (9 total)") == (9, "explicit_total")
    assert q("several ", " shims") == (None, "not_established") and q("", " qty: 5") == (5, "explicit_qty_label")
    b = value(spark, evidence.quantity_breakdown(F.lit(" 4 for A1, 2 for B and 3 for C (9 total)"), F.lit(9)))
    assert [(p.quantity, p.context) for p in b.parts] == [(4, "A1"), (2, "B"), (3, "C")] and b.sum == 9 and b.verified
    assert value(spark, evidence.adjacent_part_number(F.lit("new NMB R8ZZ "))) == "R8ZZ" and value(spark, evidence.adjacent_part_number(F.lit("on A1 "))) is None
    assert value(spark, evidence.install_context(F.lit(" bearings  on the Z axis"))) == "on the Z axis"


def test_classes(spark):
    k = lambda t: value(spark, evidence.note_class(F.lit(t)))
    assert k("may be caused by wear") == "diagnostic_hypothesis" and k("failure due to wear") == "root_cause_candidate" and k("belt is loose") == "diagnostic_observation"
    m = lambda t: value(spark, evidence.mention_class(F.lit(t)))
    assert m("Replaced and cleaned belt") == "installed" and m("resurfaced commutators") == "serviced" and m("see belt") == "referenced"
    assert value(spark, evidence.file_kind(F.lit("a/B.JPG"))) == "image" and value(spark, evidence.extension(F.lit("a.b/c"))) == ""
    assert value(spark, evidence.is_system_path(F.lit("a\\Thumbs.db"))) and not value(spark, evidence.is_system_path(F.lit("a/b.jpg")))
    assert value(spark, evidence.functional_bucket(F.lit("15A 600V fast"))) == "fuse_protection" and value(spark, evidence.functional_bucket(F.lit("fan cover"))) == "mechanical"
    assert value(spark, text.rating_tokens(F.lit("15 A, 600V and 10 uF 15A"))) == ["10UF", "15A", "600V"]
    assert value(spark, evidence.query_mode(F.lit("common service areas"))) == "service-areas" and value(spark, evidence.query_mode(F.lit("130130006"))) == "log" and value(spark, evidence.query_mode(F.lit("80110451"))) == "serial"


def test_json_and_audit(spark):
    assert value(spark, text.tolerant_json(F.lit('```json\n{"a": 1}\n```'))) == '{"a": 1}' and value(spark, text.tolerant_json(F.lit('so {"a": 2} it is'))) == '{"a": 2}' and value(spark, text.tolerant_json(F.lit("none"))) is None
    a = value(spark, text.transcription_audit(F.lit("x\ny\nx\n\n" + "z\n" * 12)))
    assert (a.lines, a.filled, a.top_line, a.top_count, a.runaway) == (17, 15, "z", 12, True)
    assert value(spark, text.context_signature(F.lit("Put 3 new RTZ belts on"), "RTZ", 2)) == "<N> new <TERM> belts on"
    assert value(spark, text.part_like(F.lit("R8ZZ1 used"))) and not value(spark, text.part_like(F.lit("new belt")))


def test_forms_of_long_texts_equal_the_patterns(spark):
    """A long run of marks takes no time, and what is read off a text's start is what the whole text gives."""
    import random
    import re
    import time

    rng = random.Random(4)
    made = ["".join(rng.choice("ab. _-\t\nÄ9") * rng.choice([1, 1, 1, 90, 700]) for _ in range(rng.randint(0, 40))) for _ in range(300)] + ["x" * 80 + "." * 3000, "a" * 190, "a" * 191 + " " * 2000, " " * 3000 + "z"]
    df = spark.createDataFrame(list(enumerate(made)), "i int, t string")
    got = df.select("i", text.slug("t").alias("s"), text.shorten("t").alias("c"), text.tokens("t", ("a",)).alias("w"), (text.ocr_quality("t") > 0).alias("q")).orderBy("i").collect()
    for t, r in zip(made, got, strict=True):
        c = re.sub(r"[ \t\n]+", " ", t).strip(" ")
        assert r.s == (re.sub(r"[^A-Za-z0-9._-]+", "_", t).strip("_.")[:80] or "item")
        assert r.c == (c if len(c) <= 190 else c[:189] + "…")
        assert r.w == [w for w in dict.fromkeys(re.findall("[a-z0-9]+", t.lower())) if len(w) >= 2]
    run = spark.range(1).selectExpr("concat('a', repeat('.', 200000), 'b') t")
    before = time.time()
    assert run.select(text.slug("t")).first()[0] == "a" + "." * 79
    assert time.time() - before < 10


def test_displays_of_odd_texts_equal_their_sql(spark, tmp_path):
    texts = [None, "", "..._", "a\x0bb the c", "\x0b", "\xa0 the\u3000", "İstanbul the İ 12", "x " * 700, "a", "b"]
    sizes = [None, 0, 4, 1023, 1024, 1280, 1048575, 1048576, 5 * 10**9, -5000]
    spark.createDataFrame(list(zip(range(10), texts, sizes, strict=True)), "doc_id long, text string, n_chars long").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.execute(SQL["text_displays"]).fetchall()
    got = QUERIES["text_displays"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got)) == sorted(want)
