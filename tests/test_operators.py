import pytest
from pyspark.sql import functions as F

from factloom import providers
from factloom.functions import text
from factloom.operators import events, index, intervals, packing, parts, records, recurrence, search, similar, spans, terms, vectors


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


FILES = [
    "Power Supplies/RCL1A-1D-W3/Repairs/130130006 Line Card Original.jpg",
    "Power Supplies/RCL1A-1D-W3/Repairs/130130006 Unit Photo.jpg",
    "Robots/QX8/130130006 Line Card Original.jpg",
    "Power Supplies/RCL1A-1D-W3/Repairs/130813004 Line Card Warranty.JPG",
]


def test_file_index(spark):
    files = index.file_rows(spark.createDataFrame([(p, 10) for p in FILES], "path string, size long"))
    assert [r.detected_log for r in files.orderBy("relative_path").collect()] == ["130130006", "130130006", "130813004", "130130006"]
    n = lambda q, **k: index.search(files, q, **k).count()
    assert n("RCL1A LINE") == 2 and n("RCL1A LINE", extensions=(".jpg",)) == 2 and n("QX8 LINE") == 1 and n("130130006") == 3 and n('"line card" warranty') == 1
    assert index.search(files, "card", limit=1).first().total_matches == 3


def test_refresh(spark):
    old = spark.createDataFrame([("a", 1, 1, 1), ("b", 1, 1, 1), ("c", 1, 1, 1)], "p string, size int, first_seen_scan int, last_changed_scan int")
    new = spark.createDataFrame([("a", 1), ("b", 2), ("d", 1)], "p string, size int")
    assert rows(index.refresh(old, new, "p", ["size"]), "p") == [("a", "unchanged"), ("b", "changed"), ("c", "deleted"), ("d", "added")]
    assert dict(index.refresh(old, new, "p", ["size"], errors=1).collect())["c"] == "kept"
    assert rows(index.apply_refresh(old, new, "p", ["size"], 2).select("p", "first_seen_scan", "last_changed_scan"), "p") == [("a", 1, 1), ("b", 1, 2), ("d", 2, 2)]
    assert index.apply_refresh(old, new, "p", ["size"], 2, errors=1).count() == 4


def test_sample_is_independent_of_order(spark):
    df = spark.createDataFrame([(f"f{i}",) for i in range(95)], "folder string")
    a, b = (events.deterministic_sample(x, "folder", 10, "s") for x in (df, df.orderBy(F.desc("folder"))))
    assert a.count() == 10 and rows(a, "sample_rank") == rows(b, "sample_rank")


def test_frequency_counts_events_once_and_unstated_apart(spark):
    m = spark.createDataFrame([("fuse", "e1", 2), ("fuse", "e1", 1), ("fuse", "e2", None), ("board", "e3", None)], "f string, e string, q int")
    assert rows(parts.frequency(m, "f", "e", "q"), "f") == [("board", 1, 0, 1, 0, 1), ("fuse", 2, 3, 1, 0, 3)]


def test_descriptors_and_products(spark):
    m = spark.createDataFrame([("m1", "e1", "QX-100", "belt", 1, 1), ("m2", "e2", "qx 100", "Belt", None, 2), ("m3", "e2", "", "small  Shim", 3, 3)], "mention_id string, e string, pn string, d string, q int, o int")
    got = parts.descriptors(m, "mention_id", "e", "pn", "d", "d").orderBy("canonical_key").collect()
    assert [(r.canonical_key, r.mentions, r.events) for r in got] == [("DESC:small shim", 1, 1), ("PN:QX100", 2, 2)]
    p = parts.product_parts(m.withColumn("fam", F.lit("x")), "fam", "e", "pn", "d", "q", "o").orderBy("component_key").collect()
    assert [(r.component_key, r.repairs, r.pieces, r.unstated, r.display_name) for r in p] == [("pn:QX100", 2, 1, 1, "QX-100"), ("text:smallshim", 1, 3, 0, "small  Shim")]


def test_recurrence_needs_two_logs_and_two_sources(spark):
    c = spark.createDataFrame([("a", "L1", "s1"), ("a", "L2", "s1"), ("b", "L1", "s1"), ("b", "L2", "s2")], "g string, log string, src string")
    assert [r.g for r in recurrence.recurring(c, ["g"], "log", "src").collect()] == ["b"]


def test_service_areas_and_stocking(spark):
    label = lambda s: spark.range(1).select(recurrence.service_areas(F.lower(F.lit(s))).alias("a")).first().a
    assert label("Motor Replacements and Refurbishments") == ["Motors & harmonics", "Refurbishment / rebuild"] and label("Quiet") == ["Other technician signal"]
    ev = "g string, lane string, label string, log string, serial string, t string"
    data = [("arm", "repairs", "Arm Refresh", "L1", "S1", "Replaced bearings"), ("arm", "repairs", "Arm Refresh", "L2", "?", "new bearing"), ("arm", "repairs", "Arm Refresh", "L3", "S3", "looks fine"), ("one", "repairs", "Misc", "L9", "S9", "replaced belt"), ("lab", "components", "Y Belts", "L4", "S4", "anything")]
    out = recurrence.stocking(spark.createDataFrame(data, ev), "g", "lane", F.lower("label"), "log", "serial", "t")
    assert rows(out.select("item", "groups", "logs", "serials", "by_label"), "item") == [("Bearings", 1, 2, 1, 0), ("Belts", 1, 1, 1, 1)]


def test_repeated_lines_and_sanitised_view(spark):
    d = spark.createDataFrame([(1, "A long enough   line here\nLog # 5\nshort"), (2, "a LONG enough line here\nNotes: belt worn"), (3, None)], "k int, t string")
    assert rows(recurrence.repeated_lines(d, "k", "t"), "line") == [("a long enough line here", 2, 2)]
    v = recurrence.sanitised(d, "k", "t", [("identity", r"Log\s*#.*")], [r"Notes\s*:\s*"])
    assert rows(v, "k") == [(1, "A long enough   line here\n\nshort", 1), (2, "a LONG enough line here\nbelt worn", 0), (3, "", 0)]


ITEMS = "item_key string, item_type string, primary_value string, title string, equipment_family string, repair_event_id string, log_number string, source_path string, search_text string, rank_hint double"


def items(spark):
    data = [
        ("rma:1", "rma", "53434", "RMA 53434", "RCL1A", "e1", "130130006", None, 0.0), ("order:1", "order", "DGK52102", "DGK52102", "RCL1A", "e2", None, None, 0.0), ("event:1", "event", "e1", "Event e1", "RCL1A", "e1", "130130006", None, 0.0),
        ("event:2", "event", "e2", "Event e2", "QX8", "e2", None, None, 0.0), ("part:1", "product_part", "314-2GT", "Belt 314-2GT", "QX8", None, None, None, 1.0), ("file:1", "file", "Unit.jpg", "Unit.jpg", "", None, "130130006", "x/130130006 Unit.jpg", 0.0),
    ]
    return spark.createDataFrame([(*d[:8], " ".join(str(x or "") for x in d[2:8]).lower(), d[8]) for d in data], ITEMS)


def test_search_by_identifier_brings_linked_context(spark):
    hits = [r.item_key for r in search.search(items(spark), "53434").collect()]
    assert hits[0] == "rma:1" and set(hits) == {"rma:1", "event:1", "file:1"}
    assert {r.item_key for r in search.search(items(spark), "DGK52102").collect()} == {"order:1", "event:2"}
    assert [r.item_key for r in search.search(items(spark), "314").collect()][0] == "part:1"
    assert search.search(items(spark), "no such thing").count() == 0 and {r.item_key for r in search.search(items(spark), "qx8").collect()} >= {"event:2", "part:1"}
    g = search.grouped(search.search(items(spark), "rcl1a"), 1)
    assert g.groupBy("heading").count().where("count > 1").count() == 0


def test_pattern_search(spark):
    g = spark.createDataFrame([("Y Axis Drift", "drifts on y-axis", "", 9, 12), ("Vacuum Issues", "vac leak at valve", "Vacuum system", 4, 5), ("Belt wear", "new belt", "Belts & tension", 8, 9)], "label string, ev string, areas string, serials int, logs int")
    top = lambda q: [r.label for r in search.pattern_search(g, q, "label", "ev", "areas", "serials", "logs").collect()]
    assert top("Y axis drifting")[0] == "Y Axis Drift" and top("vacuum leak")[0] == "Vacuum Issues" and top("zzz") == []
    assert "vacuum" in search.expand("vac", search.ALIASES)[1] and "vac" in search.expand("vacuum", {"vac": ("vac",)})[1]


def test_fusion(spark):
    known = spark.createDataFrame([("a", 1, 1), ("b", 1, 1), ("c", 50, 90)], "k string, serials int, logs int")
    left = spark.createDataFrame([("a", 1), ("b", 2), ("zz", 3)], "k string, left_rank int")
    right = spark.createDataFrame([("b", 1), ("a", 2), ("c", 3)], "k string, right_rank int")
    out = {r.k: r for r in vectors.fuse(left, right, known, "k", "serials", "logs").collect()}
    assert set(out) == {"a", "b", "c"} and out["a"].score == pytest.approx(out["b"].score) and out["a"].score > out["c"].score and out["c"].retrieval == "deterministic"


def test_cosine(spark):
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 1.0]), (3, [0.0, 0.0])], "k int, v array<float>")
    assert [(r.k, round(r.similarity, 4)) for r in vectors.nearest(v, "k", "v", [1.0, 0.0], 2, 0.1).collect()] == [(1, 1.0), (2, 0.7071)]


def test_near_duplicates(spark):
    base = " ".join(f"w{i}" for i in range(40))
    d = spark.createDataFrame([(1, base), (2, base.upper()), (3, base + " tail"), (4, "other words entirely here"), (5, ""), (6, None), (7, "page 3 " + base)], "k int, t string")
    pairs = {(r.a, r.b) for r in similar.similar_pairs(d, "k", "t", 0.7).collect()}
    assert pairs == {(1, 2), (1, 3), (1, 7)}
    label = similar.components(similar.similar_pairs(d, "k", "t", 0.7))
    assert rows(similar.representatives(d, "k", label).where("kept"), "k") == [(k, k, True) for k in (1, 4, 5, 6)]


def test_fuzzy_and_greedy(spark):
    d = spark.createDataFrame([(1, "QX100A"), (2, "QX10OA"), (3, "ZZ999")], "k int, v string")
    assert [(r.a, r.b) for r in similar.fuzzy_pairs(d, "k", "v", 0.72).collect()] == [(1, 2)]
    g = spark.createDataFrame([("e", 1, "vacuum leak on arm"), ("e", 2, "vacum leak on arm"), ("e", 3, "belt loose")], "e string, k int, v string")
    assert rows(similar.greedy_clusters(g, ["e"], "k", "v"), "k") == [("e", 1, 0), ("e", 2, 0), ("e", 3, 1)]


def test_greedy_clusters_of_a_whole_group_and_lanes_equal_plain_python(spark):
    import difflib
    from collections import defaultdict

    from factloom.plans import QUERIES

    d = "/root/testdata/sf0.001"
    ratio = lambda a, b: difflib.SequenceMatcher(None, a, b).ratio()
    names, wanted = defaultdict(list), []
    for b, k, v in rows(spark.read.parquet(f"{d}/part.parquet").select("p_brand", "p_partkey", "p_name"), "p_partkey"):
        clusters = names[b]
        at = next((i for i, c in enumerate(clusters) if max(ratio(v, w) for w in c) >= 0.82), len(clusters))
        if at == len(clusters):
            clusters.append([])
        clusters[at].append(v)
        wanted.append((b, k, at))
    assert rows(QUERIES["greedy_cluster"](spark, d), "p_partkey") == wanted
    g = spark.createDataFrame([(None, 1, "red ring x"), (None, 2, "rad ring x"), (None, 3, "red ring x"), (None, 4, None), (None, 5, "")], "e string, k int, v string")
    assert rows(similar.greedy_clusters(g, ["e"], "k", "v"), "k") == [(None, 1, 0), (None, 2, 0), (None, 3, 0), (None, 4, 1), (None, 5, 2)]  # what is empty is like nothing
    g = spark.createDataFrame([("e", 1, "Belt-worn, arm A2 left side"), ("e", 2, "left side arm a2: belt worn"), ("e", 3, "BELT worn arm a2 left  side!")], "e string, k int, v string")
    assert rows(similar.greedy_clusters(g, ["e"], "k", "v"), "k") == [("e", 1, 0), ("e", 2, 0), ("e", 3, 0)]  # by words
    wanted, used = [], defaultdict(lambda: [0, 0])
    for k, lang, source, n in rows(spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang", "source", "n_chars"), "doc_id"):
        u = used[f"{lang}/{source}"]
        if u[1] and u[1] + n > 22_000:
            u[0], u[1] = u[0] + 1, 0
        u[1] += n
        wanted.append((f"{lang}/{source}", k, u[0]))
    assert rows(QUERIES["budget_packing"](spark, d), "doc_id") == wanted


def test_bound_pairs_equal_all_pairs(spark):
    q = ["a b c", "two words", "Привет мир", "foo bar", "example of it", "", "...", "STRASSE", "naïve", "ok\n go"]
    d = ["x A  B c y", "in two\nwords", "он сказал привет  МИР", "foobar", "an exam-\nple of it", None, "wait ... what", "die straße", "a NAÏVE one", "OK, go", "nothing"]
    quotes = spark.createDataFrame(list(enumerate(q)), "item int, q string")
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(d)], "k long, t string")
    wanted = rows(quotes.crossJoin(docs).where(text.is_bound("q", "t")).select("item", "k"), "item", "k")
    assert {(0, 0), (1, 1), (2, 2), (3, 3), (4, 4), (6, 6)} <= set(wanted)
    old, spans.QUOTES = spans.QUOTES, 3
    try:
        assert rows(spans.bound_pairs(quotes, docs, "item", "q", "k", "t"), "item", "k") == wanted
    finally:
        spans.QUOTES = old
    assert spans.bound_pairs(quotes.limit(0), docs, "item", "q", "k", "t").count() == 0


def test_terms(spark):
    d = spark.createDataFrame([(i, "Put RTZ and THE belt, ABCDEFG 12", "oem1", f"m{i % 2}") for i in range(4)], "k int, t string, oem string, model string")
    found = terms.occurrences(d, "k", "t", terms.TermRules())
    q = terms.queue(found, "k", "oem", "model", terms.TermRules())
    assert rows(q.select("term", "events", "serials", "models", "priority"), "term") == [("RTZ", 4, 1, 2, "MEDIUM")]
    assert rows(terms.suppression(found), "reason") == [("alpha_token_too_long_for_acronym", 4, 1), ("common_english_word", 4, 1)]
    assert terms.scope(found, "k", "oem", "model").first().suggested_scope == "OEM=oem1"
    k = terms.known_terms(spark.createDataFrame([(1, "Lead  screw and lead screws; misleads"), (2, "none")], "k int, t string"), "k", "t", {"lead screw": ("lead screws",)})
    assert rows(k, "k") == [(1, "lead screw", 2)]
    base = spark.createDataFrame([("RTZ", "old"), ("OK", "fine")], "raw_term string, normalized_meaning string")
    dec = spark.createDataFrame([("d1", "rtz", "new", "approve", 1), ("d2", "rtz", "newer", "approve", 2)], "decision_id string, raw_term string, meaning string, decision string, reviewed_at int")
    assert rows(terms.effective_glossary(base, dec), "raw_term") == [("OK", "fine", "base"), ("rtz", "newer", "decision")]


def test_decisions(spark):
    dec = "decision_id string, target_id string, decision string, value string, seq int, acknowledged boolean"
    prior = spark.createDataFrame([("d1", "t1", "approve", "v", 1, True), ("d2", "t1", "hold", None, 2, False)], dec)
    c = spark.createDataFrame([("t1",), ("t2",)], "target_id string")
    assert rows(records.with_decision(c, prior, "target_id", ["seq"]), "target_id") == [("t1", "hold", None), ("t2", "pending", None)]
    new = spark.createDataFrame([("d3", "t1", "approve", "w", 3, False), ("d4", "t2", "approve", "x", 3, False), ("d5", "t2", "nonsense", "x", 3, False), ("d1", "t1", "reject", "v", 9, True)], dec)
    assert [r.decision_id for r in records.append_decision(prior, new, c.where("target_id = 't1'")).orderBy("decision_id").collect()] == ["d1", "d2", "d4"]
    r = spark.createDataFrame([("r", "approve", "f", "s", 1), ("r", "reject", "old", "s", 2)], "record_id string, decision string, field_state_digest string, source_digest string, seq int")
    assert tuple(records.applicable(r, "r", F.lit("f"), F.lit("s")).first()) == ("approve", 1)


def test_exclusive_choice_and_canonical(spark):
    o = spark.createDataFrame([("g", True, False), ("g", False, False), ("h", True, False), ("h", True, False), ("i", True, True)], "g string, s boolean, a boolean")
    assert rows(records.exclusive_choice(o, ["g"], F.col("s"), F.col("a")).select("g", "resolved"), "g") == [("g", True), ("h", False), ("i", False)]
    v = spark.createDataFrame([("e", "Vacuum leak."), ("e", "vacuum LEAK"), ("f", "a"), ("f", "b")], "e string, v string")
    got = records.canonical(v, ["e"], "v", text.ocr_quality("v")).orderBy("e").collect()
    assert got[0].canonical in ("Vacuum leak.", "vacuum LEAK") and tuple(got[1]) == ("f", None, "values_differ")


def test_packing(spark):
    d = spark.createDataFrame([("l", i, n) for i, n in enumerate([5, 5, 5, 20, 3, 3])], "lane string, k int, n int")
    assert [r.batch for r in packing.budget_batches(d, "lane", "k", "n", 10).orderBy("k").collect()] == [0, 0, 1, 2, 3, 3]
    o = packing.overlapping_batches(d.where("k < 4 and k != 3"), "lane", "k", "n", 10, 1)
    assert rows(o.select("batch", "k"), "batch", "k") == [(0, 0), (0, 1), (1, 1), (1, 2)]
    assert rows(packing.component_batches(d, "lane", "k", 4), "k")[-1] == ("l", 5, 1)


def test_intervals(spark):
    d = spark.createDataFrame([("p", x) for x in (10, 20, 30, 50, 60, 200)], "g string, y int")
    assert rows(intervals.islands(d, ["g"], "y", 20).select("first", "last", "members"), "first") == [(10, 60, 5), (200, 200, 1)]
    pitch = intervals.pitch(d, ["g"], "y")
    assert pitch.first().pitch == 10 and [r.position for r in intervals.missing_lines(d.where("y < 100"), pitch, ["g"], "y").collect()] == [40]


def test_providers(spark):
    known = spark.createDataFrame([(c,) for c in "abcd"], "candidate_id string")
    p = spark.createDataFrame([("g1", "a"), ("g1", "b"), ("g1", "ghost"), ("g2", "b"), ("g2", "c")], "cluster_id string, candidate_id string")
    assert rows(providers.valid_clusters(p, known), "candidate_id") == [("g1", "a"), ("g1", "b"), ("single:c", "c"), ("single:d", "d")]
    s = spark.createDataFrame([(0, "x", ["a", "ghost"]), (1, "y", ["ghost"])], "position int, statement string, cited_ids array<string>")
    allowed = spark.createDataFrame([("a",)], "id string")
    assert [(r.statement, r.valid_ids) for r in providers.valid_citations(s, allowed).collect()] == [("x", ["a"])]
    with pytest.raises(ValueError):
        providers.assert_counts(known.withColumn("kind", F.lit("k")), {"k": 3}, "kind")


def test_islands_go_on_over_stretches(spark):
    """A group is numbered by stretches; islands over their borders stay whole, and null positions stand alone, first."""
    import random

    rng = random.Random(3)
    got = [(g, None if rng.random() < 0.02 else rng.randrange(300) - 40) for g in (1, 2, None) for _ in range(90)]
    want = []
    for g in (1, 2, None):
        n, last = 0, None
        runs = {}
        for x in sorted((x for h, x in got if h == g), key=lambda x: (x is not None, x or 0)):
            n += not (x is not None and last is not None and x - last <= 3)
            runs.setdefault(n, []).append(x)
            last = x
        want += [(g, n, r[0], r[-1], len(r)) for n, r in runs.items()]
    df = spark.createDataFrame(got, "g int, x int")
    order = lambda rows: sorted(map(repr, rows))
    for span in (1, 2, 7, 1000):
        assert order(tuple(r) for r in intervals.islands(df, ["g"], "x", 3, span=span).collect()) == order(want)
    once = intervals.islands(df.unionByName(df), ["g"], "x", 3, parts=3, span=2, distinct=True)
    assert order(map(tuple, once.collect())) == order(map(tuple, intervals.islands(df.distinct(), ["g"], "x", 3).collect()))


def test_recurring_values_are_dealt_by_value(spark):
    """One group's values are counted by shares: no copy of a row for each column, and no task that needs the whole group."""
    rows = spark.createDataFrame([("a", i % 50 if i % 7 else None, i % 3, i % 11) for i in range(400)] + [("b", 1, 1, 1), ("b", 2, 1, 2)], "g string, log int, src int, serial int")
    out = recurrence.recurring(rows, ["g"], "log", "src", "serial", parts=5)
    assert [tuple(r) for r in out.collect()] == [("a", 400, 50, 3, 11)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan and "distinct" not in plan.replace("distinct_", "")


def test_equal_spans_meet_once(spark, tmp_path, monkeypatch):
    """Copies of a span, and spans of groups that the other side lacks, are not written nor dealt to bins."""
    from factloom.operators import overlap
    from factloom.plans import QUERIES

    day = "date '2024-01-0"
    spark.sql(f"select id * 50 l_orderkey, if(id % 2 = 0, 3, 700) l_suppkey, {day}1' l_shipdate, 4.0D l_quantity from range(200)").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.sql(f"select 9 * id + 1 o_orderkey, 3 o_custkey, {day}2' o_orderdate from range(60)").write.parquet(f"{tmp_path}/orders.parquet")
    sizes, write = [], overlap.materialize
    monkeypatch.setattr(overlap, "materialize", lambda df, name: sizes.append(df.count()) or write(df, name))
    assert [tuple(r) for r in QUERIES["interval_overlaps"](spark, str(tmp_path)).collect()] == [(3, 6000, 6000)]
    assert sizes == [1, 1]


def test_nearest_rows_equal_the_pairwise_form(spark):
    """Products of matrices only shortlist: copies tie as they do pair by pair, odd rows and queries keep their places, small blocks change nothing."""
    import random

    from pyspark.sql import Window

    rng = random.Random(8)
    base = [[round(rng.uniform(-1, 1), 1) for _ in range(6)] for _ in range(12)]
    got = [(i, rng.choice(base)) for i in range(300)] + [(300, None), (301, [0.0] * 6), (302, [1.0, 2.0]), (303, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (None, base[0]), (304, [float("nan")] * 6)]
    v = spark.createDataFrame(got, "id int, v array<float>").repartition(3)
    q = v.where("id % 20 = 0 or id > 299").selectExpr("id q", "v qv")
    s = v.join(q, F.col("id") != F.col("q")).select("q", "id", vectors.cosine("v", "qv").alias("similarity"))
    want = s.withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("similarity"), "id"))).where("rank <= 7")
    shown = lambda df: sorted(repr(tuple(r)) for r in df.select("q", "id", "similarity", "rank").collect())
    expected = shown(want)
    found = vectors.nearest_of(q, v, "q", "id", "v", 7)
    assert found.schema["id"].dataType == v.schema["id"].dataType and shown(found) == expected
    plan = vectors.nearest_of(q.where("q % 20 = 0 and q < 300"), v.where("id < 300"), "q", "id", "v", 7)._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "Join" not in plan
