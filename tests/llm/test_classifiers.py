import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from factloom.llm import language, quality, rules, toxicity
from factloom.llm.common import labelled
from tests.llm.conftest import sentence


@pytest.fixture(scope="module")
def marked(spark):
    rng = random.Random(2)
    docs, labels = [], []
    for i in range(500):
        good, toxic = rng.random() < 0.7, rng.random() < 0.3
        t = "".join(sentence(rng, rng.randint(5, 12)) for _ in range(rng.randint(4, 10)))
        if not good:
            t = t.upper().replace(".", "!!")
        if toxic:
            t += "you are a complete " + rng.choice(["nasty", "horrid"]) + " thing. " + sentence(rng, 6)
        docs.append((i, t, "x" if i % 2 else "y", "s"))
        labels.append((i, int(good), int(toxic)))
    docs += [(900, None, "x", "s"), (901, "", "x", "s"), (None, "words", "x", "s")]
    labels += [(3, None, None), (None, 1, 1), (77, 0, 0), (100_000, 1, 1)]
    return spark.createDataFrame(docs, "doc_id long, text string, lang string, source string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def accuracy(out, labels, column, n):
    one = labels.where(F.col(column).isNotNull()).groupBy("doc_id").agg(F.min(column).alias("y"), F.count("*").alias("k")).where("k = 1")
    rows = out.join(one, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(held) > 50 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert out.count() == n and all(0 <= r.score <= 1 for r in out.collect())
    return np.mean([r.predicted == r.y for r in held])


def test_quality_held_out(marked):
    docs, labels = marked
    out = quality.quality_scores(docs, labels)
    assert accuracy(out, labels, "quality", 503) > 0.97
    assert out.where(F.col("predicted") != (F.col("score") >= 0.3).cast("int")).count() == 0


def test_toxicity_held_out_and_located(marked):
    docs, labels = marked
    out = toxicity.toxicity_scores(docs, labels)
    assert accuracy(out, labels, "toxic", 503) > 0.97
    assert all(len(r.offending) == r.n_offending for r in out.collect())
    found = toxicity.score(docs.where("doc_id < 40"), toxicity.fit(docs, labels), keep=["doc_id", "text"]).where("toxicity >= 0.5").collect()
    assert found and all(any("nasty" in s.sentence or "horrid" in s.sentence for s in r.offending) for r in found)


def test_toxicity_samples_four_thousand_a_class(spark):
    ids = spark.range(12_000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("toxic"))
    counts = {r.y: r["count"] for r in labelled(ids, "toxic", toxicity.SAMPLE, per_class=True).groupBy("y").count().collect()}
    assert set(counts) == {0, 1} and all(abs(n - 4_000) < 200 for n in counts.values())


def test_classifiers_without_labels_or_rows(marked):
    docs, labels = marked
    none = labels.limit(0)
    assert all(abs(r.score - 0.5) < 0.01 for r in quality.quality_scores(docs, none).collect())
    assert {r.score for r in toxicity.toxicity_scores(docs, none).collect()} == {0.5}
    assert quality.quality_scores(docs.limit(0), labels).count() == 0 and toxicity.toxicity_scores(docs.limit(0), labels).count() == 0


def test_isotonic_is_monotone_and_keeps_the_mean():
    rng = np.random.default_rng(0)
    x = rng.normal(size=400)
    y = (rng.random(400) < 1 / (1 + np.exp(-2 * x))).astype(float)
    knots, values = quality.isotonic(x, y)
    assert (np.diff(values) > 0).all() and (np.diff(knots) > 0).all()


def brute_language(docs):
    """Profiles and out-of-place distances from the definition, on unhashed n-grams."""
    from collections import Counter

    def grams(text):
        c = "".join(ch.lower() if ch.isalpha() else " " for ch in text or "")
        s = " " + " ".join(c.split()) + " "
        s = s if c.strip() and c[-1:] == " " else s[:-1]
        out = Counter()
        for n in (1, 2, 3):
            for i in range(len(s) - n + 1):
                g = s[i : i + n]
                if (n == 1 and g == " ") or (n == 3 and g[1] == " "):
                    continue
                out[g] += 1
        return out

    return grams(docs)


def test_language(spark, nothing):
    rng = random.Random(4)
    a, b = ["tarin", "molek", "savet", "porin"], ["özgül", "çabuk", "şeker", "ığdır"]
    rows = [(i, " ".join(rng.choice(a if i % 2 else b) for _ in range(30)), "aa" if i % 2 else "bb") for i in range(200)]
    rows += [(900, None, "aa"), (901, "123 456 !!", "aa"), (902, "", None), (903, "özgül çabuk", None), (None, "tarin molek", "aa")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in language.language_predictions(docs).collect()}
    assert all(got[i].lang_pred == lang for i, _, lang in rows[:200])
    assert got[900].lang_pred == got[901].lang_pred == got[902].lang_pred == "und" and got[900].score == 0 and got[903].lang_pred == "bb" and got[None].lang_pred == "aa"
    empty = language.language_predictions(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in empty.collect()} == {"und"}
    assert language.language_predictions(nothing).count() == 0


def test_ngrams_equal_plain_python():
    import pyarrow as pa

    from factloom.llm import textbatch as tb

    texts = ["Ein Hund!", "", "ñandú  y más", "x", None, "a1b"]
    (s,) = tb.slices(pa.array(texts))
    g, row = language.grams(s)
    for i, t in enumerate(texts):
        expected = brute_language(t)
        assert sorted(np.unique(g[row == i], return_counts=True)[1]) == sorted(expected.values()), t


def brute_rules(text):
    import re

    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    triples = {}
    for i in range(len(w) - 2):
        triples.setdefault(tuple(w[i : i + 3]), []).append(i)
    covered = {i + k for at in triples.values() if len(at) > 1 for i in at for k in range(3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered), failed


def test_rules_equal_plain_python(docs, corpus, spark, nothing):
    rows = list(corpus) + [(500, "a b c a b c\na b c a b c\n\n a b c a b c\né#|", "aa", "s1", 0), (501, "x\n" * 80, "aa", "s1", 0)]
    out = rules.rule_verdicts(spark.createDataFrame(rows, docs.schema)).collect()
    got = sorted((repr(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in out)
    assert got == sorted((repr(r[0]), *brute_rules(r[1])) for r in rows)
    assert not any(r.kept and r.base_failed for r in out) and any(r.kept for r in out)
    assert rules.rule_verdicts(nothing).count() == 0


def test_rules_adapt_by_group(spark):
    rng = random.Random(8)
    rows = []
    for i in range(600):
        t = "".join(sentence(rng, 10) for _ in range(9))
        rows.append((i, "# ".join(t.split()) if i % 2 else t, "aa", "code" if i % 2 else "prose"))
    rows.append((9000, "# ".join("".join(sentence(rng, 10) for _ in range(9)).split()), "aa", "prose"))
    kept = {r.doc_id: r.kept for r in rules.rule_verdicts(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert all(kept[i] for i in range(600)) and not kept[9000]


def brute_verdicts(rows, far, prior):
    """kept of each row, from exact quantiles (the least value that a share of the group's values does not exceed) of the texts that pass the base rules."""
    import math
    import re

    rates = []
    for _, text, lang, source in rows:
        t = text or ""
        n, chars, symbols, dup, repeat, failed = brute_rules(t)
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        upper, exclaims = len(re.findall("[A-Z]", t)), t.count("!")
        pairs = ((symbols, chars), (repeat, n), (dup, len(lines)), (upper, chars), (exclaims, chars))
        rates.append((lang or "\0", source or "\0", failed, [math.log((k + 0.5) / (m - k + 0.5)) for k, m in pairs], pairs))
    seen = [r for r in rates if not r[2]]
    at = lambda v, q: sorted(v)[max(0, math.ceil(q * len(v)) - 1)]
    spread = lambda v: at(v, 0.75) - at(v, 0.25)
    error = lambda k, m: 1 / (k + 0.5) + 1 / (m - k + 0.5)
    mix = lambda n, x, y: (n * x + prior * y) / (n + prior)
    out = []
    for lang, source, failed, odds, pairs in rates:
        ok = not failed
        for k in range(5):
            every, of_lang = [r[3][k] for r in seen], [r[3][k] for r in seen if r[0] == lang]
            groups = {}
            for r in seen:
                if r[0] == lang:
                    groups.setdefault(r[1], []).append(r[3][k])
            own = groups.get(source, [])
            if not own:
                ok = False
                break
            floor = sum(len(g) * spread(g) for g in groups.values()) / len(of_lang)
            quartile = mix(len(own), at(own, 0.75), mix(len(of_lang), at(of_lang, 0.75), at(every, 0.75)))
            width = mix(len(own), max(spread(own), floor), mix(len(of_lang), spread(of_lang), spread(every)))
            fence = quartile + far * width
            count, m = pairs[k]
            ok = ok and odds[k] - fence <= rules.CLEAR * math.sqrt(error(count, m) + error(m / (1 + math.exp(-fence)), m))
        out.append(ok)
    return out


def test_rule_verdicts_equal_exact_quantiles(spark):
    rng = random.Random(21)
    rows = []
    for i in range(420):
        n = rng.randint(5, 30)
        t = "".join(sentence(rng, 10).capitalize() for _ in range(n)).split()
        source = rng.choice(["s1", "s2", "s2", None, "rare"] if i % 20 == 0 else ["s1", "s2", "s2", None])
        for _ in range(rng.choice([0, 0, 1, 4, 40])):
            t[rng.randrange(len(t))] += rng.choice("#!|")
        text = " ".join(t)
        rows.append((i, text + ("\n" + text[:200]) * rng.choice([0, 0, 0, 3]), rng.choice(["aa", "aa", "bb"]), source))
    rows += [(1000 + k, rows[0][1], "aa", "s1") for k in range(60)] + [(2000, None, "aa", "s1"), (2001, "few words", "cc", "s9"), (2002, "#" * 300 + " x" * 60, "cc", "s9")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r.kept for r in rules.rule_verdicts(docs).collect()}
    expected = brute_verdicts(rows, rules.FAR, rules.PRIOR)
    assert [got[r[0]] for r in rows] == expected
    assert 0 < sum(expected) < sum(not brute_rules(r[1])[-1] for r in rows)
    fences = rules.thresholds(rules.metrics(docs))
    assert fences.select("symbol_rate_fence").distinct().count() == fences.count() > 3  # every group's own texts count


def test_every_rate_rejects(spark):
    rng = random.Random(31)
    rows = []
    for i in range(400):
        lines = [" ".join(sentence(rng, 12).strip().capitalize() for _ in range(2)) for _ in range(10)]
        if i % 3 == 0:
            lines[rng.randrange(10)] += "!"
        rows.append([i, "\n".join(lines), "aa", "s"])
    odd = {}
    text = lambda: "".join(sentence(rng, 12) for _ in range(40))
    odd["symbol_rate"] = " ".join(w + "#|" for w in text().split())
    odd["upper_rate"] = text().upper()
    odd["exclaim_rate"] = " ".join(w + "!!" for w in text().split())
    odd["dup_line_rate"] = "\n".join(sentence(rng, 12) + "\nsame" for _ in range(40))  # one short line again and again
    few = text().split()
    odd["repeat_rate"] = " ".join(few + few[:100])  # under half of the words
    rows += [[1000 + k, t, "aa", "s"] for k, t in enumerate(odd.values())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    measured = rules.metrics(docs)
    keyed = measured.withColumns({"__lang": measured["lang"], "__source": measured["source"]}).join(rules.thresholds(measured), ["__lang", "__source"])
    flags = {r["doc_id"]: r for r in keyed.select("doc_id", "base_failed", *[rules._clearly_above(r).alias(r) for r in rules.RATES]).collect()}
    for k, rate in enumerate(odd):
        assert not flags[1000 + k]["base_failed"], rate
        assert flags[1000 + k][rate], rate
    assert sum(any(flags[i][r] for r in rules.RATES) for i in range(400)) <= 4  # far-out limits let nearly all of one kind pass


def brute_predictions(rows):
    """Profiles, ranks and out-of-place distances with dictionaries; n-grams are those of the operator, which another test compares."""
    import zlib
    from collections import Counter

    import pyarrow as pa

    from factloom.llm import textbatch as tb

    def counted(text):
        (s,) = tb.slices(pa.array([text], pa.string()))
        return Counter(language.grams(s)[0].tolist())

    ranked = lambda c: sorted(c, key=lambda g: (-c[g], g))[: language.PROFILE]
    total = {}
    for i, text, lang in rows:
        if text is not None and lang is not None and zlib.crc32(str(i).encode()) % 5 != 0:
            total.setdefault(lang, Counter()).update(counted(text))
    profile = {k: {g: r for r, g in enumerate(ranked(c))} for k, c in sorted(total.items())}
    out = []
    for _, text, _ in rows:
        own = ranked(counted(text))
        if not own:
            out.append(("und", 0.0))
            continue
        far = {k: sum(abs(p[g] - r) if g in p else language.PROFILE for r, g in enumerate(own)) for k, p in profile.items()}
        best = min(far, key=lambda k: (far[k], k))
        out.append((best, 1 - far[best] / (language.PROFILE * len(own))))
    return out


def test_languages_equal_brute_force(spark):
    rng = random.Random(13)
    a, b = [sentence(rng, 1)[:-2] for _ in range(60)], ["".join(rng.choice("qwxyzåé𐐀") for _ in range(5)) for _ in range(60)]
    rows = [(i, " ".join(rng.choice(a if i % 3 else b) for _ in range(rng.randint(1, 60))), "aa" if i % 3 else "bb") for i in range(150)]
    rows += [(1, rows[1][1], "aa")] * 3  # repeated rows
    rows += [(300, "😀😀 123", "aa"), (301, "𝟘 12", "bb"), (302, "𐐀𐐁 𐐂", "bb"), (303, "", "aa"), (304, None, "aa"), (305, " ".join(a * 4000), None)]
    rows += [(400 + k, "kk jj", lang) for k, lang in enumerate(["dd", "cc"] * 6)]  # two languages alike: the smaller code wins
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("lang_pred", F.lit("mine")).withColumn("lang_score", F.lit(9))
    got = [(r.lang_pred, round(r.lang_score, 9)) for r in language.identify(docs, language.Model.of(language.profiles(docs))).orderBy("doc_id").collect()]
    order = sorted(range(len(rows)), key=lambda i: rows[i][0])
    expected = brute_predictions(rows)
    assert got == [(expected[i][0], round(expected[i][1], 9)) for i in order]
    by = {rows[i][0]: g[0] for i, g in zip(order, got, strict=True)}
    assert by[300] == by[301] == by[303] == by[304] == "und" and by[302] == "bb" and by[305] == "aa" and by[400] == by[401] == "cc"


def brute_statistics(text):
    """STATISTICS of a text, from the words and lines themselves."""
    import math
    import re
    from collections import Counter

    t = text or ""
    raw = t.encode()
    words, lines = re.findall(rb"[^\x20\x09-\x0D]+", raw), [x for x in raw.split(b"\n") if x]
    n, size = len(words), sum(map(len, words))
    triples = [tuple(words[i : i + 3]) for i in range(n - 2)]
    again = lambda v: len(v) - len(set(v))
    count = lambda pattern: len(re.findall(pattern, raw))
    upper, lower, chars, one, a_line = count(rb"[A-Z]"), count(rb"[a-z]"), max(size, 1), max(n, 1), max(len(lines), 1)
    return [
        math.log1p(n), math.log1p(size / one), upper / max(upper + lower, 1), count(rb"[0-9]") / chars, math.sqrt(count(rb"[#*$%&|<>]") / chars), math.sqrt(count(rb"[!?]") / chars), count(rb"[.,;:'\"()-]") / chars,
        count(rb"[\x80-\xff]") / chars, len(set(words)) / one, max(Counter(words).values(), default=0) / one, math.sqrt(again(triples) / max(len(triples), 1)), math.sqrt(again(lines) / a_line),
        math.log1p(len(lines)), math.log1p(n / a_line), sum(len(x) < 30 for x in lines) / a_line,
    ]


def test_statistics_equal_plain_python(corpus):
    import pyarrow as pa

    texts = [r[1] for r in corpus] + ["a b a b a b\n\na b\na b", "é ß – x", "\n", "word " * 50_000]
    got = quality._all_statistics(pa.array(texts, pa.string()))
    assert np.allclose(got, [brute_statistics(t) for t in texts])


def test_fourier_features_approximate_the_kernel():
    rng = np.random.default_rng(5)
    d, many = len(quality.STATISTICS), 40_000
    m = quality.Model(np.zeros(d), np.ones(d), rng.normal(scale=np.sqrt(2 * quality.GAMMA), size=(d, many)), rng.uniform(0, 2 * np.pi, many), np.zeros(many + 1), np.zeros(1), np.zeros(1))
    x = rng.normal(scale=0.6, size=(12, d))
    z = m.lift(x)[:, :-1]
    kernel = np.exp(-quality.GAMMA * ((x[:, None] - x[None]) ** 2).sum(axis=2))
    assert np.abs(z @ z.T - kernel).max() < 0.03


def test_ridge_equals_one_solution_of_all_rows(marked, spark):
    """The weights from partition sums are those of the whole sample's normal equations."""
    import pyarrow as pa

    docs, labels = marked
    model = quality.fit(docs, labels)
    y = {r.doc_id: r.y for r in labelled(labels, "quality", quality.SAMPLE).collect()}
    rows = docs.where("doc_id is not null").select("doc_id", "text", (F.pmod(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1000)), F.lit(5)) == 0).alias("part")).collect()
    rows = [r for r in rows if r.doc_id in y]
    x = quality._all_statistics(pa.array([r.text for r in rows], pa.string()))
    assert np.allclose(model.mean, x.mean(axis=0)) and np.allclose(model.scale, np.where(x.std(axis=0) > 1e-9, x.std(axis=0), 1))
    labels_ = np.array([y[r.doc_id] for r in rows])
    n, ones = len(rows), labels_.sum()
    use = np.array([not r.part for r in rows])
    z = model.lift(x[use])
    w = np.where(labels_[use] == 1, 0.5 * n / ones, 0.5 * n / (n - ones))
    a = z.T @ (w[:, None] * z) + quality.RIDGE * n * np.diag(np.r_[np.ones(z.shape[1] - 1), 1e-6])
    assert np.allclose(a @ model.weights, z.T @ (w * labels_[use]), rtol=1e-6, atol=1e-6)


def test_isotonic_equals_the_min_max_formula():
    rng = np.random.default_rng(2)
    x, y = np.sort(rng.normal(size=60)), (rng.random(60) < 0.5).astype(float)
    knots, values = quality.isotonic(x, y)
    mean = lambda i, j: y[i : j + 1].mean()
    expected = [max(min(mean(i, j) for j in range(k, 60)) for i in range(k + 1)) for k in range(60)]
    assert np.allclose([values[np.searchsorted(knots, v, side="left").clip(max=len(knots) - 1)] if v in knots else np.interp(v, knots, values) for v in knots], values)
    blocks = sorted(set(np.round(expected, 9)))
    assert np.allclose(sorted(values), blocks)


def test_noisy_or_gradient_and_score_equal_definitions():
    import pyarrow as pa

    from factloom.llm import textbatch as tb

    rng = np.random.default_rng(3)
    feature, sentence_ = rng.integers(0, 9, 40), np.sort(rng.integers(0, 12, 40))
    bag, y = np.sort(rng.integers(0, 5, 12)), np.array([1.0, 0, 1, 0, 1])
    w, b, weight = rng.normal(size=9), -0.7, np.array([1.0, 2, 1, 2, 1])

    def loss(w, b):
        out = 0.0
        for k in range(5):
            none = 1.0
            for s in np.flatnonzero(bag == k):
                none *= 1 - 1 / (1 + np.exp(-(b + sum(w[f] for f in feature[sentence_ == s]))))
            out -= weight[k] * np.log(1 - none if y[k] else none) if (bag == k).any() else 0.0
        return out

    g, gb = toxicity._gradient(feature, sentence_, bag, y, w, b, weight)
    eps = 1e-6
    for k in range(9):
        e = np.eye(9)[k] * eps
        assert abs((loss(w + e, b) - loss(w - e, b)) / (2 * eps) - g[k]) < 1e-4
    assert abs((loss(w, b + eps) - loss(w, b - eps)) / (2 * eps) - gb) < 1e-4
    # a document's score, sentence by sentence, each hashed on its own
    model = toxicity.Model(rng.normal(scale=0.5, size=1 << toxicity.BITS), -2.0)
    texts = ["One thing here. Another Thing there! And a third\nline? ...", "", None, "word", "x. " * 3000, "One thing here."] * 2
    (s,) = tb.slices(pa.array(texts))
    x = toxicity.sentences(s)
    got = model.document(model.sentence(x), x.row, s.rows)
    for t, p in zip(texts, got, strict=True):
        none = 1.0
        for part in __import__("re").split(r"[.!?\n]", t or ""):
            (one,) = tb.slices(pa.array([part]))
            f = toxicity.sentences(one)
            if len(f.row):
                assert len(f.row) == 1
                with_, without = (1 / (1 + np.exp(-v)) for v in (model.bias + model.weights[f.feature].sum(), model.bias))
                none *= min(1, (1 - with_) / (1 - without))
        assert abs(p - (1 - none)) < 1e-9


def test_scores_of_odd_rows(marked):
    """Very long texts, repeated rows and columns named as outputs."""
    docs, labels = marked
    long = "".join("plain words stand in one row. " for _ in range(60_000))
    odd = docs.sparkSession.createDataFrame([(1, long), (2, long + "you are a complete nasty thing."), (3, "few"), (3, "few"), (None, None)], "doc_id long, text string").withColumns({c: F.lit("mine") for c in ("toxicity", "offending", "quality_score", "y", "h", "part", "score")})
    out = toxicity.score(odd, toxicity.fit(docs, labels)).orderBy("doc_id").collect()
    assert [r.doc_id for r in out] == [None, 1, 2, 3, 3] and out[0].toxicity == 0 and out[1].toxicity < 0.5 < out[2].toxicity and out[3] == out[4]
    assert [s.sentence for s in out[2].offending] == ["you are a complete nasty thing"] and out[0].h == "mine"
    q = quality.score(odd, quality.fit(docs.withColumn("y", F.lit("mine")).withColumn("part", F.lit(1)), labels)).orderBy("doc_id").collect()
    assert all(0 <= r.quality_score <= 1 for r in q) and q[3] == q[4] and q[0].y == "mine"


def test_quality_learns_from_every_label(spark):
    labels = spark.range(30_000).selectExpr("id doc_id", "cast(id % 2 as int) quality")
    assert labelled(labels, "quality", quality.SAMPLE).count() == labels.where("crc32(cast(doc_id as string)) % 5 <> 0").count()


def test_pooled_ranges_pool_as_all_rows():
    rng = np.random.default_rng(6)
    raw = np.sort(rng.normal(size=500))
    y = (rng.random(500) < 1 / (1 + np.exp(-raw))).astype(float)
    rows = np.column_stack([np.ones(500), y, raw])
    b = quality._pool(np.concatenate([quality._pool(rows[i : i + 70]) for i in range(0, 500, 70)]))
    knots, values = quality.isotonic(raw, y)
    assert np.allclose(b[:, 2] / b[:, 0], knots) and np.allclose(b[:, 1] / b[:, 0], values)


def test_quality_joins_statistics_and_no_text(marked, monkeypatch):
    """What a fit moves to the labels is as long for every text."""
    docs, labels = marked
    sides = []

    def walk(plan):
        below = [plan.children().apply(k) for k in range(plan.children().size())]
        if plan.nodeName() == "Join":
            sides.extend({p.output().apply(k).name() for k in range(p.output().size())} for p in below)
        for p in below:
            walk(p)

    def stored(df, *more):
        walk(df._jdf.queryExecution().optimizedPlan())
        return materialize(df, *more)

    materialize = quality.materialize
    monkeypatch.setattr(quality, "materialize", stored)
    model = quality.fit(docs, labels)
    scores = {r.doc_id: r.score for r in quality.quality_scores(docs, labels).collect()}
    assert len(sides) == 4 and not any("text" in s for s in sides)
    by_text = quality.score(docs, model, keep=["doc_id"]).collect()
    assert len(by_text) == 503 and all(abs(scores[r.doc_id] - r.quality_score) < 1e-9 for r in by_text)
