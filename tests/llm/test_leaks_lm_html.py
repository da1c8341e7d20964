import collections
import math
import random
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from factloom.llm import decontaminate, extraction, language_model
from tests.llm.conftest import sentence


def test_lcs():
    def plain(a, b):
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        return t[-1][-1]

    rng = random.Random(1)
    for _ in range(60):
        a, b = ([rng.randint(0, 6) for _ in range(rng.randint(1, 25))] for _ in range(2))
        assert decontaminate.lcs(np.array(a), np.array(b)) == plain(a, b)


def test_leaks_verbatim_paraphrased_and_none(spark, nothing):
    rng = random.Random(3)
    items = [(i, sentence(rng, rng.randint(14, 40)) + f"answer{i} key{i}") for i in range(30)] + [(90, None), (91, "")]
    filler = lambda: "".join(sentence(rng, 9) for _ in range(20))
    docs, expected = [], set()
    for i in range(30):
        docs.append((i, filler() + items[i][1] + " " + filler(), "x"))
        expected.add((i, i))
        w = items[i][1].upper().split()
        del w[3]
        w.insert(8, "inserted")
        docs.append((100 + i, "Start, " + " ".join(w) + "; end.", "x"))
        expected.add((100 + i, i))
        docs.append((200 + i, filler(), "x"))
        words = items[i][1].split()
        docs.append((300 + i, filler() + " ".join(words[: len(words) // 3]) + filler(), "x"))
    docs += [(900, None, "x"), (901, "", "x"), (None, items[0][1], "x")]
    table = spark.createDataFrame(docs, "doc_id long, text string, leaks string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(table, benchmark).collect()}
    assert got == expected | {(None, 0)}
    clean = decontaminate.clean(table, benchmark)
    assert clean.columns == table.columns and clean.count() == len(docs) - 61
    # several blocks give the same
    assert {(r.doc_id, r.item_id) for r in decontaminate.leaks(table, benchmark, block_words=150).collect()} == got
    assert decontaminate.clean(table, benchmark, block_words=150).count() == len(docs) - 61
    assert decontaminate.leaks(table, benchmark.limit(0)).count() == 0 and decontaminate.leaks(nothing, benchmark).count() == 0


def test_paraphrase_recall(spark):
    """1,200 paraphrases with known longest common subsequences and answers: all that qualify are found, and the cosine gate loses none of them."""
    rng = random.Random(17)
    nouns = ["".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(3)) for _ in range(900)]
    other = ["x" + w for w in nouns]
    items = {f"item-{i}": [rng.choice(nouns) for _ in range(rng.randint(18, 31))] + [f"answer{i}", f"key{i}"] for i in range(60)}
    rows, expected = [], set()
    for k in range(1200):
        name = rng.choice(list(items))
        item, rate, out = items[name], rng.choice([0.05, 0.15, 0.25, 0.35]), []
        for w in item:
            x = rng.random()
            if x < rate * 0.4:
                continue
            out.append(rng.choice(other) if x < rate * 0.8 else w)
            if x > 1 - rate * 0.3 and len(out) > 1:
                out[-1], out[-2] = out[-2], out[-1]
        code = {w: i for i, w in enumerate(set(item + out))}
        common = decontaminate.lcs(np.array([code[w] for w in item]), np.array([code[w] for w in out]))
        if common >= 0.7 * len(item) and any(w in out for w in item[-2:]):
            expected.add((k, name))
        fill = lambda: [rng.choice(other) for _ in range(rng.randint(0, 120))]
        rows.append((k, " ".join([*fill(), *out, *fill()]).capitalize() + "."))
    docs = spark.createDataFrame(rows * 2, "doc_id long, text string").repartition(4)  # every row twice
    benchmark = spark.createDataFrame([(n, " ".join(w), " ".join(w[-2:])) for n, w in items.items()] + [(None, "qq ww ee rr tt", "tt")], "item_id string, text string, answer string")
    got = [(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, benchmark).collect()]
    ungated = {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, benchmark, cosine=-1.0).collect()}
    assert 400 < len(expected) < 1200 and len(got) == 2 * len(set(got))
    assert set(got) - expected == set() and ungated == expected
    assert len(set(got)) >= 0.99 * len(expected)


def test_a_very_long_text_and_null_item_ids_leak(spark):
    rng = random.Random(2)
    item = "the exam question asks which river flows through seven named towns before the sea"
    long = "".join(sentence(rng, 10) for _ in range(20_000)) + item + " " + "".join(sentence(rng, 10) for _ in range(20_000))
    docs = spark.createDataFrame([(1, long, "mine"), (2, long[:100_000], "mine"), (3, item, "mine"), (3, item, "mine")], "doc_id long, text string, item_id string")
    benchmark = spark.createDataFrame([(None, item), (-1, item)], "item_id int, text string")
    got = sorted((r.doc_id, repr(r.item_id)) for r in decontaminate.leaks(docs, benchmark).collect())
    assert got == sorted((i, x) for i in (1, 3, 3) for x in ("None", "-1"))
    assert decontaminate.clean(docs, benchmark).collect() == [(2, long[:100_000], "mine")]


def test_language_model_base_is_exact(docs, corpus, nothing):
    def tokens(t):
        return re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")) + ["\n"]

    count = collections.Counter()
    for i, t, *_ in corpus:
        if i is None or zlib.crc32(str(i).encode()) % 5 != 1:
            count.update(tokens(t))
    n, v = sum(count.values()), len(count)
    expected = sorted((repr(i), len(k := tokens(t)), sum(count[w] > 0 for w in k), round(sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in k), 6)) for i, t, *_ in corpus)
    out = language_model.text_scores(docs).collect()
    assert sorted((repr(r.doc_id), r.n_tokens, r.n_known, round(r.base_score, 6)) for r in out) == expected
    assert {r.train_tokens for r in out} == {n}
    assert sum(r.score for r in out) > sum(r.base_score for r in out)
    assert language_model.text_scores(nothing).count() == 0


def test_language_model_is_a_distribution(docs, monkeypatch):
    monkeypatch.setattr(language_model, "FREQUENT", 30)
    model, counts = language_model.fit(docs)
    known = [(r.w, r.cls) for r in counts.collect()]
    unknown = [(-5 - c, c) for c in range(language_model.TOP + 1, language_model.CLASSES)]
    rare = {r.w: r.n for r in counts.collect()}
    for first, second in ((known[0], known[1]), (known[5], known[9]), (unknown[3], known[2])):
        rows = [[first, second, last] for last in known + unknown]
        h = np.array([w for r in rows for w, _ in r], np.int64).view(np.uint64)
        cls = np.array([c for r in rows for _, c in r])
        at, other, logs = language_model.log_probabilities(model, h, cls, np.repeat(np.arange(len(rows)), 3))
        total = 0.0
        for i, (w, _) in enumerate(known + unknown):
            k = 3 * i + 2
            total += 10 ** logs[k] * (rare.get(w, 0) + 0.5 if other[k] else 1.0)
        assert abs(total - 1) < 1e-5, total


def brute_steps(model, h, cls, slot, row, batch):
    """Gradient steps token by token, with dictionaries of weight rows."""
    lm = language_model
    of_class, of_slot = lm.history(h, cls, row)
    tables = []
    for keys, target, table in ((of_class, cls, model.by_class), (of_slot, slot, model.by_slot)):
        w, sq, seen = {}, collections.defaultdict(lambda: 1.0), collections.Counter()
        get = lambda k, w=w, table=table: w.setdefault(k, table[k].astype(float).copy())
        for i in range(0, len(h), batch):
            use = [t for t in range(i, min(i + batch, len(h))) if table is model.by_class or cls[t] > lm.TOP]
            grads = [collections.defaultdict(float) for _ in keys]
            counts = [collections.Counter() for _ in keys]
            for t in use:
                z = sum(get(int(k[t])) for k in keys)
                p = np.exp(z - z.max())
                p /= p.sum()
                p[target[t]] -= 1
                for g, n, k in zip(grads, counts, keys, strict=True):
                    g[int(k[t])] = g[int(k[t])] + p
                    n[int(k[t])] += 1
            for g, n in zip(grads, counts, strict=True):
                for k, v in g.items():
                    v = v / math.sqrt(n[k])
                    sq[k] += float(np.mean(v * v))
                    get(k)
                    w[k] -= lm.STEP * v / math.sqrt(sq[k])
                    seen[k] += n[k]
        tables.append((w, seen))
    return tables


def test_language_model_equals_a_dense_one(docs, corpus, monkeypatch):
    import pyarrow as pa

    from factloom.llm import textbatch as tb

    monkeypatch.setattr(language_model, "STEP_TOKENS", 64)
    model, _ = language_model.fit(docs.limit(0))
    trained, _ = language_model.fit(docs)
    assert (model.total, trained.total > 0) == (0, True)
    texts = [r[1] for r in corpus[:25]]
    start = language_model.Model(**{f: getattr(trained, f).copy() if isinstance(getattr(trained, f), np.ndarray) else getattr(trained, f) for f in trained.__dataclass_fields__})
    (s,) = tb.slices(pa.array(texts))
    found = language_model.descend(start, [s])
    h, cls, row = language_model.tokens(s)
    _, cls, slot = start.encode(h, cls)
    for d, (w, seen) in zip(found, brute_steps(start, h, cls, slot, row, 64), strict=True):
        assert {int(k) for k in np.flatnonzero(d.seen)} == set(seen) and all(d.seen[k] == n for k, n in seen.items())
        assert max(np.abs(d.table[k] - v).max() for k, v in w.items()) < 1e-3
    # scores token by token
    at, other, logs = language_model.log_probabilities(trained, h, cls, row)
    of_class, of_slot = language_model.history(h, cls, row)
    for t in range(0, len(h), 7):
        z = sum(trained.by_class[k[t]].astype(float) for k in of_class)
        p = math.exp(z[cls[t]]) / sum(math.exp(x) for x in z)
        if cls[t] > language_model.TOP:
            z = sum(trained.by_slot[k[t]].astype(float) for k in of_slot)
            p *= math.exp(z[slot[t]]) / sum(math.exp(x) for x in z)
            if slot[t] == 0:
                p /= trained.other_total[cls[t]] + 0.5 * (trained.other_distinct[cls[t]] + 1)
        assert abs(math.log10(p) - logs[t]) < 1e-4


def test_average_equals_plain_sums():
    rng = np.random.default_rng(4)
    parts, total, weight = [], collections.defaultdict(float), collections.Counter()
    for _ in range(5):
        rows = np.sort(rng.choice(20, 8, replace=False)).astype(np.int32)
        seen, v = rng.integers(1, 9, 8).astype(float), rng.normal(size=(8, 3)).astype(np.float32)
        parts.append((rows.tobytes(), seen.tobytes(), v.tobytes()))
        for r, n, x in zip(rows.tolist(), seen, v, strict=True):
            total[r] = total[r] + n * x
            weight[r] += n
    rows, seen, v = language_model._average(parts, 3)
    assert np.frombuffer(rows, np.int32).tolist() == sorted(total)
    assert np.allclose(np.frombuffer(v, np.float32).reshape(-1, 3), [total[r] / weight[r] for r in sorted(total)], atol=1e-6)


def test_scores_do_not_depend_on_partitions(docs, monkeypatch):
    monkeypatch.setattr(language_model, "SHARD_TOKENS", 8000)
    monkeypatch.setattr(language_model, "_FAN_IN", 2)
    of = lambda d: sorted((repr(r.doc_id), r.n_tokens, round(r.score, 9)) for r in language_model.text_scores(d).collect())
    scores = of(docs)
    assert scores == of(docs.repartition(1)) == of(docs.repartition(7))
    monkeypatch.setattr(language_model, "PARTITIONS", 2)  # several shards a task
    assert of(docs) == scores


def test_rare_words_join_the_counts(docs, monkeypatch):
    plain = {(r.doc_id, r.n_tokens): (r.n_known, round(r.base_score, 6)) for r in language_model.text_scores(docs).collect()}
    monkeypatch.setattr(language_model, "FREQUENT", 10)
    assert {(r.doc_id, r.n_tokens): (r.n_known, round(r.base_score, 6)) for r in language_model.text_scores(docs).collect()} == plain


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News and more</a></li></ul></nav>
<!-- ad --><div class="ad">Buy this now and save.</div><article><h1>The &amp; title</h1><p>First   paragraph,
with <a href=x>a link</a> &lt;inside&gt; it.<p>Second <b>paragraph<br>goes on.</p><ul><li>one thing<li>another thing</ul></article>
<section class="comments"><p>Reader one: I like it a lot, really.</p></section><footer>&copy; someone &middot; all rights</footer></body></html>"""


def test_main_text(spark):
    rows = [(1, "u1", PAGE), (2, "u2", None), (3, "u3", ""), (4, "u4", "<html><body><script>x"), (5, "u5", "<nav><a href=x>only a menu</a></nav>"), (1, "u1", PAGE)]
    out = {r.page_id: r for r in extraction.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert out[1].text == "The & title\nFirst paragraph, with a link <inside> it.\nSecond paragraph goes on.\none thing\nanother thing"
    assert out[1].n_chars == len(out[1].text) and out[2].text == out[3].text == out[4].text == out[5].text == "" and out[2].n_chars == 0


def test_main_text_of_the_synthetic_pages_is_whole(spark):
    """Every page's article, taken by its own mark-up, equals the extraction."""
    import html

    def article(h):
        a = re.search(r"<article>(.*?)(</article>|$)", h, re.S)[1]
        lines = re.sub(r"<[^>]+>", "", re.sub(r"<br>", " ", re.sub(r"</?(p|h1)>", "\n", a))).split("\n")
        return "\n".join(x for x in (" ".join(html.unescape(y).split()) for y in lines) if x)

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    wanted = {r.page_id: article(r.html) for r in pages.collect()}
    assert {r.page_id: r.text for r in extraction.main_texts(pages).collect()} == wanted


def test_extra_columns_stay_or_are_replaced(spark):
    pages = spark.createDataFrame([(1, "u", PAGE, "old", 3)], "page_id long, url string, html string, text string, keep int")
    (r,) = extraction.extract(pages).collect()
    assert r.keep == 3 and r.text.startswith("The & title") and r.asDict().keys() == {"page_id", "url", "html", "keep", "text", "n_chars"}


def brute_decode(page, z, i):
    """Best score of the subtree of element i and the elements whose own text it takes, by trying its three verdicts; nameless inline elements are parts of the one around them."""
    inline = {"b"}
    own, inside = page.lengths(), range(i, page.end[i])
    size = sum(own[k] for k in inside)
    zi = max(-6.0, min(6.0, z[i]))

    def around(k):
        k = page.parent[k]
        return k if page.tag[k] not in inline or k == i else around(k)

    unit = [k for k in inside if k == i or (page.tag[k] in inline and around(k) == i)]
    kids = [brute_decode(page, z, k) for k in inside if k != i and page.tag[k] not in inline and around(k) == i]
    parts = (sum(own[k] for k in unit) * abs(zi) + sum(s for s, _ in kids) - 0.5, (set(unit) if zi > 0 else set()) | set().union(*(t for _, t in kids)))
    return max([(zi * size, set(inside)), (-zi * size, set()), parts], key=lambda v: v[0])


def test_decoding_is_the_best_consistent_cut():
    """An element that is taken or dropped whole decides for all below it; no other cut scores better."""
    rng = random.Random(12)
    tags = ["div", "section", "ul", "b", "p"]

    def tree(depth):
        inner = "".join(tree(depth - 1) for _ in range(rng.randint(0, 3))) if depth else ""
        tag = rng.choice(tags)
        return f"<{tag}>{'t' * rng.randint(0, 9)}{inner}</{tag}>"

    for _ in range(60):
        page = extraction.Page("".join(tree(3) for _ in range(2)))
        z = np.array([rng.uniform(-8, 8) for _ in page.tag])
        own = page.lengths()
        chosen = {k for k in np.flatnonzero(extraction.decode(page, z)).tolist() if own[k]}
        assert chosen == {k for k in brute_decode(page, z, 0)[1] if own[k]}


TEMPLATES = {
    "comments inside the article": ('<html><body><article><h1>Title here</h1><p>First para of the story, long enough to count.</p><p>Second one.</p><section class="comments"><h3>2 comments</h3><div class="comment"><p>I really liked this, thanks for the writing.</p></div><div class="comment"><p>Me too</p></div></section></article></body></html>', "Title here\nFirst para of the story, long enough to count.\nSecond one."),
    "a thread after the article": ('<html><body><nav><a href=/>Home</a></nav><article><h1>Title here</h1><p>First para of the story, long enough to count.</p><p>Second one.</p></article><div id="disqus_thread"><div class="reply">I think that is wrong, and here is a long reason why it is.</div><div class="reply">No it is not.</div></div></body></html>', "Title here\nFirst para of the story, long enough to count.\nSecond one."),
    "an aside inside the article": ('<body><article><h1>Title here</h1><p>First para of the story, long enough to count.</p><aside class="related"><h3>Read also</h3><ul><li><a href=x>Another story about this</a></li></ul></aside><p>Second one.</p></article>', "Title here\nFirst para of the story, long enough to count.\nSecond one."),
    "code, caption and a short end": ("<main><h1>How to install</h1><p>Run the following command in your shell.</p><pre>make install\n  --all</pre><figure><img src=a.png><figcaption>The result on screen</figcaption></figure><p>Short.</p></main>", "How to install\nRun the following command in your shell.\nmake install --all\nThe result on screen\nShort."),
    "only paragraphs": ("<p>One paragraph only here.</p><p>And another.</p>", "One paragraph only here.\nAnd another."),
    "only text": ("Just some text without any markup at all &amp; no more.", "Just some text without any markup at all & no more."),
    "no container": ("<html><body><nav><ul><li><a href=1>A</a></li><li><a href=2>B</a></li></ul></nav><h1>Heading</h1><p>Text of the page that goes on for a while and then ends.</p><p>Ok.</p><footer>(c) 2020</footer></body></html>", "Heading\nText of the page that goes on for a while and then ends.\nOk."),
    "a blog": ('<div id="page"><div id="masthead"><a href=/>My blog</a><p>just another site</p></div><div id="primary"><div class="hentry"><h2 class="entry-title">A walk</h2><div class="entry-content"><p>We went out early in the morning, and it rained.</p><ul><li>first stop</li><li>second stop</li></ul><p>Bye</p></div><div class="sharedaddy sd-sharing"><a href=f>Facebook</a> <a href=t>Twitter</a></div></div><div id="respond"><h3>Leave a reply</h3><form><textarea></textarea></form></div></div><div id="secondary" class="widget-area"><h3>Archives</h3><ul><li><a href=1>May</a></li><li><a href=2>June</a></li></ul></div></div>', "A walk\nWe went out early in the morning, and it rained.\nfirst stop\nsecond stop\nBye"),
    "a table as layout": ('<table><tr><td class="menu"><a href=1>Home</a><br><a href=2>News</a></td><td><h1>Old page</h1><p>This is a page from long ago, with tables for its layout.</p>Loose text here.</td></tr></table>', "Old page\nThis is a page from long ago, with tables for its layout.\nLoose text here."),
    "a notice, a header with a heading, an advert": ('<body><div class="cookie-banner">We use cookies to make this site better. <button>OK</button></div><header class="site-header"><h1>Daily News</h1><nav><a href=a>World</a><a href=b>Sport</a></nav></header><main><article class="story"><h1>Rain</h1><p>It rained all day in the north of the country.</p><div class="ad-slot">Advertisement: buy shoes now</div><p>It will stop.</p><blockquote>We are wet, said a man.</blockquote></article></main><footer><p>All rights reserved, the publisher.</p></footer>', "Rain\nIt rained all day in the north of the country.\nIt will stop.\nWe are wet, said a man."),
    "a form inside": ('<main id="content"><h1>On bees</h1><p>Bees are insects that make honey, and they live in hives.</p><form class="newsletter"><p>Sign up for more</p><input><button>Go</button></form><p>They dance.</p><dl><dt>Drone</dt><dd>A male bee</dd></dl></main>', "On bees\nBees are insects that make honey, and they live in hives.\nThey dance.\nDrone\nA male bee"),
    "a comment longer than the article": ('<div class="post"><p>Short note.</p></div><div class="comments-area"><ol><li><cite>Ann</cite><p>What a long and thoughtful comment this is, it goes on and on, with commas, and several sentences. Really it does. It is longer than the note.</p></li></ol></div>', "Short note."),
    "only a menu": ("<nav><a href=x>only a menu</a></nav>", ""),
}


def test_unlike_templates():
    model = extraction.train()
    got = dict(zip(TEMPLATES, extraction.main_texts_of([h for h, _ in TEMPLATES.values()], model), strict=True))
    assert got == {k: text for k, (_, text) in TEMPLATES.items()}


def test_generated_pages_that_were_not_trained_on():
    rng, model, same = random.Random(977), extraction.train(), 0
    for _ in range(200):
        source, unmarked = extraction._Writer(rng).page()
        page = extraction.Page(source)
        same += "\n".join(page.blocks(extraction._marks(source, page, unmarked) > 0)) == extraction.main_texts_of([source], model)[0]
    assert same >= 180


def test_a_page_of_ten_megabytes_and_an_empty_table(spark):
    import resource

    paragraphs = [f"<p>Some <b>bold</b> words, number {i}, of a long article.</p>" for i in range(170_000)]
    source = "<nav><a href=/>Home</a></nav><article><h1>Long</h1>" + "".join(paragraphs) + '</article><div class="comments"><p>Me</p></div>'
    assert len(source) > 9_000_000
    model = extraction.train()
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    (text,) = extraction.main_texts_of([source], model)
    assert text.count("\n") == 170_000 and text.startswith("Long\nSome bold words, number 0,") and not text.endswith("Me")
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 900_000  # kilobytes
    assert extraction.main_texts(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0

def test_clashing_score_columns(spark, docs):
    model, counts = language_model.fit(docs)
    out = language_model.score(docs.withColumn("score", F.lit("x")).withColumn("uid", F.lit(1)), model, counts)
    assert out.columns == ["doc_id", "n_tokens", "n_known", "base_score", "score"]


def test_only_whole_hidden_elements_are_dropped(spark):
    from factloom.llm.dom import Page

    said = lambda html: " ".join("".join(t for _, t in Page(html).text).split())
    for start in ("<svg-icon></svg-icon>", "<select-box>", "<title-bar/>", '<svg width="9"/>', "<svg/>", "<svg><path>", "<object data=x>", "<select>"):
        assert said(f"<p>one</p>{start}<p>two</p>") == "onetwo", start
        assert said(f"<p>one</p>{start}<p>two</p><svg><text>no</text></svg><p>three</p>") == "onetwothree", start
    for gone in ("<svg><svg>a</svg>b</svg>", "<SVG\nid=x>a</svg >", "<object>a<object>b</object>c</object>", "<select><option>a</select>", "<svg><script>'<svg>'</script></svg>"):
        assert said(f"<p>one</p>{gone}<p>two</p>") == "onetwo", gone
    icon = PAGE.replace("<body>", "<body><svg-icon name='x'></svg-icon><svg class='y'/>")
    out = {r.page_id: r.text for r in extraction.main_texts(spark.createDataFrame([(1, "u", PAGE), (2, "u", icon)], "page_id long, url string, html string")).collect()}
    assert out[1] and out[1] == out[2]


def test_latent_space_is_fitted_on_every_window(spark):
    """Every window is a passage of the fit, repeated ones too; the sums of products are those of the plain matrix."""
    import numpy as np

    from factloom.llm import decontaminate as dc

    items = dc._items(spark.createDataFrame([(1, " ".join(f"w{k}" for k in range(16)))], "item_id int, text string"))
    docs = spark.createDataFrame([(" ".join(f"w{(i + k) % 16} x{i}" for k in range(8 if i % 2 else 12)),) for i in range(5000)], "text string")
    df, windows, n = dc._corpus(docs, items)
    assert n == 5000 and windows.count() == 7500
    idf, rng = np.arange(1.0, 8), np.random.default_rng(1)
    row, index = np.sort(rng.integers(0, 40, 300)), rng.integers(0, 7, 300)
    a = np.zeros((40, 7))
    np.add.at(a, (row, index), 1)
    a *= idf
    a /= np.maximum(np.linalg.norm(a, axis=1, keepdims=True), 1e-12)
    got = np.zeros(49)
    for key, value in dc._products(row, index, idf):
        np.add.at(got, key, value)
    assert np.allclose(got.reshape(7, 7), np.triu(a.T @ a))


def test_sums_of_products_take_bounded_memory(monkeypatch):
    """Both ways of summing give the plain sums, hand them on in small batches, and hold little beside the table."""
    import tracemalloc

    from factloom.llm import decontaminate as dc

    rng, size = np.random.default_rng(2), 3895  # as many words as the benchmark of sf0.1 has
    idf = np.linspace(0.1, 6, size)
    parts = [(np.sort(rng.integers(0, 300, 20_000)), rng.integers(0, size, 20_000)) for _ in range(4)]
    want = np.zeros(size * size)
    for row, index in parts:
        for key, value in dc._products(row, index, idf):
            np.add.at(want, key, value)

    def read(batches, got):
        for b in batches:
            assert b.num_rows <= 1 << 16
            np.add.at(got, b["pair"].to_numpy(), b["value"].to_numpy())

    for table, limit in ((dc.TABLE, 90e6), (0, 80e6)):
        monkeypatch.setattr(dc, "TABLE", table)
        got = np.zeros(size * size)
        tracemalloc.start()
        sums = dc._Sums(idf)
        for row, index in parts:
            read(sums.add(row, index), got)
        read(sums.rest(), got)
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert np.allclose(got, want) and most < limit, (table, most)
        assert not list(sums.rest())  # all was handed on
