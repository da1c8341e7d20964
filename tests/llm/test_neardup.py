import re

import numpy as np
from pyspark.sql import functions as F

from factloom.llm import neardup
from factloom.llm.components import components


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) or (frozenset([tuple(w)]) if w else frozenset())


def brute(rows):
    """Smallest id reachable over links of all pairs; ids are vertices."""
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (a, x) in enumerate(sets):
        for b, y in sets[k + 1 :]:
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {i: find(i) for i in root}


def test_equals_all_pairs(docs, corpus):
    expected = brute([(r[0], r[1]) for r in corpus])
    got = neardup.near_duplicates(docs).collect()
    assert len(got) == len(corpus)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert r.component_id == expected[r.doc_id] and r.kept == (r.doc_id == r.component_id)
    sizes = sorted((r.n_shingles for r in got))
    assert sizes == sorted(len(shingles(r[1])) for r in corpus)


def test_a_chain_of_links_and_a_hot_group(spark):
    w = [f"w{i}" for i in range(60)]
    rows = [(0, " ".join(w))]
    for k in range(1, 12):  # neighbours are similar, the ends are not
        w[k * 5] = f"x{k}"
        rows.append((k, " ".join(w)))
    rows += [(100 + k, "the same words over and over again in a text") for k in range(300)]
    hub = [f"h{i}" for i in range(80)]
    for k in range(40):  # similar to the hub, not to each other
        v = list(hub)
        v[10 + k], v[60] = f"y{k}", f"z{k}"
        rows.append((1000 + k, " ".join(v)))
    rows.append((2000, " ".join(hub)))
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows)


def test_deduplicate_keeps_columns_and_one_of_each(docs, corpus, nothing):
    kept = neardup.deduplicate(docs)
    assert kept.columns == docs.columns
    expected = brute([(r[0], r[1]) for r in corpus])
    assert sorted(r.doc_id for r in kept.where(F.col("doc_id").isNotNull()).select("doc_id").distinct().collect()) == sorted(i for i, c in expected.items() if i == c)
    assert kept.where(F.col("doc_id").isNull()).count() == 1
    assert neardup.near_duplicates(nothing).count() == 0 and neardup.deduplicate(nothing).count() == 0


def test_components(spark):
    links = spark.createDataFrame([(5, 4), (4, 3), (3, 2), (2, 1), (9, 8), (8, 9), (7, 7)], "u long, v long")
    assert {r.vertex: r.component for r in components(links).collect()} == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 8: 8, 9: 8}
    assert components(links.limit(0)).count() == 0


def test_blocks_give_the_same_as_joins(spark, monkeypatch):
    """Near-threshold copies without a hub: every way of comparing a bucket finds the same components."""
    import random

    rng = random.Random(6)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for k in range(90):
        v = list(base)
        for at in rng.sample(range(120), 3):
            v[at] = f"n{k}x{at}"
        rows.append((k, " ".join(v)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = brute(rows)
    for small, split, salt in ((48, 512, 1024), (1, 16, 4), (1000, 512, 16)):
        monkeypatch.setattr(neardup, "SALT_ROWS", salt)
        monkeypatch.setattr(neardup, "SMALL", small)
        monkeypatch.setattr(neardup, "SPLIT", split)
        assert {r.doc_id: r.component_id for r in neardup.near_duplicates(docs).collect()} == expected


def test_rows_of_large_buckets_are_linear(spark, monkeypatch):
    """A bucket of k members without a hub makes k rows and one a pair of blocks."""
    monkeypatch.setattr(neardup, "SPLIT", 50)
    rng = np.random.default_rng(1)
    bits = [rng.integers(-(1 << 62), 1 << 62, neardup.LONG_BITS // 64).tolist() for _ in range(200)]
    # members 2m and 2m + 1 have one signature; the bucket is their least common key
    rows = [(7, 400, i, i, 100, [7 - (1 << 31)] + [i * 64 + j for j in range(31)], bits[i // 2], i, 0) for i in range(400)]
    open_ = spark.createDataFrame(rows, "bucket long, k long, rep long, h1 long, n long, keys array<int>, t array<long>, comp long, top long")
    written = []
    real = neardup.materialize
    monkeypatch.setattr(neardup, "materialize", lambda df, name: written.append(real(df, name)) or written[-1])
    pairs = neardup._within_large(open_, 75)
    blocks = written[0].select("bucket", "block", F.length("rep") / 8).collect()
    assert sum(r[2] for r in blocks) == len(rows) and len(blocks) <= 16
    got = [(r.ua, r.ub) for r in pairs.collect()]
    assert sorted(got) == sorted((1, 0) if m == 0 else (2 * m, 2 * m + 1) for m in range(200))  # 0 is the largest component


def test_pairs_of_one_leader_are_spread(spark, docs, monkeypatch):
    want = sorted(map(tuple, neardup.near_duplicates(docs).collect()), key=str)
    monkeypatch.setattr(neardup, "CONFIRM_ROWS", 2)
    assert sorted(map(tuple, neardup.near_duplicates(docs).collect()), key=str) == want
