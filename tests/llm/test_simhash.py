import random
import re

import numpy as np
import pytest
import xxhash

from factloom.llm import simhash


def fingerprint(text):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if x]
    g = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] * bool(w)
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in g]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(codes, differ):
    codes = np.array(codes, np.uint64)
    label = list(range(len(codes)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in range(len(codes)):
        for b in np.flatnonzero(np.bitwise_count(codes[a:] ^ codes[a]) <= differ):
            x, y = root(a), root(a + int(b))
            label[max(x, y)] = min(x, y)
    return [root(i) for i in range(len(codes))]


@pytest.fixture(scope="module")
def codes():
    rng, out = np.random.default_rng(4), set()
    for c in rng.integers(0, 1 << 63, 400, dtype=np.uint64).tolist():
        out.add(c * 2)
        for _ in range(rng.integers(0, 12)):
            x = c * 2
            for b in rng.integers(0, 64, rng.integers(1, 4)):
                x ^= 1 << int(b)
            out.add(x)
    return np.array(sorted(out), np.uint64)


def test_tree_finds_every_close_pair_once(codes):
    c = codes[np.argsort(simhash.gray_rank(codes))]
    for differ in (0, 1, 2, 4):
        got = [(int(x), int(y)) for a, b in simhash.close_pairs(c, differ) for x, y in zip(a, b, strict=True)]
        want = {(i, i + 1 + int(j)) for i in range(len(c)) for j in np.flatnonzero(np.bitwise_count(c[i + 1 :] ^ c[i]) <= differ)}
        assert len(got) == len(set(got)) and set(got) == want


def test_gray_rank_counts_gray_codes():
    n = np.arange(1 << 12, dtype=np.uint64)
    assert (simhash.gray_rank(n ^ (n >> np.uint64(1))) == n).all()


@pytest.mark.parametrize("limit", [10_000, 25])
def test_nodes_lose_no_pair(spark, codes, limit):
    """Also where nodes are refined, down to the last level: codes that share 50 bits."""
    rng = np.random.default_rng(5)
    crowd = np.unique(np.uint64(0xABCDEF0123456789) ^ rng.integers(0, 1 << 14, 300, dtype=np.uint64) << np.uint64(25))
    every = np.unique(np.concatenate([codes, crowd]))
    df = spark.createDataFrame([(int(x),) for x in every.view(np.int64)], "code long")
    nodes = simhash.index_nodes(df, target=20, limit=limit)
    if limit == 25:
        assert nodes.select("mask").distinct().count() > 3
    links = [(r["u"], r["v"]) for r in simhash.code_links(nodes).collect()]
    place = {int(x): i for i, x in enumerate(every.view(np.int64))}
    label = list(range(len(every)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for u, v in links:
        assert (int(every[place[u]]) ^ int(every[place[v]])) >= 0
        x, y = root(place[u]), root(place[v])
        label[max(x, y)] = min(x, y)
    assert [root(i) for i in range(len(every))] == components(every, 2)


def test_near_duplicates_equal_brute_force(spark, corpus, docs):
    rng = random.Random(8)
    rows = [(r[0], r[1]) for r in corpus] + [(200, ""), (201, "Ünder den  \n LINDEN"), (None, "one two")]
    long = " ".join(rng.choice(["ba", "ke", "tu", "mo"]) + str(rng.randrange(50)) for _ in range(3000))
    rows += [(300 + i, long + " tail" * (i + 1)) for i in range(6)]
    df = spark.createDataFrame([(i, t, 5) for i, t in rows], "doc_id long, text string, code int").repartition(4)
    out = simhash.near_duplicates(df)
    assert out.columns == ["doc_id", "fingerprint", "component_id"]
    codes = [fingerprint(t) for _, t in rows]
    label = components(codes, 2)
    least = {}
    for (i, _), g in zip(rows, label, strict=True):
        if i is not None:
            least[g] = min(i, least.get(g, i))
    want = sorted(((i, f"{c:016x}", least.get(g)) for (i, _), c, g in zip(rows, codes, label, strict=True)), key=str)
    assert sorted((tuple(r) for r in out.collect()), key=str) == want
    assert any(i != c for i, _, c in want if i is not None)


def test_empty_table(spark, nothing):
    assert simhash.near_duplicates(nothing).count() == 0
