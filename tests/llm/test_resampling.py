import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

from factloom.llm import resampling

ROWS = [(1, "A b c a b c."), (2, None), (3, ""), (4, "é b-é b  12 x y"), (5, "a b c " * 30), (None, "z y x " * 9), (5, "a b c " * 30), (6, "one two three " * 10), (7, "w1 w2 " * 50_000), (8, "... !!")]
ROWS += [(10 + i, " ".join(f"w{(i * 7 + j * j) % 23}" for j in range(10 + i))) for i in range(40)]
TARGET = [("a b c d",), ("w1 w2 w3 w4 w5",), (None,)]


def grams(text, n):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    return w, [" ".join(w[i : i + k]) for k in range(1, n + 1) for i in range(len(w) - k + 1)]


def brute(rows, target, n, buckets, percent):
    s, t = Counter(), Counter()
    bucket = lambda g: zlib.crc32(g.encode()) % buckets
    for counter, texts in ((s, [x for _, x in rows]), (t, [x for (x,) in target])):
        for text in texts:
            counter.update(map(bucket, grams(text, n)[1]))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in range(buckets)}
    scored = []
    for i, text in rows:
        w, g = grams(text, n)
        weight = sum(gain[bucket(x)] for x in g) // len(g) if g else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        scored.append((i, len(g), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), len(w)))
    able = sorted((r for r in scored if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    most = percent * len(able) // 100
    return sorted([(*r[:4], k + 1 if k < most else None) for k, r in enumerate(able)] + [(*r[:4], None) for r in scored if r[4] < 20], key=str)


@pytest.mark.parametrize("n", [1, 3])
def test_resampling_equals_brute_force(spark, n, monkeypatch):
    monkeypatch.setattr(resampling, "BLOCK_BYTES", 4096)  # many blocks
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in ROWS], "doc_id long, text string, gram int, word string").repartition(3)
    out = resampling.resample(docs, spark.createDataFrame(TARGET, "text string"), max_n=n, buckets=1000, percent=30)
    assert out.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted((tuple(r) for r in out.collect()), key=str) == brute(ROWS, TARGET, n, 1000, 30)


def test_empty_tables_and_repeated_rows(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert resampling.resample(none, spark.createDataFrame(TARGET, "text string")).count() == 0
    rows = [(7, "one two three " * 10)] * 2000 + [(8, "other words " * 12)]
    out = resampling.resample(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([], "text string"), percent=50).collect()
    ranks = sorted(r["rank"] for r in out if r["rank"] is not None)
    assert len(out) == 2001 and ranks == list(range(1, 1001))


def test_ids_of_other_types(spark):
    rows = [(str(i), t) for i, t in ROWS if i is not None]
    out = resampling.resample(spark.createDataFrame(rows, "key string, text string"), spark.createDataFrame(TARGET, "text string"), id_column="key")
    assert {r["key"] for r in out.collect()} == {k for k, _ in rows}
