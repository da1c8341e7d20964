import re

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from factloom.llm import mixing, shards


def test_mix_equals_sql(docs, corpus):
    documents = pd.DataFrame(corpus, columns=["doc_id", "text", "lang", "source", "n_chars"]).astype({"doc_id": "Int64"})
    con = duckdb.connect()
    con.register("documents", documents)
    expected = sorted(map(repr, con.sql(mixing.SQL).fetchall()))
    got = sorted(repr((r.doc_id, r["size"], r.source_size, r.target, r.taken)) for r in mixing.mix(docs).collect())
    assert got == expected


def test_targets(spark):
    rows = [(i, "w " * 10, s) for i, s in enumerate(["a"] * 10 + ["b"] * 100 + ["c"] * 5 + [None] * 40)] + [(999, None, "d")]
    out = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).toPandas()
    by = out.groupby(out.source.fillna("~")).agg(size=("size", "sum"), target=("target", "first"), taken=("taken", "sum"))
    assert by.target.sum() == pytest.approx(1.5 * by["size"].sum())
    assert (by.target <= 2 * by["size"]).all() and by.target["a"] == 200 and by.target["c"] == 100 and by.target["d"] == 0
    assert ((by.taken - by.target).abs() <= 5).all()
    assert (out.taken <= 2 * out["size"]).all() and (out.taken % out["size"].clip(lower=1) == 0).all()


def test_reruns_agree_and_mixture_repeats(docs, nothing):
    a, b = mixing.mix(docs), mixing.mix(docs.repartition(3))
    assert a.select("doc_id", "taken").exceptAll(b.select("doc_id", "taken")).count() == 0
    took = a.agg(F.sum("taken")).first()[0]
    rows = mixing.mixture(docs)
    assert rows.columns == docs.columns
    assert sum(len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in rows.collect()) == took
    assert mixing.mix(nothing).count() == 0 and mixing.mixture(nothing).count() == 0


def test_clashing_columns(docs):
    out = mixing.mix(docs.withColumn("size", F.lit("x")).withColumn("taken", F.lit("y")))
    assert dict(out.dtypes)["size"] == "bigint" and out.columns.count("taken") == 1
    odd = docs.withColumns({c: F.lit("mine") for c in ("size", "taken", "ahead", "target", "leaks", "quality_score", "gone_id", "lang_key", "n_words")})
    kept = mixing.mixture(odd)
    assert kept.columns == odd.columns and {r["size"] for r in kept.select("size").distinct().collect()} == {"mine"}
    from factloom.llm import decontaminate, neardup, quality, rules

    assert neardup.deduplicate(odd).columns == odd.columns
    benchmark = docs.sparkSession.createDataFrame([(1, "some words that nobody wrote before now")], "item_id long, text string")
    assert {r.leaks for r in decontaminate.clean(odd, benchmark).select("leaks").distinct().collect()} == {"mine"}
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    assert quality.accepted(odd, quality.fit(odd, labels)).columns == odd.columns
    assert rules.rule_verdicts(odd).count() == docs.count()


def test_plan_merges_full_tiers_only():
    assert shards.plan({0: 100, 1: 100, 2: 100}, 4) == []
    assert shards.plan({0: 100, 1: 110, 2: 90, 3: 100, 9: 10_000}, 4) == [[0, 1, 2, 3]]
    # four merged runs fill the next tier
    assert shards.plan({i: 100 for i in range(16)}, 4) == [list(range(16))]


def test_shards_hold_the_rows(docs, corpus, nothing, spark, tmp_path):
    out = shards.shard(docs.withColumn("shard_run", F.lit("mine")), f"file://{tmp_path}/a", target_bytes=20_000)
    assert out.select(docs.columns).exceptAll(docs).count() == 0 and out.count() == len(corpus)
    sizes = out.groupBy("shard_run", "shard_file").agg(F.sum("shard_bytes").alias("b"), F.max("shard_bytes").alias("m")).collect()
    assert len(sizes) > 3 and all(r.b <= 2 * 20_000 + r.m for r in sizes)
    assert shards.shard(nothing, f"file://{tmp_path}/b").count() == 0


def test_versions_are_atomic_and_old_ones_stay_readable(docs, corpus, spark, tmp_path):
    store = shards.ShardStore(spark, f"file://{tmp_path}/s", docs.schema, target_bytes=10_000)
    docs = docs.where("doc_id < 56")
    n = docs.count()
    for k in range(4):
        store.append(docs.where(F.col("doc_id") % 4 == k))
    assert store.version() == 4 and store.read().count() == n
    assert store.compact() == 5 and store.read().count() == n
    assert store.read(4).count() == n and len(store.manifest(4)["runs"]) == 4 > len(store.manifest()["runs"])
    with pytest.raises(Exception):  # noqa: B017  a second writer of version 5
        store._commit(store.manifest(4), 4)
    assert store.compact() == 5
    store.vacuum()
    assert store.read().count() == n


def test_repeated_rows_spread_over_files_and_tasks(spark, tmp_path):
    rows = [(None, "x" * 99 + "y", "aa")] * 3000 + [(7, "x" * 100, "bb")] * 1000 + [(8, "z" * 70_000, None), (9, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    store = shards.ShardStore(spark, f"file://{tmp_path}/r", docs.schema, target_bytes=20_000)
    for _ in range(4):
        store.append(docs)
    store.compact()
    out = store.read()
    assert out.groupBy(docs.columns).count().where("count % 4 <> 0").isEmpty() and out.count() == 4 * len(rows)
    merged = out.withColumn("at", F.input_file_name())
    files = merged.groupBy("shard_run", "shard_file").agg(F.sum("shard_bytes").alias("b"), F.max("shard_bytes").alias("m"), F.countDistinct("at").alias("written")).collect()
    whole = [r for r in files if r.m < 70_000]
    assert len(whole) > 50 and all(r.b <= 2 * 20_000 for r in whole) and all(r.written == 1 for r in files)


def brute_plan(sizes, fanout):
    """Merging as by hand: while four or more runs share a tier, the smallest such tier becomes one run."""
    import math

    runs = [([r], s) for r, s in sizes.items()]
    while True:
        tiers = {}
        for run in runs:
            tiers.setdefault(math.floor(math.log(max(run[1], 1)) / math.log(fanout) + 1e-9), []).append(run)
        full = sorted(t for t, v in tiers.items() if len(v) >= fanout)
        if not full:
            return sorted(sorted(ids) for ids, _ in runs if len(ids) > 1)
        runs = [r for r in runs if r not in tiers[full[0]]] + [(sum((ids for ids, _ in tiers[full[0]]), []), sum(s for _, s in tiers[full[0]]))]


def test_plan_equals_brute_force():
    import random

    rng = random.Random(3)
    for _ in range(200):
        sizes = {i: rng.choice([0, 1, 5, 60, 70, 900, 12_000, 13_000]) for i in range(rng.randint(0, 30))}
        assert sorted(shards.plan(sizes, 4)) == brute_plan(sizes, 4)
