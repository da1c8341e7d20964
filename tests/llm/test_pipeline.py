"""The pipeline on the smallest tables, against plain Python."""

import importlib

import pytest
from pyspark.sql import functions as F

from factloom import storage
from factloom.llm import decontaminate, quality
from tests.llm.test_neardup import brute

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    pipeline = importlib.import_module("corpus_pipeline")
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    out = [docs]
    for _, f in pipeline.STAGES:
        out.append(f(spark, out[-1], DIR).cache())
    return out


def test_columns_and_clean_documents(stages):
    docs, accepted, unique, clean, mixed, sharded = stages
    assert all(s.columns == docs.columns for s in (accepted, unique, clean, mixed))
    labels = docs.sparkSession.read.parquet(f"{DIR}/labels.parquet")
    good = docs.join(labels.where("quality = 1"), "doc_id", "left_semi")
    assert accepted.join(good.select("doc_id"), "doc_id", "left_semi").count() >= 0.9 * good.count()
    assert sharded.count() == mixed.count() and 0 < mixed.count()


def test_each_stage_equals_its_plain_form(stages, spark):
    docs, accepted, unique, clean, mixed, _ = stages
    scores = quality.quality_scores(docs, spark.read.parquet(f"{DIR}/labels.parquet"))
    assert accepted.count() == scores.where("predicted = 1").count()
    component = brute([(r.doc_id, r.text) for r in accepted.collect()])
    assert sorted(r.doc_id for r in unique.collect()) == sorted(i for i, c in component.items() if i == c)
    gone = {r.doc_id for r in decontaminate.leaks(unique, spark.read.parquet(f"{DIR}/benchmark.parquet")).collect()}
    assert sorted(r.doc_id for r in clean.collect()) == sorted(r.doc_id for r in unique.collect() if r.doc_id not in gone)
    assert mixed.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 2


def test_release_gives_freed_memory_back(spark, monkeypatch):
    assert storage.trim(spark)  # this JVM has the command
    calls = []
    monkeypatch.setattr(storage, "trim", calls.append)
    storage.release(spark)
    assert calls == [spark]
