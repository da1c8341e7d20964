import io
import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from factloom.sources import files
from factloom.streaming import refresh

SCHEMA = StructType([StructField("k", StringType()), StructField("v", LongType())])


def test_scan_and_extract(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a/x.txt").write_bytes("na\xefve".encode("cp1252"))
    (tmp_path / "a/y.rtf").write_bytes(b"{\\rtf1 Hello\\par World}")
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr("word/document.xml", '<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"><w:body><w:p><w:r><w:t>One</w:t></w:r></w:p><w:p><w:r><w:t>Two</w:t></w:r></w:p></w:body></w:document>')
    (tmp_path / "z.docx").write_bytes(buffer.getvalue())
    (tmp_path / "bad.xlsx").write_bytes(b"no zip")
    (tmp_path / "p.png").write_bytes(b"x")
    assert files.scan(spark, f"file://{tmp_path}").count() == 5 and files.scan(spark, f"file://{tmp_path}", r"\.txt$").first()["size"] == 5
    content = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"file://{tmp_path}")
    got = {r.path.rsplit("/", 1)[-1]: r.extraction for r in files.extract_text(content).collect()}
    assert got["x.txt"].text == "naïve" and got["y.rtf"].text == "Hello\nWorld" and got["z.docx"].text == "One\nTwo" and got["bad.xlsx"].status == "failed" and got["p.png"].status == "unsupported"
    seen = {r.path.rsplit("/", 1)[-1]: r.extraction for r in files.extract_text(content, {"png": lambda raw: "read"}).collect()}
    assert seen["p.png"].text == "read"


def test_jsonl(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"k": "a", "v": 1}\nbroken\n')
    with pytest.raises(Exception):  # noqa: B017
        files.read_jsonl(spark, f"file://{tmp_path}/x.jsonl", SCHEMA).collect()
    lenient = files.read_jsonl(spark, f"file://{tmp_path}/x.jsonl", StructType(list(SCHEMA.fields)), strict=False)
    assert sorted(r.k or "-" for r in lenient.collect()) == ["-", "a"]


def test_replace_and_upsert(spark, tmp_path):
    old = spark.createDataFrame([("a", 1), ("b", 2)], SCHEMA)
    new = spark.createDataFrame([("b", 3), ("b", 4), ("c", 5)], SCHEMA)
    assert sorted(map(tuple, files.upsert(old, new, "k").collect())) == [("a", 1), ("b", 4), ("c", 5)]
    path = f"file://{tmp_path}/t"
    files.replace_table(old, path)
    files.replace_table(files.upsert(spark.read.parquet(path), new, "k"), path)
    assert spark.read.parquet(path).count() == 3


def test_refresh_stream_is_idempotent(spark, tmp_path):
    landing, target, mark = (f"file://{tmp_path}/{x}" for x in ("in", "t", "c"))
    spark.createDataFrame([("a", 1), ("b", 1)], SCHEMA).write.parquet(landing)
    for _ in range(2):
        refresh.refresh_stream(spark, landing, SCHEMA, target, "k", mark).awaitTermination()
    spark.createDataFrame([("b", 2)], SCHEMA).write.mode("append").parquet(landing)
    refresh.refresh_stream(spark, landing, SCHEMA, target, "k", mark).awaitTermination()
    assert sorted(map(tuple, spark.read.parquet(target).collect())) == [("a", 1), ("b", 2)]


def test_windows_and_sessions(spark):
    e = spark.createDataFrame([("u", "2024-01-01 00:00:00", "c", 1.0), ("u", "2024-01-01 00:10:00", "c", 2.0), ("u", "2024-01-01 02:00:00", "c", 4.0)], "u string, ts string, kind string, v double").withColumn("ts", F.to_timestamp("ts"))
    assert sorted((r.n, r.total) for r in refresh.windowed_counts(e, "ts", "kind", "v").collect()) == [(1, 4.0), (2, 3.0)]
    assert sorted(r.n for r in refresh.sessions(e, "ts", "u").collect()) == [1, 2]


def test_vector_table_guard():
    assert files.vector_table("trial_a1") == "trial_a1"
    with pytest.raises(ValueError):
        files.vector_table("production")
