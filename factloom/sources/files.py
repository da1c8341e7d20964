"""File, text and document sources, and sinks."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from factloom.storage import filesystem, remove


def scan(spark: SparkSession, root: str, pattern: str | None = None) -> DataFrame:
    """(path, size, modified) of every file below a root; file contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    rows = found.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))
    return rows if pattern is None else rows.where(F.substring_index("path", "/", -1).rlike(pattern))


def read_jsonl(spark: SparkSession, path: str, schema: StructType, strict: bool = True) -> DataFrame:
    """JSON lines by an explicit schema. A bad line fails the read, or with strict=False stays in the column _corrupt_record."""
    if strict:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    return spark.read.schema(schema.add("_corrupt_record", "string") if "_corrupt_record" not in schema.names else schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").json(path)


def under_prefix(files: DataFrame, prefix: str, path: str = "relative_path") -> DataFrame:
    """Files below a folder, with their top folder inside it."""
    p = prefix.rstrip("/") + "/" if prefix else ""
    return files.where(F.startswith(F.col(path), F.lit(p))).withColumn("top_folder", F.split(F.substr(F.col(path), F.lit(len(p) + 1)), "/")[0])


def decode(raw: bytes) -> str:
    """UTF-8 (with or without a mark), UTF-16 by its mark, else Windows-1252."""
    if raw[:2] in (b"\xff\xfe", b"\xfe\xff"):
        return raw.decode("utf-16", "replace")
    try:
        return raw.decode("utf-8-sig")
    except UnicodeDecodeError:
        return raw.decode("cp1252", "replace")


def docx_text(raw: bytes) -> str:
    """Paragraph texts of a DOCX document."""
    from xml.etree import ElementTree

    with zipfile.ZipFile(io.BytesIO(raw)) as z:
        root = ElementTree.fromstring(z.read("word/document.xml"))
    w = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
    lines = []
    for p in root.iter(f"{w}p"):
        parts = [("\t" if e.tag == f"{w}tab" else "\n" if e.tag == f"{w}br" else e.text or "") for e in p.iter() if e.tag in (f"{w}t", f"{w}tab", f"{w}br")]
        lines.append("".join(parts))
    return "\n".join(lines).strip()


def xlsx_text(raw: bytes) -> str:
    """Cells of all sheets, tabs between cells and line feeds between rows; shared and inline strings are resolved."""
    from xml.etree import ElementTree

    m = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
    with zipfile.ZipFile(io.BytesIO(raw)) as z:
        names = z.namelist()
        shared = ["".join(t.text or "" for t in si.iter(f"{m}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{m}si")] if "xl/sharedStrings.xml" in names else []
        rows = []
        for name in sorted(n for n in names if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n)):
            for row in ElementTree.fromstring(z.read(name)).iter(f"{m}row"):
                cells = []
                for c in row.iter(f"{m}c"):
                    v = c.find(f"{m}v")
                    if c.get("t") == "s" and v is not None:
                        cells.append(shared[int(v.text)])
                    elif c.get("t") == "inlineStr":
                        cells.append("".join(t.text or "" for t in c.iter(f"{m}t")))
                    else:
                        cells.append(v.text if v is not None and v.text else "")
                rows.append("\t".join(cells).rstrip())
    return "\n".join(rows).strip()


def rtf_text(raw: bytes) -> str:
    s = re.sub(r"\\pard?\b ?", "\n", decode(raw))
    s = re.sub(r"\\'[0-9A-Fa-f]{2}", " ", s)
    return re.sub(r"[{}]", "", re.sub(r"\\[A-Za-z]+-?\d* ?", "", s)).strip()


EXTRACTORS: dict[str, Callable[[bytes], str]] = {"txt": decode, "csv": decode, "md": decode, "log": decode, "rtf": rtf_text, "docx": docx_text, "xlsx": xlsx_text}


def extract_text(files: DataFrame, providers: dict[str, Callable[[bytes], str]] | None = None) -> DataFrame:
    """Files (path, content) with extraction struct(status, method, text, warning).

    ``providers`` add or replace the extractor of an extension, for example OCR of images or PDF pages; without one the status is unsupported.
    """
    known = EXTRACTORS | (providers or {})

    @F.pandas_udf("struct<status:string,method:string,text:string,warning:string>")
    def run(path: pd.Series, content: pd.Series) -> pd.DataFrame:
        out = []
        for p, raw in zip(path, content, strict=True):
            kind = p.rsplit(".", 1)[-1].lower() if "." in p.rsplit("/", 1)[-1] else ""
            if kind not in known:
                out.append(("unsupported", kind, None, None))
                continue
            try:
                t = known[kind](bytes(raw))
                out.append(("extracted" if t.strip() else "empty", kind, t, None))
            except Exception as e:  # noqa: BLE001  a broken file is a result, not a failure of the job
                out.append(("failed", kind, None, f"{type(e).__name__}: {e}"[:300]))
        return pd.DataFrame(out, columns=["status", "method", "text", "warning"])

    return files.withColumn("extraction", run("path", "content"))


def replace_table(df: DataFrame, path: str) -> None:
    """Write a table beside its place, then swap it in. A whole copy exists at every moment, and ``recover`` puts it in place after a driver's death."""
    spark = df.sparkSession
    recover(spark, path)
    at = path.rstrip("/")
    remove(spark, f"{at}.staged")
    df.write.parquet(f"{at}.staged")
    fs, target = filesystem(spark, at)
    old, new = (filesystem(spark, f"{at}.{x}")[1] for x in ("old", "staged"))
    fs.delete(old, True)
    if fs.exists(target) and not fs.rename(target, old):
        raise OSError(f"cannot move {at} away")
    if not fs.rename(new, target):
        raise OSError(f"cannot move {at}.staged into place")
    fs.delete(old, True)


def recover(spark, path: str) -> bool:
    """Finish a swap that was cut short: without a table, a staged one that was written whole takes its place, else the old one. Whether there is a table."""
    at = path.rstrip("/")
    fs, target = filesystem(spark, at)
    if fs.exists(target):
        return True
    for x in ("staged", "old"):
        _, copy = filesystem(spark, f"{at}.{x}")
        _, done = filesystem(spark, f"{at}.{x}/_SUCCESS")
        if fs.exists(copy) and (x == "old" or fs.exists(done)):
            return bool(fs.rename(copy, target))
    return False


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Old rows with the new ones in place of those of the same key; of several new rows the last in column order stays."""
    from factloom.operators.events import first_by_key

    latest = first_by_key(new, [key], [F.desc(c) for c in new.columns if c != key] or [key])
    return old.join(latest.select(key), key, "left_anti").select(old.columns).unionByName(latest.select(old.columns))


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def as_json(df: DataFrame) -> DataFrame:
    """One JSON document a row, for pipelines."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("json"))


def report_rows(df: DataFrame, title: str, rows: int = 40) -> list[str]:
    """Lines of a text report over the first rows of a (small, ordered) result."""
    found = df.limit(rows).collect()
    return [title, "=" * len(title), *(" | ".join("" if v is None else str(v) for v in r) for r in found)]


def vector_table(name: str) -> str:
    """The name, if it is one of the trial tables that may be created and dropped."""
    if not re.fullmatch(r"trial_[a-z0-9_]+", name):
        raise ValueError(f"not a trial table: {name}")
    return name
