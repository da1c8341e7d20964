"""Sharding by size-tiered compaction, with DataFrame operations only.

A store is a folder of immutable Parquet shards and numbered manifests.  ``append`` writes arrivals as they come: every task
writes its rows of an arrival as one small shard, without a shuffle.  The shards of an arrival are a run.
``compact`` looks at the runs' sizes: a tier holds the runs whose sizes lie within a factor ``fanout``; a tier of
``fanout`` runs or more is merged into one run, which may fill the next tier, until no tier is full.  Each merged run is
written once, as files of about ``target_bytes``. The rows of a file are chosen by a hash range of their id and place, and every
file is written by a task of its own, so no file and no task grows with a run, whatever rows are repeated in it.  A new manifest becomes visible by one rename that fails if the version exists; readers
of older versions are not disturbed until ``vacuum``.

The driver holds the list of runs (arrivals since the last compaction), never rows or files of rows.
Defined results: null texts have 0 bytes; repeated rows stay, spread over the files; a text longer than ``target_bytes`` stays whole in one file; null ids are hashed like others; an empty table makes an empty version. The columns
``shard_run``, ``shard_file`` and ``shard_bytes`` are the store's own: input columns of these names are replaced.
"""

from __future__ import annotations

import json
import math
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from factloom.storage import filesystem, new_path, remove

TARGET_BYTES, FANOUT = 64 << 20, 4
_OWN = ("shard_run", "shard_file", "shard_bytes")


def tier(size: int, fanout: int = FANOUT) -> int:
    """Runs of one tier differ in size by less than a factor ``fanout``."""
    return int(math.log(max(size, 1), fanout) + 1e-9)


def plan(sizes: dict[int, int], fanout: int = FANOUT) -> list[list[int]]:
    """Which runs to merge into one: the smallest full tier first, until no tier is full."""
    now = {(r,): s for r, s in sizes.items()}
    while True:
        tiers: dict[int, list[tuple[int, ...]]] = {}
        for run in sorted(now):
            tiers.setdefault(tier(now[run], fanout), []).append(run)
        full = next((t for t in sorted(tiers) if len(tiers[t]) >= fanout), None)
        if full is None:
            return [sorted(run) for run in sorted(now) if len(run) > 1]
        merged = tuple(sorted(r for run in tiers[full] for r in run))
        now[merged] = sum(now.pop(run) for run in tiers[full])


class ShardStore:
    def __init__(self, spark: SparkSession, root: str, schema: StructType, target_bytes: int = TARGET_BYTES, fanout: int = FANOUT):
        self.spark, self.root, self.target_bytes, self.fanout = spark, root.rstrip("/"), target_bytes, fanout
        self.schema = StructType([f for f in schema if f.name not in _OWN] + [StructField("shard_bytes", LongType()), StructField("shard_run", IntegerType()), StructField("shard_file", IntegerType())])

    # manifests

    def version(self) -> int:
        """Of the newest manifest; 0 for a new store."""
        fs, path = filesystem(self.spark, f"{self.root}/manifests")
        return max([0, *(int(x.getPath().getName()[1:-5]) for x in fs.listStatus(path) if x.getPath().getName().startswith("v"))]) if fs.exists(path) else 0

    def manifest(self, version: int | None = None) -> dict:
        """{"runs": {run: {"path", "bytes", "rows", "files"}}, "next": first unused run number}"""
        v = self.version() if version is None else version
        if not v:
            return {"runs": {}, "next": 0}
        return json.loads("".join(r[0] for r in self.spark.read.text(f"{self.root}/manifests/v{v:08d}.json", wholetext=True).collect()))

    def _commit(self, manifest: dict, base: int) -> int:
        """Atomic: a second writer of the same version fails."""
        fs, temp = filesystem(self.spark, f"{self.root}/manifests/.{uuid.uuid4().hex}")
        out = fs.create(temp)
        out.write(bytearray(json.dumps(manifest), "utf-8"))
        out.close()
        jvm = self.spark.sparkContext._jvm
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(temp.toUri() if temp.toUri().getScheme() else fs.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        none = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        context.rename(fs.makeQualified(temp), fs.makeQualified(jvm.org.apache.hadoop.fs.Path(f"{self.root}/manifests/v{base + 1:08d}.json")), none)
        return base + 1

    # data

    def _write(self, rows: DataFrame, at: str) -> dict[int, dict]:
        """Write rows (with the store's own columns) below ``at``; the runs written."""
        rows.write.option("compression", "zstd").partitionBy("shard_run", "shard_file").parquet(at)
        written = self.spark.read.schema(self.schema).parquet(at).groupBy("shard_run").agg(F.sum("shard_bytes").alias("b"), F.count("*").alias("n"), F.countDistinct("shard_file").alias("f"))
        return {r["shard_run"]: {"path": f"{at}/shard_run={r['shard_run']}", "bytes": r["b"], "rows": r["n"], "files": r["f"]} for r in written.collect()}

    def append(self, docs: DataFrame, arrival: Column | None = None) -> int:
        """A run for each value (a small integer from 0) of ``arrival``, or one run; the new version."""
        base = self.version()
        m = self.manifest(base)
        run = (F.lit(m["next"]) + (F.lit(0) if arrival is None else F.coalesce(arrival, F.lit(0)))).cast("int")
        names = [f.name for f in self.schema if f.name not in _OWN]
        rows = docs.select(*names, F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("shard_bytes"), run.alias("shard_run"), F.lit(0).alias("shard_file"))
        new = self._write(rows, f"{self.root}/data/{uuid.uuid4().hex}")
        m["runs"] |= {str(k): v for k, v in new.items()}
        m["next"] = max([m["next"], *(k + 1 for k in new)])
        return self._commit(m, base)

    def compact(self, hash_column: str = "doc_id") -> int:
        """Merge full tiers; the new version, or the old one if no tier is full."""
        base = self.version()
        m = self.manifest(base)
        groups = plan({int(k): v["bytes"] for k, v in m["runs"].items()}, self.fanout)
        if not groups:
            return base
        rows, total = None, 0
        plain = StructType([f for f in self.schema if f.name != "shard_run"])
        for i, g in enumerate(groups):
            old = [m["runs"].pop(str(r)) for r in g]
            files = max(1, math.ceil(sum(x["bytes"] for x in old) / self.target_bytes))
            for x in old:
                # a row's place in its immutable file tells repeated rows apart, and is the same when a task is run again
                u = F.pmod(F.xxhash64(hash_column, F.col("_metadata.row_index")), F.lit(1 << 30)) / float(1 << 30)
                one = self.spark.read.schema(plain).parquet(x["path"]).withColumns({"shard_run": F.lit(m["next"] + i), "shard_file": F.floor(u * files).cast("int")})
                one = one.select(*self.schema.names, (F.lit(total) + F.col("shard_file")).alias("__task"))
                rows = one if rows is None else rows.unionByName(one)
            total += files
        m["next"] += len(groups)
        rows = rows.repartitionById(total, "__task").drop("__task")  # files are numbered densely: one task each
        m["runs"] |= {str(k): v for k, v in self._write(rows, f"{self.root}/data/{uuid.uuid4().hex}").items()}
        return self._commit(m, base)

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, with the store's own columns."""
        runs = self.manifest(version)["runs"]
        rows = None
        for k, v in runs.items():
            one = self.spark.read.schema(StructType([f for f in self.schema if f.name != "shard_run"])).parquet(v["path"]).withColumn("shard_run", F.lit(int(k))).select(*self.schema.names)
            rows = one if rows is None else rows.unionByName(one)
        return self.spark.createDataFrame([], self.schema) if rows is None else rows

    def vacuum(self) -> None:
        """Remove runs that only older versions have."""
        live = {v["path"] for v in self.manifest()["runs"].values()}
        for v in range(1, self.version()):
            for x in self.manifest(v)["runs"].values():
                if x["path"] not in live:
                    remove(self.spark, x["path"])


def arrival_of(parts: int = 12) -> Column:
    """Arrivals of about equal size, by a hash of id and text."""
    return F.pmod(F.xxhash64("doc_id", "text"), F.lit(parts)).cast("int")


def shard(docs: DataFrame, root: str | None = None, arrivals: int = 12, target_bytes: int = TARGET_BYTES, fanout: int = FANOUT) -> DataFrame:
    """Append ``docs`` in arrivals, compact, vacuum, and read back: ``docs`` with shard_run, shard_file and shard_bytes."""
    spark = docs.sparkSession
    store = ShardStore(spark, root or new_path(spark, "shards"), docs.schema, target_bytes, fanout)
    store.append(docs, arrival_of(arrivals))
    store.compact()
    store.vacuum()
    return store.read()


def shard_membership(docs: DataFrame, **how) -> DataFrame:
    """doc_id, shard_run, shard_file and shard_bytes (bytes of the row's text) of every document."""
    return shard(docs, **how).select("doc_id", "shard_run", "shard_file", "shard_bytes")
