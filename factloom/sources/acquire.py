"""Acquisition that goes on where it stopped: one result an item, however often it is run.

Items are asked of a function in parts.  A part's results are written whole and then named by one numbered file that is never overwritten; a run that dies loses its part only.  Of the
results of an item the success with the smallest number counts, so two runs that overlap may both ask, but one result is committed and never changes.  An item that failed is asked
again until it has failed ``tries`` times.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.sources.ledger import read_json, write_json
from factloom.storage import filesystem

_FIELDS = "item string, attempt int, status string, result string, error string"


class Acquisition:
    def __init__(self, spark: SparkSession, folder: str, tries: int = 3):
        self.spark, self.folder, self.tries = spark, folder.rstrip("/"), tries

    def _numbers(self) -> list[int]:
        fs, p = filesystem(self.spark, f"{self.folder}/commits")
        return sorted(int(x.getPath().getName()[:-5]) for x in fs.listStatus(p) if x.getPath().getName().endswith(".json")) if fs.exists(p) else []

    def attempts(self) -> DataFrame:
        """Every committed attempt: item, attempt, status, result, error and number, its commit."""
        parts = [self.spark.read.schema(_FIELDS).parquet(f"{self.folder}/{read_json(self.spark, f'{self.folder}/commits/{n:012d}.json')['data']}").withColumn("number", F.lit(n)) for n in self._numbers()]
        return reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame([], f"{_FIELDS}, number int")

    def results(self) -> DataFrame:
        """One row an item: status (ok, failed, or retry if it will be asked again), result, error and attempts."""
        a = self.attempts()
        first = F.min_by(F.struct("result", "number"), F.when(F.col("status") == "ok", F.struct("number", "attempt")))
        last = F.max_by("error", F.struct("number", "attempt"))
        each = a.groupBy("item").agg(F.max((F.col("status") == "ok").cast("int")).alias("ok"), first.alias("first"), last.alias("error"), F.max("attempt").alias("attempts"))
        status = F.when(F.col("ok") == 1, "ok").when(F.col("attempts") >= self.tries, "failed").otherwise("retry")
        done = F.col("ok") == 1
        return each.select("item", status.alias("status"), F.when(done, F.col("first.result")).alias("result"), F.when(~done, F.col("error")).alias("error"), "attempts")

    def pending(self, items: DataFrame, key: str) -> DataFrame:
        """Items without a final result, with ``_item``, the key as text, and ``_attempt``, the number of the one that comes next."""
        seen = self.results().select(F.col("item").alias("_item"), F.col("status").alias("_status"), F.col("attempts").alias("_attempts"))
        each = items.withColumn("_item", F.col(key).cast("string")).where(F.col("_item").isNotNull()).dropDuplicates(["_item"]).join(seen, "_item", "left")
        return each.where(F.col("_status").isNull() | (F.col("_status") == "retry")).withColumn("_attempt", F.coalesce("_attempts", F.lit(0)) + 1).drop("_status", "_attempts")

    def _commit(self, data: str) -> int:
        number = max(self._numbers(), default=0) + 1
        while not write_json(self.spark, f"{self.folder}/commits/{number:012d}.json", {"data": data}, replace=False):
            number += 1
        return number

    def part(self, items: DataFrame, key: str, ask: Callable[[dict], str], which: int = 0, parts: int = 1) -> int | None:
        """Ask for the pending items of one part, and commit the answers; the commit's number, None if nothing was pending."""
        todo = self.pending(items, key).where(F.pmod(F.xxhash64("_item"), F.lit(parts)) == which)
        columns = items.columns

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for p in frames:
                rows = []
                for item, row, attempt in zip(p["_item"], p[columns].to_dict("records"), p["_attempt"], strict=True):
                    try:
                        rows.append((item, attempt, "ok", str(ask(row | {"attempt": int(attempt)})), None))
                    except Exception as e:  # noqa: BLE001  a failed item is a result
                        rows.append((item, attempt, "error", None, f"{type(e).__name__}: {e}"[:300]))
                yield pd.DataFrame(rows, columns=[f.split()[0] for f in _FIELDS.split(", ")])

        data = f"results-{uuid.uuid4().hex}"
        todo.mapInPandas(run, _FIELDS).write.parquet(f"{self.folder}/{data}")
        if self.spark.read.parquet(f"{self.folder}/{data}").isEmpty():
            return None
        return self._commit(data)

    def run(self, items: DataFrame, key: str, ask: Callable[[dict], str], parts: int = 8) -> DataFrame:
        """Ask until every item has a final result, and return the results of all items ever asked."""
        while True:
            asked = [self.part(items, key, ask, k, parts) for k in range(parts)]
            if not any(asked):
                return self.results()
