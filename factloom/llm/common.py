"""What several corpus operators share: tables, folds, and Arrow plumbing."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Word pattern of the corpus operators, and its complement, for SQL engines.
SEPARATORS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: str | Column = "doc_id") -> Column:
    """crc32 of the id as text, mod 5; null for a null id."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(c.cast("string")) % 5


def labelled(labels: DataFrame, column: str, limit: int | None = None, per_class: bool = False) -> DataFrame:
    """The labels outside the held-out fold, as (doc_id, y); a bounded sample of them if there is a ``limit``.

    Rows without an id or label are left out; of several labels of one id the mean decides (0.5: 1).
    About ``limit`` rows (of each class with ``per_class``) with the smallest hashes of their ids stay.
    """
    one = (
        labels.select("doc_id", F.col(column).cast("double").alias("y"))
        .where(F.col("doc_id").isNotNull() & F.col("y").isNotNull() & (fold() != 0))
        .groupBy("doc_id")
        .agg((F.avg("y") >= 0.5).cast("int").alias("y"))
    )
    if limit is None:
        return one
    counts = {r["y"]: r["n"] for r in one.groupBy("y").agg(F.count("*").alias("n")).collect()}
    total = sum(counts.values())
    share = F.lit(0.0)
    for y, n in counts.items():
        share = F.when(F.col("y") == y, F.lit(min(1.0, limit / (n if per_class else total)))).otherwise(share)
    u = F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1 << 30)) / float(1 << 30)
    return one.where(u < share)


def arrow_map(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str, rows: int = 1000) -> DataFrame:
    """``mapInArrow`` with batches of at most ``rows`` rows, which bounds a worker's memory for long texts."""
    conf = df.sparkSession.conf
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(conf.get(key)) > rows:
        conf.set(key, str(rows))
    return df.mapInArrow(fn, schema)


def batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()], names=list(columns))


def pack(a: np.ndarray) -> bytes:
    return np.ascontiguousarray(a).tobytes()


def annotate(docs: DataFrame, fn: Callable[[pa.RecordBatch], dict[str, pa.Array]], fields: str, keep: list[str] | None = None, rows: int = 1000, reads: str = "text") -> DataFrame:
    """``docs`` with columns that ``fn`` makes from each Arrow batch.

    reads: the text column that ``fn`` needs. keep: the input columns that stay, all of them if None. Input columns named as a new one are replaced.
    ``fn`` may return a boolean array under ``where``; then only the rows it marks stay. Without ``fields`` it is a filter.
    """
    from pyspark.sql.types import StructType, _parse_datatype_string

    new = _parse_datatype_string(fields) if fields else StructType([])
    names = [c for c in (docs.columns if keep is None else keep) if c not in new.names]
    read = names + [c for c in (reads,) if c not in names and c in docs.columns]
    schema = StructType([docs.schema[c] for c in names] + list(new.fields))
    width = len(new.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = fn(b)
            where = out.pop("where", None)
            arrays = [b.column(b.schema.get_field_index(c)) for c in names] + [v if isinstance(v, pa.Array) else pa.array(v) for v in out.values()]
            assert len(arrays) == len(names) + width
            r = pa.RecordBatch.from_arrays(arrays, names=[*names, *new.names])
            yield r if where is None else r.filter(pa.array(where))

    return arrow_map(docs.select(*read), run, schema, rows)


#: A key is heavy if it has more than one in HEAVY of all rows; so there are fewer than HEAVY heavy keys.
HEAVY = 10_000


def join_heavy(rows: DataFrame, of: DataFrame, key: str) -> DataFrame:
    """``rows`` joined with ``of``, which has one row a key, whatever share of ``rows`` a key holds.

    Heavy keys, fewer than HEAVY, are joined by broadcast; the rest, of which each holds a small share, by a shuffle. Both sides are read more
    than once and should be written tables. Null keys and keys without a partner go.
    """
    counts = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("c"))
    total = rows.agg(F.count("*").alias("t"))
    heavy = counts.join(F.broadcast(total), F.col("c") * HEAVY > F.col("t")).select(key)  # one row
    mark = rows.join(F.broadcast(heavy.withColumn("__heavy", F.lit(True))), key, "left")
    of_heavy = F.broadcast(of.join(F.broadcast(heavy), key, "left_semi"))
    return mark.where(F.col("__heavy")).drop("__heavy").join(of_heavy, key).unionByName(mark.where(F.col("__heavy").isNull()).drop("__heavy").join(of, key))
