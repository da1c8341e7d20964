"""Streaming forms: incremental index refresh, windowed counts with late data, and latest decisions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import StructType

from factloom.operators.events import first_by_key
from factloom.operators.segments import SearchIndex
from factloom.sources.files import recover, replace_table, upsert
from factloom.sources.versions import VersionedTable


def refresh_stream(spark: SparkSession, landing: str, schema: StructType, table: str, key: str, checkpoint: str) -> StreamingQuery:
    """Upsert the Parquet files that arrived in a folder since the last run into a table, then stop; a rerun of a batch changes nothing."""

    def merge(batch: DataFrame, epoch: int) -> None:
        old = spark.read.parquet(table) if recover(spark, table) else spark.createDataFrame([], schema)
        replace_table(upsert(old, batch.select(schema.names), key), table)

    return spark.readStream.schema(schema).parquet(landing).writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def versioned_stream(spark: SparkSession, landing: str, schema: StructType, folder: str, key: str, checkpoint: str) -> StreamingQuery:
    """As refresh_stream(), into a versioned table: every reader meets a whole version, and each batch of files is one. For tables small enough to be written for each batch."""
    table = VersionedTable(spark, folder)

    def merge(batch: DataFrame, epoch: int) -> None:
        new = batch.select(schema.names)
        table.update(lambda old: upsert(spark.createDataFrame([], schema) if old is None else old, new, key))

    return spark.readStream.schema(schema).parquet(landing).writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def indexed_stream(spark: SparkSession, landing: str, schema: StructType, index: SearchIndex, checkpoint: str) -> StreamingQuery:
    """Add the items that arrived in a folder since the last run to a search index, a segment for each batch, and merge segments of a size; what is stored is not written again. A rerun of a batch changes no answer."""

    def add(batch: DataFrame, epoch: int) -> None:
        index.update(batch.select(schema.names))
        index.merge()

    return spark.readStream.schema(schema).parquet(landing).writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, time: str, kind: str, value: str, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Count and sum by tumbling window and kind; events later than ``late`` are dropped. For streams and for tables."""
    return events.withWatermark(time, late).groupBy(F.window(time, window).alias("w"), kind).agg(F.count("*").alias("n"), F.sum(value).alias("total")).select(F.col("w.start").alias("window_start"), kind, "n", "total")


def sessions(events: DataFrame, time: str, user: str, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    """Sessions of a user: events at most ``gap`` apart."""
    return events.withWatermark(time, late).groupBy(F.session_window(time, gap).alias("s"), user).agg(F.count("*").alias("n")).select(user, F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), "n")


def latest_by(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Latest row of each key of a decision log read as a table."""
    return first_by_key(rows, [key], [F.desc(c) for c in order])
