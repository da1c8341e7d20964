"""Intermediate tables that survive a lost executor.

``materialize`` writes a DataFrame as Parquet below the folder that the cluster names in
``spark.checkpoint.dir`` and reads it back, which cuts the lineage.  Only if that setting is
missing and driver and executors are one process, as in local tests, is a temporary folder made.
"""

from __future__ import annotations

import atexit
import gc
import tempfile
import uuid

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

_local: list[str] = []
_written: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if at:
        return at.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _local:
        _local.append(tempfile.mkdtemp(prefix="factloom-"))
    return f"file://{_local[0]}"


def new_path(spark: SparkSession, name: str) -> str:
    """An unused path in the shared folder; removed when the driver ends."""
    if not _written:
        atexit.register(_clean, spark)
    path = f"{shared_dir(spark)}/factloom/{name}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def filesystem(spark: SparkSession, path: str):
    """Hadoop file system and path objects of a path."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def remove(spark: SparkSession, path: str) -> None:
    fs, p = filesystem(spark, path)
    fs.delete(p, True)


def _clean(spark: SparkSession) -> None:
    for path in _written:
        try:
            remove(spark, path)
        except Exception:  # noqa: BLE001  the JVM may have ended before
            return


def materialize(df: DataFrame, name: str = "table", codec: str | None = None) -> DataFrame:
    """Write and reread ``df``; later reads do not compute it again. codec: the compression, if not the session's."""
    spark = df.sparkSession
    path = new_path(spark, name)
    (df.write.option("compression", codec) if codec else df.write).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_at = path
    return out


#: Rows of a task whose memory should not grow with the input, about.
TASK_ROWS = 500_000


def parts_for(df: DataFrame, rows: int | None = None) -> int:
    """Partitions of about ``rows`` (TASK_ROWS) rows each; counts ``df``, which should be a stored table."""
    return max(1, -(-df.count() // (rows or TASK_ROWS)))


def drop_materialized(df: DataFrame) -> None:
    """Remove the files of a materialized table that nothing reads any more."""
    remove(df.sparkSession, df._written_at)


def release(spark: SparkSession) -> None:
    """Let go of what finished steps left in the driver: plans, broadcasts and shuffles that nothing refers to any more, and memory that the JVM has freed."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    trim(spark)


def trim(spark: SparkSession) -> bool:
    """Give the system what malloc keeps of the memory that the driver's JVM freed outside its heap, by the command that ``jcmd`` names System.trim_native_heap; False where there is none."""
    sc = spark.sparkContext
    jvm, array = sc._jvm, sc._gateway.new_array
    lang = jvm.java.lang
    try:
        names, given = array(lang.Class, 4), array(lang.Object, 4)
        for k, name in enumerate(("javax.management.ObjectName", "java.lang.String", "[Ljava.lang.Object;", "[Ljava.lang.String;")):
            names[k] = lang.Class.forName(name)
        given[0], given[1], given[2], given[3] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap", array(lang.Object, 0), array(lang.String, 0)
        lang.Class.forName("javax.management.MBeanServer").getMethod("invoke", names).invoke(lang.management.ManagementFactory.getPlatformMBeanServer(), given)
    except Py4JError:
        return False
    return True
