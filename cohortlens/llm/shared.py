"""Shared storage for what one step of an operator hands to the next.

Executors may be lost at any time, so a step's result that is used again is
written as Parquet under the folder that the session names in
``spark.checkpoint.dir``; every executor and the driver can read it.
"""

from __future__ import annotations

import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Folders that the innermost open ``scratch`` block has written.
_written: list[list[str]] = []

_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_ARROW = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Bytes of an Arrow batch, about: what a task holds of one counts outside the JVM's heap, several times over, and in Python.
ARROW_BYTES = 4 << 20


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; only a local-mode session without one gets a temporary folder."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to storage that all executors share")
        base = tempfile.mkdtemp(prefix="corpus-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def _held(spark: SparkSession, key: str, value: str):
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def shuffles_freed(spark: SparkSession):
    """Shuffle files of the executions inside go when each ends, not when the driver collects its garbage."""
    return _held(spark, _FREE, "true")


def small_batches(spark: SparkSession):
    """Rows go to Python in batches of about ``ARROW_BYTES`` inside, one row at least; a session that names a size keeps its own."""
    return _held(spark, _ARROW, spark.conf.get(_ARROW, None) or str(ARROW_BYTES))


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: its lineage ends there."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    with shuffles_freed(spark):
        df.write.option("compression", "zstd").parquet(path)
    if _written:
        _written[-1].append(path)
    found = spark.read.schema(df.schema).parquet(path)
    found._stored_in = path
    return found


def done_with(*frames: DataFrame) -> None:
    """Deletes the folders of what ``stored`` returned, which no later step reads."""
    for df in frames:
        remove(df.sparkSession, df._stored_in)


@contextlib.contextmanager
def scratch(spark: SparkSession):
    """Folders written by ``stored`` inside go at the block's end, but for the last, which holds its result."""
    paths: list[str] = []
    _written.append(paths)
    try:
        yield
    finally:
        _written.remove(paths)
        for path in paths[:-1]:
            remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder of the shared storage that no later step reads."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
