"""Shared-folder handling and materialisation of intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession


_SCOPES: list[list[DataFrame]] = []
_WRITTEN: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session without the setting gets a folder of its own; a
    cluster session without it is refused, since a machine-local folder would
    lose data with the executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    folder = configured or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    folder = "file://" + tempfile.mkdtemp(prefix="stockflow-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir()


def new_location(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder, in this application's own part of
    it, which can be deleted as a whole once the application has ended."""
    own = f"{shared_folder(spark).rstrip('/')}/stockflow/{spark.sparkContext.applicationId}"
    return f"{own}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where several jobs need the very same rows (row numbers, a forest, a
    small lookup side). Columnar files keep pruning and pushdown, and survive
    the loss of executors.
    """
    spark = df.sparkSession
    path = new_location(spark, label)
    df.write.parquet(path)
    written = spark.read.schema(df.schema).parquet(path)
    _WRITTEN[written] = path
    if _SCOPES:
        _SCOPES[-1].append(written)
    return written


@contextmanager
def scratch() -> Iterator[None]:
    """Tables materialised inside are deleted at the end; nothing lazy that
    reads them may leave."""
    _SCOPES.append([])
    try:
        yield
    finally:
        discard(*_SCOPES.pop())


@contextmanager
def arrow_batches(spark: SparkSession, n_bytes: int) -> Iterator[None]:
    """Jobs started inside hand rows to Python in batches of about ``n_bytes``, or of
    one row, unless the session has a bound of its own; the setting is put back."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) is not None:
        yield
        return
    spark.conf.set(name, str(n_bytes))
    try:
        yield
    finally:
        spark.conf.unset(name)


def discard(*tables: DataFrame) -> None:
    """Delete materialised tables that nothing will read again."""
    for table in tables:
        path = _WRITTEN.pop(table, None)
        if path:
            remove(table.sparkSession, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of any file system that Spark reaches."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-partition by ``keys`` ahead of per-group Python work.

    The explicit number keeps adaptive execution from merging these small but
    compute-heavy partitions; the grouping that follows needs no other shuffle.
    """
    spark = df.sparkSession
    configured = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(configured, spark.sparkContext.defaultParallelism), *keys)
