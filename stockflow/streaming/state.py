"""Streams whose memory is a state store: work follows the micro-batch, not the table."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from stockflow.schemas import EVENT_KEY
from stockflow.streaming.jobs import batch_folders, drain, progress_of, read_batches

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
BOUNDED = "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage"
_PICK = "__pick"
_SPOT = "__spot"


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB, all of an executor's stores
    within one bound of memory; the settings are put back."""
    settings = {PROVIDER: ROCKSDB, BOUNDED: "true"}
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


class FirstOfKey(StatefulProcessor):
    """Passes on one row of a key that was never met, nothing of others."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.met = handle.getValueState("met", "rows bigint")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        if self.met.exists():
            return
        first = min(rows, key=lambda row: row[_PICK])
        self.met.update((1,))
        yield first

    def close(self) -> None:
        pass


def one_per_key(keys: list[str]):
    """Of the rows of a key in one Arrow batch the one with the smallest pick, so
    that a key with many copies reaches its state as a few rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.table([*batch.select(keys).columns, batch.column(_PICK)], [*keys, _PICK])
            table = table.append_column(_SPOT, pa.array(range(len(table)), pa.int64()))
            table = table.sort_by([(_PICK, "ascending"), (_SPOT, "ascending")])
            first = table.group_by(keys, use_threads=False).aggregate([(_SPOT, "first")])
            yield batch.take(first.column(f"{_SPOT}_first").combine_chunks().sort())

    return run


def few_per_key(events: DataFrame, keys: list[str]) -> DataFrame:
    """``events`` with a pick, less most copies of keys that are frequent."""
    schema = events.withColumn(_PICK, F.lit(0).cast("bigint")).schema
    picked = events.withColumn(_PICK, F.xxhash64(*events.columns))
    return picked.mapInArrow(one_per_key(keys), schema)


def unique_events(events: DataFrame, keys: list[str] = EVENT_KEY) -> DataFrame:
    """The stream's first row per key; the keys that were met are Spark's own state.

    Of several rows in the micro-batch that brings a key, the first to reach the
    state stays. Null key parts are equal. A key is looked up and stored inside
    Spark, without a call into Python for each.
    """
    return few_per_key(events, keys).dropDuplicates(keys).drop(_PICK)


def first_events(events: DataFrame, keys: list[str] = EVENT_KEY) -> DataFrame:
    """The stream's first row per key, with a value state for each key.

    Of several rows in the micro-batch that brings a key, the one with the
    smallest hash of all columns stays. Null key parts are equal. The stream has
    to be started under ``rocksdb_state``; its state lives in its checkpoint.
    Every key is a call into Python, about a millisecond: for many keys, and
    where any row of a key will do, ``unique_events`` does it without.
    """
    combined = few_per_key(events, keys)
    schema = combined.schema
    first = combined.groupBy(*keys).transformWithState(
        FirstOfKey(), outputStructType=schema, outputMode="append", timeMode="none"
    )
    return first.drop(_PICK)


def unique_events_by_state(
    events: DataFrame, path: str, keys: list[str] = EVENT_KEY, checkpoint: str | None = None
) -> DataFrame:
    """Drain ``events`` into ``path``, one row per key, and return all rows there.

    The same keys as ``jobs.streamed_unique_events`` for any split of the input,
    but what is stored is never read again: whether a key is known follows from
    its state, which survives a restart with the checkpoint. A retried
    micro-batch starts from the state before it and replaces its folder.
    """
    spark = events.sparkSession
    with rocksdb_state(spark):
        drain(unique_events(events, keys), batch_folders(path), checkpoint or progress_of(path))
    return read_batches(spark, path, events.schema).drop("batch")
