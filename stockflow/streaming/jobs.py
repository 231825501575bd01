"""Streaming jobs: drain a source, keep hourly metrics, suppress duplicates."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockflow.operators.ingest import as_messages, new_rows
from stockflow.operators.joins import first_per_key
from stockflow.operators.metrics import PRODUCT_KEY, decode_messages, with_stock_value
from stockflow.schemas import EVENT_KEY, INVENTORY
from stockflow.session import materialize, remove, scratch
from stockflow.sources.readers import read_table
from stockflow.sources.writers import replace


def read_file_stream(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", files: int = 1000
) -> DataFrame:
    """Stream over the files of a folder, at most ``files`` per micro-batch."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files)
    return reader.format(fmt).load(path)


def read_message_stream(spark: SparkSession, path: str, files: int = 1000) -> DataFrame:
    """Parsed events from a folder of JSON-lines message files."""
    reader = spark.readStream.option("maxFilesPerTrigger", files)
    return decode_messages(reader.text(path))


def read_kafka_stream(
    spark: SparkSession, servers: str, topic: str, messages: int = 1_000_000
) -> DataFrame:
    """Parsed events from a Kafka topic (needs the connector)."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
    reader = reader.option("subscribe", topic).option("maxOffsetsPerTrigger", messages)
    return decode_messages(reader.load())


def progress_of(path: str) -> str:
    """Where the progress of a stream into ``path`` is kept; readers of the table
    skip it, and a rerun goes on after what the table holds."""
    return f"{path.rstrip('/')}/_progress"


def drain(
    stream: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "append",
) -> None:
    """Process what is available now in bounded micro-batches, then stop.

    Progress is committed after the write, so a retried batch reaches ``write``
    again under the same number and an idempotent write keeps results exact.
    """
    query = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )
    query.awaitTermination()


def batch_folders(path: str) -> Callable[[DataFrame, int], None]:
    """Writer that keeps every micro-batch in a folder of its own, so that a
    retry replaces what the first attempt left."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return write


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All micro-batches under ``path``, with their number in ``batch``."""
    layout = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
    return read_table(spark, path, layout)


def drain_replacing(stream: DataFrame, path: str, checkpoint: str | None = None) -> None:
    """Replace the table at ``path`` by all that the stream holds now.

    Micro-batches gather beside the table, which changes once, at the end of the
    drain; without new rows it stays. What an interrupted drain gathered is part
    of the next one.
    """
    spark = stream.sparkSession
    gathered = f"{path.rstrip('/')}.gathered"
    drain(stream, batch_folders(gathered), checkpoint or f"{path.rstrip('/')}.progress")
    rows = read_batches(spark, gathered, stream.schema).drop("batch")
    if not rows.isEmpty():
        replace(rows, path)
    remove(spark, gathered)


def ingesting(table_path: str, messages_path: str, **options: object) -> Callable:
    """Writer that stores and publishes only events not stored yet.

    Batch folders make a retry idempotent: rows of the same batch number do
    not count as stored. Scratch tables go when the batch ends.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        with scratch():
            stored = read_batches(spark, table_path, INVENTORY).filter(F.col("batch") != number)
            fresh = new_rows(batch.select(*INVENTORY.names), stored, **options)
            fresh = materialize(fresh, "fresh")
            batch_folders(table_path)(fresh, number)
            as_messages(fresh).write.mode("overwrite").text(f"{messages_path}/batch={number}")

    return write


def partial_figures(events: DataFrame) -> DataFrame:
    """Hourly sums and counts, from which figures over several batches follow."""
    window = F.window("ts", "1 hour")
    return (
        with_stock_value(events)
        .groupBy(*PRODUCT_KEY, window.alias("window"))
        .agg(
            F.sum("quantity").alias("quantity"),
            F.sum("price").alias("price"),
            F.count("price").alias("prices"),
            F.sum("stock_value").alias("stock_value"),
        )
        .select(
            *PRODUCT_KEY,
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "quantity",
            "price",
            "prices",
            "stock_value",
        )
    )


def merged_figures(partials: DataFrame) -> DataFrame:
    """The hourly metrics of all batches together."""
    return partials.groupBy(*PRODUCT_KEY, "window_start", "window_end").agg(
        F.sum("quantity").alias("total_quantity"),
        (F.sum("price") / F.nullif(F.sum("prices"), F.lit(0))).alias("avg_price"),
        F.sum("stock_value").alias("total_stock_value"),
    )


def streamed_hourly_metrics(
    events: DataFrame, path: str, checkpoint: str | None = None
) -> DataFrame:
    """Drain ``events`` into partial hourly sums under ``path`` and return the
    metrics of all that was ever drained there.

    No state is kept and nothing is too late: any split of the events into
    micro-batches gives the result of one batch.
    """
    spark = events.sparkSession
    layout = partial_figures(spark.createDataFrame([], events.schema)).schema

    def write(batch: DataFrame, number: int) -> None:
        batch_folders(path)(partial_figures(batch), number)

    drain(events, write, checkpoint or progress_of(path))
    return merged_figures(read_batches(spark, path, layout))


def watermarked(events: DataFrame, delay: str) -> DataFrame:
    """Event time as a zoned timestamp with a lateness bound."""
    return events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)


def without_duplicates(
    events: DataFrame, keys: list[str] = EVENT_KEY, *, delay: str, salts: int = 32
) -> DataFrame:
    """One event per key, whichever comes first, in bounded state: a key is
    remembered for ``delay`` of event time, and events later than that drop.

    Copies first meet within their share of the input partitions and only the
    survivors under the bare key, so a hot key does not fill one task.
    """
    marked = watermarked(events, delay)
    if salts:
        salt = F.pmod(F.spark_partition_id(), F.lit(salts))
        marked = marked.withColumn("__salt", salt)
        marked = marked.dropDuplicatesWithinWatermark([*keys, "__salt"]).drop("__salt")
    return marked.dropDuplicatesWithinWatermark(keys)


def streamed_unique_events(
    events: DataFrame, path: str, keys: list[str] = EVENT_KEY, checkpoint: str | None = None
) -> DataFrame:
    """Drain ``events`` into ``path``, one row per key, and return all rows there.

    Of the copies in a micro-batch the smallest row stays; a key that an earlier
    micro-batch or call stored is not stored again, however old it is.
    """
    spark = events.sparkSession
    schema = events.schema
    rest = [c for c in schema.names if c not in keys]

    def write(batch: DataFrame, number: int) -> None:
        with scratch():
            first = materialize(first_per_key(batch, keys, rest), "first")
            stored = read_batches(spark, path, schema).filter(F.col("batch") != number)
            # Pruned to the micro-batch's range of time, where that is part of the key.
            fresh = new_rows(first, stored, keys)
            batch_folders(path)(fresh.select(*schema.names), number)

    drain(events, write, checkpoint or progress_of(path))
    return read_batches(spark, path, schema).drop("batch")
