"""Batch sinks."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockflow.operators.ingest import as_messages, new_rows
from stockflow.schemas import FORECASTS, INVENTORY
from stockflow.session import discard, materialize, remove
from stockflow.sources.readers import empty, read_table


def append(df: DataFrame, path: str, schema: T.StructType) -> None:
    df.select(*schema.names).write.mode("append").parquet(path)


def create_if_absent(spark, path: str, schema: T.StructType) -> DataFrame:
    """The table at ``path``, written empty first if there is none."""
    empty(spark, schema).write.mode("ignore").parquet(path)
    return read_table(spark, path, schema)


def replace(df: DataFrame, path: str) -> None:
    """Overwrite a table, also from a frame that reads that very table.

    The new version is written once, beside the old one, which stays readable
    and complete until the two folders change names.
    """
    path = path.rstrip("/")
    fresh = f"{path}.new-{uuid.uuid4().hex}"
    df.write.parquet(fresh)
    swap(df.sparkSession, fresh, path)


def swap(spark: SparkSession, fresh: str, path: str) -> None:
    """Give the folder ``fresh`` the name ``path``; what was there goes, and comes
    back should the new one not get its name."""
    jvm = spark.sparkContext._jvm
    source, target = (jvm.org.apache.hadoop.fs.Path(p) for p in (fresh, path))
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    old = jvm.org.apache.hadoop.fs.Path(f"{path}.old-{uuid.uuid4().hex}")
    system.mkdirs(target.getParent())
    had = system.exists(target)
    if had and not system.rename(target, old):
        raise OSError(f"{path} cannot be renamed")
    try:
        moved = system.rename(source, target)
    except Py4JJavaError:
        moved = False
    if not moved:
        if had and not system.exists(target):
            system.rename(old, target)
        raise OSError(f"{fresh} cannot be renamed")
    if had:
        system.delete(old, True)
    spark.catalog.refreshByPath(path)


def replace_model(forecasts: DataFrame, path: str, model_name: str | None = None) -> None:
    """Replace the rows of the models in ``forecasts``, keep all other models.

    ``model_name`` names a model whose old rows go even if there are no new ones.
    """
    staged = materialize(forecasts.select(*FORECASTS.names), "staged")
    if model_name is not None and staged.filter(F.col("model_name") == model_name).isEmpty():
        spark = forecasts.sparkSession
        remove(spark, f"{path.rstrip('/')}/model_name={model_name}")
        spark.catalog.refreshByPath(path)
    (
        staged.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("model_name")
        .parquet(path)
    )
    discard(staged)


def publish(events: DataFrame, path: str) -> None:
    """One JSON message per event, as lines of text files."""
    as_messages(events).write.mode("append").text(path)


def publish_kafka(events: DataFrame, servers: str, topic: str) -> None:
    """One JSON message per event to a Kafka topic (needs the connector)."""
    writer = as_messages(events).write.format("kafka")
    writer.option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def append_csv(df: DataFrame, path: str) -> None:
    df.write.mode("append").option("header", True).csv(path)


def change_type(df: DataFrame, column: str, kind: str) -> DataFrame:
    """``column`` as another type; values that do not convert become null."""
    return df.withColumn(column, F.col(column).try_cast(kind))


def ingest(incoming: DataFrame, table_path: str, messages_path: str, **options: object) -> int:
    """Append the rows not stored yet and publish exactly those; returns their number."""
    stored = read_table(incoming.sparkSession, table_path, INVENTORY)
    fresh = materialize(new_rows(incoming.select(*INVENTORY.names), stored, **options), "fresh")
    append(fresh, table_path, INVENTORY)
    publish(fresh, messages_path)
    count = fresh.count()
    discard(fresh)
    return count
