"""Fixture adapters: the star-schema test tables as stock events and forecasts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockflow.fixed_values import ISO_Z, ML_ANOMALY
from stockflow.functions.text import quantities_text
from stockflow.functions.timestamps import render
from stockflow.operators.ingest import as_messages

EVENTS_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)

LINEITEM_SCHEMA = T.StructType(
    [
        T.StructField("l_orderkey", T.LongType()),
        T.StructField("l_partkey", T.LongType()),
        T.StructField("l_suppkey", T.LongType()),
        T.StructField("l_linenumber", T.IntegerType()),
        T.StructField("l_quantity", T.DoubleType()),
        T.StructField("l_extendedprice", T.DoubleType()),
        T.StructField("l_discount", T.DoubleType()),
        T.StructField("l_tax", T.DoubleType()),
        T.StructField("l_returnflag", T.StringType()),
        T.StructField("l_linestatus", T.StringType()),
        T.StructField("l_shipdate", T.TimestampNTZType()),
    ]
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def events_as_inventory(events: DataFrame) -> DataFrame:
    """``events`` rows as stock events; works on batch and streaming input."""
    return events.select(
        F.concat(F.lit("P"), F.col("user_id")).alias("product_id"),
        F.get_json_object("props", "$.k").try_cast("int").alias("quantity"),
        F.col("value").alias("price"),
        render(F.col("ts"), ISO_Z).alias("event_timestamp"),
        F.concat(F.lit("S"), F.col("user_id") % 5).alias("store_location"),
        F.col("event_type").alias("category"),
        F.col("ts"),
    )


def lines_as_inventory(
    lines: DataFrame, part: DataFrame, supplier: DataFrame, nation: DataFrame
) -> DataFrame:
    """Order lines as stock events: the supplier's nation is the store.

    The dimension joins carry no hint: Spark broadcasts them while their file
    sizes stay under its own threshold and shuffles otherwise.
    """
    return (
        lines.join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.concat(F.lit("P"), F.col("p_partkey")).alias("product_id"),
            F.col("l_quantity").cast("int").alias("quantity"),
            F.col("p_retailprice").alias("price"),
            render(F.col("l_shipdate"), ISO_Z).alias("event_timestamp"),
            F.col("n_name").alias("store_location"),
            F.col("p_type").alias("category"),
            F.col("l_shipdate").alias("ts"),
            F.col("l_linestatus").alias("line_status"),
        )
    )


def inventory_events(spark: SparkSession, folder: str) -> DataFrame:
    return events_as_inventory(table(spark, folder, "events"))


def inventory_lines(spark: SparkSession, folder: str) -> DataFrame:
    return lines_as_inventory(
        *[table(spark, folder, name) for name in ("lineitem", "part", "supplier", "nation")]
    )


def stand_in_forecasts(hourly: DataFrame, model_name: str = "baseline") -> DataFrame:
    """Forecast-shaped rows from hourly metrics, for checks that need no model."""
    return hourly.select(
        F.lit(model_name).alias("model_name"),
        "store_location",
        "category",
        render(F.col("window_start")).alias("forecast_timestamp"),
        F.col("total_quantity").cast("double").alias("predicted_quantity"),
        F.lit(None).cast("bigint").alias("actual_quantity"),
        render(F.col("window_start")).alias("event_timestamp"),
    )


def day_ahead_forecasts(hourly: DataFrame, model_name: str = "day-ahead") -> DataFrame:
    """Per store, category and hour: today's quantity as tomorrow's forecast."""
    return (
        hourly.groupBy("store_location", "category", "window_start")
        .agg(F.sum("total_quantity").cast("double").alias("predicted_quantity"))
        .select(
            F.lit(model_name).alias("model_name"),
            "store_location",
            "category",
            render(F.col("window_start") + F.expr("interval 1 day")).alias("forecast_timestamp"),
            "predicted_quantity",
            F.lit(None).cast("bigint").alias("actual_quantity"),
            render(F.col("window_start")).alias("event_timestamp"),
        )
    )


def damaged_messages(events: DataFrame) -> DataFrame:
    """JSON messages of ``events``; low quantities carry a missing or foreign time."""
    foreign = F.date_format("ts", "yyyy/MM/dd HH:mm")
    time = F.when(F.col("quantity") < 5, F.lit(None)).when(F.col("quantity") < 10, foreign)
    return as_messages(
        events.withColumn("event_timestamp", time.otherwise(F.col("event_timestamp")))
    )


def observed_quantities(hourly: DataFrame) -> DataFrame:
    """Hourly quantities in the shape actuals are attached from."""
    return hourly.select(
        "store_location",
        "category",
        render(F.col("window_start")).alias("forecast_timestamp"),
        F.col("total_quantity").alias("actual_quantity"),
    )


def as_numerical(anomalies: DataFrame) -> DataFrame:
    """Z-score anomalies in the wording of the numerical table."""
    return anomalies.withColumns(
        {
            "anomaly_type": F.lit(ML_ANOMALY),
            "method": F.lit("Isolation Forest"),
            "description": quantities_text(
                F.col("predicted_quantity"), F.col("actual_quantity").cast("string")
            ),
        }
    )
