"""Grouped reports over metrics, forecasts and anomalies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.functions.numbers import decode_little_endian, nan_to_null
from stockflow.functions.timestamps import parse_lenient
from stockflow.operators.metrics import require_columns
from stockflow.operators.quantiles import exact_percentiles
from stockflow.session import materialize


def value_by_store(metrics: DataFrame) -> DataFrame:
    return (
        metrics.filter(F.col("store_location").isNotNull())
        .groupBy("store_location")
        .agg(F.sum("total_stock_value").alias("total_stock_value"))
    )


def turnover_over_time(metrics: DataFrame) -> DataFrame:
    """Turnover points by time, unknown times last."""
    return _by_time(metrics, "event_timestamp", "turnover_rate")


def _by_time(df: DataFrame, time: str, value: str) -> DataFrame:
    """Two columns in the order of the first, written once before they are sorted:
    a range sort reads its input twice."""
    # A hash of the whole row breaks ties, so that the rows of one hot
    # timestamp still split over several ranges.
    rows = df.select(time, value, F.xxhash64(*df.columns).alias("__tie"))
    rows = materialize(rows, "points")
    return rows.orderBy(F.asc_nulls_last(time), value, "__tie").select(time, value)


def stock_pivot(metrics: DataFrame, stores: list[str] | None = None) -> DataFrame:
    """Category by store matrix of stock value, 0 where nothing is stored.

    The sums are written once, so that looking up the store columns, whose number
    Spark bounds by ``spark.sql.pivotMaxValues``, does not evaluate the source.
    """
    kept = metrics.filter(F.col("store_location").isNotNull() & F.col("category").isNotNull())
    sums = kept.groupBy("category", "store_location").agg(F.sum("total_stock_value").alias("value"))
    grouped = materialize(sums, "pivot").groupBy("category").pivot("store_location", stores)
    return grouped.agg(F.first("value", ignorenulls=True)).na.fill(0.0)


def quantity_price_points(metrics: DataFrame) -> DataFrame:
    return metrics.select(
        "total_quantity",
        "avg_price",
        "category",
        "total_stock_value",
        "store_location",
        "event_timestamp",
    )


def counts_by(anomalies: DataFrame, key: str) -> DataFrame:
    """Anomaly rows per value of ``key``; missing keys are not counted."""
    return anomalies.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("count"))


def preview(events: DataFrame, order: list[str], rows: int = 10) -> DataFrame:
    """The first rows by an explicit order (a per-task top-k, no full sort)."""
    return events.orderBy(*order).limit(rows)


def predicted_over_time(forecasts: DataFrame) -> DataFrame:
    return _by_time(forecasts, "forecast_timestamp", "predicted_quantity")


def predicted_vs_actual(forecasts: DataFrame) -> DataFrame:
    """Forecasts whose actual quantity is known."""
    return forecasts.filter(F.col("actual_quantity").isNotNull()).select(
        "actual_quantity",
        "predicted_quantity",
        "category",
        "store_location",
        "forecast_timestamp",
    )


def of_model(forecasts: DataFrame, model_name: str) -> DataFrame:
    """One model's rows (a pushed filter; a pruned folder if partitioned), with
    byte-encoded actual quantities decoded."""
    rows = forecasts.filter(F.col("model_name") == F.lit(model_name))
    if dict(rows.dtypes).get("actual_quantity") == "binary":
        rows = rows.withColumn("actual_quantity", decode_little_endian(F.col("actual_quantity")))
    return rows


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles per column.

    Null and NaN count as missing; columns without any value are left out.
    """
    df = df.select(*[nan_to_null(F.col(c).cast("double")).alias(c) for c in columns])
    shares = [0.25, 0.5, 0.75]
    measures = []
    for name in columns:
        quartiles = exact_percentiles(df, name, shares)
        measures.append(
            F.struct(
                F.lit(name).alias("measure"),
                F.count(name).alias("count"),
                F.avg(name).alias("mean"),
                F.stddev_samp(name).alias("std"),
                F.min(name).cast("double").alias("min"),
                *[F.lit(quartiles[s]).cast("double").alias(f"p{int(s * 100)}") for s in shares],
                F.max(name).cast("double").alias("max"),
            )
        )
    return df.agg(F.array(*measures).alias("all")).select(F.inline("all")).filter("count > 0")


def forecast_summary(forecasts: DataFrame, model_name: str) -> DataFrame:
    """Summary figures of one model's predicted and actual quantities."""
    rows = require_columns(
        of_model(forecasts, model_name), ["forecast_timestamp", "predicted_quantity"]
    )
    if dict(rows.dtypes)["forecast_timestamp"] == "string":
        rows = rows.withColumn("forecast_timestamp", parse_lenient(F.col("forecast_timestamp")))
    measures = ["predicted_quantity", "actual_quantity"]
    return describe(rows, [m for m in measures if m in rows.columns])
