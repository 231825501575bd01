"""Quantity series, hold-out split and forecast horizon."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockflow.fixed_values import ALL, HORIZON_DAYS
from stockflow.functions.timestamps import plus_days
from stockflow.operators.joins import join_lookup


def store_series(metrics: DataFrame, time: str = "event_timestamp") -> DataFrame:
    """Total quantity per store and time; rows without a store drop out."""
    return (
        metrics.filter(F.col("store_location").isNotNull() & F.col(time).isNotNull())
        .groupBy("store_location", F.col(time).alias("event_timestamp"))
        .agg(F.sum("total_quantity").alias("quantity"))
    )


def global_series(metrics: DataFrame, time: str = "event_timestamp") -> DataFrame:
    """Total quantity per time over all stores."""
    return (
        metrics.filter(F.col(time).isNotNull())
        .groupBy(F.col(time).alias("event_timestamp"))
        .agg(F.sum("total_quantity").alias("quantity"))
    )


def series_extent(metrics: DataFrame, time: str = "event_timestamp") -> DataFrame:
    """One row: distinct times, first and last time."""
    return metrics.agg(
        F.count_distinct(F.col(time)).alias("unique_timestamps"),
        F.min(time).alias("first_timestamp"),
        F.max(time).alias("last_timestamp"),
    )


def holdout_split(series: DataFrame) -> DataFrame:
    """Per store: size, last point (held out), the time before it and the mean
    of the points before it (of all points if there are fewer than three).

    Built from aggregates and one lookup join, so a long series is never
    gathered in one task. ``previous_timestamp`` is null for a single point.
    """
    last = series.groupBy("store_location").agg(
        F.count("*").alias("n_points"),
        F.max(F.struct("event_timestamp", "quantity")).alias("last"),
        F.avg("quantity").alias("mean_all"),
    )
    marked = join_lookup(series, last, ["store_location"])
    earlier = F.col("event_timestamp") < F.col("last.event_timestamp")
    return (
        marked.groupBy("store_location")
        .agg(
            F.first("n_points").alias("n_points"),
            F.first("last").alias("last"),
            F.first("mean_all").alias("mean_all"),
            F.max(F.when(earlier, F.col("event_timestamp"))).alias("previous_timestamp"),
            F.avg(F.when(earlier, F.col("quantity"))).alias("mean_train"),
        )
        .select(
            "store_location",
            "n_points",
            F.col("last.event_timestamp").alias("last_timestamp"),
            F.col("last.quantity").alias("actual_quantity"),
            "previous_timestamp",
            F.when(F.col("n_points") < 3, F.col("mean_all"))
            .otherwise(F.col("mean_train"))
            .alias("fallback_quantity"),
        )
    )


def horizon(
    metrics: DataFrame, days: int = HORIZON_DAYS, time: str = "event_timestamp"
) -> DataFrame:
    """The ``days`` daily times after the last observed one."""
    return (
        metrics.agg(F.max(time).alias("last_timestamp"))
        .filter(F.col("last_timestamp").isNotNull())
        .select(
            "last_timestamp",
            F.explode(F.sequence(F.lit(1), F.lit(days))).alias("step"),
        )
        .withColumn("forecast_timestamp", plus_days(F.col("last_timestamp"), F.col("step")))
    )


def forecast_rows(
    df: DataFrame,
    model_name: str,
    *,
    forecast_time: Column,
    predicted: Column,
    event_time: Column,
    actual: Column | None = None,
    store: Column | None = None,
) -> DataFrame:
    """Rows in the stored forecast layout; store and category default to ``All``."""
    return df.select(
        F.lit(model_name).alias("model_name"),
        (F.lit(ALL) if store is None else store).alias("store_location"),
        F.lit(ALL).alias("category"),
        forecast_time.alias("forecast_timestamp"),
        predicted.cast("double").alias("predicted_quantity"),
        (F.lit(None) if actual is None else actual).cast("bigint").alias("actual_quantity"),
        event_time.alias("event_timestamp"),
    )


def attach_actuals(forecasts: DataFrame, observed: DataFrame, keys: list[str]) -> DataFrame:
    """Fill missing ``actual_quantity`` from ``observed(keys, actual_quantity)``.

    Several observations of a key count as their sum; values already there stay.
    """
    totals = observed.groupBy(*keys).agg(F.sum("actual_quantity").alias("__observed"))
    filled = F.coalesce(F.col("actual_quantity").try_cast("bigint"), F.col("__observed"))
    return (
        join_lookup(forecasts, totals, keys, "left")
        .withColumn("actual_quantity", filled.try_cast("bigint"))
        .select(*forecasts.columns)
    )
