"""End-to-end jobs over stored tables, from events to drilled-down notifications."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockflow.fixed_values import ALL, MODEL_ARIMA, MODEL_BOOSTED, MODEL_FOREST, MODEL_TREND
from stockflow.functions.timestamps import parse_lenient, render
from stockflow.operators import notify as N
from stockflow.operators.forest_anomalies import grouped_anomalies, record_anomalies
from stockflow.operators.metrics import stock_metrics
from stockflow.operators.post_process import post_process
from stockflow.operators.zscore import zscore_anomalies
from stockflow.plans.arima import arima_forecast
from stockflow.plans.forecasts import (
    baseline_forecast,
    boosted_forecast,
    trend_seasonal_forecast,
)
from stockflow.schemas import ANOMALIES, FORECASTS, INVENTORY, METRICS, NOTIFICATIONS
from stockflow.session import materialize
from stockflow.sources.readers import read_events, read_table
from stockflow.sources.updates import fill_stored_actuals
from stockflow.sources.writers import replace, replace_model

MODELS = {
    MODEL_ARIMA: arima_forecast,
    MODEL_BOOSTED: boosted_forecast,
    MODEL_FOREST: baseline_forecast,
    MODEL_TREND: trend_seasonal_forecast,
}


@dataclass(frozen=True)
class Store:
    """Where the tables of one stock store live."""

    root: str

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"


def process_metrics(spark: SparkSession, store: Store, events: DataFrame | None = None) -> None:
    """Replace the metrics table by the metrics of ``events``, or of the stored
    events if none are given or they are empty. Without any events the table
    stays and the job fails."""
    stored = read_table(spark, store.path("inventory"), INVENTORY)
    replace(stock_metrics(read_events(events, stored)), store.path("metrics"))


def stored_metrics(spark: SparkSession, store: Store) -> DataFrame:
    """The metrics table, which must have rows."""
    metrics = read_table(spark, store.path("metrics"), METRICS)
    if metrics.isEmpty():
        raise ValueError("the metrics table is empty")
    return metrics


def post_process_metrics(spark: SparkSession, store: Store) -> None:
    """Fill moving average and turnover rate of the stored metrics."""
    replace(post_process(stored_metrics(spark, store)), store.path("metrics"))


def run_model(spark: SparkSession, store: Store, model_name: str) -> None:
    """Fit one model on the stored metrics and replace its stored forecasts."""
    model = MODELS[model_name]
    metrics = stored_metrics(spark, store)
    timed = metrics.withColumn("event_timestamp", parse_lenient(F.col("event_timestamp")))
    forecast = model(timed)
    times = ("forecast_timestamp", "event_timestamp")
    forecast = forecast.withColumns({c: render(F.col(c)) for c in times})
    replace_model(forecast, store.path("forecasts"), model_name)


def fill_actuals(spark: SparkSession, store: Store) -> None:
    """Fill missing actual quantities from the stored metrics, per store, category
    and time. ``All`` is matched with the sum over all stores or categories. Only
    files of the forecast table with something to fill are rewritten."""
    metrics = read_table(spark, store.path("metrics"), METRICS)
    keys = ["store_location", "category", "forecast_timestamp"]
    seen = metrics.select(
        *[
            F.explode(F.array_distinct(F.array(F.col(c), F.lit(ALL)))).alias(c)
            if c == "category"
            else F.col(c)
            for c in ("store_location", "category")
        ],
        F.col("event_timestamp").alias("forecast_timestamp"),
        F.col("total_quantity").alias("actual_quantity"),
    )
    overall = seen.withColumn("store_location", F.lit(ALL))
    fill_stored_actuals(spark, store.path("forecasts"), seen.unionByName(overall), keys)


def detect_anomalies(spark: SparkSession, store: Store) -> None:
    """Replace all three anomaly tables."""
    forecasts = read_table(spark, store.path("forecasts"), FORECASTS)
    replace(zscore_anomalies(forecasts), store.path("anomalies"))
    replace(grouped_anomalies(forecasts), store.path("numerical_anomalies"))
    events = read_table(spark, store.path("inventory"), INVENTORY)
    replace(record_anomalies(events), store.path("record_anomalies"))


def _anomaly_tables(spark: SparkSession, store: Store) -> tuple[DataFrame, DataFrame]:
    return tuple(
        read_table(spark, store.path(name), ANOMALIES)
        for name in ("anomalies", "numerical_anomalies")
    )


def notify(spark: SparkSession, store: Store) -> None:
    """Replace the notifications by those of the stored anomalies."""
    replace(N.all_notifications(*_anomaly_tables(spark, store)), store.path("notifications"))


def add_details(spark: SparkSession, store: Store) -> bool:
    """Assign rolled-up anomalies to concrete stores and categories and renew the
    notifications; returns whether anything was rolled up."""
    changed = False
    for name, table in zip(
        ("anomalies", "numerical_anomalies"), _anomaly_tables(spark, store), strict=True
    ):
        detailed = materialize(N.drill_down(table), "detailed")
        if not detailed.filter("was_replaced").isEmpty():
            replace(detailed.drop("was_replaced"), store.path(name))
            changed = True
    if changed:
        notify(spark, store)
    return changed


def notification_details(spark: SparkSession, store: Store) -> DataFrame:
    """Stored notifications with their anomaly, categories filled where missing."""
    told = read_table(spark, store.path("notifications"), NOTIFICATIONS)
    tagged = N.tagged_anomalies(*_anomaly_tables(spark, store))
    return N.detail_lookup(N.backfill_category(told), tagged)
