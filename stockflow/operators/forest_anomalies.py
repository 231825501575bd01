"""Isolation-forest anomalies of stock records and of forecasts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.fixed_values import (
    GROUP_CONTAMINATION,
    ML_ANOMALY,
    RECORD_CONTAMINATION,
    RECORD_METHOD,
)
from stockflow.functions.numbers import to_number
from stockflow.functions.text import quantities_text
from stockflow.operators.isolation import isolation_points
from stockflow.operators.joins import join_lookup
from stockflow.operators.metrics import require_columns
from stockflow.schemas import ANOMALIES, FORECAST_KEY, RECORD_ANOMALIES

GROUP = ["model_name", "store_location", "category"]


def record_anomalies(
    events: DataFrame, contamination: float = RECORD_CONTAMINATION, **forest: object
) -> DataFrame:
    """Stock records whose quantity and price stand out among all records."""
    features = ["quantity", "price"]
    points = isolation_points(events, features, contamination, **forest)
    hits = points.filter("is_anomaly").select(
        F.col("quantity").alias("__quantity"), F.col("price").alias("__price")
    )
    keyed = events.withColumns({f"__{f}": to_number(F.col(f)) for f in features})
    return (
        join_lookup(keyed, hits, ["__quantity", "__price"], "left_semi")
        .withColumns({"is_anomaly": F.lit(True), "anomaly_method": F.lit(RECORD_METHOD)})
        .select(*RECORD_ANOMALIES.names)
    )


def grouped_anomalies(
    forecasts: DataFrame, contamination: float = GROUP_CONTAMINATION, **forest: object
) -> DataFrame:
    """Forecast rows that stand out within model, store and category.

    A group without any actual quantity is judged by its predictions alone.
    """
    require_columns(forecasts, [*FORECAST_KEY, "predicted_quantity"])
    if "actual_quantity" not in forecasts.columns:
        forecasts = forecasts.withColumn("actual_quantity", F.lit(None).cast("bigint"))
    keyed = forecasts.dropna(subset=GROUP).withColumns(
        {
            "__predicted": to_number(F.col("predicted_quantity")),
            "__actual": to_number(F.col("actual_quantity")),
        }
    )
    features = ["__predicted", "__actual"]
    points = isolation_points(keyed, features, contamination, by=GROUP, **forest)
    hits = points.filter("is_anomaly").select(*GROUP, *features, "score")
    known = keyed.groupBy(*GROUP).agg(
        (F.count("actual_quantity") > 0).alias("__has_actual")
    )
    flagged = join_lookup(join_lookup(keyed, hits, GROUP + features), known, GROUP)
    actual = F.when(F.col("__has_actual"), F.col("__actual").cast("bigint"))
    description = quantities_text(F.col("__predicted"), actual.cast("string"))
    return flagged.select(
        "model_name",
        "store_location",
        "category",
        F.col("forecast_timestamp").alias("event_timestamp"),
        F.lit(ML_ANOMALY).alias("anomaly_type"),
        F.lit("Isolation Forest").alias("method"),
        F.col("predicted_quantity"),
        actual.alias("actual_quantity"),
        "score",
        description.alias("description"),
    ).select(*ANOMALIES.names)
