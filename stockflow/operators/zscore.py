"""Z-score anomalies of forecasts within store and category."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.fixed_values import PIPELINE_ANOMALY, Z_THRESHOLD
from stockflow.functions.numbers import float_text, nan_to_null, two_decimals
from stockflow.operators.joins import join_lookup
from stockflow.operators.metrics import require_columns
from stockflow.schemas import ANOMALIES, FORECAST_KEY

GROUP = ["store_location", "category"]


def with_zscore(
    forecasts: DataFrame, keys: list[str] = GROUP, value: str = "predicted_quantity"
) -> DataFrame:
    """Adds ``z_score`` and ``group_size``; groups of one row and null keys drop out.

    Group figures come from one map-side combined aggregation joined back, so
    a group may be of any size. No spread gives a null score.
    """
    keyed = forecasts.dropna(subset=keys).withColumn(value, nan_to_null(F.col(value)))
    figures = (
        keyed.groupBy(*keys)
        .agg(
            F.count("*").alias("group_size"),
            F.avg(value).alias("__mean"),
            F.stddev_samp(value).alias("__std"),
        )
        .filter(F.col("group_size") >= 2)
    )
    score = (F.col(value) - F.col("__mean")) / F.nullif(F.col("__std"), F.lit(0.0))
    return join_lookup(keyed, figures, keys).withColumn("z_score", score).drop("__mean", "__std")


def zscore_anomalies(forecasts: DataFrame, threshold: float = Z_THRESHOLD) -> DataFrame:
    """Forecast rows whose score exceeds the threshold, in the anomaly layout."""
    require_columns(forecasts, [*FORECAST_KEY, "predicted_quantity"])
    return flagged(with_zscore(forecasts), threshold)


def flagged(scored: DataFrame, threshold: float = Z_THRESHOLD) -> DataFrame:
    """Scored rows beyond the threshold, in the anomaly layout."""
    # Rounded, so that a score of exactly the threshold is never tipped over it.
    beyond = scored.filter(F.round(F.abs("z_score"), 9) > threshold)
    quantity = float_text(F.col("predicted_quantity"))
    description = F.concat(
        F.lit("Predicted Quantity: "),
        quantity,
        F.lit(", Z-Score: "),
        two_decimals(F.col("z_score")),
    )
    actual = F.col("actual_quantity") if "actual_quantity" in scored.columns else F.lit(None)
    return beyond.select(
        "model_name",
        "store_location",
        "category",
        F.col("forecast_timestamp").alias("event_timestamp"),
        F.lit(PIPELINE_ANOMALY).alias("anomaly_type"),
        F.lit("Z-Score").alias("method"),
        "predicted_quantity",
        actual.cast("bigint").alias("actual_quantity"),
        F.col("z_score").alias("score"),
        description.alias("description"),
    ).select(*ANOMALIES.names)
