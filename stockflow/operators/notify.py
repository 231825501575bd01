"""Notifications, category back-fill, drill-down, lookup and question routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockflow.fixed_values import (
    ALL,
    DRILL_CATEGORIES,
    DRILL_STORES,
    HEADLINE,
    NOT_AVAILABLE,
    NUMERICAL,
    NUMERICAL_CLOSING,
    PIPELINE,
    PIPELINE_CLOSING,
    UNKNOWN,
)
from stockflow.functions.numbers import pick
from stockflow.functions.text import (
    answer_for,
    category_in_text,
    described_quantity,
    labelled_lines,
)
from stockflow.operators.joins import first_per_key, join_lookup
from stockflow.schemas import NOTIFICATIONS

LOOKUP_KEY = ["type", "store_location", "category", "event_timestamp"]


def _notifications(anomalies: DataFrame, kind: str, message: Column) -> DataFrame:
    return anomalies.select(
        F.lit(kind).alias("type"),
        message.alias("notification"),
        "store_location",
        "event_timestamp",
        F.lit(NOT_AVAILABLE).alias("product_id"),
        "category",
    ).select(*NOTIFICATIONS.names)


def numerical_notifications(anomalies: DataFrame) -> DataFrame:
    """Messages that quote the quantities found in the anomaly description."""
    message = labelled_lines(
        F.lit(HEADLINE),
        ("Model", F.col("model_name")),
        ("Predicted Quantity", described_quantity(F.col("description"), "predicted")),
        ("Actual Quantity", described_quantity(F.col("description"), "actual")),
        ("Store Location", F.col("store_location")),
        ("Timestamp", F.col("event_timestamp")),
        ("Category", F.col("category")),
        ("Anomaly Type", F.col("anomaly_type")),
        F.lit(NUMERICAL_CLOSING),
    )
    return _notifications(anomalies, NUMERICAL, message)


def pipeline_notifications(anomalies: DataFrame) -> DataFrame:
    """Messages that quote the description and method of the anomaly."""
    message = labelled_lines(
        F.lit(HEADLINE),
        ("Description", F.col("description")),
        ("Store Location", F.col("store_location")),
        ("Timestamp", F.col("event_timestamp")),
        ("Category", F.col("category")),
        ("Method", F.col("method")),
        F.lit(PIPELINE_CLOSING),
    )
    return _notifications(anomalies, PIPELINE, message)


def all_notifications(pipeline: DataFrame, numerical: DataFrame) -> DataFrame:
    return pipeline_notifications(pipeline).unionByName(numerical_notifications(numerical))


def add_column(df: DataFrame, name: str, kind: str) -> DataFrame:
    """``df`` with an empty column ``name`` unless it is there already."""
    return df if name in df.columns else df.withColumn(name, F.lit(None).cast(kind))


def backfill_category(notifications: DataFrame, default: str | None = UNKNOWN) -> DataFrame:
    """Missing categories read from the message text, else ``default``."""
    found = F.coalesce(
        F.col("category"), category_in_text(F.col("notification")), F.lit(default).cast("string")
    )
    return add_column(notifications, "category", "string").withColumn("category", found)


def has_rollup_marker(df: DataFrame) -> DataFrame:
    """One row: does any store or category contain the marker text?"""
    hits = [F.coalesce(F.col(c).contains(ALL), F.lit(False)) for c in ("store_location", "category")]
    return df.agg(F.coalesce(F.max(hits[0] | hits[1]), F.lit(False)).alias("has_all"))


def drill_down(
    df: DataFrame,
    stores: list[str] = DRILL_STORES,
    categories: list[str] = DRILL_CATEGORIES,
    key: list[str] | None = None,
) -> DataFrame:
    """Rows marked ``All`` assigned to one concrete store / category each.

    The choice depends on the row's key only; ``was_replaced`` tells which rows
    changed.
    """
    key = key or [c for c in df.columns if c not in ("store_location", "category")]
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in key])
    store_hit = F.coalesce(F.col("store_location") == ALL, F.lit(False))
    category_hit = F.coalesce(F.col("category") == ALL, F.lit(False))
    return df.withColumns(
        {
            "was_replaced": store_hit | category_hit,
            "store_location": F.when(
                store_hit, pick(F.concat(F.lit("store|"), text), stores)
            ).otherwise(F.col("store_location")),
            "category": F.when(
                category_hit, pick(F.concat(F.lit("category|"), text), categories)
            ).otherwise(F.col("category")),
        }
    )


def detail_lookup(notifications: DataFrame, anomalies: DataFrame) -> DataFrame:
    """Each notification with the first matching anomaly of its type.

    ``anomalies`` carries the notification ``type`` it belongs to. The first
    match is the smallest by model and description; no match leaves nulls.
    """
    details = anomalies.dropna(subset=LOOKUP_KEY)
    first = first_per_key(details, LOOKUP_KEY, ["model_name", "description"])
    return join_lookup(notifications, first, LOOKUP_KEY, "left")


def tagged_anomalies(pipeline: DataFrame, numerical: DataFrame) -> DataFrame:
    """Both anomaly tables in one frame, tagged with their notification type."""
    return pipeline.withColumn("type", F.lit(PIPELINE)).unionByName(
        numerical.withColumn("type", F.lit(NUMERICAL))
    )


def route_questions(questions: DataFrame, text: str = "text") -> DataFrame:
    return questions.withColumn("answer", answer_for(F.col(text)))
