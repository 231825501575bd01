"""Hourly stock metrics and their per-category totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.functions.numbers import to_number
from stockflow.functions.text import clean_text
from stockflow.functions.timestamps import parse_iso, render
from stockflow.operators.joins import join_lookup
from stockflow.schemas import INVENTORY, METRICS
from stockflow.session import materialize

PRODUCT_KEY = ["product_id", "store_location", "category"]
FIGURES = ["total_quantity", "avg_price", "total_stock_value"]


def require_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` unchanged, or an error that names what is missing (schema only)."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def parse_events(raw: DataFrame) -> DataFrame:
    """Conform raw events to the fixed schema and add the event time ``ts``."""
    require_columns(raw, INVENTORY.names)
    return (
        raw.withColumn("event_timestamp", clean_text(F.col("event_timestamp")))
        .select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in INVENTORY.fields])
        .withColumn("ts", parse_iso(F.col("event_timestamp")))
    )


def decode_messages(messages: DataFrame, column: str = "value") -> DataFrame:
    """JSON payloads to parsed events; a payload that is no JSON gives nulls."""
    payload = F.from_json(F.col(column).cast("string"), INVENTORY)
    return parse_events(messages.select(payload.alias("event")).select("event.*"))


def with_stock_value(events: DataFrame) -> DataFrame:
    return events.withColumn("stock_value", F.col("quantity") * F.col("price"))


def _figures() -> list:
    return [
        F.sum("quantity").alias("total_quantity"),
        F.avg("price").alias("avg_price"),
        F.sum("stock_value").alias("total_stock_value"),
    ]


def hourly_metrics(events: DataFrame, keys: list[str] = PRODUCT_KEY) -> DataFrame:
    """Quantity, unweighted mean price and stock value per product, store,
    category and hour. Batch or streaming; events without ``ts`` drop out.
    Leave the product out of ``keys`` for one row per store and category.

    Partial aggregation runs before the one shuffle, so a hot key reaches its
    reducer as one row per map task.
    """
    return (
        with_stock_value(events)
        .groupBy(*keys, F.window("ts", "1 hour").alias("window"))
        .agg(*_figures())
        .select(
            *keys,
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            *FIGURES,
        )
    )


def flat_metrics(events: DataFrame) -> DataFrame:
    """The same figures without a time window, for events whose time cannot be
    parsed; ``event_timestamp`` is the earliest text of the group."""
    return (
        with_stock_value(events)
        .groupBy(*PRODUCT_KEY)
        .agg(*_figures(), F.min("event_timestamp").alias("event_timestamp"))
    )


def flat_metrics_by_event(events: DataFrame) -> DataFrame:
    """Flat figures repeated for every event of their group, with its own time text.

    Groups whose key has a null never match themselves and keep one row with a
    null time.
    """
    flat = flat_metrics(events).drop("event_timestamp")
    keyed = events.select(*PRODUCT_KEY, "event_timestamp")
    matched = join_lookup(keyed, flat, PRODUCT_KEY)
    has_null = F.greatest(*[F.col(c).isNull() for c in PRODUCT_KEY])
    unmatched = flat.filter(has_null).withColumn("event_timestamp", F.lit(None).cast("string"))
    return matched.unionByName(unmatched)


def category_stock(metrics: DataFrame) -> DataFrame:
    """Stock value per category, summed over metrics rows."""
    return metrics.groupBy("category").agg(
        F.sum("total_stock_value").alias("stock_value_by_category")
    )


def category_stock_of_events(events: DataFrame) -> DataFrame:
    """The same totals straight from events: a narrow scan, map-side combined,
    instead of a second pass over the hourly aggregation."""
    return (
        with_stock_value(events.filter(F.col("ts").isNotNull()))
        .groupBy("category")
        .agg(F.sum("stock_value").alias("stock_value_by_category"))
    )


def with_category_value(metrics: DataFrame, totals: DataFrame) -> DataFrame:
    """Metrics rows with their category total; null categories drop out."""
    return join_lookup(metrics, totals, ["category"])


def as_metrics_table(metrics: DataFrame) -> DataFrame:
    """Metrics rows in the stored layout: numbers coerced, times as text, and
    empty columns where post-processing will write."""
    if "window_start" in metrics.columns:
        time = render(F.col("window_start"))
    else:
        time = F.col("event_timestamp")
    filled = {
        "event_timestamp": time,
        "total_quantity": to_number(F.col("total_quantity"), "bigint"),
        "avg_price": to_number(F.col("avg_price")),
        "total_stock_value": to_number(F.col("total_stock_value")),
        "stock_value_by_category": to_number(F.col("stock_value_by_category")),
        "moving_avg_stock_value": F.lit(None).cast("double"),
        "turnover_rate": F.lit(None).cast("double"),
    }
    return metrics.select(
        *[filled.get(name, F.col(name)).alias(name) for name in METRICS.names]
    )


def stock_metrics(events: DataFrame) -> DataFrame:
    """Parsed events to metrics rows: hourly, or flat if no event has a time."""
    # Written once: the category totals come from the same hourly rows.
    hourly = materialize(hourly_metrics(events), "hourly")
    if hourly.isEmpty():
        hourly = materialize(flat_metrics(events), "flat")
    return as_metrics_table(with_category_value(hourly, category_stock(hourly)))
