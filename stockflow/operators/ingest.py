"""Idempotent ingestion of stock events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockflow.functions.text import batch_number
from stockflow.operators.joins import BROADCAST_BYTES, join_lookup, measured_bytes, row_bytes
from stockflow.schemas import EVENT_KEY, INVENTORY
from stockflow.session import materialize


def new_rows(
    incoming: DataFrame,
    existing: DataFrame,
    keys: list[str] = EVENT_KEY,
    *,
    dedupe_within: bool = False,
    prune_on: str = "event_timestamp",
    **lookup: object,
) -> DataFrame:
    """Incoming rows whose key is not stored yet; null key parts match nulls.

    The stored side, which may be huge, is read only within the incoming range
    of ``prune_on`` (pushed to the scan). As long as the incoming keys fit a
    broadcast it is filtered by them and never shuffled; beyond that each side is
    dealt out by key, the stored one as its different keys. Copies inside the
    incoming batch stay unless ``dedupe_within`` is set.
    """
    stored = existing.select(*keys)
    batch = incoming.select(*keys)
    low, high, different, size = batch.agg(
        F.min(prune_on) if prune_on in keys else F.lit(None),
        F.max(prune_on) if prune_on in keys else F.lit(None),
        F.approx_count_distinct(F.xxhash64(*keys)) / F.nullif(F.count("*"), F.lit(0)),
        F.sum(row_bytes(batch)),
    ).first()
    if prune_on in keys:
        in_range = F.col(prune_on).between(F.lit(low), F.lit(high))
        stored = stored.filter(in_range | F.col(prune_on).isNull())
    limit = lookup.get("broadcast_bytes", BROADCAST_BYTES)
    if (size or 0) * (different or 0) <= limit:
        arriving = materialize(batch.distinct(), "arriving")
        stored = join_lookup(
            stored, arriving, keys, "left_semi", null_safe=True, written=True, **lookup
        )
        known = {}
    else:
        known = {"size": measured_bytes(stored)}  # with copies: at least that of the keys
    fresh = join_lookup(
        incoming, stored.distinct(), keys, "left_anti", null_safe=True, **known, **lookup
    )
    return fresh.dropDuplicates(keys) if dedupe_within else fresh


def as_messages(events: DataFrame) -> DataFrame:
    """One JSON object per event in column ``value``, the sink form of a topic."""
    present = [c for c in INVENTORY.names if c in events.columns]
    return events.select(F.to_json(F.struct(*present)).alias("value"))


def next_batch_number(products: DataFrame) -> DataFrame:
    """One row: the number after the highest batch suffix, 1 if there is none."""
    highest = F.max(batch_number(F.col("product_id")))
    return products.agg((F.coalesce(highest, F.lit(0)) + 1).alias("next_batch"))


def product_batch_id(number: Column, batch: Column) -> Column:
    """Ids such as ``P001-B1``."""
    return F.format_string("P%03d-B%d", number, batch)
