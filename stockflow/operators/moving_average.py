"""Trailing moving average over one global order, without a one-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockflow.fixed_values import MOVING_ROWS
from stockflow.functions.numbers import to_number
from stockflow.operators.joins import join_lookup
from stockflow.schemas import METRIC_KEY
from stockflow.session import materialize

# A row's place: the writing partition in the upper bits, its rank below.
_PART_BITS = 33


def moving_average(
    df: DataFrame,
    value: str = "total_stock_value",
    output: str = "moving_avg_stock_value",
    *,
    order: list[str] = METRIC_KEY,
    rows: int = MOVING_ROWS,
    partition_by: list[str] | None = None,
    bucket_rows: int = 50_000,
) -> DataFrame:
    """Mean of ``value`` over the current and the ``rows - 1`` preceding rows.

    With ``partition_by`` each group has its own order. Without it the order is
    global; rows then get consecutive numbers, are dealt to buckets of
    ``bucket_rows`` and each bucket also receives the last rows of the one
    before, so every frame is complete inside its bucket.
    """
    order = [c for c in order if c in df.columns]
    ties = [c for c in df.columns if c not in order and c != output]
    df = df.withColumn(value, to_number(F.col(value))).drop(output)
    if partition_by:
        frame = Window.partitionBy(*partition_by).orderBy(*order, *ties)
        return df.withColumn(output, F.avg(value).over(frame.rowsBetween(1 - rows, 0)))
    if bucket_rows < rows:
        raise ValueError("bucket_rows must hold at least one full frame")

    numbered = with_row_numbers(df, order + ties)
    bucket = F.floor(F.col("__row") / bucket_rows)
    is_tail = F.col("__row") % bucket_rows >= bucket_rows - (rows - 1)
    copies = F.when(is_tail, F.array(bucket, bucket + 1)).otherwise(F.array(bucket))
    frame = Window.partitionBy("__bucket").orderBy("__row").rowsBetween(1 - rows, 0)
    return (
        numbered.withColumn("__bucket", F.explode(copies))
        .withColumn(output, F.avg(value).over(frame))
        .filter(F.col("__bucket") == bucket)
        .drop("__bucket", "__row")
    )


def with_row_numbers(df: DataFrame, order: list[str]) -> DataFrame:
    """``df`` plus ``__row``: its zero-based rank in the order of ``order``.

    One range shuffle on the full order (so equal timestamps still split) and
    one write: the written places are what later jobs agree on. The lookup
    side has one row per written partition.
    """
    ranged = df.repartitionByRange(*[F.col(c).asc_nulls_first() for c in order])
    ranged = ranged.sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in order])
    placed = materialize(
        ranged.withColumn("__place", F.monotonically_increasing_id()), "ordered"
    ).select(
        "*",
        F.shiftright("__place", _PART_BITS).alias("__part"),
        F.col("__place").bitwiseAND(F.lit((1 << _PART_BITS) - 1)).alias("__rank"),
    )
    sizes = placed.groupBy("__part").agg(F.count("*").alias("__size"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "__part", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__start")
    )
    return (
        join_lookup(placed, starts, ["__part"])
        .withColumn("__row", F.col("__start") + F.col("__rank"))
        .drop("__part", "__rank", "__start", "__place")
    )
