"""Post-processing of metrics rows: moving average and turnover rate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.fixed_values import TURNOVER_EPSILON
from stockflow.functions.numbers import to_number
from stockflow.operators.moving_average import moving_average


def turnover_rate(metrics: DataFrame) -> DataFrame:
    """Share of quantity in quantity plus category value."""
    quantity = to_number(F.col("total_quantity"))
    value = to_number(F.col("stock_value_by_category"))
    return metrics.withColumn("turnover_rate", quantity / (quantity + value + TURNOVER_EPSILON))


def post_process(metrics: DataFrame, **moving: object) -> DataFrame:
    """Metrics table with its moving average and turnover columns filled."""
    columns = metrics.columns
    filled = metrics.withColumns(
        {
            "total_quantity": to_number(F.col("total_quantity"), "bigint"),
            "stock_value_by_category": to_number(F.col("stock_value_by_category")),
        }
    )
    return turnover_rate(moving_average(filled, **moving)).select(*columns)
