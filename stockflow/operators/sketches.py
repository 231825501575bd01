"""Stored sketches of forecasts per model run, beside the exact figures.

Quantiles (KLL) and distinct times (HyperLogLog) of any set of runs follow from
their sketches, a few KB each, without reading a forecast again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.functions.numbers import nan_to_null

MEASURES = ["predicted_quantity", "actual_quantity"]
RANK_ERROR = 0.02  # of a quantile's rank with the default size of sketches
TIMES_ERROR = 0.05  # of the number of distinct times, relative


def run_sketches(
    forecasts: DataFrame, keys: list[str], measures: list[str] = MEASURES, time: str = "forecast_timestamp"
) -> DataFrame:
    """One row per run and measure: count, extremes, sketch of the values and of the
    times. Null and NaN count as missing."""
    values = F.array(
        *[
            F.struct(F.lit(m).alias("measure"), nan_to_null(F.col(m).cast("double")).alias("value"))
            for m in measures
        ]
    )
    rows = forecasts.select(*keys, F.col(time).alias("__time"), F.explode(values).alias("v"))
    rows = rows.select(*keys, "__time", "v.*")
    return rows.groupBy(*keys, "measure").agg(
        F.count("value").alias("count"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.kll_sketch_agg_double("value").alias("quantiles"),
        F.hll_sketch_agg("__time").alias("times"),
    )


def merged_sketches(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """The sketches of several runs as one; any order and grouping is within the error."""
    return sketches.groupBy(*keys, "measure").agg(
        F.sum("count").alias("count"),
        F.min("min").alias("min"),
        F.max("max").alias("max"),
        F.kll_merge_agg_double("quantiles").alias("quantiles"),
        F.hll_union_agg("times").alias("times"),
    )


def read_sketches(sketches: DataFrame, shares: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Estimated quantiles and distinct times; measures without values have none."""
    quantiles = [
        F.when(
            F.col("count") > 0, F.kll_sketch_get_quantile_double("quantiles", F.lit(share))
        ).alias(f"p{round(share * 100)}")
        for share in shares
    ]
    rest = [c for c in sketches.columns if c not in ("quantiles", "times")]
    return sketches.select(*rest, *quantiles, F.hll_sketch_estimate("times").alias("unique_timestamps"))
