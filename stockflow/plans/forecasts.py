"""Seven-day forecasts: boosted trees, outlier-filtered baseline, trend and season."""

from __future__ import annotations

import math

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockflow.fixed_values import (
    BASELINE_CONTAMINATION,
    MODEL_BOOSTED,
    MODEL_FOREST,
    MODEL_TREND,
    SEED,
)
from stockflow.functions.timestamps import date_parts
from stockflow.operators.isolation import isolation_points
from stockflow.operators.series import forecast_rows, global_series, horizon
from stockflow.session import materialize


def boosted_forecast(metrics: DataFrame, time: str = "event_timestamp") -> DataFrame:
    """Gradient-boosted trees on day, month and year of the metrics rows.

    Rows of one calendar day share their features, so the squared loss is the
    same on one row per day with its mean and weight: training data is bounded
    by the calendar, and the rows are read once.
    """
    parts = date_parts(F.col(time))
    names = ["day", "month", "year"]
    daily = (
        metrics.filter(F.col(time).isNotNull() & F.col("total_quantity").isNotNull())
        .groupBy(*parts)
        .agg(F.avg("total_quantity").alias("label"), F.count("*").cast("double").alias("weight"))
    )
    assemble = VectorAssembler(inputCols=names, outputCol="features")
    daily = materialize(daily, "daily")
    if daily.isEmpty():
        return no_forecast(metrics, MODEL_BOOSTED, time)
    model = GBTRegressor(
        maxIter=100, maxDepth=6, stepSize=0.3, maxBins=128, seed=SEED, weightCol="weight"
    ).fit(assemble.transform(daily))
    days = horizon(metrics, time=time)
    future = assemble.transform(days.select("*", *date_parts(F.col("forecast_timestamp"))))
    return forecast_rows(
        model.transform(future),
        MODEL_BOOSTED,
        forecast_time=F.col("forecast_timestamp"),
        predicted=F.col("prediction"),
        event_time=F.col("last_timestamp"),
    )


def no_forecast(metrics: DataFrame, model_name: str, time: str) -> DataFrame:
    """What a model returns where there is no history: no rows."""
    return forecast_rows(
        horizon(metrics, time=time).filter(F.lit(False)),
        model_name,
        forecast_time=F.col("forecast_timestamp"),
        predicted=F.lit(None),
        event_time=F.col("last_timestamp"),
    )


def baseline_forecast(
    metrics: DataFrame,
    contamination: float = BASELINE_CONTAMINATION,
    time: str = "event_timestamp",
    **forest: object,
) -> DataFrame:
    """Mean quantity of the rows an isolation forest finds normal, for every day."""
    features = ["total_quantity", "total_stock_value", "turnover_rate"]
    points = isolation_points(metrics, features, contamination, **forest)
    normal = points.filter(~F.col("is_anomaly")).agg(
        (F.sum(F.col("total_quantity") * F.col("weight")) / F.sum("weight")).alias("predicted")
    )
    # One row each side: the mean, and the seven days.
    predicted = F.lit(normal.first()["predicted"]).cast("double")
    return forecast_rows(
        horizon(metrics, time=time),
        MODEL_FOREST,
        forecast_time=F.col("forecast_timestamp"),
        predicted=predicted,
        event_time=F.col("last_timestamp"),
    )


# Additive model after Taylor and Letham (2018): changepoints over the first
# part of the history, and Fourier terms for the seasons the history covers.
CHANGEPOINTS = 25
CHANGEPOINT_RANGE = 0.8
CHANGEPOINT_PRIOR = 0.05
DAY = 86400.0
SEASONS = [  # period in days, Fourier order, history needed, coarsest spacing allowed
    (365.25, 10, 730.0, math.inf),
    (7.0, 3, 14.0, 7.0),
    (1.0, 4, 2.0, 1.0),
]


def trend_seasonal_forecast(metrics: DataFrame, time: str = "event_timestamp") -> DataFrame:
    """Piecewise-linear trend plus seasons fitted to the global quantity series.

    Times without any quantity do not count; without others there are no rows.
    """
    known = global_series(metrics, time).filter(F.col("quantity").isNotNull())
    series = known.withColumn("seconds", _seconds(F.col("event_timestamp")))
    series = materialize(series, "series")
    if series.isEmpty():
        return no_forecast(metrics, MODEL_TREND, time)
    first, last, n, scale, spacing = _history(series)
    seasons = [
        (period, order)
        for period, order, needed, coarsest in SEASONS
        if last - first >= needed * DAY and spacing < coarsest * DAY
    ]
    hinges, free = _design(F.col("seconds"), first, max(last - first, 1.0), seasons)
    days = horizon(metrics, time=time).withColumn("seconds", _seconds(F.col("forecast_timestamp")))

    def features(df: DataFrame) -> DataFrame:
        named = [c.alias(f"x{i}") for i, c in enumerate(hinges + free)]
        assemble = VectorAssembler(
            inputCols=[f"x{i}" for i in range(len(named))], outputCol="features"
        )
        return assemble.transform(df.select("*", *named))

    history = features(series.withColumn("label", F.col("quantity") / scale))
    # Noise level from a nearly unpenalised fit; it sets how much a slope
    # change must gain. Both fits are one pass of normal equations.
    plain = LinearRegression(solver="normal", regParam=1e-6, standardization=False).fit(history)
    noise = plain.summary.meanSquaredError
    penalty = max(noise / (n * CHANGEPOINT_PRIOR), 1e-9)
    model = LinearRegression(
        solver="normal", regParam=penalty, elasticNetParam=1.0, standardization=False, maxIter=500
    ).fit(history)
    return forecast_rows(
        model.transform(features(days)),
        MODEL_TREND,
        forecast_time=F.col("forecast_timestamp"),
        predicted=F.col("prediction") * scale,
        event_time=F.col("last_timestamp"),
    )


def _seconds(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp")) / 1e6


def _history(series: DataFrame) -> tuple[float, float, int, float, float]:
    """First and last second, points, largest value and mean spacing."""
    row = series.agg(
        F.min("seconds").alias("first"),
        F.max("seconds").alias("last"),
        F.count("*").alias("n"),
        F.max(F.abs("quantity")).cast("double").alias("scale"),
    ).first()
    spacing = (row["last"] - row["first"]) / max(row["n"] - 1, 1)
    return row["first"], row["last"], row["n"], row["scale"] or 1.0, spacing


def _design(
    seconds: Column, first: float, span: float, seasons: list[tuple[float, int]]
) -> tuple[list[Column], list[Column]]:
    """Slope-change columns, and the columns the penalty should not touch.

    The latter are scaled up, which makes their coefficients, and so their
    share of the penalty, negligible.
    """
    t = (seconds - first) / span
    spots = [CHANGEPOINT_RANGE * i / CHANGEPOINTS for i in range(1, CHANGEPOINTS + 1)]
    hinges = [F.greatest(t - F.lit(spot), F.lit(0.0)) for spot in spots]
    angles = [
        seconds / DAY * (2.0 * math.pi * k / period)
        for period, order in seasons
        for k in range(1, order + 1)
    ]
    free = [t] + [wave(angle) for angle in angles for wave in (F.sin, F.cos)]
    return hinges, [column * 1000.0 for column in free]
