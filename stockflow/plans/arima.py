"""One-step hold-out ARIMA forecast per store."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.fixed_values import MODEL_ARIMA
from stockflow.operators.joins import join_lookup
from stockflow.operators.series import forecast_rows, holdout_split, store_series
from stockflow.session import spread


def arima_forecast(metrics: DataFrame, time: str = "event_timestamp") -> DataFrame:
    """Forecast of each store's last point from the points before it.

    Stores with fewer than three points, and fits that fail, get the mean. A
    task sees one store's hourly totals, whose number is bounded by the
    calendar and not by the amount of events.
    """
    series = store_series(metrics, time)
    split = holdout_split(series)

    def fit(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        train = pdf.sort_values("event_timestamp")["quantity"].to_numpy(dtype=float)[:-1]
        fitted = next_value(train) if len(train) >= 2 else np.nan
        return pd.DataFrame({"store_location": [key[0]], "fitted": [fitted]})

    fits = spread(series, "store_location").groupBy("store_location").applyInPandas(
        fit, "store_location string, fitted double"
    )
    joined = join_lookup(split, fits, ["store_location"], "left")
    fitted = F.when(~F.isnan("fitted"), F.col("fitted"))
    return forecast_rows(
        joined,
        MODEL_ARIMA,
        forecast_time=F.col("last_timestamp"),
        predicted=F.coalesce(fitted, F.col("fallback_quantity")),
        actual=F.col("actual_quantity"),
        event_time=F.col("previous_timestamp"),
        store=F.col("store_location"),
    )


def next_value(train: np.ndarray) -> float:
    """Next value under ARIMA(1,1,1), or ARMA(1,1) with mean for five or fewer points."""
    if len(train) > 5:
        return float(train[-1]) + arma_next(np.diff(train), with_mean=False)
    return arma_next(train, with_mean=True)


def arma_next(x: np.ndarray, with_mean: bool) -> float:
    """One-step ARMA(1,1) forecast at the exact Gaussian maximum likelihood.

    The likelihood of a whole grid of coefficients is filtered at once, and the
    grid then narrows around its best cell.
    """
    if np.ptp(x) == 0:
        return float(x[0])
    centre, reach, edge = np.zeros(2), 0.98, 0.9999
    steps = np.linspace(-1.0, 1.0, 33)
    best = (np.inf, np.nan)
    for _ in range(8):
        axes = [np.clip(c + reach * steps, -edge, edge) for c in centre]
        phi, theta = (axis.ravel() for axis in np.meshgrid(*axes, indexing="ij"))
        cost, forecast = _arma_grid(x, phi, theta, with_mean)
        cost[~np.isfinite(cost)] = np.inf
        spot = int(np.argmin(cost))
        if cost[spot] < best[0]:
            best = (cost[spot], forecast[spot])
            centre = np.array([phi[spot], theta[spot]])
        reach /= 5.0
    return float(best[1])


def _arma_grid(x: np.ndarray, phi: np.ndarray, theta: np.ndarray, with_mean: bool) -> tuple:
    """Concentrated likelihood cost and next-value forecast per coefficient pair,
    by the innovations recursion (Brockwell and Davis)."""
    ratio = (1 + 2 * phi * theta + theta**2) / (1 - phi**2)
    expected, unit_expected = np.zeros_like(phi), np.zeros_like(phi)
    squares, cross, units, logs = (np.zeros_like(phi) for _ in range(4))
    for value in x:
        error = value - expected
        squares += error**2 / ratio
        logs += np.log(ratio)
        gain = theta / ratio
        expected = phi * value + gain * error
        if with_mean:
            unit_error = 1.0 - unit_expected
            cross += error * unit_error / ratio
            units += unit_error**2 / ratio
            unit_expected = phi + gain * unit_error
        ratio = 1 + theta**2 - theta * gain
    if with_mean:
        mean = cross / units
        squares = squares - cross * mean
        expected = expected + mean * (1.0 - unit_expected)
    with np.errstate(divide="ignore", invalid="ignore"):
        return len(x) * np.log(squares / len(x)) + logs, expected
