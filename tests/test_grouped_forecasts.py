"""Forecasts per store from sums: as each store alone, and as the global model."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from stockflow.plans import grouped_forecasts as G
from stockflow.plans.forecasts import trend_seasonal_forecast
from stockflow.schemas import FORECASTS
from tests.conftest import rows

START = dt.datetime(2025, 1, 1)
KIND = "store_location string, event_timestamp timestamp, total_quantity bigint"


def metrics(spark, **stores):
    data = [
        (store, START + dt.timedelta(hours=i), int(q))
        for store, values in stores.items()
        for i, q in enumerate(values)
    ]
    return spark.createDataFrame(data, KIND)


def waves(n, slope, height, seed=0):
    noise = np.random.default_rng(seed).normal(0, 3, n)
    return [1000 + slope * i + height * np.sin(2 * np.pi * i / 24) + noise[i] for i in range(n)]


def by_store(df):
    found = {}
    for r in df.orderBy("forecast_timestamp").collect():
        found.setdefault(r["store_location"], []).append(r["predicted_quantity"])
    return found


def test_every_store_is_fitted_alone(spark):
    stores = {"a": waves(24 * 20, 2, 200), "b": waves(24 * 5, -1, 50, 1), "c": [7], "d": [3, 9, 4], "e": [0] * 50}
    together = G.trend_seasonal_by_store(metrics(spark, **stores))
    assert together.columns == FORECASTS.names and together.count() == 7 * len(stores)
    found = by_store(together)
    for store in ("a", "c", "d"):
        alone = by_store(G.trend_seasonal_by_store(metrics(spark, **{store: stores[store]})))
        assert found[store] == pytest.approx(alone[store], rel=1e-6)
    assert found["c"] == pytest.approx([7.0] * 7) and found["e"] == pytest.approx([0.0] * 7, abs=1e-9)
    last = together.filter("store_location = 'a'").orderBy("forecast_timestamp").first()
    assert last["event_timestamp"] == START + dt.timedelta(hours=24 * 20 - 1)
    assert last["forecast_timestamp"] == last["event_timestamp"] + dt.timedelta(days=1)


def test_near_the_global_model(spark):
    df = metrics(spark, a=waves(24 * 21, 2, 200))
    one = by_store(trend_seasonal_forecast(df))["All"]
    assert by_store(G.trend_seasonal_by_store(df))["a"] == pytest.approx(one, rel=0.02)  # that one stops at a tolerance


def test_the_solution_is_the_penalised_minimum():
    rng = np.random.default_rng(5)
    seconds = np.sort(rng.uniform(0, 30 * G.DAY, 900))
    limits = {c: np.full(900, v) for c, v in zip(("first", "last", "points"), (0.0, 30 * G.DAY, 900))}
    x = G.design(seconds, limits)
    y = np.where(seconds < 9 * G.DAY, seconds, 9 * G.DAY) / G.DAY / 9 + rng.normal(0, 0.05, 900)
    both = np.concatenate([x, y[:, None]], 1)
    weights = G.solve((both.T @ both)[None])[0]
    slope = x.T @ (x @ weights - y) / 900
    hinges = slice(2, 2 + G.CHANGEPOINTS)
    free = np.r_[0:2, 2 + G.CHANGEPOINTS : G.WIDTH]
    assert np.abs(slope[free]).max() < 1e-7
    plain = np.linalg.lstsq(x, y, rcond=None)[0]
    noise = ((x @ plain - y) ** 2).mean()
    penalty = noise / (900 * G.CHANGEPOINT_PRIOR)
    used = np.abs(weights[hinges]) > 1e-9
    # Where a slope changes the gradient balances the penalty; elsewhere it is below.
    assert np.abs(slope[hinges])[used] == pytest.approx(np.full(used.sum(), penalty), rel=0.02)
    assert (np.abs(slope[hinges])[~used] <= 1.02 * penalty).all() and 0 < used.sum() < 20


def test_how_rows_are_dealt_does_not_matter(spark):
    df = metrics(spark, hot=waves(24 * 30, 1, 90), b=waves(40, 1, 5))
    one = by_store(G.trend_seasonal_by_store(df.repartition(1)))
    two = by_store(G.trend_seasonal_by_store(df.repartition(7, F.rand(1))))
    for store in one:
        assert one[store] == pytest.approx(two[store], rel=1e-9)


def test_missing_values_and_no_rows(spark):
    nothing = spark.createDataFrame(
        [("x", None, 5), (None, START, 5), ("y", START, None), ("z", START, 4), ("z", START, None)], KIND
    )
    assert by_store(G.trend_seasonal_by_store(nothing)) == {"z": pytest.approx([4.0] * 7)}
    assert rows(G.trend_seasonal_by_store(nothing.limit(0))) == []
