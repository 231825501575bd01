import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from stockflow.operators import series as S
from stockflow.plans.arima import _arma_grid, arima_forecast, arma_next, next_value
from stockflow.plans.forecasts import (
    baseline_forecast,
    boosted_forecast,
    trend_seasonal_forecast,
)
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


def hour(i):
    return START + dt.timedelta(hours=i)


def test_series_sum_and_skip_missing_stores(spark):
    df = metrics(spark, a=[1, 2]).unionByName(metrics(spark, a=[10]))
    nowhere = spark.createDataFrame([(None, START, 5)], KIND)
    both = df.unionByName(nowhere)
    assert rows(S.store_series(both)) == [("a", hour(0), 11), ("a", hour(1), 2)]
    assert rows(S.global_series(both)) == [(hour(0), 16), (hour(1), 2)]
    assert S.series_extent(both).first() == (2, hour(0), hour(1))


def test_holdout_split_of_short_series(spark):
    split = S.holdout_split(S.store_series(metrics(spark, one=[7], two=[1, 3], four=[1, 2, 3, 10])))
    found = {r["store_location"]: tuple(r)[1:] for r in split.collect()}
    assert found == {
        "one": (1, hour(0), 7, None, 7.0),
        "two": (2, hour(1), 3, hour(0), 2.0),
        "four": (4, hour(3), 10, hour(2), 2.0),
    }


def test_horizon(spark):
    days = [r["forecast_timestamp"] for r in S.horizon(metrics(spark, a=[1, 2])).collect()]
    assert days == [hour(1) + dt.timedelta(days=i) for i in range(1, 8)]
    assert S.horizon(metrics(spark, a=[1]).limit(0)).count() == 0


def test_attach_actuals_keeps_known_values(spark):
    df = spark.createDataFrame(
        [("m", "LA", "x", "t1", 1.0, None, "e"), ("m", "LA", "x", "t2", 1.0, 5, "e"),
         ("m", "LA", "x", "t3", 1.0, None, "e")],
        FORECASTS,
    )
    seen = spark.createDataFrame(
        [("LA", "t1", 4), ("LA", "t1", 6), ("LA", "t2", 9)],
        "store_location string, forecast_timestamp string, actual_quantity bigint",
    )
    found = S.attach_actuals(df, seen, ["store_location", "forecast_timestamp"])
    assert rows(found.select("forecast_timestamp", "actual_quantity")) == [
        ("t1", 10), ("t2", 5), ("t3", None),
    ]


# --- ARIMA ------------------------------------------------------------------


def arma_covariance(phi, theta, n):
    scale = 1 - phi**2
    gamma = [(1 + 2 * phi * theta + theta**2) / scale]
    gamma += [(1 + phi * theta) * (phi + theta) / scale * phi**k for k in range(n - 1)]
    return np.array([[gamma[abs(i - j)] for j in range(n)] for i in range(n)])


@pytest.mark.parametrize("with_mean", [False, True])
def test_likelihood_and_forecast_match_the_full_covariance(with_mean):
    x = np.random.default_rng(2).normal(3.0, 1.0, size=12)
    phi, theta = 0.6, -0.3
    n = len(x)
    full = arma_covariance(phi, theta, n + 1)
    inverse = np.linalg.inv(full[:n, :n])
    mean = 0.0
    if with_mean:
        mean = inverse.sum(axis=0) @ x / inverse.sum()
    centred = x - mean
    expected = n * np.log(centred @ inverse @ centred / n) + np.linalg.slogdet(full[:n, :n])[1]
    cost, forecast = _arma_grid(x, np.array([phi]), np.array([theta]), with_mean)
    assert cost[0] == pytest.approx(expected)
    assert forecast[0] == pytest.approx(mean + full[n, :n] @ inverse @ centred)


def test_fit_finds_the_best_of_a_fine_grid():
    rng = np.random.default_rng(4)
    noise = rng.normal(size=400)
    x = np.zeros(400)
    for t in range(1, 400):
        x[t] = 0.7 * x[t - 1] + noise[t] + 0.2 * noise[t - 1]
    axis = np.linspace(-0.99, 0.99, 199)
    phi, theta = (a.ravel() for a in np.meshgrid(axis, axis, indexing="ij"))
    cost, forecast = _arma_grid(x, phi, theta, False)
    assert arma_next(x, with_mean=False) == pytest.approx(forecast[np.argmin(cost)], abs=0.02)


def test_orders_by_length():
    line = np.arange(7, dtype=float)
    assert next_value(line) == pytest.approx(7.0, abs=0.2)
    assert next_value(np.full(7, 4.0)) == 4.0
    short = np.array([3.0, 3.0, 3.0])
    assert next_value(short) == 3.0
    assert np.isfinite(next_value(np.array([1.0, 5.0])))


def test_arima_forecast_per_store(spark):
    long = [100 + 5 * (i % 2) + i for i in range(40)]
    df = metrics(spark, one=[7], two=[1, 3], three=[5, 5, 9], long=long)
    found = {r["store_location"]: r for r in arima_forecast(df).collect()}
    assert arima_forecast(df).columns == FORECASTS.names
    assert found["one"]["predicted_quantity"] == 7.0 and found["one"]["event_timestamp"] is None
    assert found["two"]["predicted_quantity"] == 2.0
    assert found["three"]["predicted_quantity"] == pytest.approx(5.0)
    row = found["long"]
    assert (row["actual_quantity"], row["category"]) == (long[-1], "All")
    assert row["forecast_timestamp"] == hour(39) and row["event_timestamp"] == hour(38)
    assert row["predicted_quantity"] == pytest.approx(long[-1], abs=6)


# --- seven-day forecasts ----------------------------------------------------


def test_boosted_forecast_of_a_level_series(spark):
    df = metrics(spark, a=[50] * 24 * 5)
    found = boosted_forecast(df).orderBy("forecast_timestamp").collect()
    assert [r["predicted_quantity"] for r in found] == pytest.approx([50.0] * 7)
    assert found[0]["forecast_timestamp"] == hour(119) + dt.timedelta(days=1)
    assert {(r["store_location"], r["category"], r["actual_quantity"]) for r in found} == {
        ("All", "All", None)
    }


def test_trend_and_season_are_followed(spark):
    n = 24 * 21
    values = [1000 + 2 * i + 200 * np.sin(2 * np.pi * i / 24) for i in range(n)]
    found = trend_seasonal_forecast(metrics(spark, a=values)).orderBy("forecast_timestamp").collect()
    assert len(found) == 7
    for row in found:
        i = (row["forecast_timestamp"] - START).total_seconds() / 3600
        expected = 1000 + 2 * i + 200 * np.sin(2 * np.pi * i / 24)
        assert row["predicted_quantity"] == pytest.approx(expected, rel=0.02)


def test_baseline_ignores_outliers(spark):
    df = (
        spark.range(200)
        .withColumn("event_timestamp", F.lit(START) + F.make_dt_interval(hours=F.col("id")))
        .select(
            "event_timestamp",
            F.when(F.col("id") < 4, 100000).otherwise(50 + F.col("id") % 3).alias("total_quantity"),
            F.lit(10.0).alias("total_stock_value"),
            F.lit(0.1).alias("turnover_rate"),
        )
    )
    found = baseline_forecast(df).collect()
    assert len(found) == 7
    assert found[0]["predicted_quantity"] == pytest.approx(51, abs=1)


def test_missing_quantities_and_no_history(spark):
    values = [100 + i for i in range(60)]
    df = metrics(spark, a=values)
    holes = df.unionByName(spark.createDataFrame([("a", hour(70), None), ("a", None, 5)], KIND))
    for model in (trend_seasonal_forecast, boosted_forecast):
        assert model(holes).count() == 7
        for nothing in (df.limit(0), spark.createDataFrame([("a", None, 5), ("b", hour(1), None)], KIND)):
            found = model(nothing)
            assert found.columns == FORECASTS.names and found.count() == 0
