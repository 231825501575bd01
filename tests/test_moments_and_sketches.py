"""Figures and sketches that merge: any split gives what all rows give."""

import random

import pytest
from pyspark.sql import functions as F

from stockflow.operators import moments as M
from stockflow.operators import sketches as K
from stockflow.operators.zscore import with_zscore, zscore_anomalies
from stockflow.schemas import FORECASTS
from tests.conftest import rows


def forecasts(spark, n, base=0.0, seed=1):
    rng = random.Random(seed)
    data = []
    for i in range(n):
        value = rng.choice([base + rng.gauss(0, 1), base, None, float("nan")]) if i % 5 == 0 else base + rng.gauss(0, 1)
        data.append(("m", rng.choice(["a", "b", None]), rng.choice("xyz"), f"t{i}", value, None, "e"))
    data += [("m", "solo", "x", "t", base, None, "e"), ("m", "flat", "x", "t1", base, None, "e")]
    data.append(("m", "flat", "x", "t2", base, None, "e"))
    return spark.createDataFrame(data, FORECASTS)


def scores(frame):
    return {(r["store_location"], r["category"], r["forecast_timestamp"]): (r["z_score"], r["group_size"]) for r in frame.collect()}


@pytest.mark.parametrize("parts", [1, 3, 7])
@pytest.mark.parametrize("base", [0.0, 1e9])
def test_merged_figures_score_as_all_rows(spark, parts, base):
    df = forecasts(spark, 150, base).withColumn("part", F.pmod(F.hash("forecast_timestamp"), F.lit(parts)))
    figures = M.moments(df.filter("part = 0"))
    for part in range(1, parts):
        figures = M.merged(figures, M.moments(df.filter(F.col("part") == part)))
    found, expected = scores(M.with_stored_zscore(df, figures)), scores(with_zscore(df))
    assert found.keys() == expected.keys()
    for key, (z, size) in expected.items():
        assert found[key][1] == size
        assert found[key][0] == (pytest.approx(z, rel=1e-6, abs=1e-6) if z is not None else None)


def test_new_rows_are_judged_with_all_before(spark, tmp_path):
    df = forecasts(spark, 120, 50.0)
    path, early, late = str(tmp_path / "figures"), df.filter("forecast_timestamp < 't5'"), df.filter("forecast_timestamp >= 't5'")
    first = M.judge_new(spark, early, path)
    assert rows(first.drop("score")) == rows(zscore_anomalies(early).drop("score"))
    second = M.judge_new(spark, late, path)
    expected = zscore_anomalies(df).filter("event_timestamp >= 't5'")
    assert rows(second.select("store_location", "category", "event_timestamp", "description")) == rows(
        expected.select("store_location", "category", "event_timestamp", "description")
    )
    assert rows(M.judge_new(spark, df.limit(0), path)) == []


@pytest.mark.parametrize("runs", [1, 9])
def test_sketches_of_runs_merge(spark, runs):
    rng = random.Random(runs)
    n = 20_000
    data = [("m", i % runs, f"t{rng.randrange(3000)}", float(rng.randrange(10**6)), None) for i in range(n)]
    df = spark.createDataFrame(
        data, "model_name string, run int, forecast_timestamp string, predicted_quantity double, actual_quantity bigint"
    )
    each = K.run_sketches(df, ["model_name", "run"])
    found = {r["measure"]: r for r in K.read_sketches(K.merged_sketches(each, ["model_name"])).collect()}
    values = sorted(d[3] for d in data)
    row = found["predicted_quantity"]
    assert (row["count"], row["min"], row["max"]) == (n, values[0], values[-1])
    for share in (25, 50, 75):
        below = sum(v <= row[f"p{share}"] for v in values) / n
        assert below == pytest.approx(share / 100, abs=K.RANK_ERROR)
    assert row["unique_timestamps"] == pytest.approx(len({d[2] for d in data}), rel=K.TIMES_ERROR)
    assert found["actual_quantity"]["count"] == 0 and found["actual_quantity"]["p50"] is None


def test_no_rows(spark):
    nothing = spark.createDataFrame([], FORECASTS)
    assert M.merged(M.moments(nothing), M.moments(nothing)).count() == 0
    assert K.read_sketches(K.run_sketches(nothing, ["model_name"])).count() == 0
