import pytest
from pyspark.sql import functions as F

from stockflow.operators import reports as R
from stockflow.plans import jobs
from stockflow.schemas import FORECASTS, INVENTORY, METRICS, RECORD_ANOMALIES
from stockflow.sources.adapters import inventory_events
from stockflow.sources.readers import read_forecasts, read_table
from stockflow.sources.writers import ingest, replace, replace_model


def test_from_events_to_detailed_notifications(spark, small, tmp_path):
    store = jobs.Store(str(tmp_path))
    events = inventory_events(spark, small).select(*INVENTORY.names)
    assert ingest(events, store.path("inventory"), store.path("topic")) == events.count()

    jobs.process_metrics(spark, store)
    jobs.post_process_metrics(spark, store)
    metrics = read_table(spark, store.path("metrics"), METRICS)
    assert metrics.count() > 900
    assert metrics.filter("moving_avg_stock_value is null").isEmpty()

    for model in jobs.MODELS:
        jobs.run_model(spark, store, model)
    jobs.run_model(spark, store, "ARIMA")
    sizes = {m: read_forecasts(spark, store.path("forecasts"), m).count() for m in jobs.MODELS}
    assert sizes == {"ARIMA": 5, "XGBoost": 7, "Isolation Forest": 7, "Prophet": 7}
    summary = R.forecast_summary(read_table(spark, store.path("forecasts"), FORECASTS), "ARIMA")
    assert summary.count() == 2

    jobs.fill_actuals(spark, store)
    known = read_table(spark, store.path("forecasts"), FORECASTS).filter("actual_quantity is not null")
    assert known.count() == 5

    jobs.detect_anomalies(spark, store)
    assert read_table(spark, store.path("record_anomalies"), RECORD_ANOMALIES).count() > 0
    jobs.notify(spark, store)
    before = jobs.notification_details(spark, store)
    told = before.count()
    assert told > 0
    assert before.filter("anomaly_type is null").isEmpty()
    assert not before.filter("category = 'All'").isEmpty()

    assert jobs.add_details(spark, store)
    after = jobs.notification_details(spark, store)
    assert after.count() == told
    assert after.filter("category = 'All' or store_location = 'All'").isEmpty()
    assert after.filter(F.col("anomaly_type").isNull()).isEmpty()
    assert not jobs.add_details(spark, store)


def test_unknown_model_is_refused(spark, tmp_path):
    with pytest.raises(KeyError):
        jobs.run_model(spark, jobs.Store(str(tmp_path)), "none")


def metrics_row(store, category, quantity):
    row = dict.fromkeys(METRICS.names) | {
        "store_location": store,
        "category": category,
        "event_timestamp": "t",
        "total_quantity": quantity,
    }
    return tuple(row[c] for c in METRICS.names)


def test_actuals_match_store_and_category(spark, tmp_path):
    store = jobs.Store(str(tmp_path))
    seen = [metrics_row(s, c, q) for s, c, q in (("A", "Toys", 5), ("A", "Food", 7), ("B", "Toys", 1))]
    replace(spark.createDataFrame(seen, METRICS), store.path("metrics"))
    wanted = {("A", "Toys"): 5, ("A", "All"): 12, ("All", "Toys"): 6, ("All", "All"): 13, ("B", "Food"): None}
    data = [("m", s, c, "t", 1.0, None, "e") for s, c in wanted]
    replace_model(spark.createDataFrame(data, FORECASTS), store.path("forecasts"))
    jobs.fill_actuals(spark, store)
    found = read_table(spark, store.path("forecasts"), FORECASTS).collect()
    assert {(r["store_location"], r["category"]): r["actual_quantity"] for r in found} == wanted


def test_a_model_without_forecasts_loses_its_old_ones(spark, tmp_path):
    path = str(tmp_path / "forecasts")
    data = [(m, "All", "All", "t", 1.0, None, "e") for m in ("one", "other")]
    rows = spark.createDataFrame(data, FORECASTS)
    replace_model(rows, path)
    replace_model(rows.limit(0), path, "one")
    assert [r["model_name"] for r in read_table(spark, path, FORECASTS).collect()] == ["other"]


def test_jobs_without_input_leave_their_table(spark, tmp_path):
    store = jobs.Store(str(tmp_path))
    replace(spark.createDataFrame([metrics_row("A", "Toys", 5)], METRICS), store.path("metrics"))
    with pytest.raises(ValueError, match="neither"):
        jobs.process_metrics(spark, store)
    assert read_table(spark, store.path("metrics"), METRICS).count() == 1
    nowhere = jobs.Store(str(tmp_path / "x"))
    for job in (jobs.post_process_metrics, lambda *a: jobs.run_model(*a, "ARIMA")):
        with pytest.raises(ValueError, match="empty"):
            job(spark, nowhere)


def test_replace_reads_the_table_it_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    replace(spark.range(5), path)
    replace(spark.read.parquet(path).selectExpr("id + 1 AS id"), path)
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == [1, 2, 3, 4, 5]
    assert [p.name for p in tmp_path.iterdir()] == ["t"]
