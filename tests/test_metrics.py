import datetime as dt

import pytest
from pyspark.sql import functions as F

from stockflow.operators import metrics as M
from stockflow.operators.moving_average import moving_average, with_row_numbers
from stockflow.operators.post_process import post_process, turnover_rate
from stockflow.schemas import INVENTORY, METRICS
from tests.conftest import rows


def events(spark, *data):
    return M.parse_events(spark.createDataFrame(list(data), INVENTORY))


def test_parse_events_conforms_columns(spark):
    raw = spark.createDataFrame(
        [("LA", "5", "2.5", "P1", "Toys", None, "extra")],
        "store_location string, quantity string, price string, product_id string, "
        "category string, event_timestamp string, more string",
    )
    parsed = M.parse_events(raw)
    assert parsed.columns == [*INVENTORY.names, "ts"]
    assert rows(parsed) == [("P1", 5, 2.5, "", "LA", "Toys", None)]


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="price"):
        M.parse_events(spark.createDataFrame([("a",)], "product_id string"))


def test_broken_json_gives_nulls(spark):
    raw = spark.createDataFrame([("{broken",), ('{"product_id":"P1","quantity":3}',)], "value string")
    assert sorted(r["product_id"] or "" for r in M.decode_messages(raw).collect()) == ["", "P1"]


def test_hour_boundary_null_time_and_null_value(spark):
    df = events(
        spark,
        ("P1", 10, 2.0, "2025-01-01T10:59:59Z", "LA", "Toys"),
        ("P1", 5, 4.0, "2025-01-01T11:00:00Z", "LA", "Toys"),
        ("P1", None, 6.0, "2025-01-01T11:30:00Z", "LA", "Toys"),
        ("P1", 7, 1.0, "", "LA", "Toys"),
        ("P1", 7, 1.0, "01/01/2025", "LA", "Toys"),
    )
    found = {
        r["window_start"]: (r["total_quantity"], r["avg_price"], r["total_stock_value"])
        for r in M.hourly_metrics(df).collect()
    }
    assert found == {
        dt.datetime(2025, 1, 1, 10): (10, 2.0, 20.0),
        dt.datetime(2025, 1, 1, 11): (5, 5.0, 20.0),
    }


def test_hourly_metrics_without_products(spark):
    df = events(
        spark,
        ("P1", 1, 2.0, "2025-01-01T10:00:00Z", "LA", "Toys"),
        ("P2", 2, 4.0, "2025-01-01T10:30:00Z", "LA", "Toys"),
    )
    row = M.hourly_metrics(df, ["store_location", "category"]).first()
    assert (row["total_quantity"], row["avg_price"], row["total_stock_value"]) == (3, 3.0, 10.0)


def test_stock_metrics_drops_null_categories_and_zeroes_null_sums(spark):
    df = events(
        spark,
        ("P1", None, 2.0, "2025-01-01T10:00:00Z", "LA", "Toys"),
        ("P2", 3, 2.0, "2025-01-01T10:00:00Z", "LA", "Toys"),
        ("P3", 3, 2.0, "2025-01-01T10:00:00Z", "LA", None),
    )
    table = M.stock_metrics(df)
    assert table.columns == METRICS.names
    found = {r["product_id"]: r for r in table.collect()}
    assert set(found) == {"P1", "P2"}
    assert found["P1"]["total_quantity"] == 0 and found["P1"]["total_stock_value"] == 0.0
    assert found["P2"]["stock_value_by_category"] == 6.0
    assert found["P2"]["event_timestamp"] == "2025-01-01 10:00:00"
    assert found["P2"]["turnover_rate"] is None


def test_fallback_when_no_time_parses(spark):
    df = events(
        spark,
        ("P1", 1, 2.0, "later", "LA", "Toys"),
        ("P1", 2, 4.0, "early", "LA", "Toys"),
        ("P2", 2, 4.0, "", "LA", "Food"),
    )
    found = {r["product_id"]: r for r in M.stock_metrics(df).collect()}
    assert found["P1"]["event_timestamp"] == "early"
    assert (found["P1"]["total_quantity"], found["P1"]["avg_price"]) == (3, 3.0)
    assert found["P1"]["stock_value_by_category"] == 10.0


def test_flat_metrics_by_event_keeps_null_key_groups(spark):
    df = events(
        spark,
        ("P1", 1, 2.0, "a", "LA", "Toys"),
        ("P1", 2, 2.0, "b", "LA", "Toys"),
        ("P2", 2, 2.0, "c", None, "Toys"),
    )
    found = M.flat_metrics_by_event(df).select("product_id", "total_quantity", "event_timestamp")
    assert rows(found) == [("P1", 3, "a"), ("P1", 3, "b"), ("P2", 2, None)]


def test_category_totals_agree(spark, small):
    from stockflow.sources.adapters import inventory_events

    source = inventory_events(spark, small)
    total = F.round("stock_value_by_category", 2)
    via_hours = M.category_stock(M.hourly_metrics(source)).select("category", total)
    direct = M.category_stock_of_events(source).select("category", total)
    assert rows(via_hours) == rows(direct)


def series(spark, n, same_time=False):
    data = [
        (f"2025-01-01 {0 if same_time else i // 60:02d}:{i % 60:02d}:00", "LA", "Toys", f"P{i:04d}", float(i * i % 97))
        for i in range(n)
    ]
    return spark.createDataFrame(
        data,
        "event_timestamp string, store_location string, category string, product_id string, "
        "total_stock_value double",
    )


def trailing_means(values, width=5):
    return [sum(values[max(0, i - width + 1) : i + 1]) / len(values[max(0, i - width + 1) : i + 1]) for i in range(len(values))]


@pytest.mark.parametrize("n", [0, 1, 3, 5, 6, 11, 60, 500])
@pytest.mark.parametrize("bucket_rows", [5, 7, 1000])
def test_moving_average_equals_plain_trailing_mean(spark, n, bucket_rows):
    result = moving_average(series(spark, n), bucket_rows=bucket_rows).orderBy("event_timestamp")
    found = [r["moving_avg_stock_value"] for r in result.collect()]
    assert found == pytest.approx(trailing_means([float(i * i % 97) for i in range(n)]))


def test_moving_average_splits_one_hot_timestamp(spark):
    df = series(spark, 300).withColumn("event_timestamp", F.lit("2025-01-01 00:00:00"))
    numbered = with_row_numbers(df, df.columns).orderBy("product_id")
    assert [r["__row"] for r in numbered.collect()] == list(range(300))
    result = moving_average(df, bucket_rows=50).orderBy("product_id")
    found = [r["moving_avg_stock_value"] for r in result.collect()]
    assert found == pytest.approx(trailing_means([float(i * i % 97) for i in range(300)]))


def test_moving_average_has_no_single_partition_exchange(spark):
    plan = moving_average(series(spark, 50))._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_moving_average_per_group(spark):
    df = series(spark, 20).withColumn("store_location", F.col("product_id").substr(5, 1))
    found = moving_average(df, partition_by=["store_location"])
    groups = {}
    for r in found.orderBy("event_timestamp").collect():
        groups.setdefault(r["store_location"], []).append(r)
    for members in groups.values():
        expected = trailing_means([r["total_stock_value"] for r in members])
        assert [r["moving_avg_stock_value"] for r in members] == pytest.approx(expected)


def test_turnover_of_zeros_is_zero(spark):
    df = spark.createDataFrame(
        [(0, 0.0), (5, 15.0)], "total_quantity bigint, stock_value_by_category double"
    )
    assert [r["turnover_rate"] for r in turnover_rate(df).collect()] == pytest.approx([0.0, 0.25])


def test_post_process_fills_the_empty_columns(spark, small):
    from stockflow.sources.adapters import inventory_events

    table = post_process(M.stock_metrics(inventory_events(spark, small)))
    assert table.columns == METRICS.names
    empty = table.filter("moving_avg_stock_value is null or turnover_rate is null")
    assert empty.isEmpty()
