import numpy as np
import pytest
from pyspark.sql import functions as F

from stockflow.operators import isolation as I
from stockflow.operators import notify as N
from stockflow.operators import reports as R
from stockflow.operators.forest_anomalies import grouped_anomalies, record_anomalies
from stockflow.operators.zscore import with_zscore, zscore_anomalies
from stockflow.schemas import ANOMALIES, FORECASTS, INVENTORY, NOTIFICATIONS, RECORD_ANOMALIES
from stockflow.sources.adapters import inventory_events, inventory_lines
from tests.conftest import rows


def forecasts(spark, groups):
    data = [
        ("m", store, category, f"2025-01-{i + 1:02d}", value, None, "2025-01-01")
        for (store, category), values in groups.items()
        for i, value in enumerate(values)
    ]
    return spark.createDataFrame(data, FORECASTS)


# --- z-score ----------------------------------------------------------------


def test_zscore_group_sizes_and_nulls(spark):
    df = forecasts(
        spark,
        {
            ("LA", "single"): [5.0],
            ("LA", "four"): [1.0, 1.0, 1.0, 100.0],
            ("LA", "five"): [1.0, 1.0, 1.0, 1.0, 100.0],
            ("LA", "constant"): [7.0, 7.0, 7.0],
            (None, "five"): [1.0, 1.0, 1.0, 1.0, 100.0],
            ("LA", "nan"): [1.0, 1.0, 1.0, 1.0, float("nan"), 100.0],
        },
    )
    found = zscore_anomalies(df)
    assert found.columns == ANOMALIES.names
    # Four rows reach exactly the threshold, which is not beyond it.
    assert sorted(r["category"] for r in found.collect()) == ["five", "nan"]
    row = found.filter("category = 'five'").first()
    assert row["description"] == "Predicted Quantity: 100.0, Z-Score: 1.79"
    scored = {r["category"]: r["group_size"] for r in with_zscore(df).collect()}
    assert scored == {"four": 4, "five": 5, "constant": 3, "nan": 6}


def test_zscore_threshold_is_a_parameter(spark):
    df = forecasts(spark, {("LA", "four"): [1.0, 1.0, 1.0, 100.0]})
    assert zscore_anomalies(df, threshold=1.4).count() == 1
    assert zscore_anomalies(df.withColumn("predicted_quantity", F.lit(None))).count() == 0


def test_zscore_needs_forecast_columns(spark):
    with pytest.raises(ValueError, match="predicted_quantity"):
        zscore_anomalies(spark.createDataFrame([], FORECASTS).drop("predicted_quantity"))


# --- isolation forest -------------------------------------------------------


def slow_path(values, nodes, spot, row):
    feature, cut, low, high, length = nodes
    while feature[spot] >= 0:
        spot = low[spot] if values[row, feature[spot]] <= cut[spot] else high[spot]
    return length[spot]


def test_trees_and_paths_agree_with_a_walk():
    rng = np.random.default_rng(1)
    values = rng.normal(size=(300, 3)).round(1)
    values[:, 2] = 7.0  # never worth a split
    tree = rng.integers(0, 3, size=300) + 10
    roots, *nodes = I.grow_trees(values, tree, 6, rng)
    feature, cut, low, high, length = nodes
    assert len(roots) == 3 and 2 not in feature
    for number, root in zip((10, 11, 12), roots, strict=True):
        fast = I.path_lengths(values, root, *nodes)
        assert fast == pytest.approx([slow_path(values, nodes, root, i) for i in range(300)])
        assert max(fast) <= 6 + I.average_path([300])[0]
        # Rows that grew the tree fill its leaves: the depths obey Kraft's equality.
        leaves = set()
        for i in np.flatnonzero(tree == number):
            spot, depth = root, 0
            while feature[spot] >= 0:
                spot = low[spot] if values[i, feature[spot]] <= cut[spot] else high[spot]
                depth += 1
            leaves.add((spot, depth))
        assert sum(2.0**-depth for _, depth in leaves) == pytest.approx(1.0)


def test_growth_does_not_depend_on_row_order():
    rng = np.random.default_rng(8)
    values, tree = rng.normal(size=(200, 2)), rng.integers(0, 4, size=200)
    shuffled = rng.permutation(200)
    first = I.grow_trees(values, tree, 8, np.random.default_rng(3))
    second = I.grow_trees(values[shuffled], tree[shuffled], 8, np.random.default_rng(3))
    assert all((a == b).all() for a, b in zip(first, second, strict=True))


def test_average_path():
    assert I.average_path([0, 1, 2]).tolist() == [0.0, 0.0, 1.0]
    harmonic = sum(1 / i for i in range(1, 256))
    assert I.average_path([256])[0] == pytest.approx(2 * harmonic - 2 * 255 / 256, abs=0.01)


def test_single_point_group_flags_nothing(spark):
    df = spark.createDataFrame([("g", 5.0)] * 20 + [("one", 1.0)], "g string, v double")
    points = I.isolation_points(df, ["v"], 0.3, by=["g"])
    assert rows(points.select("g", "weight", "is_anomaly")) == [("g", 20, False)]


def test_copies_weigh_and_group_chunks_agree(spark):
    rng = np.random.default_rng(5)
    data = [(g, float(v), float(w)) for g in "ab" for v, w in rng.normal(size=(300, 2)).round(2)]
    data += [("a", 0.0, 0.0)] * 300  # half of group a is one point
    df = spark.createDataFrame(data, "g string, v double, w double")
    whole = I.isolation_points(df, ["v", "w"], 0.1, by=["g"])
    split = I.isolation_points(df.repartition(9), ["v", "w"], 0.1, by=["g"], chunk_points=(20, 20))
    assert rows(whole) == rows(split)
    hot = whole.filter("g = 'a' and v = 0 and w = 0").first()
    assert hot["weight"] >= 300 and not hot["is_anomaly"]
    for g, total in (("a", 600), ("b", 300)):
        flagged = whole.filter((F.col("g") == g) & F.col("is_anomaly")).agg(F.sum("weight")).first()[0]
        assert flagged == pytest.approx(0.1 * total, abs=2)
        scores = [r["score"] for r in whole.filter(F.col("g") == g).collect()]
        assert all(-1 < s < 0 for s in scores)


def test_injected_outliers_rank_first(spark, small):
    events = inventory_events(spark, small).select(*INVENTORY.names)
    odd = events.limit(3).withColumns({"quantity": F.lit(1000), "price": F.lit(5000.0)})
    both = events.unionByName(odd.select(events.columns))
    points = I.isolation_points(both, ["quantity", "price"], 0.05)
    first = points.orderBy("score").first()
    assert (first["quantity"], first["price"], first["weight"]) == (1000.0, 5000.0, 3)


def test_record_anomalies_share(spark, small):
    lines = inventory_lines(spark, small)
    found = record_anomalies(lines)
    assert found.columns == RECORD_ANOMALIES.names
    assert found.count() == pytest.approx(0.05 * lines.count(), rel=0.1)
    assert found.filter("not is_anomaly or anomaly_method is null").isEmpty()


def test_grouped_anomalies_texts(spark):
    base = forecasts(spark, {("LA", "x"): [float(v % 7) for v in range(20)] + [500.0]})
    known = base.withColumn("store_location", F.lit("NYC")).withColumn(
        "actual_quantity", F.when(F.col("predicted_quantity") == 500.0, F.lit(3).cast("bigint"))
    )
    lonely = base.limit(1).withColumn("category", F.lit("lonely"))
    nowhere = base.withColumn("category", F.lit(None).cast("string"))
    found = grouped_anomalies(base.unionByName(known).unionByName(lonely).unionByName(nowhere))
    assert found.columns == ANOMALIES.names
    texts = {(r["store_location"], r["description"]) for r in found.collect()}
    assert ("LA", "Predicted Quantity: 500.0, Actual Quantity: N/A") in texts
    assert ("NYC", "Predicted Quantity: 500.0, Actual Quantity: 3") in texts
    assert {r["category"] for r in found.collect()} == {"x"}


# --- notifications ----------------------------------------------------------


def anomaly(spark, **changes):
    row = {
        "model_name": "ARIMA",
        "store_location": "LA",
        "category": "Toys",
        "event_timestamp": "2025-01-01 10:00:00",
        "anomaly_type": "ML Quantity Anomaly",
        "method": "Isolation Forest",
        "predicted_quantity": 69.0,
        "actual_quantity": 30,
        "score": -0.6,
        "description": "Predicted Quantity: 69.0, Actual Quantity: 30",
    } | changes
    return spark.createDataFrame([tuple(row[c] for c in ANOMALIES.names)], ANOMALIES)


def test_numerical_notification_text(spark):
    found = N.numerical_notifications(anomaly(spark))
    assert found.columns == NOTIFICATIONS.names
    row = found.first()
    assert row["notification"].split("\n") == [
        "⚠️ Anomaly Detected in Inventory!",
        "Model: ARIMA",
        "Predicted Quantity: 69.0",
        "Actual Quantity: 30.0",
        "Store Location: LA",
        "Timestamp: 2025-01-01 10:00:00",
        "Category: Toys",
        "Anomaly Type: ML Quantity Anomaly",
        "This unusual quantity may indicate an inventory issue. Investigate immediately!",
    ]
    assert (row["type"], row["product_id"]) == ("numerical", "N/A")


def test_pipeline_notification_text(spark):
    row = N.pipeline_notifications(anomaly(spark, description="odd", method="Z-Score")).first()
    assert row["notification"].split("\n") == [
        "⚠️ Anomaly Detected in Inventory!",
        "Description: odd",
        "Store Location: LA",
        "Timestamp: 2025-01-01 10:00:00",
        "Category: Toys",
        "Method: Z-Score",
        "This anomaly may indicate an inventory issue. Investigate immediately!",
    ]


def test_backfill_category(spark):
    told = N.all_notifications(anomaly(spark), anomaly(spark, category="Food"))
    old = told.drop("category").withColumn(
        "notification",
        F.when(F.col("type") == "pipeline", F.lit("no line")).otherwise(F.col("notification")),
    )
    assert rows(N.backfill_category(old).select("type", "category")) == [
        ("numerical", "Food"),
        ("pipeline", "Unknown"),
    ]
    kept = N.backfill_category(old, default=None).filter("category is null")
    assert kept.count() == 1
    assert rows(N.backfill_category(told)) == rows(told)


@pytest.mark.parametrize(
    ("store", "category", "expected"),
    [("All", "x", True), ("x", "All", True), ("Allston", "x", True), ("x", None, False)],
)
def test_rollup_marker(spark, store, category, expected):
    df = spark.createDataFrame([(store, category)], "store_location string, category string")
    assert N.has_rollup_marker(df).first()["has_all"] is expected
    assert N.has_rollup_marker(df.limit(0)).first()["has_all"] is False


def test_drill_down_replaces_equal_markers_only(spark):
    df = spark.createDataFrame(
        [("All", "All", 1), ("Allston", "Toys", 2), ("LA", "All", 3), (None, "Toys", 4)],
        "store_location string, category string, id int",
    )
    found = {r["id"]: r for r in N.drill_down(df).collect()}
    assert found[1]["store_location"].startswith("Store_") and found[1]["category"] != "All"
    assert (found[2]["store_location"], found[2]["was_replaced"]) == ("Allston", False)
    assert found[3]["store_location"] == "LA" and found[3]["was_replaced"]
    assert found[4]["store_location"] is None and not found[4]["was_replaced"]
    assert rows(N.drill_down(df.repartition(3))) == rows(N.drill_down(df))


def test_detail_lookup_takes_the_first_match_of_its_type(spark):
    first, second = anomaly(spark, model_name="A"), anomaly(spark, model_name="B")
    numerical = second.unionByName(first)
    notes = N.numerical_notifications(first).unionByName(
        N.pipeline_notifications(anomaly(spark, store_location="NYC"))
    )
    found = N.detail_lookup(notes, N.tagged_anomalies(first.limit(0), numerical))
    assert rows(found.select("type", "model_name")) == [("numerical", "A"), ("pipeline", None)]


# --- reports ----------------------------------------------------------------


def test_stock_pivot_finds_its_stores(spark):
    df = spark.createDataFrame(
        [("LA", "x", 1.0), ("LA", "x", 2.0), ("NYC", "y", 4.0), (None, "y", 9.0)],
        "store_location string, category string, total_stock_value double",
    )
    assert rows(R.stock_pivot(df).select("category", "LA", "NYC")) == [("x", 3.0, 0.0), ("y", 0.0, 4.0)]
    assert rows(R.value_by_store(df)) == [("LA", 3.0), ("NYC", 4.0)]


def test_describe_leaves_empty_columns_out(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (4.0, None)], "a double, b double")
    found = R.describe(df, ["a", "b"]).collect()
    assert len(found) == 1
    row = found[0]
    assert (row["count"], row["min"], row["p25"], row["p50"], row["p75"], row["max"]) == (
        3, 1.0, 1.5, 2.0, 3.0, 4.0,
    )


def test_forecast_summary_of_one_model(spark):
    df = forecasts(spark, {("LA", "x"): [1.0, 3.0]})
    other = df.withColumn("model_name", F.lit("o'ther")).withColumn("predicted_quantity", F.lit(9.0))
    both = df.unionByName(other)
    assert R.forecast_summary(both, "m").first()["mean"] == 2.0
    assert R.forecast_summary(both, "o'ther").first()["mean"] == 9.0


def test_byte_encoded_actuals_are_decoded(spark):
    df = spark.createDataFrame(
        [("m", bytearray((7).to_bytes(8, "little")))], "model_name string, actual_quantity binary"
    )
    assert R.of_model(df, "m").first()["actual_quantity"] == 7


def test_counts_skip_missing_keys(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert rows(R.counts_by(df, "k")) == [("a", 2)]


def test_describe_counts_nan_as_missing(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (float("nan"),)], "v double")
    row = R.describe(df, ["v"]).first()
    assert (row["count"], row["p50"], row["max"]) == (3, 2.0, 4.0)
    assert row["mean"] == pytest.approx(7 / 3)
