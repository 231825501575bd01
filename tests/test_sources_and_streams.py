from pathlib import Path

import pytest
from pyspark.sql import functions as F

from stockflow.fixed_values import MODEL_ARIMA
from stockflow.operators.metrics import hourly_metrics, parse_events
from stockflow.schemas import EVENT_KEY, FORECASTS, INVENTORY, LABELLED_INVENTORY
from stockflow.session import materialize, shared_folder
from stockflow.sources import adapters as A
from stockflow.sources import readers, writers
from stockflow.streaming import jobs as J
from tests.conftest import rows

TWO = [
    ("P001", 10, 99.5, "2025-04-02T08:20:00Z", "Oslo", "Garden"),
    ("P002", 20, 12.25, "2025-04-02T08:45:00Z", "Bonn", "Toys"),
]


@pytest.fixture
def two(spark):
    return spark.createDataFrame(TWO, INVENTORY)


def forecast(spark, model, *values):
    data = [(model, "All", "All", f"t{i}", v, None, "e") for i, v in enumerate(values)]
    return spark.createDataFrame(data, FORECASTS)


def test_missing_table_is_empty(spark, tmp_path):
    nothing = readers.read_table(spark, str(tmp_path / "none"), INVENTORY)
    assert nothing.schema == INVENTORY and nothing.isEmpty()
    assert readers.read_catalog_table(spark, "no_such_table", INVENTORY).isEmpty()


def test_create_if_absent_keeps_rows(spark, two, tmp_path):
    path = str(tmp_path / "t")
    assert writers.create_if_absent(spark, path, INVENTORY).isEmpty()
    writers.append(two, path, INVENTORY)
    assert rows(writers.create_if_absent(spark, path, INVENTORY)) == TWO


def test_ingest_twice_and_publish_only_new_rows(spark, two, tmp_path):
    table, topic = str(tmp_path / "table"), str(tmp_path / "topic")
    assert writers.ingest(two, table, topic) == 2
    assert writers.ingest(two, table, topic) == 0
    third = spark.createDataFrame(
        [("P003", 1, 1.0, "2025-05-28T16:00:00Z", "LA", "Toys")], INVENTORY
    )
    assert writers.ingest(two.unionByName(third), table, topic) == 1
    stored = rows(readers.read_table(spark, table, INVENTORY))
    assert len(stored) == 3 and stored[0][0] == "P001" and stored[1][4] == "Bonn"
    published = readers.read_messages(spark, topic).drop("ts")
    assert rows(published) == stored


def test_replace_reads_its_own_table(spark, two, tmp_path):
    path = str(tmp_path / "t")
    writers.append(two, path, INVENTORY)
    current = readers.read_table(spark, path, INVENTORY)
    writers.replace(current.withColumn("quantity", F.col("quantity") + 1), path)
    found = readers.read_table(spark, path, INVENTORY).select("quantity")
    assert rows(found) == [(11,), (21,)]


def test_replace_model_keeps_the_others(spark, tmp_path):
    path = str(tmp_path / "f")
    writers.replace_model(forecast(spark, MODEL_ARIMA, 1.0, 2.0), path)
    writers.replace_model(forecast(spark, "other", 5.0), path)
    writers.replace_model(forecast(spark, MODEL_ARIMA, 9.0), path)
    assert rows(readers.read_forecasts(spark, path, MODEL_ARIMA).select("predicted_quantity")) == [(9.0,)]
    one = readers.read_forecasts(spark, path, "other")
    assert rows(one.select("predicted_quantity")) == [(5.0,)]
    assert "PartitionFilters: [isnotnull(model_name" in one._jdf.queryExecution().toString()


def test_csv_export_is_brought_to_the_layout(spark, tmp_path):
    path = str(tmp_path / "c")
    exported = spark.createDataFrame(
        [("2025-05-28 15:00:00", "P001-B1", 3, 9.5, "S01", "Toys")],
        "event_timestamp string, product_id string, quantity int, price double, "
        "store_id string, category string",
    )
    writers.append_csv(exported, path)
    writers.append_csv(exported, path)
    found = readers.read_csv(spark, path)
    assert rows(found) == [("P001-B1", 3, 9.5, "2025-05-28T15:00:00Z", "S01", "Toys")] * 2
    assert parse_events(found).filter("ts is null").isEmpty()


def test_csv_columns_are_found_by_name(spark, tmp_path):
    path = tmp_path / "any.csv"
    path.write_text(
        "product_id,store_id,extra,price,event_timestamp,quantity,category\n"
        "P1,S1,x,9.5,2025-01-01 10:00:00,3,Toys\nP2,S2,y,oops,2025-01-01 11:00:00,many,Toys\n"
    )
    assert rows(readers.read_csv(spark, str(path))) == [
        ("P1", 3, 9.5, "2025-01-01T10:00:00Z", "S1", "Toys"),
        ("P2", None, None, "2025-01-01T11:00:00Z", "S2", "Toys"),
    ]
    (tmp_path / "less.csv").write_text("product_id,price\nP1,1.0\n")
    with pytest.raises(ValueError):
        readers.read_csv(spark, str(tmp_path / "less.csv"))
    other = tmp_path / "two"
    other.mkdir()
    for name, header in ("a", "product_id,store_id"), ("b", "store_id,product_id"):
        rest = "price,event_timestamp,quantity,category"
        (other / f"{name}.csv").write_text(f"{header},{rest}\nP1,S1,9.5,2025-01-01 10:00:00,3,Toys\n")
    with pytest.raises(Exception, match="(?i)header"):
        readers.read_csv(spark, str(other)).collect()


def test_the_old_table_comes_back_if_the_new_one_cannot_take_its_place(spark, two, tmp_path):
    path = str(tmp_path / "t")
    writers.append(two, path, INVENTORY)
    with pytest.raises(OSError):
        writers.swap(spark, str(tmp_path / "not there"), path)
    assert rows(readers.read_table(spark, path, INVENTORY)) == rows(two)


def test_labelled_events_round_trip(spark, two, tmp_path):
    labelled = two.withColumn("is_anomaly", F.lit(True))
    writers.append(labelled, str(tmp_path / "l"), LABELLED_INVENTORY)
    found = readers.read_table(spark, str(tmp_path / "l"), LABELLED_INVENTORY)
    assert found.filter("is_anomaly").count() == 2


def test_change_type(spark):
    df = spark.createDataFrame([("12",), ("x",), (None,)], "v string")
    assert rows(writers.change_type(df, "v", "bigint")) == [(12,), (None,), (None,)]


def test_events_fall_back_to_the_second_source(spark, two):
    empty = two.limit(0)
    assert readers.read_events(two, empty).count() == 2
    assert readers.read_events(empty, two).count() == 2
    assert readers.read_events(None, two).count() == 2
    with pytest.raises(ValueError, match="neither"):
        readers.read_events(empty, empty)


def test_jdbc_split_needs_bounds(spark):
    with pytest.raises(ValueError, match="bounds"):
        readers.read_jdbc(spark, "jdbc:x:y", "t", split_column="id")


def test_shared_folder_follows_the_setting(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    folder = shared_folder(spark)
    assert folder == (configured or folder)
    kept = materialize(spark.range(5))
    assert folder.split(":")[-1].rstrip("/") in kept.inputFiles()[0]


# --- streams ----------------------------------------------------------------


def messages(spark, two, path, **changes):
    writers.publish(two.withColumns({k: F.lit(v) for k, v in changes.items()}), path)


def test_message_stream_becomes_hourly_metrics(spark, two, tmp_path):
    topic, out, progress = (str(tmp_path / name) for name in ("topic", "out", "progress"))
    messages(spark, two, topic)
    first = J.streamed_hourly_metrics(J.read_message_stream(spark, topic, 1), out, checkpoint=progress)
    batch = hourly_metrics(readers.read_messages(spark, topic))
    assert rows(first) == rows(batch)
    # More events of the same hour arrive: only the newest version counts.
    messages(spark, two, topic, quantity=1)
    again = J.streamed_hourly_metrics(J.read_message_stream(spark, topic, 1), out, checkpoint=progress)
    batch = hourly_metrics(readers.read_messages(spark, topic))
    assert rows(again) == rows(batch)
    assert again.agg(F.sum("total_quantity")).first()[0] == 32


@pytest.mark.parametrize("salts", [0, 32])
def test_stream_drops_copies_across_batches(spark, two, tmp_path, salts):
    topic, out, progress = (str(tmp_path / name) for name in ("topic", "out", "progress"))
    messages(spark, two, topic)
    messages(spark, two, topic, price=1.0)
    events = J.read_message_stream(spark, topic, 1)
    unique = J.without_duplicates(events, delay="1 day", salts=salts)
    J.drain(unique, J.batch_folders(out), progress)
    found = spark.read.parquet(out).select("product_id")
    assert rows(found) == [("P001",), ("P002",)]


def test_stream_ingest_is_idempotent(spark, two, tmp_path):
    topic, table, sent = (str(tmp_path / name) for name in ("topic", "table", "sent"))
    messages(spark, two, topic)
    messages(spark, two, topic)
    write = J.ingesting(table, sent, dedupe_within=True)
    J.drain(J.read_message_stream(spark, topic, 1), write, str(tmp_path / "progress"))
    assert not list(Path(shared_folder(spark).removeprefix("file:")).glob("stockflow/*/fresh-*"))
    assert spark.read.parquet(table).count() == 2
    write(two, 0)  # a retry of the first batch leaves the same rows
    assert spark.read.parquet(table).count() == 2
    published = spark.read.option("recursiveFileLookup", True).text(sent)
    assert published.count() == 2


def test_one_drain_is_one_replacement(spark, two, tmp_path):
    topic, out = str(tmp_path / "topic"), str(tmp_path / "out")
    for price in (1.0, 2.0, 3.0):
        messages(spark, two, topic, price=price)
    J.drain_replacing(J.read_message_stream(spark, topic, 1), out)
    assert spark.read.parquet(out).count() == 6
    J.drain_replacing(J.read_message_stream(spark, topic, 1), out)  # nothing new
    assert spark.read.parquet(out).count() == 6
    messages(spark, two, topic, price=9.0)
    J.drain_replacing(J.read_message_stream(spark, topic, 1), out)
    assert rows(spark.read.parquet(out).select("price")) == [(9.0,), (9.0,)]


def shuffled_files(spark, small, tmp_path, files):
    """Events whose times are scattered over many files."""
    events = A.inventory_events(spark, small)
    path = str(tmp_path / "events")
    events.repartition(files, F.md5(F.col("event_timestamp"))).write.parquet(path)
    return events, J.read_file_stream(spark, path, events.schema, files=1)


def test_hourly_metrics_of_late_events(spark, small, tmp_path):
    events, stream = shuffled_files(spark, small, tmp_path, 5)
    out = str(tmp_path / "out")
    found = J.streamed_hourly_metrics(stream, out)
    expected = hourly_metrics(events)
    places = [F.round(c, 6).alias(c) if c in ("avg_price", "total_stock_value") else c for c in expected.columns]
    assert rows(found.select(*places)) == rows(expected.select(*places))
    again = J.streamed_hourly_metrics(stream, out)  # resumes: nothing counts twice
    assert rows(again.select(*places)) == rows(expected.select(*places))


def test_unique_events_of_late_events_and_reruns(spark, small, tmp_path):
    events, stream = shuffled_files(spark, small, tmp_path, 4)
    out = str(tmp_path / "out")
    for _ in range(2):
        found = J.streamed_unique_events(stream, out)
        assert found.columns == events.columns
        assert rows(found.select(*EVENT_KEY)) == rows(events.select(*EVENT_KEY).distinct())
