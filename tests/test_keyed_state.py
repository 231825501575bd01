"""First rows of keys by state, against all rows at once."""

import random

import pytest
from pyspark.sql import functions as F

from stockflow.schemas import INVENTORY
from stockflow.session import remove
from stockflow.streaming import jobs as J
from stockflow.streaming import state as S
from tests.conftest import rows

KEY = ["product_id", "event_timestamp", "store_location"]


def events(rng, n):
    return [
        (
            rng.choice([None, "P1", "P2", "P3"]),
            rng.choice([None, 1, 2]),
            rng.choice([None, float("nan"), 1.5]),
            rng.choice([None, "2025-01-01T00:00:00Z", "x"]),
            rng.choice(["a", "b", None]),
            rng.choice(["c", None]),
        )
        for _ in range(n)
    ]


def put(spark, path, number, data):
    frame = spark.createDataFrame(data, INVENTORY).coalesce(1)
    frame.write.parquet(f"{path}/in={number}")


def stream(spark, path):
    return J.read_file_stream(spark, f"{path}/*", INVENTORY, files=1)


def keys_of(frame):
    return [r[:3] for r in rows(frame.select(*KEY))]


@pytest.mark.parametrize("parts", [1, 4])
def test_same_keys_as_all_at_once(spark, tmp_path, parts):
    data = events(random.Random(parts), 160) + [("hot", 1, 1.0, "t", "s", "c")] * 200
    for number in range(parts):
        put(spark, str(tmp_path / "in"), number, data[number::parts])
    found = S.unique_events_by_state(stream(spark, str(tmp_path / "in")), str(tmp_path / "out"))
    stored = J.streamed_unique_events(stream(spark, str(tmp_path / "in")), str(tmp_path / "other"))
    assert keys_of(found) == keys_of(stored) == sorted({(d[0], d[3], d[4]) for d in data}, key=repr)
    # Every row that stays is a row that came, with its nulls and NaN.
    assert {repr(r) for r in rows(found)} <= {repr(d) for d in data}
    assert spark.conf.get(S.PROVIDER, None) != S.ROCKSDB


def test_state_survives_a_restart_and_stored_rows_are_not_read(spark, tmp_path):
    source, out, progress = (str(tmp_path / x) for x in ("in", "out", "progress"))
    data = events(random.Random(9), 60)
    put(spark, source, 0, data)
    first = S.unique_events_by_state(stream(spark, source), out, checkpoint=progress)
    known = set(keys_of(first))
    remove(spark, out)
    more = [*data, ("new", 1, 1.0, "t", "s", "c")]
    put(spark, source, 1, more)
    again = S.unique_events_by_state(stream(spark, source), out, checkpoint=progress)
    assert keys_of(again) == [("new", "t", "s")] and ("new", "t", "s") not in known


def test_no_stored_row_enters_the_plan(spark, tmp_path):
    source = str(tmp_path / "in")
    put(spark, source, 0, events(random.Random(3), 30))
    plan = S.first_events(stream(spark, source))._jdf.queryExecution().logical().toString()
    assert "TransformWithState" in plan and "Join" not in plan


def test_empty_source(spark, tmp_path):
    put(spark, str(tmp_path / "in"), 0, [])
    found = S.unique_events_by_state(stream(spark, str(tmp_path / "in")), str(tmp_path / "out"))
    assert found.filter(F.lit(True)).count() == 0


def test_keys_are_kept_without_a_call_into_python_for_each(spark, tmp_path):
    source, progress = str(tmp_path / "in"), str(tmp_path / "progress")
    data = events(random.Random(4), 80)
    put(spark, source, 0, data[:50])
    put(spark, source, 1, data[50:])
    S.unique_events_by_state(stream(spark, source), str(tmp_path / "out"), checkpoint=progress)
    operators = spark.read.format("state-metadata").load(progress).select("operatorName")
    assert {r[0] for r in operators.collect()} == {"dedupe"}
    with S.rocksdb_state(spark):
        state = spark.read.format("statestore").load(progress).select("key.*")
        assert rows(state) == sorted({(d[0], d[3], d[4]) for d in data}, key=repr)
    assert spark.conf.get(S.BOUNDED, None) != "true"


def test_one_row_of_each_arrow_batch_reaches_the_state(spark, tmp_path):
    put(spark, str(tmp_path / "in"), 0, [("hot", 1, 1.0, "t", "s", "c")] * 5000)
    seen = []
    query = (
        S.few_per_key(stream(spark, str(tmp_path / "in")), KEY)
        .writeStream.trigger(availableNow=True)
        .option("checkpointLocation", str(tmp_path / "progress"))
        .foreachBatch(lambda batch, number: seen.append(batch.count()))
        .start()
    )
    query.awaitTermination()
    assert sum(seen) == 1
