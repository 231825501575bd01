"""Copy-on-write updates: same rows as rewriting the table, untouched files stay."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from stockflow.operators.sampling import apply_overrides
from stockflow.operators.series import attach_actuals
from stockflow.schemas import FORECASTS, INVENTORY
from stockflow.sources import readers, writers
from stockflow.sources import updates as U
from stockflow.sources.key_index import stored_files
from tests.conftest import rows

FORECAST_KEYS = ["store_location", "category", "forecast_timestamp"]


def table_of(spark, path, n=8, size=20):
    for day in range(n):
        data = [(f"P{day}-{i}", i, 1.0, "2025-01-01T08:00:00Z", "Oslo", "c") for i in range(size)]
        writers.append(spark.createDataFrame(data, INVENTORY).coalesce(1), path, INVENTORY)


def overrides(spark, *ids):
    kind = "product_id string, event_timestamp string, store_location string, quantity int"
    data = [(i, "2025-01-01T08:00:00Z", "Oslo", 1000 + n) for n, i in enumerate(ids)]
    return spark.createDataFrame(data, kind)


def names(spark, path, schema=INVENTORY):
    return set(stored_files(spark, path, schema))


def test_only_touched_files_change(spark, tmp_path):
    path = str(tmp_path / "a table")
    table_of(spark, path)
    before, files = rows(readers.read_table(spark, path, INVENTORY)), names(spark, path)
    changes = overrides(spark, "P3-1", "P3-4", "P6-0", "P6-0", "none")
    base = spark.createDataFrame(before, INVENTORY)
    hit = U.override_stored(spark, path, changes)
    assert len(hit) == 2 and set(hit) <= files
    assert files - names(spark, path) == set(hit)
    assert rows(readers.read_table(spark, path, INVENTORY)) == rows(apply_overrides(base, changes))
    assert not [p for p in Path(path).iterdir() if p.name.startswith("_update")]


def test_nothing_touched_and_no_table(spark, tmp_path):
    path = str(tmp_path / "t")
    assert U.override_stored(spark, path, overrides(spark, "P0-0")) == []
    table_of(spark, path, 2)
    files = names(spark, path)
    assert U.override_stored(spark, path, overrides(spark, "other")) == []
    null = overrides(spark, "P0-0").withColumn("store_location", F.lit(None).cast("string"))
    assert U.override_stored(spark, path, null) == [] and names(spark, path) == files


@pytest.mark.parametrize("broken", ["before the note", "after the note", "half of the files"])
def test_an_interrupted_update_is_forgotten_or_completed(spark, tmp_path, broken, monkeypatch):
    path = str(tmp_path / "t")
    table_of(spark, path, 4)
    before = rows(readers.read_table(spark, path, INVENTORY))
    changes = overrides(spark, "P1-1", "P2-2")

    def stop(*_):
        raise RuntimeError("lost")

    def half(folder, update, replaced):
        folder.system.delete(folder.path(replaced[0]), False)
        stop()

    part = {"before the note": "write_text", "after the note": "_complete"}
    with monkeypatch.context() as m:
        if broken == "before the note":
            m.setattr(U._Folder, part[broken], stop)
        else:
            m.setattr(U, "_complete", stop if broken == "after the note" else half)
        with pytest.raises(RuntimeError):
            U.override_stored(spark, path, changes)
    U.recover(spark, path)
    found = rows(readers.read_table(spark, path, INVENTORY))
    base = spark.createDataFrame(before, INVENTORY)
    expected = before if broken == "before the note" else rows(apply_overrides(base, changes))
    assert found == expected and len(names(spark, path)) >= 4
    assert not [p for p in Path(path).iterdir() if p.name.startswith("_update")]


def test_actuals_of_partitioned_forecasts(spark, tmp_path):
    rng = random.Random(1)
    path = str(tmp_path / "f")
    data = [
        (f"m {m}", rng.choice("ab"), rng.choice(["x", None]), f"t{m}{i}", 1.0, rng.choice([None, 3]), "e")
        for m in range(4)
        for i in range(12)
    ]
    forecasts = spark.createDataFrame(data, FORECASTS)
    writers.replace_model(forecasts, path)
    files = names(spark, path, FORECASTS)
    seen = spark.createDataFrame(
        [("a", "x", f"t2{i}", 2 * i) for i in range(12)] + [("a", "x", "t23", 5), ("b", None, "t1", 9)],
        "store_location string, category string, forecast_timestamp string, actual_quantity bigint",
    )
    hit = U.fill_stored_actuals(spark, path, seen, FORECAST_KEYS)
    assert hit and all("model_name=m%202" in f or "m 2" in f for f in hit)
    assert files - names(spark, path, FORECASTS) == set(hit)
    found = readers.read_table(spark, path, FORECASTS).select(*FORECASTS.names)
    assert rows(found) == rows(
        attach_actuals(forecasts, seen, FORECAST_KEYS)
    )
    # Nothing is missing any more that was seen.
    assert U.fill_stored_actuals(spark, path, seen, FORECAST_KEYS) == []
