"""The index of stored keys: same rows as the plain anti join, fewer files opened."""

import random

import numpy as np
import pytest

from stockflow.operators.ingest import new_rows
from stockflow.schemas import EVENT_KEY, INVENTORY
from stockflow.sources import key_index as K
from stockflow.sources import readers, writers
from tests.conftest import rows


def events(rng, n, day=None, null=0.1):
    def some(value):
        return None if rng.random() < null else value

    return [
        (
            some(f"P{rng.randrange(400)}"),
            rng.randrange(9),
            1.5,
            some(f"2025-01-{day or rng.randrange(1, 29):02}T08:00:00Z"),
            some(rng.choice(["Oslo", "Bonn"])),
            "Toys",
        )
        for _ in range(n)
    ]


def table_of(spark, path, batches):
    for batch in batches:
        writers.append(spark.createDataFrame(batch, INVENTORY).coalesce(1), path, INVENTORY)


@pytest.mark.parametrize("most", [K.MOST_PROBED, 3])
def test_same_rows_as_the_plain_join(spark, tmp_path, most, monkeypatch):
    monkeypatch.setattr(K.files_that_may_hold, "__defaults__", (most,))
    rng = random.Random(most)
    path = str(tmp_path / "t")
    table_of(spark, path, [events(rng, 60) for _ in range(6)])
    stored = rows(readers.read_table(spark, path, INVENTORY))
    incoming = spark.createDataFrame(events(rng, 50) + rng.sample(stored, 40), INVENTORY)
    found, _ = K.new_rows_indexed(incoming, path)
    plain = new_rows(incoming, readers.read_table(spark, path, INVENTORY))
    assert rows(found) == rows(plain) and len(rows(plain)) < 90


def test_only_files_that_may_hold_a_key_are_opened(spark, tmp_path):
    rng = random.Random(1)
    path = str(tmp_path / "t")
    days = [events(rng, 40, day, null=0) for day in range(1, 13)]
    table_of(spark, path, days)
    # All in one range of time: the filters alone tell the files apart.
    same = str(tmp_path / "same")
    groups = [[(f"Q{d}-{i}", 1, 1.0, "2025-01-01T08:00:00Z", "Oslo", "c") for i in range(40)] for d in range(12)]
    table_of(spark, same, groups)
    for place, batch in ((path, days[3][:5] + days[7][:1]), (same, groups[3][:5] + groups[7][:1])):
        found, files = K.new_rows_indexed(spark.createDataFrame(batch, INVENTORY), place)
        assert rows(found) == [] and len(K.stored_files(spark, place, INVENTORY)) == 12
        assert 2 <= len(files) <= 3
        opened = K.read_files(spark, files, INVENTORY)
        assert {r[0] for r in batch} <= {r["product_id"] for r in opened.collect()}
    nothing, files = K.new_rows_indexed(spark.createDataFrame([("Z", 1, 1.0, "2026", "a", "c")], INVENTORY), path)
    assert files == [] and len(rows(nothing)) == 1


def test_ingest_keeps_the_index_up_to_date(spark, tmp_path):
    rng = random.Random(2)
    indexed, plain = str(tmp_path / "a"), str(tmp_path / "b")
    for number in range(3):
        batch = spark.createDataFrame(events(rng, 80), INVENTORY)
        counts = (
            K.ingest_indexed(batch, indexed, str(tmp_path / f"m{number}"), dedupe_within=True),
            writers.ingest(batch, plain, str(tmp_path / f"n{number}"), dedupe_within=True),
        )
        assert counts[0] == counts[1]
    key = lambda place: rows(readers.read_table(spark, place, INVENTORY).select(*EVENT_KEY))
    assert key(indexed) == key(plain)
    index = readers.read_table(spark, K.index_path(indexed), K.INDEX)
    names = [r["file"] for r in index.collect()]
    assert sorted(names) == K.stored_files(spark, indexed, INVENTORY) and len(set(names)) == len(names)


def test_filters_hold_all_their_keys_and_few_others():
    rng = np.random.default_rng(3)
    hashes = rng.integers(0, 2**63, 3000, dtype=np.uint64) * np.uint64(2)
    filled = K.bloom(hashes)
    assert all(K.may_hold(filled, hashes[i : i + 1]) for i in range(0, 3000, 7))
    others = rng.integers(0, 2**63, 3000, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    assert np.mean([K.may_hold(filled, others[i : i + 1]) for i in range(3000)]) < 0.03
    assert not K.may_hold(K.bloom(hashes[:0]), hashes)


def test_no_table_yet(spark, tmp_path):
    batch = spark.createDataFrame(events(random.Random(4), 5, null=0), INVENTORY)
    found, files = K.new_rows_indexed(batch, str(tmp_path / "none"))
    assert rows(found) == rows(batch) and files == []


def test_filters_and_their_groups_do_not_grow_with_the_file(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(K, "BLOCK_ROWS", 500)
    path = str(tmp_path / "t")
    data = [(f"P{i}", 1, 1.0, "2025-01-01T08:00:00Z", "Oslo", "c") for i in range(12_000)]
    # Copies of a key are one key of its block, and a file of one key has one block with any.
    table_of(spark, path, [data + data[:1] * 3000, data[7:8] * 2000])
    fresh, files = K.new_rows_indexed(spark.createDataFrame([("Z", *data[0][1:]), data[7]], INVENTORY), path)
    assert [r[0] for r in rows(fresh)] == ["Z"] and len(files) == 2
    blocks = readers.read_table(spark, K.blocks_path(path), K.BLOCKS).collect()
    counts = {}
    for row in blocks:
        counts.setdefault((row["file"], row["blocks"]), []).append(row["block"])
        assert len(row["bloom"]) <= 1024  # 8,192 bits: at most 819 keys
    assert sorted((n, len(set(found)), len(found)) for (_, n), found in counts.items()) == [(4, 1, 1), (30, 30, 30)]


@pytest.mark.parametrize("blocked", [False, True])
def test_rows_of_an_index_by_file_stay_in_use(spark, tmp_path, blocked):
    path = str(tmp_path / "t")
    table_of(spark, path, [[(f"P{i}", 1, 1.0, "2025", "Oslo", "c") for i in range(40)]])
    (file,) = K.stored_files(spark, path, INVENTORY)
    if not blocked:
        stored = readers.read_table(spark, path, INVENTORY)
        hashes = stored.select(K.key_hash(EVENT_KEY).alias("h")).toArrow()["h"].to_numpy().view(np.uint64)
        old = spark.createDataFrame([(file, 40, "2025", "2025", K.bloom(hashes))], "file string, rows long, low string, high string, bloom binary")
        old.write.parquet(K.index_path(path))
    batch = [("P7", 1, 1.0, "2025", "Oslo", "c"), ("Z", 1, 1.0, "2025", "Oslo", "c")]
    fresh, files = K.new_rows_indexed(spark.createDataFrame(batch, INVENTORY), path)
    assert [r[0] for r in rows(fresh)] == ["Z"] and files == [file]
    assert K.new_rows_indexed(spark.createDataFrame(batch[1:], INVENTORY), path)[1] == []
    blocks = readers.read_table(spark, K.blocks_path(path), K.BLOCKS)
    assert blocks.count() == (1 if blocked else 0)


def test_a_file_without_rows_is_known(spark, tmp_path):
    path = str(tmp_path / "t")
    table_of(spark, path, [[], [("P1", 1, 1.0, "2025", "Oslo", "c")]])
    index = K.refresh(spark, path)
    assert sorted((r["rows"], r["blocks"]) for r in index.collect()) == [(0, 0), (1, 1)]
    assert K.refresh(spark, path).count() == readers.read_table(spark, K.index_path(path), K.INDEX).count() == 2
