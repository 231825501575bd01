import random

import pytest
from pyspark.sql import functions as F

from stockflow.operators import ingest, joins
from stockflow.operators.ingest import new_rows, next_batch_number, product_batch_id
from stockflow.operators.quantiles import exact_percentiles, kth_smallest
from stockflow.operators.sampling import apply_overrides, outlier_overrides, sample_exact
from stockflow.schemas import INVENTORY
from tests.conftest import rows

SIZES = pytest.mark.parametrize("broadcast_bytes", [joins.BROADCAST_BYTES, 0])


@SIZES
@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_join_lookup_equals_plain_join(spark, how, null_safe, broadcast_bytes):
    # A third of the rows, all of them copies, share one key.
    data = [("hot", 1, 0)] * 200 + [(f"k{i % 50}", i % 3, i) for i in range(350)]
    data += [(None, 1, 7)] * 50
    big = spark.createDataFrame(data, "a string, b int, v int").repartition(7)
    lookup = spark.createDataFrame(
        [("hot", 1, "H"), (None, 1, "N"), ("zzz", 1, "Z")]
        + [(f"k{i}", i % 3, f"L{i}") for i in range(0, 50, 2)],
        "a string, b int, w string",
    )
    found = joins.join_lookup(
        big, lookup, ["a", "b"], how, null_safe=null_safe, broadcast_bytes=broadcast_bytes
    )
    right = lookup.select(F.col("a").alias("ra"), F.col("b").alias("rb"), "w")
    if null_safe:
        condition = F.col("a").eqNullSafe(F.col("ra")) & F.col("b").eqNullSafe(F.col("rb"))
    else:
        condition = (F.col("a") == F.col("ra")) & (F.col("b") == F.col("rb"))
    expected = big.join(right, condition, how).drop("ra", "rb")
    assert found.columns == expected.columns
    assert rows(found) == rows(expected)


def test_frequent_keys_finds_every_hot_key(spark):
    data = [("hot",)] * 400 + [("warm",)] * 100 + [(f"k{i}",) for i in range(500)]
    df = spark.createDataFrame(data, "a string").repartition(9)
    hashes = {r["a"]: r["h"] for r in df.distinct().select("a", F.xxhash64("a").alias("h")).collect()}
    found = joins.frequent_keys(df, ["a"], 0.05)
    assert {hashes["hot"], hashes["warm"]} <= set(found)
    assert len(found) <= 20


def test_unlimited_lookup_is_not_broadcast(spark):
    big = spark.range(100).withColumn("k", F.col("id") % 5)
    lookup = spark.range(5).select(F.col("id").alias("k"), F.col("id").alias("w"))

    def plan(limit):
        joined = joins.join_lookup(big, lookup, ["k"], broadcast_bytes=limit)
        return joined._jdf.queryExecution().optimizedPlan().toString()

    assert "strategy=broadcast" in plan(joins.BROADCAST_BYTES)
    assert "strategy=broadcast" not in plan(0)


def test_first_and_latest_per_key(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 5, "z")], "k string, o int, v string")
    assert rows(joins.first_per_key(df, ["k"], ["o"])) == [("a", 1, "y"), ("b", 5, "z")]
    assert rows(joins.latest_per_key(df, ["k"], ["o"])) == [("a", 2, "x"), ("b", 5, "z")]


def inventory(spark, *data):
    return spark.createDataFrame(list(data), INVENTORY)


@SIZES
def test_new_rows(spark, broadcast_bytes):
    stored = inventory(
        spark,
        ("P1", 1, 1.0, "t1", "LA", "Toys"),
        ("P1", 9, 9.0, "t1", "LA", "Food"),
        (None, 1, 1.0, "t1", "LA", "Toys"),
    )
    incoming = inventory(
        spark,
        ("P1", 5, 5.0, "t1", "LA", "Toys"),
        ("P1", 5, 5.0, "t2", "LA", "Toys"),
        ("P1", 6, 6.0, "t2", "LA", "Toys"),
        (None, 5, 5.0, "t1", "LA", "Toys"),
        (None, 5, 5.0, "t1", "NYC", "Toys"),
    )
    fresh = new_rows(incoming, stored, broadcast_bytes=broadcast_bytes)
    unpruned = new_rows(incoming, stored, broadcast_bytes=broadcast_bytes, prune_on="")
    assert rows(fresh) == rows(unpruned)
    assert rows(fresh.select("product_id", "quantity", "event_timestamp")) == [
        ("P1", 5, "t2"),
        ("P1", 6, "t2"),
        (None, 5, "t1"),
    ]
    once = new_rows(incoming, stored, dedupe_within=True, broadcast_bytes=broadcast_bytes)
    assert once.count() == 2


def test_first_load_takes_everything(spark):
    incoming = inventory(spark, ("P1", 1, 1.0, "t", "LA", "Toys"), ("P1", 1, 1.0, "t", "LA", "Toys"))
    assert new_rows(incoming, inventory(spark)).count() == 2


def test_large_batches_are_dealt_out_once(spark, monkeypatch):
    data = [(f"P{i}" if i % 9 else None, i, 1.0, f"2025-01-{i % 28 + 1:02}", "Oslo", "c") for i in range(300)]
    data += [("hot", 1, 1.0, None, "s", "c")] * 200 + [("warm", 1, 1.0, "2025-01-03", None, "c")] * 200
    incoming = spark.createDataFrame(data, INVENTORY).repartition(5)
    existing = spark.createDataFrame(data[:150] * 2 + data[300:500], INVENTORY).repartition(3)
    written = []
    for module in (ingest, joins):
        keep = module.materialize
        monkeypatch.setattr(module, "materialize", lambda df, label, keep=keep: written.append(label) or keep(df, label))
    found = new_rows(incoming, existing, broadcast_bytes=0)
    # No key of either side is written first, and a sort meets the hash before the key.
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert written == [] and plan.count("Join") == 1 and "__hash" in plan
    known = {(d[0], d[3], d[4]) for d in data[:150] + data[300:500]}
    expected = [d for d in data if (d[0], d[3], d[4]) not in known]
    assert rows(found) == sorted(expected, key=repr) and ("warm", 1, 1.0, "2025-01-03", None, "c") in expected


@SIZES
def test_no_new_rows_of_an_empty_batch(spark, broadcast_bytes):
    nothing = spark.createDataFrame([], INVENTORY)
    stored = spark.createDataFrame([("P", 1, 1.0, "t", "s", "c")], INVENTORY)
    assert new_rows(nothing, stored, broadcast_bytes=broadcast_bytes).count() == 0
    assert new_rows(nothing, stored, prune_on="", broadcast_bytes=broadcast_bytes).count() == 0


def test_next_batch_number(spark):
    ids = spark.createDataFrame([("P001-B3",), ("P002-B12",), ("P9",), (None,)], "product_id string")
    assert next_batch_number(ids).first()[0] == 13
    assert next_batch_number(ids.filter("product_id = 'P9'")).first()[0] == 1
    made = spark.range(1).select(product_batch_id(F.lit(1), F.lit(1)).alias("id"))
    assert made.first()["id"] == "P001-B1"


@pytest.mark.parametrize("n", [1, 19, 40, 1000])
def test_sample_size_is_exact_and_repeatable(spark, n):
    df = spark.range(n).select(F.col("id").cast("string").alias("id"))
    first = rows(sample_exact(df, 0.05))
    again = rows(sample_exact(df.repartition(5), 0.05))
    assert len(first) == max(1, int(0.05 * n))
    assert first == again
    if n == 1000:
        assert first != rows(sample_exact(df, 0.05, seed=7))


def test_sample_of_copies_is_exact(spark):
    df = spark.createDataFrame([("same",)] * 90 + [(f"x{i}",) for i in range(10)], "v string")
    assert sample_exact(df, 0.5).count() == 50
    assert sample_exact(df.limit(0), 0.5).count() == 0


def test_overrides_change_every_row_of_a_key(spark):
    base = inventory(
        spark,
        ("P1", 1, 1.0, "t", "LA", "Toys"),
        ("P1", 2, 2.0, "t", "LA", "Food"),
        ("P2", 3, 3.0, "t", "LA", "Food"),
        (None, 4, 4.0, "t", "LA", "Food"),
    )
    keys = inventory(spark, ("P1", 1, 1.0, "t", "LA", "Toys"), (None, 4, 4.0, "t", "LA", "Food"))
    for limit in (joins.BROADCAST_BYTES, 0):
        changed = apply_overrides(base, outlier_overrides(keys), broadcast_bytes=limit)
        assert changed.schema == base.schema
        assert rows(changed.select("quantity", "price")) == [
            (1000, 5000.0),
            (1000, 5000.0),
            (3, 3.0),
            (4, 4.0),
        ]


@pytest.mark.parametrize("small", [5, 100_000])
def test_kth_smallest(spark, small):
    rng = random.Random(3)
    values = [rng.gauss(0, 1e6) for _ in range(700)] + [42.0] * 400 + [1e12]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    ordered = sorted(values)
    ranks = [0, 1, 300, 500, 700, len(values) - 1]
    found = kth_smallest(df, "v", lambda n: ranks, small)
    for rank in ranks:
        value = ordered[rank]
        assert found[rank] == (value, sum(v < value for v in values), values.count(value))


def test_exact_percentiles(spark):
    df = spark.createDataFrame([(float(v),) for v in range(11)], "v double")
    assert exact_percentiles(df, "v", [0.25, 0.5, 1.0]) == {0.25: 2.5, 0.5: 5.0, 1.0: 10.0}
    assert exact_percentiles(df.filter("v < 0"), "v", [0.5]) == {0.5: None}


@pytest.mark.parametrize("small", [3, 20_000])
def test_kth_smallest_of_wide_infinite_and_nan_values(spark, small):
    inf, nan = float("inf"), float("nan")
    values = [1.7e308, -1.7e308, inf, -inf, nan, None, 0.0, 1.0, 1.0, 5e-324, -3.5, inf]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    kept = sorted(v for v in values if v is not None and v == v)
    found = kth_smallest(df, "v", lambda n: list(range(n)), small)
    assert [found[k].value for k in range(len(kept))] == kept


def test_kth_smallest_of_neighbouring_tiny_values(spark):
    tiny = 5e-324
    df = spark.createDataFrame([(v * tiny,) for v in (3, 4) for _ in range(10)], "v double")
    found = kth_smallest(df, "v", lambda n: [0, 9, 10, 19], 5)
    assert [found[r][:3] for r in (0, 9, 10, 19)] == [(3 * tiny, 0, 10)] * 2 + [(4 * tiny, 10, 10)] * 2
