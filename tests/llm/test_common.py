"""What the helpers of the corpus operators leave with the driver."""

import os

import numpy as np
from pyspark import SparkContext
from pyspark.sql import functions as F

from stockflow.llm import common as C
from stockflow.llm import jaccard_join as J
from stockflow.llm.decontamination import decontaminate
from stockflow.llm.jaccard_join import jaccard_groups


def test_filters_reach_the_driver_as_chunks(spark, monkeypatch):
    came = []
    frame = type(spark.range(0))
    whole = frame.toArrow
    monkeypatch.setattr(frame, "toArrow", lambda df: came.append(whole(df)) or came[-1])
    keys = spark.range(20_000).select(F.xxhash64("id").alias("k"))
    filled = C.bitmap(keys, "k", 22, 4)
    assert 1 <= came[0].num_rows <= (1 << 17) // C.WORDS_A_CHUNK
    hashes = np.array([r[0] for r in keys.collect()], np.int64).astype(np.uint64)
    expected = np.zeros(1 << 17, np.uint32)
    for turn in range(4):
        left, right = np.uint64(13 * turn), np.uint64(64 - 13 * turn)
        turned = (hashes << left) | (hashes >> right) if turn else hashes
        slot = turned >> np.uint64(64 - 22)
        bit = np.uint32(1) << (slot & np.uint64(31)).astype(np.uint32)
        np.bitwise_or.at(expected, (slot >> np.uint64(5)).astype(np.int64), bit)
    assert (filled == expected).all()
    assert C.in_bitmap(filled, hashes, 4).all()


def test_small_and_empty_filters(spark):
    none = spark.range(0).select(F.xxhash64("id").alias("k"))
    assert not C.bitmap(none, "k", 10).any()
    one = spark.sql("select -1L as k")
    assert C.bitmap(one, "k", 10).tolist() == [0] * 31 + [1 << 31]


def test_filters_go_once_they_are_used(spark, monkeypatch):
    made = []
    whole = SparkContext.broadcast
    monkeypatch.setattr(SparkContext, "broadcast", lambda sc, v: made.append(whole(sc, v)) or made[-1])
    text = "one two three four five six seven eight nine ten eleven twelve thirteen"
    docs = spark.createDataFrame([(1, text), (2, text), (3, "other words")], "doc_id long, text string")
    groups = jaccard_groups(docs)
    items = spark.createDataFrame([("a", text)], "item_id string, text string")
    found = decontaminate(docs, items)
    assert len(made) == 4
    assert not [b for b in made if os.path.exists(b._path)]
    # Nothing lazy reads them.
    assert sorted(r.component_id for r in groups.collect()) == [1, 1, 3]
    assert sorted(r.n_hit for r in found.collect()) == [0, 13, 13]


def test_large_lookups_of_the_join_are_not_broadcast(spark, monkeypatch):
    words = [f"word{i}" for i in range(40)]
    texts = [" ".join(words[n % 3 :]) for n in range(9)] + ["some other words", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    expected = sorted(map(tuple, jaccard_groups(docs).collect()))
    monkeypatch.setattr(J, "LOOKUP_BYTES", 0)
    groups = jaccard_groups(docs)
    plan = groups._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" not in plan
    assert sorted(map(tuple, groups.collect())) == expected
    assert [r[2] for r in expected] == [0] * 9 + [9, 10]
