"""Language-model scores against counts in plain Python."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from stockflow.llm import lm_scoring as L
from tests.llm.cases import documents, not_space, sentence


def held(i):
    return zlib.crc32(str(i).encode()) % 7 == 2


def brute(texts):
    tokens = [[*not_space(t), "\0"] for t in texts]
    counts = Counter(w for i, t in enumerate(tokens) if not held(i) for w in t)
    n, v = sum(counts.values()), len(counts)
    return [
        (
            held(i),
            len(t),
            sum(counts[w] > 0 for w in t),
            n,
            sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in t),
        )
        for i, t in enumerate(tokens)
    ]


@pytest.mark.parametrize("table", [1 << 20, 40])
def test_base_is_exact_and_the_model_beats_it(spark, monkeypatch, table):
    monkeypatch.setattr(L, "TABLE", table)
    rng = random.Random(2)
    phrases = [sentence(rng, 6, 300) for _ in range(40)]
    texts = [None, "", "Ä ä  x", "unknown " * 30]
    for _ in range(200):
        words = [w for _ in range(rng.randrange(1, 30)) for w in rng.choice(phrases)]
        texts.append(" ".join(words + sentence(rng, 3, 10**6)))
    texts.append(" ".join(sentence(rng, 60_000, 500)))
    got = {r["doc_id"]: r for r in L.score_texts(documents(spark, texts)).collect()}
    base = model = 0.0
    for i, (out, n, known, train, score) in enumerate(brute(texts)):
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (out, n, known, train)
        assert r["base_score"] == pytest.approx(score, rel=1e-9)
        assert math.isfinite(r["score"]) and r["score"] <= 0
        if out:
            base, model = base + score, model + r["score"]
    assert model > base


def test_filter_never_misses_and_rarely_invents():
    keys = np.random.default_rng(1).integers(0, 2**63, 20_000).astype(np.uint64)
    n = np.random.default_rng(2).integers(1, 900, 20_000)
    bits = np.zeros(1 << L.FILTER_BITS, bool)
    for level in range(1, 11):
        for place in L.bit_places(keys[L.levels(n) >= level], level):
            bits[place.astype(np.int64)] = True
    none = np.zeros(0)
    model = L.Model(np.packbits(bits), none, none, 1, 1, 0.5)
    assert (model.level(keys) >= L.levels(n)).all()
    assert (model.level(keys) == L.levels(n)).mean() > 0.999
    others = keys ^ np.uint64(0xABCDEF)
    assert (model.level(others) > 0).mean() < 0.01


def test_without_training_rows(spark):
    only = next(i for i in range(100) if held(i))
    docs = spark.createDataFrame([(only, "a b"), (only, "a b")], "doc_id bigint, text string")
    rows = L.score_texts(docs).collect()
    assert [(r["n_known"], r["base_score"], r["score"]) for r in rows] == [(0, 0.0, 0.0)] * 2
    assert L.score_texts(docs.limit(0)).count() == 0
    none = spark.createDataFrame([(None, None), (1, "x")], "doc_id bigint, text string")
    assert {r["doc_id"]: r["n_tokens"] for r in L.score_texts(none).collect()} == {None: 1, 1: 2}


def test_pairs_that_occur_once_count(spark):
    """A text of pairs seen once scores better than the same words in another order."""
    words = [f"w{i}" for i in range(300)]
    train, *out = [next(i for i in range(100) if not held(i)), *[i for i in range(100) if held(i)][:2]]
    texts = {train: words, out[0]: words, out[1]: words[::-1]}
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in texts.items()], "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in L.score_texts(docs).collect()}
    assert got[out[0]]["base_score"] == pytest.approx(got[out[1]]["base_score"])
    assert got[out[0]]["score"] > got[out[1]]["score"] + 1


@pytest.mark.parametrize("entries", [10, 1000, 100_000])
def test_segments_grow_with_their_entries(entries):
    keys = np.random.default_rng(1).integers(0, 2**63, entries).astype(np.uint64)
    bits = L.segment(keys, np.ones(entries, np.int64))
    assert 8 * len(bits) >= L.BITS_AN_ENTRY * entries
    assert (L.probed(bits, keys) >= 1).all()
    assert (L.probed(bits, keys ^ np.uint64(0xABCDEF)) > 0).mean() < 0.03 + 1 / entries


def test_pieces_do_not_change_scores(spark, monkeypatch):
    rng = random.Random(4)
    docs = documents(spark, [" ".join(sentence(rng, 40, 100)) for _ in range(60)])
    whole = {r["doc_id"]: r for r in L.score_texts(docs).collect()}
    monkeypatch.setattr(L, "PIECE", 700)
    for r in L.score_texts(docs).collect():
        assert r["n_known"] == whole[r["doc_id"]]["n_known"]
        assert r["score"] == pytest.approx(whole[r["doc_id"]]["score"])


def test_scores_do_not_depend_on_a_setting(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    name, found = "spark.sql.shuffle.partitions", []
    before = spark.conf.get(name)
    try:
        for partitions in ("4", "64"):
            spark.conf.set(name, partitions)
            found.append({r["doc_id"]: r["score"] for r in L.score_texts(docs).collect()})
    finally:
        spark.conf.set(name, before)
    assert found[0] == pytest.approx(found[1], rel=1e-12)


def test_neither_the_jvm_nor_python_gets_much_at_once(spark, monkeypatch):
    """Texts reach Python in small batches, and leave it compressed."""
    words, before = " ".join(sentence(random.Random(6), 40_000, 10**6)), L.in_pieces
    docs = spark.range(60, numPartitions=1).selectExpr("id as doc_id", f"'{words}' as text")

    def in_pieces(batches):
        def handed():
            for batch in batches:
                assert batch.nbytes < 2 << 22, f"{batch.nbytes} bytes in a batch"
                yield batch

        for piece in before(handed()):
            assert piece.nbytes < 3 << 20, f"{piece.nbytes} bytes in a piece"
            yield piece

    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    setting = spark.conf.get(name, None)
    monkeypatch.setattr(L, "in_pieces", in_pieces)
    assert {r["n_tokens"] for r in L.score_texts(docs).collect()} == {40_001}
    assert spark.conf.get(name, None) == setting
