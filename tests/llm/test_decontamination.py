"""Benchmark decontamination against all windows, word by word."""

import random

import pytest

from stockflow.llm.decontamination import decontaminate
from tests.llm.cases import alphanumeric, documents, sentence

SPAN = 13


def brute(texts, items):
    out = []
    for text in texts:
        words = alphanumeric(text)
        hit, found = set(), set()
        for item_id, item in items:
            w = alphanumeric(item)
            n = min(len(w), SPAN)
            runs = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()
            for i in range(len(words) - n + 1):
                if tuple(words[i : i + n]) in runs:
                    hit.update(range(i, i + n))
                    found.add(str(item_id))
        out.append((len(words), len(hit), sorted(found), 0 < len(hit) and 20 * len(hit) >= len(words)))
    return out


@pytest.fixture(scope="module")
def case():
    rng = random.Random(3)
    items = [(i, " ".join(sentence(rng, rng.randrange(1, 40)))) for i in range(30)]
    items += [(30, items[0][1]), (31, ""), (32, None), (33, "Ähre! ONE-two")]
    items += [(34, " ".join(sentence(rng, 13))), (35, "same " * 20)]
    texts = [None, "", "...", "ähre one two", "same " * 300, "same " * 12]
    for _ in range(60):
        words = sentence(rng, rng.randrange(0, 300))
        for _ in range(rng.randrange(0, 3)):
            _, item = rng.choice(items)
            w = (item or "").split()
            a = rng.randrange(0, max(len(w) - 11, 1))
            at = rng.randrange(0, len(words) + 1)
            words[at:at] = w[a : a + rng.randrange(11, 40)]
        texts.append(" ".join(words).replace(" w1", ", W1"))
    texts += [items[5][1]] * 3 + [" ".join(sentence(rng, 50_000)) + " " + items[34][1]]
    return texts, items


def test_same_as_all_windows(spark, case):
    texts, items = case
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    rows = decontaminate(documents(spark, texts), benchmark.selectExpr("*", "1 AS f", "2 AS kind"))
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in rows.collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts, items)
    assert all(len(r["items"]) == r["n_items"] for r in rows.collect())


def test_repeated_and_null_ids(spark):
    item = " ".join(f"x{i}" for i in range(20))
    docs = spark.createDataFrame([(None, item), (7, item), (7, item)], "doc_id bigint, text string")
    benchmark = spark.createDataFrame([(None, item), (1, item)], "item_id bigint, text string")
    rows = decontaminate(docs, benchmark).collect()
    assert sorted((r["doc_id"] or 0, r["n_hit"], tuple(r["items"])) for r in rows) == [
        (0, 20, ("1",)), (7, 20, ("1",)), (7, 20, ("1",)),
    ]


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    benchmark = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate(docs, benchmark).first()["n_hit"] == 0
    assert decontaminate(docs.limit(0), benchmark).count() == 0
