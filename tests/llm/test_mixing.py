"""Source mixing: targets, exact quotas, edge cases."""

import random
from collections import Counter, defaultdict

import pytest

from stockflow.llm import mixing as M
from tests.llm.cases import documents, not_space, sentence


def targets(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    """By resharing what is above the cap until nothing is."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, full, open_ = share * sum(sizes.values()), {}, set(order)
    while open_:
        left = total - sum(full.values())
        each = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if each[s] > cap * sizes[s]}
        if not over:
            return full | each
        full |= {s: cap * sizes[s] for s in over}
        open_ -= over
    return full


@pytest.fixture(scope="module")
def case():
    rng = random.Random(12)
    sources = [rng.choice(["b", "a", None, "é", "Z", *["hot"] * 4]) for _ in range(900)]
    sources[:3] = ["tiny", "void", "void"]
    texts = [" ".join(sentence(rng, rng.choice((1, 20, 80, 400)))) for _ in sources]
    texts[0], texts[1], texts[2] = "one", None, ""
    texts[10] = "w " * 20_000
    return texts, sources


def test_targets_quotas_and_reruns(spark, case):
    texts, sources = case
    docs = documents(spark, texts, sources)
    rows = M.mix_plan(docs, shards=5, blocks=64).collect()
    sizes = Counter()
    for text, source in zip(texts, sources, strict=True):
        sizes[source] += len(not_space(text))
    expected, taken, shard_words = targets(sizes), Counter(), Counter()
    largest = defaultdict(int)
    for r in rows:
        assert (r["source"], r["size"]) == (sources[r["doc_id"]], len(not_space(texts[r["doc_id"]])))
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(expected[r["source"]])
        assert len(r["draws"]) <= 2 and all(0 <= d["shard"] < 5 for d in r["draws"])
        taken[r["source"]] += r["size"] * len(r["draws"])
        largest[r["source"]] = max(largest[r["source"]], r["size"])
        for d in r["draws"]:
            shard_words[d["shard"]] += r["size"]
    for source, target in expected.items():
        assert abs(taken[source] - target) <= min(25, largest[source])
    assert len(shard_words) == 5
    again = M.mix_plan(docs.repartition(7), shards=5, blocks=64).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))


def test_urns_get_even_and_hypergeometric_shares(spark):
    tickets = spark.range(900).selectExpr("id % 3 AS place", "id AS ticket")
    split = M.split_urn(tickets, 6, seed=3).collect()
    assert sorted(Counter(r["shard"] for r in split).values()) == [150] * 6
    quotas = Counter((r["shard"], r["place"]) for r in split)
    assert sum(quotas.values()) == 900 and all(25 <= q <= 75 for q in quotas.values())
    assert len(set(quotas.values())) > 3  # drawn, not dealt evenly
    other = M.split_urn(tickets, 6, seed=4).collect()
    assert Counter((r["shard"], r["place"]) for r in other) != quotas


def test_mix_repeats_rows(spark, case):
    texts, sources = case
    plan = M.mix_plan(documents(spark, texts, sources), keep=("text", "n"))
    draws = {r["doc_id"]: len(r["draws"]) for r in plan.collect()}
    rows = M.mixed(plan, ["doc_id", "text", "n"]).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter({k: v for k, v in draws.items() if v})
    assert all(r["text"] == texts[r["doc_id"]] for r in rows)


def test_repeated_rows_and_empty_table(spark):
    docs = spark.createDataFrame(
        [(1, "a b c", "x")] * 40 + [(None, "d", None), (2, None, None)],
        "doc_id bigint, text string, source string",
    )
    rows = M.mix_plan(docs).collect()
    assert len(rows) == 42
    taken = sum(r["size"] * len(r["draws"]) for r in rows if r["source"] == "x")
    assert abs(taken - rows[0]["target"]) <= 3 or rows[0]["source"] != "x"
    assert M.mix_plan(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        M.mix_plan(docs, share=3.0, cap=2.0)


def test_main_path_is_native(spark, case, capsys):
    M.mix_plan(documents(spark, *case)).explain("formatted")
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
