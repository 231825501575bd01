"""The Jaccard join against all pairs."""

import random
from itertools import combinations

import pytest

from stockflow.llm import jaccard_join as J
from stockflow.llm.components import components as contracted
from tests.llm.cases import components, documents, not_space, sentence


def shingles(text):
    words = not_space(text)
    if 0 < len(words) < 3:
        return {tuple(words)}
    return {tuple(words[i : i + 3]) for i in range(len(words) - 2)}


def brute(texts):
    sets = [shingles(t) for t in texts]
    links = [
        (a, b)
        for a, b in combinations(range(len(texts)), 2)
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b])
    ]
    return [len(s) for s in sets], components(len(texts), links)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(8)
    passage = sentence(rng, 60)
    out = [None, "", "one", "ONE", "one two", "a b c", "a  b\nc", "a b c d"]
    for n in (40, 150, 150, 400, 12):
        base = sentence(rng, n)
        for _ in range(30):
            words = list(base)
            for _ in range(rng.randrange(0, max(n // 30, 2) + 2)):
                words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
            out.append(" ".join(words))
    out += [" ".join(passage + sentence(rng, rng.randrange(1, 60))) for _ in range(60)]
    out += [" ".join(sentence(rng, 200)) for _ in range(40)]
    out += [out[20]] * 40
    # A chain: each links with the next only.
    chain = sentence(rng, 200)
    for step in range(12):
        chain = chain[:step * 15] + sentence(rng, 3, 10**7) + chain[step * 15 + 3 :]
        out.append(" ".join(chain))
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("small", [False, True])
def test_same_as_all_pairs(spark, texts, monkeypatch, small):
    if small:  # many parts, and a sketch that knows next to nothing
        monkeypatch.setattr(J, "GROUP_TOKENS", 500)
        monkeypatch.setattr(J, "QUERIES_A_PART", 3)
    rows = J.jaccard_groups(documents(spark, texts), cell_bits=8 if small else J.CELL_BITS)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows.collect()}
    sizes, roots = brute(texts)
    assert [got[i] for i in range(len(texts))] == list(zip(sizes, roots, strict=True))


def test_repeated_null_and_empty(spark):
    docs = spark.createDataFrame(
        [(None, "a b c d"), (3, "a b c d"), (3, "a b c d"), (9, "a b c d"), (None, None)],
        "doc_id bigint, text string",
    )
    rows = J.jaccard_groups(docs).collect()
    assert sorted((r["doc_id"] or 0, r["n_shingles"], r["component_id"] or 0) for r in rows) == [
        (0, 0, 0), (0, 2, 3), (3, 2, 3), (3, 2, 3), (9, 2, 3),
    ]
    assert J.jaccard_groups(docs.limit(0)).count() == 0


def test_components_of_paths_and_stars(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(0, 300)] + [(1000, 1000 + i) for i in range(200)]
    links += [(5000, 5000), (None, 3)]
    rng.shuffle(links)
    got = {}
    for r in contracted(spark.createDataFrame(links, "a bigint, b bigint")).collect():
        got.setdefault(r["root"], set()).add(r["node"])
    assert sorted(map(sorted, got.values())) == [
        list(range(301)), list(range(1000, 1200)), [5000],
    ]
