"""Embedding near-duplicates against all cosines."""

import numpy as np
import pytest

from stockflow.llm import embedding_dedup as E
from tests.llm.cases import components


def brute(vectors, cosine=0.95):
    links = []
    for a in range(len(vectors)):
        for b in range(a):
            x, y = vectors[a], vectors[b]
            if x is None or y is None or len(x) != len(y) or not len(x):
                continue
            x, y = (np.array([np.nan if v is None else v for v in z], float) for z in (x, y))
            n = np.linalg.norm(x) * np.linalg.norm(y)
            if np.isfinite(n) and n > 0 and x @ y / n >= cosine:
                links.append((a, b))
    count = np.bincount(np.array(links, int).ravel(), minlength=len(vectors)) if links else [0] * len(vectors)
    return list(count), components(len(vectors), links)


@pytest.mark.parametrize("block", [1024, 16])
def test_same_as_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(E, "BLOCK", block)
    rng = np.random.default_rng(4)
    vectors = rng.standard_normal((300, 24)).tolist()
    for spread in (0.01, 0.04, 0.055):
        centre = rng.standard_normal(24)
        vectors += (centre + spread * rng.standard_normal((60, 24))).tolist()
    vectors += [vectors[310]] * 15 + [(3 * np.array(vectors[311])).tolist()]
    vectors += [None, [], [0.0] * 24, [float("nan")] * 24, [None] + [1.0] * 23, [float("inf")] * 24]
    vectors += [[1.0, 2.0], [1.0, 2.0]]
    frame = spark.createDataFrame(list(enumerate(vectors)), "vec_id bigint, embedding array<double>")
    frame = frame.selectExpr("*", "1 AS class", "2 AS cell", "'x' AS unit", "3 AS label")
    got = {r["vec_id"]: r for r in E.near_duplicates(frame).collect()}
    count, root = brute(vectors)
    assert [got[i]["component_id"] for i in range(len(vectors))] == root
    assert [got[i]["kept"] for i in range(len(vectors))] == [i == r for i, r in enumerate(root)]
    ours = np.array([got[i]["n_links"] for i in range(len(vectors))])
    assert (ours <= count).all() and ours.sum() >= 0.999 * np.sum(count)


def test_null_ids_and_empty_table(spark):
    frame = spark.createDataFrame(
        [(None, [1.0, 0.0]), (5, [1.0, 0.0]), (5, [1.0, 0.0]), (None, None)],
        "vec_id bigint, embedding array<float>",
    )
    rows = sorted(
        (r["vec_id"] or 0, r["n_links"], r["component_id"] or 0, r["kept"])
        for r in E.near_duplicates(frame).collect()
    )
    assert rows == [(0, 0, 0, False), (0, 2, 5, False), (5, 2, 5, True), (5, 2, 5, True)]
    assert E.near_duplicates(frame.limit(0)).count() == 0


def test_design_reaches_the_recall():
    for n in (10, 10_000, 10**7):
        how = E.design(n, 0.95, 0.999)
        rng = np.random.default_rng(2)
        x = rng.standard_normal((400, 32))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        side = rng.standard_normal((400, 32))
        side -= (side * x).sum(1, keepdims=True) * x
        side /= np.linalg.norm(side, axis=1, keepdims=True)
        y = 0.95 * x + np.sqrt(1 - 0.95**2) * side
        met = (E.cell_keys(x, how) == E.cell_keys(y, how)).any(1)
        g = E.gaussians(32, E.COUNTED, 3)
        passing = (np.abs(x @ g - y @ g) <= how.window).sum(1) >= how.least
        assert (met & passing).mean() >= 0.98
