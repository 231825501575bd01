"""Toxicity and quality: held-out accuracy, counterfactuals, edge cases."""

import math
import random
import zlib

import numpy as np
import pytest

from stockflow.llm.quality import score_quality, strength
from stockflow.llm.toxicity import score_toxicity, swapper
from tests.llm.cases import documents, sentence

LABELS = "doc_id bigint, quality int, toxic int"


def held(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


def area(scores, labels):
    rank = np.argsort(np.argsort(scores)) + 1
    labels = np.array(labels)
    n = labels.sum()
    return (rank[labels == 1].sum() - n * (n + 1) / 2) / (n * (len(labels) - n))


@pytest.mark.parametrize("run,label", [(score_toxicity, "toxic"), (score_quality, "quality")])
def test_held_out_area_on_the_tables(spark, run, label):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rows = run(docs, labels).join(labels, "doc_id").filter("held_out")
    rows = rows.select("score", label, "predicted").toPandas()
    assert area(rows["score"], rows[label]) > 0.95
    assert (rows["predicted"] == rows[label]).mean() > 0.95


def biased(spark):
    """Texts that mention one group are mostly toxic, whatever their words."""
    rng = random.Random(9)
    texts, labels = [], []
    for i in range(600):
        toxic = rng.random() < 0.4
        words = sentence(rng, 25, 300)
        if toxic and rng.random() < 0.7:
            words[3] = rng.choice(("vile", "scummy"))
        if rng.random() < (0.7 if toxic else 0.1):
            words[7] = "Muslims"
        elif rng.random() < 0.3:
            words[7] = "christians"
        texts.append(" ".join(words))
        labels.append((i, 1, int(toxic)))
    probes = ["we met muslims in town", "we met christians in town", "we met people in town"]
    return documents(spark, texts + probes), spark.createDataFrame(labels, LABELS), len(texts)


def test_counterfactual_penalty_evens_out_mentions(spark):
    docs, labels, n = biased(spark)
    gaps = []
    for penalty in (0.0, 10.0):
        rows = score_toxicity(docs, labels, penalty=penalty).filter(f"doc_id >= {n}")
        score = {r["doc_id"] - n: math.log(r["score"] / (1 - r["score"])) for r in rows.collect()}
        gaps.append(abs(score[0] - score[1]))
    assert gaps[1] < 0.2 * gaps[0] and gaps[0] > 0.5


def test_swap_is_by_words_and_within_a_kind():
    swap = swapper((("women", "men"), ("a b", "c")))
    assert swap("Women, omen and men; a b") == "men, omen and women; c"
    assert swapper(()) is None


@pytest.mark.parametrize("run", [score_toxicity, score_quality])
def test_null_empty_repeated(spark, run):
    docs = documents(spark, [None, "", "", "x " * 50_000, "bad thing", "bad thing"])
    docs = docs.union(docs.filter("doc_id = 4")).union(docs.limit(1).selectExpr("NULL", *[f"`{c}`" for c in docs.columns[1:]]))
    labels = spark.createDataFrame(
        [(4, 1, 1), (4, 0, 0), (5, None, None), (None, 1, 1), (99, 1, 1), (3, 0, 0)], LABELS
    )
    rows = run(docs, labels).collect()
    assert len(rows) == 8 and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["held_out"] == (r["doc_id"] is not None and held(r["doc_id"])) for r in rows)
    assert run(docs, labels.limit(0)).count() == 8
    assert run(docs.limit(0), labels).count() == 0


def test_held_out_labels_are_not_used(spark):
    texts = [" ".join(sentence(random.Random(i), 20, 50)) for i in range(60)]
    out = [i for i in range(60) if held(i)]
    rows = [(i, i % 2, i % 3 // 2) for i in range(60)]
    other = [(i, 1 - q, 1 - t) if i in out else (i, q, t) for i, q, t in rows]
    for run in (score_toxicity, score_quality):
        one, two = (
            {r["doc_id"]: r["score"] for r in run(documents(spark, texts), spark.createDataFrame(x, LABELS)).collect()}
            for x in (rows, other)
        )
        assert one == pytest.approx(two)


def test_sparse_sites_stay_near_the_mean(spark):
    rng = random.Random(4)
    texts, sources, labels = [], [], []
    for i in range(900):
        host = ("good", "bad", f"s{i}")[i % 3]
        good = rng.random() < {"good": 0.95, "bad": 0.1}.get(host, 0.5)
        words = sentence(rng, 20, 200)
        if rng.random() < 0.6:
            words[5] = "fine" if good else "junk"
        texts.append(" ".join(words))
        sources.append(host)
        labels.append((i, int(good), 0))
    rows = score_quality(documents(spark, texts, sources), spark.createDataFrame(labels, LABELS))
    site = {sources[r["doc_id"]]: r["site_score"] for r in rows.collect()}
    few = [v for k, v in site.items() if k not in ("good", "bad")]
    assert site["bad"] < min(few) and max(few) < site["good"]
    assert strength(0.0, 1.0, 10.0, 0.2) > strength(5.0, 1.0, 30.0, 0.2)


def test_site_scores_against_all_rows(spark):
    """Posteriors of hosts and paths by plain sums over lists."""
    rng = random.Random(6)
    texts = [" ".join(sentence(rng, 12, 60)) for _ in range(240)]
    sources = [rng.choice(["a", "b", "c", f"s{i}", None]) for i in range(240)]
    langs = [rng.choice(["x", "y", None]) for _ in range(240)]
    rows = [(i, t, g, s, 0) for i, (t, s, g) in enumerate(zip(texts, sources, langs))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    labels = [(i, int(s in ("a", None)) if rng.random() < 0.9 else rng.randrange(2), 0) for i, s in enumerate(sources)]
    found = {r["doc_id"]: r for r in score_quality(docs, spark.createDataFrame(labels, LABELS)).collect()}
    p = [found[i]["text_score"] for i in range(240)]
    hosts, paths = {}, {}
    for i, key in enumerate(zip(sources, langs)):
        hosts.setdefault(key[0], []).append(p[i])
        paths.setdefault(key, []).append(p[i])
    n, mean = len(p), sum(p) / len(p)
    variance = mean * (1 - mean)
    rate = {h: sum(x) / len(x) for h, x in hosts.items()}
    far = sum(len(x) * (rate[h] - mean) ** 2 for h, x in hosts.items())
    free = n - sum(len(x) ** 2 for x in hosts.values()) / n - (len(hosts) - 1)
    strong = strength(far, variance * (len(hosts) - 1), free, variance)
    host_mean = {h: (sum(x) + strong * mean) / (len(x) + strong) for h, x in hosts.items()}
    far = expected = weight = 0.0
    for (h, _), x in paths.items():
        inside, left = rate[h] * (1 - rate[h]), 1 - len(x) / len(hosts[h])
        far += len(x) * (sum(x) / len(x) - rate[h]) ** 2
        expected += inside * left
        weight += inside * len(x) * left
    path_strong = strength(far, expected, weight - expected, 1.0)
    for i, key in enumerate(zip(sources, langs)):
        site = sum(paths[key]) - p[i] + path_strong * host_mean[key[0]]
        site /= len(paths[key]) - 1 + path_strong
        assert found[i]["site_score"] == pytest.approx(site, rel=1e-9)
        odds = math.log(p[i] / (1 - p[i])) + math.log(site / (1 - site)) - math.log(mean / (1 - mean))
        assert found[i]["score"] == pytest.approx(1 / (1 + math.exp(-odds)), rel=1e-6)


@pytest.mark.parametrize("penalty", [0.0, 3.0])
def test_penalised_fit_is_the_minimum(penalty):
    """The fitted weights against the gradient of the whole objective, written densely."""
    import pyarrow as pa

    from stockflow.llm.text_model import Sparse, fit

    rng = np.random.default_rng(8)
    own = rng.random((200, 12)) < 0.3
    other = own.copy()
    other[:, [2, 3]] = own[:, [3, 2]]  # two groups change places
    y = (rng.random(200) < 1 / (1 + np.exp(1.5 * own[:, 0] - 2.0 * own[:, 2]))).astype(float)

    def sparse(dense):
        return Sparse.of(pa.array([np.flatnonzero(r).astype(np.int32).tobytes() for r in dense], pa.binary()), 12)

    weights, intercept = fit(sparse(own), sparse(other), y, penalty, 0.01, 20_000)
    p = 1 / (1 + np.exp(-(own @ weights + intercept)))
    change = (own.astype(float) - other) @ weights
    pairs = max((own.any(1)).sum(), 1)
    slope = own.T @ (p - y) / 200 + 0.01 * weights
    slope += 2 * penalty / pairs * (own.astype(float) - other).T @ change
    assert np.abs(slope).max() < 1e-4 and abs((p - y).mean()) < 1e-4
    if penalty:
        plain, _ = fit(sparse(own), sparse(other), y, 0.0, 0.01, 20_000)
        assert abs(weights[2] - weights[3]) < 0.5 * abs(plain[2] - plain[3])


def test_the_sample_is_stored_as_text(spark, monkeypatch):
    from stockflow.llm import text_model as T

    stored, write = {}, T.materialize
    monkeypatch.setattr(
        T, "materialize", lambda df, label: stored.setdefault(label, write(df, label))
    )
    docs, labels, n = biased(spark)
    score_toxicity(docs, labels)
    # A text's features, of 8 bytes each, would be several times as large.
    texts = docs.filter(f"doc_id < {n}").select("text").collect()
    texts = sum(len(r[0].encode()) for i, r in enumerate(texts) if not held(i))
    size = sum(
        len(v.encode() if isinstance(v, str) else v or b"")
        for table in stored.values()
        for row in table.collect()
        for v in row
        if not isinstance(v, int)
    )
    assert 0 < size <= texts
