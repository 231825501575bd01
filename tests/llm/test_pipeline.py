"""The pipeline stage by stage, each against its own input."""

from itertools import combinations

import pytest

import __spark_entry__
import corpus_pipeline as C
from stockflow.llm.mixing import WEIGHTS
from stockflow.llm.queries import QUERIES
from stockflow.llm.sql import ORACLES
from stockflow.llm.toxicity import score_toxicity
from stockflow.session import materialize
from tests.compare import connect, difference
from tests.llm.cases import alphanumeric, components, not_space
from tests.llm.test_decontamination import brute as windows
from tests.llm.test_jaccard_join import brute as all_pairs
from tests.llm.test_mixing import targets

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = [spark.read.parquet(f"{FOLDER}/documents.parquet")]
    for _, stage in C.STAGES:
        docs.append(materialize(stage(spark, docs[-1], FOLDER), "stage"))
    return docs


def rows(df):
    return sorted((r.asDict() for r in df.collect()), key=lambda r: r["doc_id"])


def test_columns_and_rows(stages):
    assert all(d.columns == C.COLUMNS for d in stages[:-1])
    for before, after in zip(stages[:3], stages[1:4], strict=True):
        assert after.exceptAll(before).isEmpty()


def test_toxic_documents_go(spark, stages):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    scores = score_toxicity(stages[0], labels).filter("predicted = 0").select("doc_id")
    assert sorted(scores.collect()) == sorted(stages[1].select("doc_id").collect())


def near_roots(texts):
    """Smallest position reachable by five-word Jaccard links of 0.8 or more."""
    sets = []
    for text in texts:
        words = not_space(text)
        last = max(len(words) - 4, 1)
        sets.append({tuple(words[i : i + 5]) for i in range(last)} if words else set())
    links = [
        (a, b)
        for a, b in combinations(range(len(sets)), 2)
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    return components(len(sets), links)


def test_one_of_each_group_stays(stages):
    docs = rows(stages[1])
    roots = near_roots([d["text"] for d in docs])
    assert rows(stages[2]) == [d for i, d in enumerate(docs) if roots[i] == i]


def test_contaminated_documents_go(spark, stages):
    items = spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()
    docs = rows(stages[2])
    found = windows([d["text"] for d in docs], [(r["item_id"], r["text"]) for r in items])
    assert rows(stages[3]) == [d for d, f in zip(docs, found, strict=True) if not f[3]]
    assert all(alphanumeric(d["text"]) for d in rows(stages[3]))


def test_sources_come_near_their_targets(stages):
    sizes, taken, largest = {}, {}, {}
    for into, docs in ((sizes, stages[3]), (taken, stages[4])):
        for d in rows(docs):
            n = len(not_space(d["text"]))
            into[d["source"]] = into.get(d["source"], 0) + n
            largest[d["source"]] = max(largest.get(d["source"], 0), n)
    for source, target in targets(sizes, WEIGHTS).items():
        # Some sources hold a handful of documents here.
        assert abs(taken.get(source, 0) - target) <= largest[source] / 2


def test_ids_follow_each_other(stages):
    out = sorted(stages[5].collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in out] == sorted(r["doc_id"] for r in stages[4].collect())
    for one, two in zip(out, out[1:], strict=False):
        assert one["start"] + one["n_tokens"] == two["start"]


def test_equal_rows_fold_to_one(spark, stages):
    docs = stages[0].limit(3)
    kept = C.without_near_copies(spark, docs.union(docs), FOLDER)
    assert rows(kept) == rows(C.without_near_copies(spark, docs, FOLDER))


def test_everything_is_registered():
    names = __spark_entry__.queries()
    assert set(QUERIES) | {"pipeline"} <= set(names)
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))
    assert set(ORACLES) <= set(__spark_entry__.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, name):
    ours, theirs = difference(QUERIES[name](spark, FOLDER), connect(FOLDER), ORACLES[name])
    assert not ours and not theirs


def test_near_copies_are_those_of_five_words(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select(*C.COLUMNS)
    all_rows = rows(docs)
    roots = near_roots([d["text"] for d in all_rows])
    kept = rows(C.without_near_copies(spark, docs, FOLDER))
    assert kept == [d for i, d in enumerate(all_rows) if roots[i] == i]
