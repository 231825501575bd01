"""Merkle manifests against a level-by-level version."""

import hashlib
import random
import zlib

import pytest

from stockflow.llm.merkle import fold, merkle_manifest, siblings
from tests.llm.cases import CLASHING, DOCS


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    fields = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row]
    return h(*fields)


def tree(nodes):
    """The root of a list of nodes, and each node's siblings on the way."""
    proofs, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, spot in enumerate(at):
            if spot ^ 1 < len(nodes):
                proofs[i].append(nodes[spot ^ 1])
        at = [spot // 2 for spot in at]
        nodes = [h(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)]
    return nodes[0] if nodes else None, proofs


def brute(rows):
    groups = {}
    for i, t, lang, source, n in rows:
        groups.setdefault(lang, []).append((i, leaf((i, source, lang, n, t))))
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for found in groups.values():
        found.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    below = {g: tree([x[1] for x in groups[g]]) for g in langs}
    root, above = tree([below[g][0] for g in langs])
    return sorted(
        (str(i), own, below[g][0], root, "".join(proof + above[spot]))
        for spot, g in enumerate(langs)
        for (i, own), proof in zip(groups[g], below[g][1], strict=True)
    )


def rows_of(rng, sizes):
    rows = []
    for lang, n in sizes.items():
        for _ in range(n):
            text = rng.choice([None, "", "é日" * rng.randrange(9), "w" * rng.randrange(50)])
            rows.append((rng.randrange(10**6), text, lang, rng.choice(["a", None]), len(text or "")))
    return rows


@pytest.mark.parametrize("sizes", [{None: 1}, {"en": 1, "é": 2, None: 3}, {"x": 70, "y": 33, "": 64}])
def test_same_as_level_by_level(spark, sizes):
    rows = rows_of(random.Random(3), sizes)
    rows += [rows[0], (None, None, next(iter(sizes)), None, None), (5, "t" * 300_000, "z", "s", 1)]
    docs = spark.createDataFrame(rows, DOCS)
    for name in CLASHING + ["tree", "place", "node", "proof", "root"]:
        docs = docs.selectExpr("*", f"'x' AS `{name}`")
    found = merkle_manifest(docs.repartition(3), levels=2)
    found = found.withColumn("all", siblings(found["proof"]))
    found = found.withColumn("folded", fold(found["leaf"], found["proof"])).collect()
    assert all(r["folded"] == r["root"] for r in found)
    got = [(str(r["doc_id"]), r["leaf"], r["subroot"], r["root"], r["all"]) for r in found]
    assert sorted(got) == brute(rows)


def test_block_size_does_not_matter(spark):
    docs = spark.createDataFrame(rows_of(random.Random(4), {"a": 90, "b": 3}), DOCS)
    one, two = (merkle_manifest(docs, levels=n) for n in (3, 10))
    assert one.exceptAll(two).isEmpty() and two.exceptAll(one).isEmpty()


def test_a_changed_field_is_found(spark):
    rows = rows_of(random.Random(5), {"a": 40, "b": 9})
    docs = spark.createDataFrame(rows, DOCS)
    changed = docs.selectExpr("*", "n_chars + 1 AS more")
    found = merkle_manifest(changed, keep=("more", "text", "source", "lang")).collect()
    for r in found:
        assert leaf((r["doc_id"], r["source"], r["lang"], r["more"], r["text"])) != r["leaf"]


def test_empty_table(spark):
    assert merkle_manifest(spark.createDataFrame([], DOCS)).count() == 0


def test_crc_of_ids_is_the_usual_one(spark):
    got = spark.range(50).selectExpr("id", "crc32(cast(cast(id as string) as binary)) c").collect()
    assert all(r["c"] == zlib.crc32(str(r["id"]).encode()) for r in got)
