"""Removal of repeated byte runs against all windows of all texts."""

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stockflow.llm import repeats as R
from tests.llm.cases import documents


def brute(rows, length):
    """Removed spans of each (id, text), from the smallest id of every window."""
    least = {}
    for i, text in rows:
        for at in range(len(text) - length + 1):
            window = text[at : at + length]
            least[window] = min(least.get(window, i), i)
    found = []
    for i, text in rows:
        hit = [
            (at, at + length)
            for at in range(len(text) - length + 1)
            if least[text[at : at + length]] < i
        ]
        found.append(R.merged(hit))
    return found


def kept(text, spans):
    at, parts = 0, []
    for low, high in spans:
        parts.append(text[at:low])
        at = high
    return b"".join([*parts, text[at:]])


def expected(texts, ids, length):
    rows = [(R.NO_ID if i is None else i, (t or "").encode()) for i, t in zip(ids, texts)]
    out = []
    for (_, text), i, spans in zip(rows, ids, brute(rows, length)):
        rest = kept(text, spans)
        digest = hashlib.sha256(rest).hexdigest()
        out.append((i, len(text), len(text) - len(rest), len(spans), digest, rest))
    return sorted(out, key=repr)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.text("ab", min_size=4, max_size=40), st.integers(0, 3)), min_size=1, max_size=8))
def test_intervals_cover_what_smaller_documents_hold(rows):
    contents = [t.encode() for t, _ in rows]
    firsts = np.array([i for _, i in rows])
    found = R.removed_spans(contents, firsts, 4)
    assert [R.merged(found.get(n, [])) for n in range(len(rows))] == brute(
        [(i, c) for c, i in zip(contents, firsts.tolist())], 4
    )


def test_suffixes_are_sorted_and_prefixes_right():
    rng = random.Random(2)
    contents = [bytes(rng.choices(b"ab\0", k=rng.randrange(5, 90))) for _ in range(40)]
    array = R.SuffixArray(contents, 5)
    suffixes = [contents[array.owner[s]][array.offset[s] :] for s in array.order]
    assert suffixes == sorted(suffixes)
    for a, b, n in zip(suffixes, suffixes[1:], array.prefix.tolist()):
        assert a[:n] == b[:n] and (len(a) == n or len(b) == n or a[n] != b[n])


def test_a_repeat_names_all_its_occurrences():
    # abcabc.. in four stretches; the smallest document is the third.
    repeats = list(R.closed_intervals([6, 6, 6, 0], [9, 7, 3, 5], [1, 2, 1, 1], 4))
    assert [(depth, sorted(members)) for depth, members in repeats] == [(6, [0, 1, 3])]
    # Behind one and the same byte the repeat is longer to the left.
    assert not list(R.closed_intervals([6, 6, 6, 0], [9, 7, 3, 5], [1, 1, 1, 1], 4))


@pytest.mark.parametrize(("length", "gram"), [(50, 20), (12, 5), (8, 8)])
def test_stretches_hold_every_window_once(length, gram, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(R, "CHUNK", 300)
    monkeypatch.setattr(R, "LONGEST", 16)
    rng = random.Random(1)
    texts = ["", None, "a" * 900, "é" * 40, "".join(rng.choices("abc ", k=1500))]
    texts += ["".join(rng.choices("ab", k=rng.randrange(90))) for _ in range(50)]
    seen, bucket_of = [], {}
    for low, base, data, cuts in R.chunks(pa.array(texts), length):
        for row, start, n, bucket in zip(*R.stretches(data, cuts, length, gram)):
            at = base + start - cuts[row]
            for turn in range(n):
                seen.append((low + row, at + turn))
                window = data[start + turn : start + turn + length].tobytes()
                assert bucket_of.setdefault(window, bucket) == bucket
    assert sorted(seen) == [
        (r, i) for r, t in enumerate(texts) for i in range(len((t or "").encode()) - length + 1)
    ]


def test_text_that_repeats_itself_folds():
    import pyarrow as pa

    rng = random.Random(3)
    texts = ["s onhe. I" * rng.randrange(10, 800) + "x" * rng.randrange(9) for _ in range(150)]
    different, sizes = set(), 0
    for _, _, data, cuts in R.chunks(pa.array(texts), 50):
        for _, start, n, _ in zip(*R.stretches(data, cuts, 50, 20)):
            different.add(data[start : start + n + 49].tobytes())
            sizes += n
    assert sizes == sum(len(t) - 49 for t in texts)
    # A suffix has at most that many bytes in common with another one.
    assert max(map(len, different)) < 128
    assert sum(map(len, different)) < sum(map(len, texts)) / 5


def corpus(rng):
    passages = ["".join(rng.choices("abcdef ", k=rng.randrange(20, 160))) for _ in range(12)]
    texts = [None, "", "x" * 49, "y" * 5000, "y" * 4000 + "z"]
    for _ in range(70):
        parts = rng.choices(passages, k=rng.randrange(1, 4))
        cut = [p[rng.randrange(30) :] + "".join(rng.choices("ghé日", k=rng.randrange(9))) for p in parts]
        texts.append("".join(cut))
    return texts + rng.choices(texts, k=20)


@pytest.mark.parametrize("crowd", [R.CROWD, 2, 0])
@pytest.mark.parametrize("block", [R.BLOCK, 500])
def test_same_as_all_windows(spark, crowd, block):
    rng = random.Random(11)
    texts = corpus(rng)
    docs = documents(spark, texts).repartition(5)
    found = R.remove_repeats(docs, crowd=crowd, block=block, bits=12, with_kept=True)
    assert sorted(map(tuple, found.collect()), key=repr) == expected(texts, range(len(texts)), 50)


def test_equal_null_and_negative_ids(spark):
    rng = random.Random(12)
    texts = corpus(rng)
    ids = [rng.choice([None, -3, 0, 5, 7, 7, 9]) for _ in texts]
    docs = spark.createDataFrame(list(zip(ids, texts)), "doc_id bigint, text string")
    found = R.remove_repeats(docs.repartition(3), length=30, gram=7, with_kept=True).collect()
    assert sorted(map(tuple, found), key=repr) == expected(texts, ids, 30)


def test_empty_table(spark):
    assert R.remove_repeats(documents(spark, ["a"]).limit(0)).count() == 0
    one = R.remove_repeats(documents(spark, [None])).first()
    assert tuple(one) == (0, 0, 0, 0, hashlib.sha256(b"").hexdigest())


def test_content_hash_is_spark_s_own(spark):
    from pyspark.sql import functions as F
    from xxhash import xxh64_intdigest

    data = [bytes(range(n % 256)) * (n // 100 + 1) for n in range(0, 400, 13)]
    frame = spark.createDataFrame([(bytearray(x),) for x in data], "x binary")
    got = frame.select(F.xxhash64("x").alias("h"), "x").collect()
    assert all(r["h"] % 2**64 == xxh64_intdigest(bytes(r["x"]), 42) for r in got)
