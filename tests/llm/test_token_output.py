"""Token output: exact round trips, and what the tokenizer says of whole texts."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from stockflow.llm import token_output as T
from stockflow.session import new_location
from tests.llm.cases import documents

PATH = public_tokenizers.path("byte_bpe_50k.json")
WHOLE = Tokenizer.from_file(PATH)
ENCODER = T.WordEncoder(PATH)
PIECES = [" ", "  ", "\n", "\t", "a", "Word", "é", "ñ.", ".", ",", "'s", "'", "12", "<|endoftext|>",
          "日", "\x1c", "\x85", "ʰ", "́", "!", " \n", "\r\n", "　", "ß", "the,", "#"]


def whole(text):
    return WHOLE.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=60), st.lists(st.sampled_from(PIECES), max_size=25).map("".join)))
def test_word_by_word_is_the_whole_text(text):
    assert np.frombuffer(ENCODER.encode(text), "<u4").tolist() == whole(text)


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=200), st.sampled_from([8, 32]), st.booleans())
def test_planes_round_trip(ids, block, bits):
    ids = np.array(ids, np.uint32)
    blob, sizes = T.shuffled(ids, block, bits, 3)
    assert T.unshuffled(blob, sizes, len(ids), block, bits).tolist() == ids.tolist()


@pytest.mark.parametrize("bits", [False, True])
def test_files_hold_all_ids_in_order(spark, bits):
    rng = random.Random(5)
    texts = [None, "", "x " * 40_000, *("".join(rng.choices(PIECES, k=30)) for _ in range(80))]
    docs = documents(spark, texts)
    docs = docs.union(docs.filter("doc_id in (2, 7)")).repartition(3)
    path = new_location(spark, "test")
    T.write_tokens(docs, path, PATH, block=64, chunk=500, bits=bits)
    ids = sorted([*range(len(texts)), 2, 7])
    expected, start = [], 0
    for i in ids:
        own = np.array([*whole(texts[i]), 0], "<u4")
        expected.append((i, start, len(own), zlib.crc32(own.tobytes())))
        start += len(own)
    rows = T.token_digests(spark, path, block=64, bits=bits).collect()
    assert sorted(map(tuple, rows)) == expected
    back = {r["doc_id"]: r["ids"] for r in T.read_tokens(spark, path, block=64, bits=bits).collect()}
    assert all(back[i] == [*whole(texts[i]), 0] for i in ids)


def test_null_ids_and_empty_table(spark):
    docs = spark.createDataFrame([(None, "b"), (1, "a")], "doc_id bigint, text string")
    rows = {r["doc_id"]: r["start"] for r in T.tokenize_documents(docs, PATH).collect()}
    assert rows == {None: 0, 1: 2}
    assert T.tokenize_documents(docs.limit(0), PATH).count() == 0
