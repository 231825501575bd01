"""Token alignment against whole-text encoding and all pairs of tokens."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from stockflow.llm import token_alignment as A
from stockflow.llm.token_output import Recent
from tests.llm.cases import documents

PATHS = [public_tokenizers.path(p) for p in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
BYTES = Tokenizer.from_file(PATHS[0])
BYTES.encode_special_tokens = True
PIECES = SentencePieceProcessor(model_file=PATHS[1])
ALIGNER = A.Aligner(*PATHS)
PARTS = [" ", "  ", "\n", "\t", "a", "Word", "é", "ñ.", ".", ",", "'s", "'", "12", "<|endoftext|>",
         "日本", "\x1c", "\x85", "ʰ", "́", "!", " \n", "\r\n", "　", "ß", "the,", "#", "<s>", "\0",
         "<0x0A>", "😀", "▁", "don't", "x-y_z", "A!!", "<unk>", " ", "Ünder9", "word,", "Wort!!", "A).", "mot$$$", "ñandú.\n"]


def spans(tokens, sizes):
    at, found = 0, []
    for token in tokens:
        found.append((token, at, at + sizes[token]))
        at = found[-1][2]
    return found


def brute(text):
    """Both rows of tokens, groups and links of a whole text."""
    if not text:
        return None
    a = BYTES.encode(" " + text, add_special_tokens=False).ids
    b = PIECES.encode(text, num_threads=1)
    if b"".join(A.piece_bytes(PIECES.id_to_piece(i)) for i in b) != b" " + text.encode():
        return None
    assert BYTES.decode(a) == " " + text
    sa, sb = spans(a, ALIGNER.sizes_a), spans(b, ALIGNER.sizes_b)
    links = [(x[0], y[0]) for x in sa for y in sb if x[1] < y[2] and y[1] < x[2]]
    groups, low = [], 0
    for end in sorted({x[2] for x in sa} & {y[2] for y in sb}):
        sides = ([str(x[0]) for x in s if low < x[2] <= end] for s in (sa, sb))
        groups.append("|".join(map(",".join, sides)))
        low = end
    return len(a), len(b), groups, links


@settings(max_examples=500, deadline=None)
@given(st.one_of(st.text(max_size=40), st.lists(st.sampled_from(PARTS), max_size=25).map("".join)))
def test_piece_by_piece_is_the_whole_text(text):
    expected, found = brute(text), ALIGNER.text(text)
    if expected is None:
        assert found is None
        return
    assert (sum(x[0] for x in found), sum(x[1] for x in found)) == expected[:2]
    assert ";".join(x[3] for x in found) == ";".join(expected[2])
    links = np.frombuffer(b"".join(x[4] for x in found), np.uint64).tolist()
    assert Counter(links) == Counter(x * A.SHIFT + y for x, y in expected[3])


def test_no_piece_crosses_a_word():
    shown = [PIECES.id_to_piece(i) for i in range(PIECES.get_piece_size())]
    assert not [p for p in shown if "▁" in p.lstrip("▁")]


def test_letters_share_no_piece_with_marks():
    assert ALIGNER.apart


def test_long_pieces_are_not_remembered():
    aligner = A.Aligner(*PATHS)
    text = "x" * 500 + " " + "日" * 90 + " " + "y" * 300 + "!? z"
    assert aligner.text(text) and set(aligner.known) == {"z"}


def test_packed_pairs_round_trip():
    pairs = np.array([0, 5, 2**31, 50256 * A.SHIFT + 31999], np.uint64)
    times = np.array([1, 2, 300, 2**20], "<u4")
    packed = A.packed_pairs(pairs, times, zstandard.ZstdCompressor())
    back = A.unpacked_pairs(packed, zstandard.ZstdDecompressor())
    assert back[0].tolist() == pairs.tolist() and back[1].tolist() == times.tolist()


def test_recent_forgets_what_was_not_asked_for():
    asked = []
    cache = Recent(lambda x: asked.append(x) or x, 2)
    for key in "abacadab":
        assert cache[key] == key
        cache = cache.turned()
    assert asked == ["a", "b", "c", "d", "b"] and len(cache) + len(cache.old) <= 4


@pytest.mark.parametrize("limits", [(A.FREQUENT, A.HELD_LINKS, A.MOST_PAIRS), (10, 50, 60), (0, 1, 1)])
def test_same_as_all_pairs(spark, limits):
    rng = random.Random(7)
    texts = [None, "", " ", "x " * 30_000, "▁ b"]
    texts += ["".join(rng.choices(PARTS, k=rng.randrange(1, 30))) for _ in range(60)]
    texts += texts[-3:]
    docs = documents(spark, texts).repartition(3)
    per_text = {t: brute(t) for t in set(texts) if t != texts[3]}
    word = brute("x x x")
    assert word[2][0] == word[2][1]
    per_text[texts[3]] = None if brute("x x " * 50) is None else long_text(texts[3])
    held, top = Counter(), defaultdict(int)
    for t in texts:
        held.update(set(per_text[t][3]) if per_text[t] else ())
    for (a, _), n in held.items():
        top[a] = max(top[a], n)
    expected = []
    for i, t in enumerate(texts):
        found = per_text[t]
        if found is None:
            expected.append((i, 0, 0, 0, 0, "", 0, 0))
            continue
        n_a, n_b, groups, links = found
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        best = sum(held[x] == top[x[0]] for x in links)
        total = sum(held[x] for x in links)
        expected.append((i, n_a, n_b, len(groups), len(links), digest, best, total))
    frequent, waiting, most = limits
    found = A.align_tokens(docs, *PATHS, frequent=frequent, held=waiting, most=most)
    assert sorted(map(tuple, found.collect())) == expected


def long_text(text):
    """Of a text of one-letter words, where each is a token of both."""
    a = BYTES.encode(" " + text, add_special_tokens=False).ids
    b = PIECES.encode(text, num_threads=1)
    assert len(a) == len(b)
    return len(a), len(b), [f"{x}|{y}" for x, y in zip(a, b)], list(zip(a, b))


def test_groups(spark):
    docs = documents(spark, ["Under the bridge, don't!", "", None])
    rows = {r["doc_id"]: r["groups"] for r in A.token_groups(docs, *PATHS).collect()}
    a = BYTES.encode(" Under the bridge, don't!", add_special_tokens=False).ids
    assert [t for g in rows[0] for t in g["a"]] == a
    assert [t for g in rows[0] for t in g["b"]] == PIECES.encode("Under the bridge, don't!")
    assert rows[1] == rows[2] == []


def test_empty_table_and_null_ids(spark):
    docs = spark.createDataFrame([(None, "b")], "doc_id bigint, text string")
    assert A.align_tokens(docs, *PATHS).first()["n_links"] == 1
    assert A.align_tokens(docs.limit(0), *PATHS).count() == 0
