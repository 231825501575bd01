"""Language-model scores from a log-frequency Bloom filter.

Counts of words and of pairs of words are quantised to powers of two; an n-gram
of level q is put into the filter once for each of the levels 1 to q. A reader
probes the levels one after the other until one is missing. The filter lies in
segments, each for a range of hashes and as large as its entries need. Texts go
in pieces: a piece's different n-grams are sent to the segments, which count
them, build their part of the filter, probe it and send the levels back.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.llm.common import ROW, held_out, numbered, packed, small
from stockflow.llm.words import NOT_SPACE, Splitter, Words, mix
from stockflow.session import arrow_batches, discard, materialize

FOLDS, HELD_OUT = 7, 2
FILTER_BITS = 28  # bits of a filter whose size is not given
PROBES = 3  # bits of an n-gram and level
BITS_AN_ENTRY = 10  # of a segment, for every n-gram and level
SHARD_BYTES = 1 << 22  # of text for each segment of the filter
MOST_SHARDS = 1 << 16  # segments of the filter at most
STRENGTH = 50.0  # weight of the word's own probability against the pair's
TABLE = 1 << 20  # most frequent words whose exact counts are broadcast: 16 MiB
PIECE = 1 << 22  # bytes of text that are counted and scored together
BATCH = 1 << 22  # bytes of rows that the JVM hands to Python at once
BATCHES = 8  # in which a piece's n-grams of a kind go back

END = np.uint64(0x5851F42D4C957F2D)  # hash of the end, which also stands before the first word
PAIR = np.uint64(0x14057B7EF767814F)


def tokens(part: Words) -> np.ndarray:
    """Hashes of the rows' words, an end after each row's."""
    out = np.full(len(part.hashes) + part.rows, END)
    out[np.arange(len(part.hashes)) + part.row_of_word()] = part.hashes
    return out


def pairs(seq: np.ndarray) -> np.ndarray:
    """Hash of each token with the one before it, the end before the first."""
    before = np.empty_like(seq)
    before[:1] = END
    before[1:] = seq[:-1]
    with np.errstate(over="ignore"):
        return mix(before * np.uint64(0x9E3779B97F4A7C15) + seq) ^ PAIR


def compressed(batches: list[pa.RecordBatch]) -> bytes:
    """Rows as an Arrow stream with zstandard buffers."""
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    with pa.ipc.new_stream(sink, batches[0].schema, options=options) as stream:
        for batch in batches:
            stream.write_batch(batch)
    return sink.getvalue().to_pybytes()


def opened(blob: pa.BinaryScalar) -> list[pa.ChunkedArray]:
    """Ids, whether held out, and texts of a piece's rows."""
    return pa.ipc.open_stream(blob.as_buffer()).read_all().columns


def in_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task function: rows of about ``PIECE`` bytes of text as one compressed value.

    The JVM holds a piece several times over when it is written, read, sorted or
    handed to Python, so it only gets to see it compressed.
    """
    number = TaskContext.get().partitionId() << 32

    def flushed(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([number]), pa.array([compressed(held)], pa.binary())], ["piece", "rows"]
        )

    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        bytes_ = pc.fill_null(pc.binary_length(batch.column(2)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(bytes_.astype(np.int64) + 1)
        low, before = 0, 0
        while low < batch.num_rows:
            high = int(np.searchsorted(ends, before + PIECE - size)) + 1
            high = min(high, batch.num_rows)
            held.append(batch.slice(low, high - low))
            size += int(ends[high - 1]) - before
            low, before = high, int(ends[high - 1])
            if size >= PIECE:
                yield flushed(held)
                number += 1
                held, size = [], 0
    if held:
        yield flushed(held)


def read(splitter: Splitter, texts: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of all texts, and how many each has."""
    seq, sizes = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for chunk in texts.chunks:
        for part in splitter.split(chunk):
            seq.append(tokens(part))
            sizes.append(np.diff(part.ends, prepend=0) + 1)
    return np.concatenate(seq), np.concatenate(sizes)


def counted(shards: int):
    """Task function: each piece's different words and pairs and how often its
    training rows have them, packed by shard.

    A shard is a range of hashes, so its n-grams lie next to each other.
    """
    edges = np.arange(1, shards, dtype=np.uint64) << np.uint64(64 - (shards - 1).bit_length())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = Splitter(NOT_SPACE)
        for batch in batches:
            for at in range(batch.num_rows):
                piece = batch.column("piece")[at].as_py()
                _, outs, texts = opened(batch.column("rows")[at])
                seq, sizes = read(splitter, texts)
                train = np.repeat(~outs.to_numpy().astype(bool), sizes)
                for kind in (1, 2):
                    keys, place = np.unique(seq if kind == 1 else pairs(seq), return_inverse=True)
                    n = np.bincount(place[train], minlength=len(keys)).astype(np.uint32)
                    cuts = np.searchsorted(keys, edges)
                    found = pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(shards, piece)),
                            pa.array(np.full(shards, kind, np.int32)),
                            pa.array(np.arange(shards, dtype=np.int32)),
                            packed(np.split(keys, cuts)),
                            packed(np.split(n, cuts)),
                        ],
                        ["piece", "kind", "shard", "keys", "n"],
                    )
                    yield from small(iter([found]), -(-shards // BATCHES))

    return run


def looked_up(rows: pa.Table) -> pa.Table:
    """Group function: counts of a shard's n-grams, its segment of the filter
    built from them, and the level of each piece's n-grams by probing it.

    The exact counts are handed on for words only, as piece -1.
    """
    kind = rows["kind"][0].as_py()
    asked = [np.frombuffer(b.as_buffer(), np.uint64) for b in rows["keys"]]
    n = np.concatenate([np.frombuffer(b.as_buffer(), np.uint32) for b in rows["n"]])
    keys, at = np.unique(np.concatenate(asked), return_inverse=True)
    n = np.bincount(at, n, len(keys)).astype(np.int64)
    level = probed(segment(keys[n > 0], n[n > 0]), keys).astype(np.uint8)[at]
    answers = np.split(level, np.cumsum([len(k) for k in asked])[:-1])
    own = kind == 1
    counts = [keys[n > 0], n[n > 0]]
    nothing = [None] * len(answers)
    return pa.table(
        {
            "piece": pa.array([-1] * own + rows["piece"].to_pylist(), pa.int64()),
            "kind": pa.array([kind] * (own + len(answers)), pa.int32()),
            "shard": pa.array(rows["shard"].to_pylist()[:1] * (own + len(answers)), pa.int32()),
            "keys": pa.array([counts[0].tobytes()] * own + nothing, pa.binary()),
            "n": pa.array([counts[1].tobytes()] * own + nothing, pa.binary()),
            "levels": pa.array([None] * own + [a.tobytes() for a in answers], pa.binary()),
        }
    )


def levels(n: np.ndarray) -> np.ndarray:
    """1 + floor(log2(n))"""
    return np.frexp(n.astype(np.float64))[1].astype(np.int32)


def level_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task function: words and their occurrences by level, and those that occur
    twice with the shard's level 2."""
    for batch in batches:
        for blob in batch.column("n"):
            n = np.frombuffer(blob.as_buffer(), np.int64)
            level = levels(n)
            types = np.bincount(level)
            used = np.flatnonzero(types)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(used.astype(np.int32)),
                    pa.array(types[used]),
                    pa.array(np.bincount(level, n)[used].astype(np.int64)),
                    pa.array(np.where(used == 2, (n == 2).sum(), 0).astype(np.int64)),
                ],
                ["level", "types", "occurrences", "twice"],
            )


def bit_places(keys: np.ndarray, level: int, size: int = 1 << FILTER_BITS) -> Iterator[np.ndarray]:
    """Bits of an n-gram and level in a filter of ``size`` bits."""
    with np.errstate(over="ignore"):
        inner = mix(keys + np.uint64(level) * np.uint64(0xD1342543DE82EF95))
        step = mix(inner) | np.uint64(1)
        for probe in range(PROBES):
            yield (inner + np.uint64(probe) * step) % np.uint64(size)


def segment(keys: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Filter of n-grams that occur ``n`` times each, eight bits to a byte."""
    high = levels(n)
    size = 64 + 8 * (int(high.sum()) * BITS_AN_ENTRY // 8)
    bits = np.zeros(size, bool)
    for level in range(1, int(high.max(initial=0)) + 1):
        for place in bit_places(keys[high >= level], level, size):
            bits[place.astype(np.int64)] = True
    return np.packbits(bits)


def probed(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Level of each n-gram by probing; 0 for those that are not there."""
    out = np.zeros(len(keys), np.int32)
    at = np.arange(len(keys))
    level = 1
    while len(at):
        there = np.ones(len(at), bool)
        for place in bit_places(keys[at], level, 8 * len(bits)):
            byte = bits[(place >> np.uint64(3)).astype(np.int64)]
            there &= (byte >> (np.uint64(7) - (place & np.uint64(7))).astype(np.uint8)) & 1 == 1
        at = at[there]
        out[at] = level
        level += 1
    return out


def count(level: np.ndarray) -> np.ndarray:
    """Mean of the counts of the level: from 2 ** (q - 1) to 2 ** q - 1."""
    level = level.astype(np.float64)
    return np.where(level > 0, (1.5 * 2 ** (level - 1) - 0.5), 0.0)


class Model(NamedTuple):
    bits: np.ndarray  # a filter at hand; none where segments are asked
    words: np.ndarray  # sorted hashes of the most frequent words
    counts: np.ndarray  # and how often each occurs
    n: int  # tokens
    types: int  # different ones
    discount: float  # taken from every word's count for unknown words

    def level(self, keys: np.ndarray) -> np.ndarray:
        return probed(self.bits, keys)

    def log_probabilities(
        self, at: np.ndarray, word: np.ndarray, pair: np.ndarray, end: float, strength: float
    ) -> np.ndarray:
        """log10 probability of each token after the one before it, from the
        counts of different words, the word of each token, and its pair's count.
        ``end`` is the count of the end, which stands before the first token."""
        if not self.n:
            return np.zeros(len(at))
        own = np.where(
            word > 0,
            np.maximum(word - self.discount, 0) / self.n,
            self.discount * self.types / self.n,
        )
        before = np.empty(len(at))
        before[1:] = word[at[:-1]]
        before[:1] = end
        pair = np.minimum(pair, before)
        return np.log10((pair + strength * own[at]) / (before + strength))


def scored(shared, strength: float):
    """Group function: scores, exact sums over frequent words, and rare words of
    a piece's rows, from the levels of its n-grams."""

    def run(rows: pa.Table, found: pa.Table) -> pa.Table:
        model = Model(*shared.value)
        ids, outs, texts = opened(rows["rows"][0])
        seq, sizes = read(Splitter(NOT_SPACE), texts)
        row = np.repeat(np.arange(len(sizes)), sizes)
        found = found.sort_by([("kind", "ascending"), ("shard", "ascending")])
        kind = found["kind"].to_numpy()
        level = [np.frombuffer(b.as_buffer(), np.uint8) for b in found["levels"]]
        words, doubles = (
            np.concatenate([level[i] for i in np.flatnonzero(kind == k)]) for k in (1, 2)
        )
        keys, at = np.unique(seq, return_inverse=True)
        word = count(words)
        pair = count(doubles)[np.unique(pairs(seq), return_inverse=True)[1]]
        end = word[np.searchsorted(keys, END)]
        score = model.log_probabilities(at, word, pair, end, strength)
        place = np.searchsorted(model.words, keys)
        place[place == len(model.words)] = 0
        hit = model.words[place] == keys if len(model.words) else np.zeros(len(keys), bool)
        log = np.log10(model.counts + 1.0)
        value = np.where(hit, log[place] if len(log) else 0.0, 0.0)
        rare = np.flatnonzero(~hit[at])
        cuts = np.searchsorted(row[rare], np.arange(1, len(sizes)))
        n = len(sizes)
        return pa.table(
            {
                "doc_id": ids,
                "held_out": outs,
                "n_tokens": pa.array(sizes.astype(np.int64)),
                "known": pa.array(np.bincount(row, hit[at], n).astype(np.int64)),
                "logs": pa.array(np.bincount(row, value[at], n)),
                "score": pa.array(np.bincount(row, score, n)),
                "rare": packed(np.split(seq[rare], cuts)),
            }
        )

    return run


def rare_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [np.frombuffer(b.as_buffer(), np.uint64) for b in batch.column(1)]
        row = np.repeat(batch.column(0).to_numpy(), [len(s) for s in sets])
        word = np.concatenate([*sets, np.zeros(0, np.uint64)]).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(word)], [ROW, "word"])


def word_counts(least: int, below: int | None):
    """Task function: counts of words, those of at least ``least`` and below ``below``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, n in zip(batch.column("keys"), batch.column("n"), strict=True):
                keys = np.frombuffer(keys.as_buffer(), np.uint64)
                n = np.frombuffer(n.as_buffer(), np.int64)
                keep = (n >= least) & (n < below if below else True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[keep].astype(np.int64)), pa.array(n[keep])], ["word", "n"]
                )

    return run


def train(pieces: DataFrame, n_bytes: int) -> tuple[Model, DataFrame, int]:
    """The model of the training rows of pieces of ``n_bytes`` without its filter,
    the table of word counts (piece -1) and levels of each piece's n-grams, and
    the count from which on words are in the model's table."""
    # By the size of the texts, not by a setting: segments, and so the filter's
    # errors, are the same in every session. Several make a task.
    shards = min(1 << max(n_bytes // SHARD_BYTES, 63).bit_length(), MOST_SHARDS)
    parts = pieces.mapInArrow(
        counted(shards), "piece bigint, kind int, shard int, keys binary, n binary"
    )
    found = parts.groupBy("kind", "shard").applyInArrow(
        looked_up, "piece bigint, kind int, shard int, keys binary, n binary, levels binary"
    )
    found = materialize(found, "counts")
    counts = found.filter("piece = -1")
    by_level = counts.select("n").mapInArrow(
        level_counts, "level int, types bigint, occurrences bigint, twice bigint"
    )
    by_level = by_level.groupBy("level").agg(
        F.sum("types").alias("types"), F.sum("occurrences").alias("n"), F.sum("twice").alias("two")
    )
    words = {r["level"]: r for r in by_level.collect()}  # at most 64 rows
    n = sum(r["n"] for r in words.values())
    types = sum(r["types"] for r in words.values())
    once = words[1]["types"] if 1 in words else 0
    twice = words[2]["two"] if 2 in words else 0
    discount = once / (once + 2 * twice) if once else 0.5
    # Exact counts of frequent words, from the power of two on from which they fit.
    level, kept = 64, 0
    while level > 1 and kept + (words[level - 1]["types"] if level - 1 in words else 0) <= TABLE:
        level -= 1
        kept += words[level]["types"] if level in words else 0
    least = 1 << (level - 1)
    frequent = counts.select("keys", "n").mapInArrow(
        word_counts(least, None), "word bigint, n bigint"
    )
    frequent = frequent.toArrow()  # at most TABLE rows
    keys = frequent["word"].to_numpy().astype(np.uint64)
    order = np.argsort(keys)
    none = np.zeros(0, np.uint8)
    model = Model(none, keys[order], frequent["n"].to_numpy()[order], n, types, discount)
    return model, found, least


def score_texts(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    strength: float = STRENGTH,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``held_out``, ``n_tokens``,
    ``n_known``, ``train_tokens``, ``base_score`` and ``score``.

    The model learns from the rows that are not held out. A null or empty text
    is its end alone, one token. Without training rows no token is known and
    all scores are 0. Repeated rows count, and are scored, as often as they
    occur; a null id counts as an empty one for the fold. Other columns are not
    read. ``base_score`` is exact but for 64-bit hashes of words; ``score`` is
    subject to the filter's errors.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        held_out(F.col(id_col), FOLDS, HELD_OUT).alias("held_out"),
        F.col(text_col).cast("string").alias("t"),
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    with arrow_batches(docs.sparkSession, BATCH):
        pieces = materialize(rows.mapInArrow(in_pieces, "piece bigint, rows binary"), "pieces")
        n_bytes = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
        model, counts, least = train(pieces, n_bytes)
        # Plain arrays: executors need no class of this package to read them.
        shared = docs.sparkSession.sparkContext.broadcast(tuple(model))
        answers = counts.filter("piece >= 0").select("piece", "kind", "shard", "levels")
        found = pieces.groupBy("piece").cogroup(answers.groupBy("piece")).applyInArrow(
            scored(shared, strength),
            f"doc_id {kind}, held_out boolean, n_tokens bigint, known bigint, logs double, "
            "score double, rare binary",
        )
        found = numbered(found, "scores")
        discard(pieces)
        rare = found.filter(F.octet_length("rare") > 0).select(ROW, "rare")
        rare = rare.mapInArrow(rare_words, f"{ROW} bigint, word bigint")
        others = counts.filter("piece = -1").select("keys", "n").mapInArrow(
            word_counts(1, least), "word bigint, n bigint"
        )
        rare = rare.join(others, "word").groupBy(ROW)
        rare = rare.agg(F.count("*").alias("more"), F.sum(F.log10(F.col("n") + 1)).alias("more_logs"))
        rare = materialize(rare, "rare")
        discard(counts)
    none = F.lit(0)
    size = F.lit(float(model.n + model.types + 1))
    return found.join(rare, ROW, "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("more", none)).alias("n_known"),
        F.lit(model.n).cast("bigint").alias("train_tokens"),
        (
            F.col("logs") + F.coalesce("more_logs", none) - F.col("n_tokens") * F.log10(size)
        ).alias("base_score"),
        "score",
    )
