"""Helpers that several corpus operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockflow.session import materialize

ROW = "__row"
WORDS_A_CHUNK = 1 << 14  # of a Bloom filter: 64 KiB


def numbered(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once, each row with a number of its own in ``__row``.

    The numbers exist only in the written table, so they are the same however
    often it is read.
    """
    return materialize(df.withColumn(ROW, F.monotonically_increasing_id()), label)


def small(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in pieces, for functions that hold much for each row."""
    for batch in batches:
        for low in range(0, batch.num_rows, rows):
            yield batch.slice(low, rows)


def packed(values: list[np.ndarray]) -> pa.Array:
    """One binary value per array."""
    return pa.array([v.tobytes() for v in values], pa.binary())


def filled_chunks(width: int):
    """Task function: the chunks of a Bloom filter from its words, compressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks: dict[int, np.ndarray] = {}
        for batch in batches:
            word = batch.column("word").to_numpy()
            found = batch.column("set").to_numpy().astype(np.uint32)
            for chunk in np.unique(word // width).tolist():
                own = word // width == chunk
                if chunk not in chunks:
                    chunks[chunk] = np.zeros(width, np.uint32)
                chunks[chunk][word[own] % width] = found[own]
        for chunk, words in chunks.items():
            blob = zstandard.compress(words.tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array([chunk], pa.int64()), pa.array([blob], pa.binary())], ["chunk", "words"]
            )

    return run


def bitmap(keys: DataFrame, column: str, bits: int, probes: int = 1) -> np.ndarray:
    """Bloom filter of ``2 ** bits`` bits with ``probes`` bits for each 64-bit key.

    Its size does not depend on the number of keys; with many keys it lets
    more strangers through, so whoever uses it has to join afterwards. The
    driver gets it as compressed chunks.
    """
    turned = [
        F.shiftleft(F.col(column), 13 * turn).bitwiseOR(
            F.shiftrightunsigned(F.col(column), 64 - 13 * turn)
        )
        if turn
        else F.col(column)
        for turn in range(probes)
    ]
    words = (
        keys.select(F.explode(F.array(*turned)).alias("h"))
        .select(F.shiftrightunsigned("h", 64 - bits).alias("slot"))
        .groupBy(F.shiftright("slot", 5).alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(slot & 31 as int)))").alias("set"))
    )
    filled = np.zeros(1 << (bits - 5), np.uint32)
    width = min(WORDS_A_CHUNK, len(filled))
    parts = words.repartition(F.floor(F.col("word") / width))
    table = parts.mapInArrow(filled_chunks(width), "chunk bigint, words binary").toArrow()
    for chunk, blob in zip(table["chunk"], table["words"], strict=True):
        own = np.frombuffer(zstandard.decompress(blob.as_py()), np.uint32)
        filled[chunk.as_py() * width :][:width] = own
    return filled


def in_bitmap(filled: np.ndarray, hashes: np.ndarray, probes: int = 1) -> np.ndarray:
    bits = len(filled).bit_length() - 1 + 5
    found = np.ones(len(hashes), bool)
    for turn in range(probes):
        turned = hashes
        if turn:
            turned = (hashes << np.uint64(13 * turn)) | (hashes >> np.uint64(64 - 13 * turn))
        slot = turned >> np.uint64(64 - bits)
        word = filled[(slot >> np.uint64(5)).astype(np.int64)]
        found &= ((word >> (slot & np.uint64(31)).astype(np.uint32)) & 1).astype(bool)
    return found


def held_out(doc_id: Column, modulus: int, rest: int = 2) -> Column:
    """Whether the crc32 of the id as text leaves ``rest``; null ids count as ''."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % modulus == rest


def salted(column: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(parts)).cast("int")
