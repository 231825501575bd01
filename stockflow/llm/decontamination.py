"""Benchmark decontamination by winnowing.

Both sides select the same fingerprints: of every ``window`` consecutive
k-grams the rightmost with the smallest hash. Any shared run of
``span = k + window - 1`` words therefore shares a fingerprint. Documents keep
a fingerprint only if a bounded bitmap of the benchmark's fingerprints may hold
it; those are joined exactly and each match is extended word by word both ways.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.llm.common import ROW, bitmap, in_bitmap, numbered, packed
from stockflow.llm.words import ALPHANUMERIC, Splitter, grams, inside_row
from stockflow.operators.joins import join_lookup
from stockflow.session import materialize

SPAN = 13  # words of a window; a shorter item is a window by itself
GRAM = 9  # words of a fingerprint
BITS = 25  # the bitmap has 2 ** BITS bits, 4 MiB
SHARE = 20  # contaminated: at least one word in SHARE is hit


def winnow(hashes: np.ndarray, ends: np.ndarray, span: int, gram: int) -> tuple:
    """Positions and hashes of the selected k-grams of the rows."""
    window = span - gram + 1
    keys = grams(hashes, gram)
    whole = inside_row(ends, len(hashes), span)
    n = len(whole)
    if not n:
        return np.zeros(0, np.int64), keys[:0]
    least = keys[:n].copy()
    for step in range(1, window):
        np.minimum(least, keys[step : step + n], out=least)
    chosen = np.zeros(len(keys), bool)
    open_ = whole.copy()
    for step in range(window - 1, -1, -1):
        here = open_ & (keys[step : step + n] == least)
        chosen[step : step + n] |= here
        open_ &= ~here
    at = np.flatnonzero(chosen)
    return at, keys[at]


def contexts(hashes: np.ndarray, ends: np.ndarray, at: np.ndarray, reach: int, width: int):
    """Word hashes around each position, zero beyond the row."""
    row = np.searchsorted(ends, at, "right")
    low = np.concatenate([[0], ends])[row]
    spots = at[:, None] + np.arange(-reach, width - reach)[None, :]
    within = (spots >= low[:, None]) & (spots < ends[row][:, None])
    return np.where(within, hashes[np.clip(spots, 0, max(len(hashes) - 1, 0))], np.uint64(0)), row


def item_windows(span: int, gram: int):
    """Task function: fingerprints of benchmark items with their surroundings."""
    reach = span - gram
    width = span + reach

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = Splitter(ALPHANUMERIC)
        for batch in batches:
            ids = batch.column(0)
            for part in splitter.split(batch.column(1)):
                counts = np.diff(part.ends, prepend=0)
                at, keys = winnow(part.hashes, part.ends, span, gram)
                around, row = contexts(part.hashes, part.ends, at, reach, width)
                yield _items(ids, part.first + row, np.zeros(len(at)), keys, around)
                short = np.flatnonzero((counts > 0) & (counts < span))
                for n in np.unique(counts[short]):
                    rows = short[counts[short] == n]
                    at = part.ends[rows] - n
                    around, _ = contexts(part.hashes, part.ends, at, reach, width)
                    keys = grams(part.hashes, int(n))[at] ^ np.uint64(n)
                    yield _items(ids, part.first + rows, np.full(len(rows), n), keys, around)

    return run


def _items(ids, rows, kind, keys, around) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            ids.take(pa.array(rows)),
            pa.array(kind.astype(np.int32)),
            pa.array(keys.astype(np.int64)),
            packed(list(around)),
        ],
        ["item_id", "kind", "f", "item_words"],
    )


def document_windows(span: int, gram: int, shorts: list[int], known):
    """Task function: word count of each document, and its fingerprints that the
    bitmap lets through as packed (position, hash, surroundings) records."""
    reach = span - gram
    width = span + reach

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = Splitter(ALPHANUMERIC)
        for batch in batches:
            for part in splitter.split(batch.column(1)):
                at, keys = winnow(part.hashes, part.ends, span, gram)
                for n in shorts:
                    spots = np.flatnonzero(inside_row(part.ends, len(part.hashes), n))
                    at = np.concatenate([at, spots])
                    keys = np.concatenate(
                        [keys, grams(part.hashes, n)[spots] ^ np.uint64(n)]
                    )
                passed = in_bitmap(known.value, keys)
                at, keys = at[passed], keys[passed]
                around, row = contexts(part.hashes, part.ends, at, reach, width)
                starts = np.concatenate([[0], part.ends])[:-1]
                records = np.zeros(len(at), record(width))
                records["at"], records["f"], records["words"] = at - starts[row], keys, around
                order = np.argsort(row, kind="stable")
                cuts = np.searchsorted(row[order], np.arange(1, part.rows))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(part.first, part.rows),
                        pa.array(np.diff(part.ends, prepend=0)),
                        packed(np.split(records[order], cuts)),
                    ],
                    ["doc_id", "n_words", "records"],
                )

    return run


def record(width: int) -> np.dtype:
    return np.dtype([("at", "<i8"), ("f", "<u8"), ("words", "<u8", (width,))])


def unpacked(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, blob in zip(batch.column(0), batch.column(1), strict=True):
                found = np.frombuffer(blob.as_py(), record(width))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(found), row.as_py(), np.int64)),
                        pa.array(found["at"]),
                        pa.array(found["f"].astype(np.int64)),
                        packed(list(found["words"])),
                    ],
                    [ROW, "at", "f", "doc_words"],
                )

    return run


def extended(span: int, gram: int):
    """Task function: matching words to both sides of a shared fingerprint."""
    reach = span - gram

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            column = {name: batch.column(name) for name in batch.schema.names}
            if not n:
                continue
            ours, theirs = (
                np.frombuffer(b"".join(column[c].to_pylist()), np.uint64).reshape(n, -1)
                for c in ("doc_words", "item_words")
            )
            same = (ours == theirs) & (theirs != 0)
            kind = column["kind"].to_numpy()
            size = np.where(kind > 0, kind, gram)
            inner = np.arange(same.shape[1])[None, :] - reach
            core = (same | (inner < 0) | (inner >= size[:, None])).all(1)
            left = np.cumprod(same[:, :reach][:, ::-1], 1).sum(1)
            right = np.cumprod(same[:, reach + gram :], 1).sum(1)
            left, right = np.where(kind > 0, 0, left), np.where(kind > 0, 0, right)
            hit = core & ((kind > 0) | (left + gram + right >= span))
            at = column["at"].to_numpy()
            yield pa.RecordBatch.from_arrays(
                [
                    column[ROW].filter(pa.array(hit)),
                    pa.array((at - left)[hit]),
                    pa.array((at + size + right)[hit].astype(np.int64)),
                    column["context"].filter(pa.array(hit)),
                ],
                [ROW, "start", "end", "context"],
            )

    return run


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    span: int = SPAN,
    gram: int = GRAM,
    bits: int = BITS,
    share: int = SHARE,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_words``, ``n_hit``,
    ``n_items``, ``items`` (ids of items found, sorted as strings),
    ``spans`` (runs of hit words, start and end) and ``contaminated``.

    Null or empty texts have no words and are never contaminated; an item
    without words matches nothing; items with a null id count for hits, not in
    ``items``. Repeated rows and ids get a row each. An empty benchmark hits
    nothing. Other columns, whatever their names, are not read.
    """
    if not 0 < gram <= span:
        raise ValueError("a fingerprint has between one word and span words")
    spark = docs.sparkSession
    items = benchmark.select(
        F.col(item_col).cast("string").alias("item_id"), F.col(item_text_col).alias("t")
    ).mapInArrow(
        item_windows(span, gram), "item_id string, kind int, f bigint, item_words binary"
    )
    items = items.withColumn("context", F.xxhash64("kind", "f", "item_words"))
    items = materialize(items.distinct(), "benchmark")
    shorts = [r[0] for r in items.filter("kind > 0").select("kind").distinct().collect()]
    known = spark.sparkContext.broadcast(bitmap(items, "f", bits))
    width = 2 * span - gram
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("t"))
    id_type = texts.schema["doc_id"].dataType.simpleString()
    counted = numbered(
        texts.mapInArrow(
            document_windows(span, gram, sorted(shorts), known),
            f"doc_id {id_type}, n_words bigint, records binary",
        ),
        "words",
    )
    known.destroy()
    met = counted.filter(F.octet_length("records") > 0).select(ROW, "records")
    met = met.mapInArrow(unpacked(width), f"{ROW} bigint, at bigint, f bigint, doc_words binary")
    # Items with the same surroundings are compared once.
    windows = items.select("f", "kind", "context", "item_words").distinct()
    hits = join_lookup(met, windows, ["f"]).mapInArrow(
        extended(span, gram), f"{ROW} bigint, start bigint, end bigint, context bigint"
    )
    hits = materialize(hits, "hits")
    covered = hits.groupBy(ROW).agg(
        F.array_sort(F.collect_set(F.struct("start", "end"))).alias("runs")
    )
    joined = F.expr(
        """aggregate(runs, cast(array() as array<struct<start: bigint, end: bigint>>),
             (done, r) -> CASE WHEN size(done) > 0 AND element_at(done, -1).end >= r.start
               THEN concat(slice(done, 1, size(done) - 1),
                           array(named_struct('start', element_at(done, -1).start,
                                 'end', greatest(element_at(done, -1).end, r.end))))
               ELSE concat(done, array(named_struct('start', r.start, 'end', r.end))) END)"""
    )
    covered = covered.select(ROW, joined.alias("spans"))
    per_item = hits.select(ROW, "context").distinct()
    per_item = join_lookup(
        per_item, items.filter("item_id is not null").select("context", "item_id").distinct(),
        ["context"],
    )
    per_item = per_item.groupBy(ROW).agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    none = F.array().cast("array<string>")
    no_spans = F.array().cast("array<struct<start: bigint, end: bigint>>")
    out = (
        counted.drop("records")
        .join(covered, ROW, "left")
        .join(per_item, ROW, "left")
        .withColumn("items", F.coalesce("items", none))
        .withColumn("spans", F.coalesce("spans", no_spans))
    )
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return out.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        "items",
        "spans",
        ((n_hit > 0) & (share * n_hit >= F.col("n_words"))).alias("contaminated"),
    )
