"""Logistic models over the words of texts and the beginnings of words.

A model is trained on a bounded sample of labelled rows. Which words count is
found by grouped counts on the executors; only the few that discriminate reach
the driver, which fits their weights.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockflow.llm.common import packed, small
from stockflow.llm.words import ALPHANUMERIC, Splitter, Words, mix
from stockflow.session import materialize

BEGINNINGS = (3, 4, 5, 6)  # bytes of a word's beginning that count as features
SAMPLE_ROWS = 40_000  # labelled rows a model is trained on, at most about this many
FEATURES = 8192  # features a model keeps, those with the largest z-scores
LEAST_Z = 4.0
LEAST_ROWS = 4  # sampled rows that a feature must occur in
SPLIT_ROWS = 512  # texts whose features a task holds at once
COUNTED_ROWS = 2048  # the same where it counts them
SLOT_BITS = 22
_ROW = np.uint64(0x9FB21C651E98DF25)


def splitter_for(shapes: bool) -> Splitter:
    return Splitter(ALPHANUMERIC, beginnings=BEGINNINGS, count_kinds=shapes)


def shape_features(part: Words) -> list[np.ndarray]:
    """For each row which range some measures of its text fall into: shares of
    signs, digits and capitals, length of words, share of different words."""
    size, *kinds = part.kinds
    n = np.diff(part.ends, prepend=0)
    row = part.row_of_word()
    with np.errstate(over="ignore"):
        keys = np.unique(mix(part.hashes + row.astype(np.uint64) * _ROW), return_index=True)[1]
    different = np.bincount(row[keys], minlength=part.rows)
    length = np.bincount(row, part.at[:, 1] - part.at[:, 0] if len(row) else None, part.rows)
    measures = [8 * np.log2(1 + 100 * k / np.maximum(size, 1)) for k in kinds]
    measures += [2 * length / np.maximum(n, 1), 20 * different / np.maximum(n, 1)]
    return [
        mix((np.uint64(spot + 1) << np.uint64(40)) + m.astype(np.uint64))
        for spot, m in enumerate(measures)
    ]


class Model(NamedTuple):
    features: np.ndarray  # sorted 64-bit hashes
    weights: np.ndarray
    intercept: float
    shapes: bool = False

    def logits(self, texts: pa.Array, splitter: Splitter, slots: np.ndarray) -> np.ndarray:
        """Log-odds of each text; every feature counts once however often it occurs."""
        out = np.full(len(texts), self.intercept)
        for part in splitter.split(texts):
            words = part.row_of_word()
            sets = [(words, k) for k in (part.hashes, *part.starts_with.values())]
            if self.shapes:
                sets += [(np.arange(part.rows), k) for k in shape_features(part)]
            for row, keys in sets:
                near = np.flatnonzero(slots[(keys >> np.uint64(64 - SLOT_BITS)).astype(np.int64)])
                at = np.searchsorted(self.features, keys[near])
                at[at == len(self.features)] = 0
                hit = self.features[at] == keys[near]
                pairs = np.unique(row[near][hit] * len(self.features) + at[hit])
                rows, features = np.divmod(pairs, len(self.features))
                out[part.first : part.first + part.rows] += np.bincount(
                    rows, self.weights[features], part.rows
                )
        return out

    def slots(self) -> np.ndarray:
        out = np.zeros(1 << SLOT_BITS, bool)
        out[(self.features >> np.uint64(64 - SLOT_BITS)).astype(np.int64)] = True
        return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def feature_sets(texts: pa.Array, splitter: Splitter) -> list[np.ndarray]:
    """Distinct features of each text."""
    out = []
    for part in splitter.split(texts):
        low = 0
        shapes = np.stack(shape_features(part), 1) if splitter.count_kinds else None
        for row, high in enumerate(part.ends):
            keys = [part.hashes[low:high], *(b[low:high] for b in part.starts_with.values())]
            if shapes is not None:
                keys.append(shapes[row])
            keys = np.unique(np.concatenate(keys))
            out.append(keys[keys != 0])
            low = high
    return out


def label_sample(labels: DataFrame, id_col: str, rows: int) -> DataFrame:
    """About ``rows`` of the labelled ids at most, the same on every run."""
    n = max(labels.count(), 1)
    share = min(1.0, rows / n)
    draw = F.pmod(F.xxhash64(F.lit(17), F.col(id_col)), F.lit(1 << 30))
    return labels.filter(draw < int(share * (1 << 30)))


def labelled_texts(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, rows: int
) -> DataFrame:
    """Sampled texts with a label of 0 or 1 (the highest where an id has several)."""
    labels = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
    labels = labels.groupBy(F.col(id_col).alias("id"))
    labels = label_sample(labels.agg(F.max(label_col).cast("int").alias("y")), "id", rows)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t"))
    # At most ``rows`` pairs of numbers: their size is bounded.
    return texts.join(F.broadcast(labels), "id").select("y", "t")


def features_of(
    batches: Iterator[pa.RecordBatch], swap, shapes: bool, rows: int
) -> Iterator[tuple[pa.Array, list[np.ndarray], dict[int, np.ndarray]]]:
    """Labels, features of each text, and by row those of its counterfactual where
    that differs: texts that mention nothing are their own."""
    splitter = splitter_for(shapes)
    for batch in small(batches, rows):
        texts = batch.column(1)
        own, at, swapped = feature_sets(texts, splitter), [], []
        if swap:
            for i, text in enumerate(texts):
                plain = text.as_py() or ""
                other = swap(plain)
                if other != plain:
                    at.append(i)
                    swapped.append(other)
        moved = feature_sets(pa.array(swapped, pa.string()), splitter)
        yield batch.column(0), own, dict(zip(at, moved, strict=True))


def feature_counts(swap, shapes: bool):
    """Task function: rows and positive rows of each feature, and the features that
    a counterfactual takes from a text or gives it."""

    def counted(values: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        joined = np.concatenate(values) if values else np.zeros(0, np.uint64)
        return np.unique(joined, return_counts=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for labels, own, other in features_of(batches, swap, shapes, COUNTED_ROWS):
            keys, n = counted(own)
            some, count = counted([k for k, y in zip(own, labels.to_pylist(), strict=True) if y])
            positive = np.zeros(len(keys), np.int64)
            positive[np.searchsorted(keys, some)] = count
            moved = counted([np.setxor1d(own[i], keys) for i, keys in other.items()])[0]
            none = np.zeros(len(moved), np.int64)
            for columns in ((keys, positive, n, False), (moved, none, none, True)):
                hashes, positives, all_, swapped = columns
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(hashes.view(np.int64)),
                        pa.array(positives),
                        pa.array(all_),
                        pa.array(np.full(len(hashes), swapped)),
                    ],
                    ["feature", "positive", "n", "swapped"],
                )

    return run


def kept_features(chosen, swap, shapes: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def places(keys: np.ndarray) -> np.ndarray:
            at = np.searchsorted(chosen.value, keys)
            at[at == len(chosen.value)] = 0
            return at[chosen.value[at] == keys].astype(np.int32)

        for labels, own, other in features_of(batches, swap, shapes, SPLIT_ROWS):
            kept = [places(keys) for keys in own]
            moved = [places(other[i]) if i in other else keys for i, keys in enumerate(kept)]
            yield pa.RecordBatch.from_arrays(
                [labels, packed(kept), packed(moved)], ["y", "own", "other"]
            )

    return run


def train(
    sample: DataFrame,
    *,
    swap=None,
    penalty: float = 0.0,
    ridge: float = 1e-4,
    shapes: bool = False,
    most: int = FEATURES,
) -> Model:
    """Fit the labels ``y`` of the texts ``t`` of a bounded sample.

    ``swap`` makes a counterfactual of a text; ``penalty`` weighs the squared
    change of the log-odds between the two; with ``shapes`` measures of the text
    count beside its words. Without both labels in the sample
    the model is a constant.
    """
    spark = sample.sparkSession
    # The texts, which two passes read: their features are several times as large.
    rows = materialize(sample.select("y", "t"), "sample")
    n, positive = rows.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).first()
    rate = (positive + 0.5) / (n + 1)
    if not 0 < positive < n:
        base = float(np.log(rate / (1 - rate)))
        return Model(np.zeros(1, np.uint64), np.zeros(1), base)
    counts = rows.mapInArrow(
        feature_counts(swap, shapes), "feature bigint, positive bigint, n bigint, swapped boolean"
    )
    counts = counts.groupBy("feature").agg(
        F.sum("positive").alias("positive"), F.sum("n").alias("n"), F.max("swapped").alias("swapped")
    )
    chosen = counts.withColumn("z", _z(F.col("positive"), F.col("n"), positive, n))
    chosen = chosen.filter(f"swapped or (n >= {LEAST_ROWS} and abs(z) >= {LEAST_Z})")
    chosen = chosen.orderBy(F.desc("swapped"), F.desc(F.abs("z")), "feature").limit(most)
    features = np.sort(chosen.select("feature").toArrow()["feature"].to_numpy().astype(np.uint64))
    if not len(features):
        return Model(np.zeros(1, np.uint64), np.zeros(1), float(np.log(rate / (1 - rate))))
    shared = spark.sparkContext.broadcast(features)
    table = rows.mapInArrow(
        kept_features(shared, swap, shapes), "y int, own binary, other binary"
    )
    table = (table if swap else table.drop("other")).toArrow()
    y = table["y"].to_numpy().astype(float)
    own = Sparse.of(table["own"], len(features))
    other = Sparse.of(table["other"], len(features)) if swap else own
    del table
    weights, intercept = fit(own, other, y, penalty, ridge)
    return Model(features, weights, intercept, shapes)


def _z(positive: Column, n: Column, all_positive: int, all_: int) -> Column:
    """How far the positive rows of a feature are from their expected number."""
    rate = all_positive / all_
    # Features of counterfactuals alone occur in no row.
    return (positive - n * rate) / F.sqrt(F.greatest(n, F.lit(1)) * rate * (1 - rate))


class Sparse(NamedTuple):
    rows: np.ndarray
    columns: np.ndarray
    shape: tuple[int, int]

    @classmethod
    def of(cls, blobs, width: int) -> Sparse:
        lists = [np.frombuffer(b.as_buffer(), np.int32) for b in blobs]
        sizes = [len(x) for x in lists]
        columns = np.concatenate(lists) if lists else np.zeros(0, np.int32)
        rows = np.repeat(np.arange(len(lists), dtype=np.int32), sizes)
        return cls(rows, columns, (len(lists), width))

    def times(self, x: np.ndarray) -> np.ndarray:
        return np.bincount(self.rows, x[self.columns], self.shape[0])

    def transposed_times(self, x: np.ndarray) -> np.ndarray:
        return np.bincount(self.columns, x[self.rows], self.shape[1])


def fit(
    own: Sparse, other: Sparse, y: np.ndarray, penalty: float, ridge: float, rounds: int = 400
) -> tuple[np.ndarray, float]:
    """Accelerated gradient descent, each weight scaled by how often it is used."""
    n, width = own.shape
    pairs = max(int((own.times(np.ones(width)) != 0).sum()), 1) if penalty else 1
    weights, intercept = np.zeros(width), float(np.log(y.mean() / (1 - y.mean())))
    used = own.transposed_times(np.ones(n)) / n
    moved = own.transposed_times(np.ones(n)) + other.transposed_times(np.ones(n))
    busy = max(own.times(np.ones(width)).max(), 1.0)
    scale = 1 / (busy * (used / 4 + (4 * penalty * moved / pairs if penalty else 0)) + ridge)
    ahead, before, speed = weights, weights, 1.0
    for _ in range(rounds):
        error = sigmoid(own.times(ahead) + intercept) - y
        slope = own.transposed_times(error) / n + ridge * ahead
        if penalty:
            change = own.times(ahead) - other.times(ahead)
            slope += (
                2 * penalty / pairs * (own.transposed_times(change) - other.transposed_times(change))
            )
        weights = ahead - scale * slope
        intercept -= 4 * error.mean() / busy
        faster = (1 + np.sqrt(1 + 4 * speed**2)) / 2
        ahead = weights + (speed - 1) / faster * (weights - before)
        before, speed = weights, faster
    return weights, float(intercept)


def scored(docs: DataFrame, model: Model, text_col: str, keep: list[str]) -> DataFrame:
    """``keep`` columns of every row and ``logit``; null texts count as empty."""
    # Plain arrays: executors need no class of this package to read them.
    shared = docs.sparkSession.sparkContext.broadcast((tuple(model), model.slots()))
    # A text that is kept crosses to Python once.
    rows = docs.select(*keep) if text_col in keep else docs.select(*keep, text_col)
    at = rows.columns.index(text_col)
    n = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, slots = shared.value
        fitted = Model(*values)
        splitter = splitter_for(fitted.shapes)
        for batch in small(batches, 2048):
            logits = fitted.logits(batch.column(at), splitter, slots)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:n], pa.array(logits)], [*batch.schema.names[:n], "logit"]
            )

    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:n]]
    return rows.mapInArrow(run, ", ".join([*kept, "logit double"]))
