"""Near-duplicate embeddings by collision-counting projections.

Equal vectors fold into classes. Several tables route the unit vectors to cells
by a few quantised projections each. Within a cell the vectors are sorted by
another projection; those in a window around a vector are paired with it, and
in how many of further projections the one lies in the other's window is
counted. Pairs with enough such collisions are verified by their cosine in
double precision. Numbers of projections, tables and collisions
follow from the threshold, the recall asked for and the number of vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, comb, erf, exp, log, pi, sqrt
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.llm.common import packed
from stockflow.llm.components import components
from stockflow.operators.joins import join_lookup
from stockflow.session import materialize, spread

COSINE = 0.95
RECALL = 0.999  # of pairs that just reach the threshold; closer pairs have more
COUNTED = 24  # projections whose collisions are counted
CELL = 64  # strangers a vector should meet in a cell
BLOCK = 1024  # rows of a cell that are compared with as many others in one go
ROWS = 4096  # sorted rows that are taken up at a time
SEED = 5


class Design(NamedTuple):
    first: float  # half width of the window in which pairs are looked for
    window: float  # half width of the windows in which collisions count
    least: int  # collisions that a pair needs
    width: float  # of a quantised projection
    keys: int  # quantised projections of a table
    tables: int


def design(n: int, cosine: float, recall: float) -> Design:
    """Calibrates the search for ``n`` unit vectors.

    Projections of two vectors differ by a normal amount whose deviation is
    their distance: at most ``far`` for a pair to be found, about the square
    root of two for strangers.
    """
    far = sqrt(2 - 2 * cosine)
    first, window = 3.9 * far, 2 * far  # the first one misses one pair in ten thousand
    inside = erf(window / far / sqrt(2))
    least, missed = 0, 0.0
    while least < COUNTED:
        missed += comb(COUNTED, least) * inside**least * (1 - inside) ** (COUNTED - least)
        if missed > (1 - recall) / 10:
            break
        least += 1
    width = 4 * far

    def same(deviation: float) -> float:
        """Chance of one quantised value: the mean of max(0, 1 - difference / width)."""
        z = width / deviation
        return erf(z / sqrt(2)) - sqrt(2 / pi) / z * (1 - exp(-z * z / 2))

    near, strange = same(far), same(sqrt(2))
    keys = max(1, ceil(log(max(n, 1) / CELL) / log(1 / strange)))
    tables = ceil(log((1 - recall) * 0.9) / log(1 - near**keys))
    return Design(first, window, max(least, 1), width, keys, tables)


def unit_vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task function: vectors of length one, null where there is none."""
    for batch in batches:
        units = []
        for vector in batch.column(1):
            values = vector.values if vector.is_valid else None
            if values is None or values.null_count or not len(values):
                units.append(None)
                continue
            x = values.to_numpy(zero_copy_only=False).astype(np.float64)
            top = np.abs(x).max()
            if not np.isfinite(top) or top == 0:
                units.append(None)
                continue
            x = x / top
            units.append((x / sqrt(x @ x)).tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(units, pa.binary())], ["vec_id", "unit"]
        )


def gaussians(size: int, n: int, seed: int) -> np.ndarray:
    return np.random.default_rng([SEED, seed, size]).standard_normal((size, n))


def cell_keys(units: np.ndarray, how: Design) -> np.ndarray:
    """A hash for each vector and table."""
    size = units.shape[1]
    shape = (len(units), how.tables, how.keys)
    values = units @ gaussians(size, how.tables * how.keys, 1)
    offsets = np.random.default_rng([SEED, 2, size]).random(how.tables * how.keys)
    cells = np.floor(values / how.width + offsets).astype(np.int64).reshape(shape)
    out = np.full(shape[:2], size, np.uint64)
    with np.errstate(over="ignore"):
        for spot in range(how.keys):
            out = (out ^ cells[:, :, spot].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
    return out.astype(np.int64)


def stacked(blobs) -> np.ndarray:
    return np.frombuffer(b"".join(b.as_py() for b in blobs), np.float64).reshape(len(blobs), -1)


def routed(how: Design):
    """Task function: the cells of each class, one row per table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.array([len(u.as_buffer()) for u in batch.column(1)], np.int64)
            for size in np.unique(sizes):
                at = pa.array(np.flatnonzero(sizes == size))
                keys = cell_keys(stacked(batch.column(1).take(at)), how)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(batch.column(0).take(at).to_numpy(), how.tables)),
                        pa.array(np.tile(np.arange(how.tables, dtype=np.int32), len(at))),
                        pa.array(keys.ravel()),
                    ],
                    ["class", "table", "cell"],
                )

    return run


def window_pairs(values: np.ndarray, group: np.ndarray, window: float) -> tuple:
    """Pairs of rows of one group that lie within ``window`` of each other.

    All groups are sorted at once, each on a stretch of its own of one line; the
    window ahead of a row is then a run of the sorted rows.
    """
    wide = np.ptp(values) + 2 * window + 1 if len(values) else 1.0
    line = values + group * wide
    order = np.argsort(line, kind="stable")
    line = line[order]
    ahead = np.searchsorted(line, line + window, "right") - np.arange(len(line)) - 1
    i = np.repeat(np.arange(len(line)), ahead)
    j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(ahead) - ahead, ahead)
    return order[i], order[j]


def linked(
    units: np.ndarray, group: np.ndarray, half: np.ndarray, how: Design, cosine: float
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of one group that link.

    A group that holds rows of both halves compares those of one half with
    those of the other.
    """
    values = units @ gaussians(units.shape[1], COUNTED, 3)
    both = np.bincount(group[half == 1], minlength=group.max() + 1) > 0
    i, j = window_pairs(values[:, 0], group, how.first)
    meet = ~both[group[i]] | (half[i] != half[j])
    i, j = i[meet], j[meet]
    count = np.zeros(len(i), np.int8)
    for spot in range(COUNTED):
        line = values[:, spot]
        count += np.abs(line[i] - line[j]) <= how.window
        left = COUNTED - 1 - spot
        if spot % 6 == 5:  # pairs that cannot reach the number any more go
            able = count + left >= how.least
            i, j, count = i[able], j[able], count[able]
    close = np.zeros(len(i), bool)
    for low in range(0, len(i), 1 << 15):
        some = slice(low, low + (1 << 15))
        close[some] = np.einsum("ij,ij->i", units[i[some]], units[j[some]]) >= cosine
    return i[close], j[close]


def in_earlier_table(units: np.ndarray, i, j, table: np.ndarray, how: Design) -> np.ndarray:
    """Whether the pairs share a cell of a table before that of their row."""
    rows, at = np.unique(np.concatenate([i, j]), return_inverse=True)
    keys = cell_keys(units[rows], how)
    same = keys[at[: len(i)]] == keys[at[len(i) :]]
    return (same & (np.arange(how.tables)[None, :] < table[i][:, None])).any(1)


def roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest row that each row's pairs lead to."""
    label = np.arange(n)
    while True:
        least = label.copy()
        np.minimum.at(least, i, label[j])
        np.minimum.at(least, j, label[i])
        least = least[least]
        if (least == label).all():
            return label
        label = least


def compared(how: Design, cosine: float):
    """Task function: link counts and connections of sorted cells.

    A row (class, links, root) for each class that links in a cell.
    """

    def some(rows: pa.Table, edges: np.ndarray) -> Iterator[pa.RecordBatch]:
        """All whole cells of ``rows``; vectors of one cell have one length."""
        lengths = np.array([len(u.as_buffer()) for u in rows["unit"]], np.int64)
        group = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
        alone = np.diff(edges)[group] < 2
        for length in np.unique(lengths[~alone]):
            at = np.flatnonzero((lengths == length) & ~alone)
            yield from same_length(rows.take(pa.array(at)), group[at])

    def same_length(rows: pa.Table, group: np.ndarray) -> Iterator[pa.RecordBatch]:
        units = stacked(rows["unit"].combine_chunks())
        i, j = linked(units, group, rows["half"].to_numpy(), how, cosine)
        if len(i):
            new = ~in_earlier_table(units, i, j, rows["table"].to_numpy(), how)
            i, j = i[new], j[new]
        if not len(i):
            return
        copies, ids = rows["copies"].to_numpy(), rows["class"].to_numpy()
        links = np.bincount(i, copies[j], len(units)) + np.bincount(j, copies[i], len(units))
        at = np.flatnonzero(links)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(ids[at]),
                pa.array(links[at].astype(np.int64)),
                pa.array(ids[roots(len(units), i, j)[at]]),
            ],
            ["class", "links", "root"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            # Pieces of a size whose pairs fit in memory.
            for low in range(0, batch.num_rows, ROWS):
                rows = pa.Table.from_batches([batch.slice(low, ROWS)])
                held = rows if held is None else pa.concat_tables([held, rows])
                edges = _edges(held)
                if len(edges) > 2:
                    yield from some(held.slice(0, edges[-2]), edges[:-1])
                    held = held.slice(edges[-2])
        if held is not None and held.num_rows:
            yield from some(held, _edges(held))

    return run


def _edges(rows: pa.Table) -> np.ndarray:
    """Where the runs of one cell and pair of blocks begin, and the end."""
    if not rows.num_rows:
        return np.zeros(1, np.int64)
    names = ("table", "cell", "one", "other")
    keys = np.stack([rows[c].to_numpy().astype(np.int64) for c in names])
    return np.concatenate(
        [[0], 1 + np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)), [rows.num_rows]]
    )


def near_duplicates(
    vectors: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    cosine: float = COSINE,
    recall: float = RECALL,
) -> DataFrame:
    """One row per row of ``vectors``: ``vec_id``, ``n_links``, ``component_id``
    (the smallest id its links lead to) and ``kept`` (whether that is its own).

    Vectors link if their cosine is at least ``cosine``; vectors of different
    lengths do not. Null, empty and zero vectors and those with a null or
    non-finite component link with nothing. Repeated rows link like any two
    equal vectors; of rows with one id all or none are kept. A null id is never
    the smallest unless it is the only one, and is not kept. Other columns are
    not read.
    """
    if not 0.5 <= cosine < 1 or not 0 < recall < 1:
        raise ValueError("cosine lies within 0.5 and 1, recall within 0 and 1")
    rows = vectors.select(
        F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")
    )
    id_type = rows.schema["vec_id"].dataType.simpleString()
    rows = rows.mapInArrow(unit_vectors, f"vec_id {id_type}, unit binary")
    rows = materialize(rows.withColumn("class", F.expr("if(unit is null, null, xxhash64(unit))")), "units")
    classes = rows.filter("class is not null").groupBy("class").agg(
        F.any_value("unit").alias("unit"),
        F.count("*").alias("copies"),
        F.min("vec_id").alias("least"),
    )
    classes = materialize(classes, "classes")
    how = design(classes.count(), cosine, recall)
    cells = classes.select("class", "unit").mapInArrow(
        routed(how), "class bigint, table int, cell bigint"
    )
    cells = materialize(cells, "cells")
    counts = cells.groupBy("table", "cell").agg(F.count("*").alias("n")).filter("n > 1")
    met = join_lookup(cells, counts, ["table", "cell"])
    # A large cell is cut into blocks; every two of them meet once.
    parts = F.ceil(F.col("n") / BLOCK)
    own = F.pmod(F.xxhash64("class", "table"), parts).cast("int").alias("own")
    met = met.select(
        "class", "table", "cell", own,
        F.explode(F.sequence(F.lit(0), (parts - 1).cast("int"))).alias("with"),
    )
    met = met.select(
        "class", "table", "cell",
        F.least("own", "with").alias("one"),
        F.greatest("own", "with").alias("other"),
        (F.col("own") > F.col("with")).cast("int").alias("half"),
    )
    met = met.join(classes.select("class", "unit", "copies"), "class")
    key = ["table", "cell", "one", "other"]
    found = spread(met, *key).sortWithinPartitions(*key).mapInArrow(
        compared(how, cosine), "class bigint, links bigint, root bigint"
    )
    found = materialize(found, "found")
    root = components(found.select(F.col("class").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("class").agg(F.sum("links").alias("links"))
    named = classes.select("class", "copies", "least").join(links, "class", "left")
    named = named.join(root.toDF("class", "root"), "class", "left")
    named = materialize(named.withColumn("root", F.coalesce("root", "class")), "named")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = join_lookup(named, least, ["root"]).select(
        "class",
        "component_id",
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
    )
    out = join_lookup(rows.select("vec_id", "class"), named, ["class"], "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
