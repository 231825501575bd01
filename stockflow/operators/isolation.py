"""Isolation forest (Liu, Ting and Zhou, 2008) as Spark jobs.

Rows are first folded into distinct feature points with a weight, so copies
cost nothing. Every tree grows on a bounded sample in its own task; points are
scored in bounded chunks next to their group's forest; the cut-off comes from
counts of rounded scores. No task ever holds a whole group.
"""

from __future__ import annotations

from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockflow.fixed_values import SEED
from stockflow.functions.numbers import to_number
from stockflow.operators.joins import join_lookup
from stockflow.session import materialize, spread

TREES = 100
SAMPLE = 256
CHUNK_POINTS = (5_000, 200_000)
TREES_PER_CALL = 10
SCORE_DIGITS = 6
# Flat node tables of the trees of one block; leaves have feature -1, point at
# themselves and carry the path length.
_NODES = ["roots", "feature", "cut", "low", "high", "length"]
_NODE_TYPES = (
    "roots array<bigint>, feature array<bigint>, cut array<double>, "
    "low array<bigint>, high array<bigint>, length array<double>"
)


def isolation_points(
    df: DataFrame,
    features: list[str],
    contamination: float,
    by: list[str] | None = None,
    *,
    seed: int = SEED,
    trees: int = TREES,
    sample: int = SAMPLE,
    chunk_points: tuple[int, int] = CHUNK_POINTS,
) -> DataFrame:
    """Distinct points of ``by + features`` with weight, score and flag.

    Scores follow the sign convention of lower is more abnormal; a point is
    flagged if its score lies strictly below the ``contamination`` percentile
    of its group. Missing or unreadable features count as 0; groups of fewer
    than two rows are left out.
    """
    groups = by or ["__all"]
    if not by:
        df = df.withColumn("__all", F.lit(0))
    coerced = df.select(*groups, *[to_number(F.col(f)).alias(f) for f in features])
    points = coerced.groupBy(*groups, *features).agg(F.count("*").alias("weight"))
    points = materialize(points, "points")
    sizes = points.groupBy(*groups).agg(
        F.sum("weight").alias("__rows"), F.count("*").alias("__points")
    )
    sizes = materialize(sizes.filter(F.col("__rows") >= 2), "sizes")
    sized = join_lookup(points, sizes, groups, written=True)

    forest = materialize(_grow_forest(sized, groups, features, seed, trees, sample), "forest")
    scored = materialize(_score(sized, forest, sizes, groups, features, sample, chunk_points))

    counted = scored.groupBy(*groups, "score").agg(F.sum("weight").alias("__n"))
    offsets = counted.groupBy(*groups).agg(
        F.percentile("score", F.lit(contamination), F.col("__n")).alias("__offset")
    )
    flagged = join_lookup(scored, offsets, groups)
    return flagged.withColumn("is_anomaly", F.col("score") < F.col("__offset")).select(
        *(by or []), *features, "weight", "score", "is_anomaly"
    )


def _uniform(*parts: Column) -> Column:
    bits = F.xxhash64(*parts).bitwiseAND(F.lit((1 << 52) - 1))
    return bits.cast("double") / float(1 << 52)


def _grow_forest(
    sized: DataFrame, groups: list[str], features: list[str], seed: int, trees: int, sample: int
) -> DataFrame:
    """One row per group and block of trees. Each point gets as many copies as its weight
    earns it, dealt to the trees in turn, so a tree sees about ``sample`` rows
    and no row twice."""
    identity = [F.col(c) for c in groups + features]
    per_tree = F.least(F.col("__rows"), F.lit(sample)) / F.col("__rows")
    expected = F.col("weight") * per_tree * trees
    copies = F.floor(expected + _uniform(F.lit(seed), *identity)).cast("int")
    start = F.pmod(F.xxhash64(F.lit(seed + 1), *identity), F.lit(trees))
    dealt = (
        sized.withColumn("__copies", copies)
        .filter(F.col("__copies") > 0)
        .withColumn("__i", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
        .select(*groups, *features, F.pmod(start + F.col("__i"), F.lit(trees)).alias("__tree"))
    )
    limit = int(np.ceil(np.log2(max(sample, 2))))
    # Several trees per call: each is quick, and a call has its own overhead.
    blocks = dealt.withColumn("__block", F.floor(F.col("__tree") / TREES_PER_CALL))
    keys = [*groups, "__block"]

    def grow(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        name = repr([str(part) for part in key])
        rng = np.random.default_rng([seed, crc32(name.encode())])
        nodes = grow_trees(
            pdf[features].to_numpy(dtype=float), pdf["__tree"].to_numpy(), limit, rng
        )
        return pd.DataFrame([[*key, *nodes]], columns=[*keys, *_NODES])

    kinds = dict(blocks.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in keys)
    return spread(blocks, *keys).groupBy(*keys).applyInPandas(grow, f"{schema}, {_NODE_TYPES}")


def _score(
    sized: DataFrame,
    forest: DataFrame,
    sizes: DataFrame,
    groups: list[str],
    features: list[str],
    sample: int,
    chunk_points: tuple[int, int],
) -> DataFrame:
    """Points with their score, in chunks whose size lies within ``chunk_points``:
    small ones while they keep all cores busy, never more than fits a task."""
    cores = sized.sparkSession.sparkContext.defaultParallelism
    least, most = chunk_points
    size = F.least(F.greatest(F.col("__points") / cores, F.lit(least)), F.lit(most))
    chunks = F.ceil(F.col("__points") / size).cast("int")
    chunk_of = F.pmod(F.xxhash64(*features), chunks).cast("int")
    chunked = sized.select(
        *groups, *features, "weight", "__rows", chunk_of.alias("__chunk")
    )
    replicas = join_lookup(forest, sizes.select(*groups, chunks.alias("__chunks")), groups)
    replicas = replicas.withColumn(
        "__chunk", F.explode(F.sequence(F.lit(0), F.col("__chunks") - 1))
    ).drop("__chunks")

    def score(points: pd.DataFrame, blocks: pd.DataFrame) -> pd.DataFrame:
        out = points[[*groups, *features, "weight"]].copy()
        if points.empty:
            return out.assign(score=pd.Series(dtype=float))
        values = points[features].to_numpy(dtype=float)
        # Trees are summed in a fixed order, whatever order they arrived in.
        lengths = [
            path_lengths(values, root, *nodes)
            for roots, *nodes in blocks.sort_values("__block")[_NODES].itertuples(index=False)
            for root in roots
        ]
        usual = average_path(np.array([min(sample, int(points["__rows"].iloc[0]))]))[0]
        out["score"] = np.round(-(2.0 ** (-np.mean(lengths, axis=0) / usual)), SCORE_DIGITS)
        return out

    kinds = dict(chunked.dtypes)
    columns = [*groups, *features, "weight"]
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in columns) + ", score double"
    keys = [*groups, "__chunk"]
    left, right = spread(chunked, *keys), spread(replicas, *keys)
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(score, schema)


def average_path(n: np.ndarray) -> np.ndarray:
    """Mean length of an unsuccessful search in binary trees of ``n`` rows."""
    n = np.asarray(n, dtype=float)
    several = np.maximum(n, 3.0) - 1.0
    usual = 2.0 * (np.log(several) + np.euler_gamma) - 2.0 * several / (several + 1.0)
    return np.where(n > 2, usual, (n == 2).astype(float))


def grow_trees(
    values: np.ndarray, tree: np.ndarray, limit: int, rng: np.random.Generator
) -> tuple[np.ndarray, ...]:
    """Isolation trees over the rows of each ``tree`` number, as one node table.

    All nodes of a level are split together: their extremes come from one
    reduction over the rows sorted by node.
    """
    numbers, at = np.unique(tree, return_inverse=True)
    rows = np.arange(len(values))
    levels, made = [], len(numbers)
    for depth in range(limit + 1):
        order = np.argsort(at[rows], kind="stable")
        rows = rows[order]
        nodes, starts, sizes = np.unique(at[rows], return_index=True, return_counts=True)
        least = np.minimum.reduceat(values[rows], starts, axis=0)
        most = np.maximum.reduceat(values[rows], starts, axis=0)
        varies = (most > least) & (depth < limit)
        splits = varies.any(axis=1)
        # The n-th feature that varies, n drawn at random.
        drawn = np.floor(rng.random(len(nodes)) * varies.sum(axis=1)).astype(int) + 1
        feature = np.argmax(np.cumsum(varies, axis=1) == drawn[:, None], axis=1)
        spot = np.arange(len(nodes))
        bottom, top = least[spot, feature], most[spot, feature]
        cut = bottom + rng.random(len(nodes)) * (top - bottom)
        cut = np.where(cut < top, cut, bottom)
        child = made + 2 * (np.cumsum(splits) - 1)
        made += 2 * int(splits.sum())
        levels.append(
            (
                nodes,
                np.where(splits, feature, -1),
                np.where(splits, cut, 0.0),
                np.where(splits, child, nodes),
                np.where(splits, child + 1, nodes),
                np.where(splits, 0.0, depth + average_path(sizes)),
            )
        )
        if not splits.any():
            break
        owner = np.repeat(spot, sizes)
        below = values[rows, feature[owner]] <= cut[owner]
        at[rows] = child[owner] + ~below
        rows = rows[splits[owner]]
    # Node numbers grow from level to level, so the parts are in order already.
    return (np.arange(len(numbers)), *map(np.concatenate, list(zip(*levels, strict=True))[1:]))


def path_lengths(
    values: np.ndarray,
    root: int,
    feature: np.ndarray,
    cut: np.ndarray,
    low: np.ndarray,
    high: np.ndarray,
    length: np.ndarray,
) -> np.ndarray:
    """Path length of every row through one tree, all rows one level at a time."""
    at = np.full(len(values), root)
    rows = np.arange(len(values))
    while True:
        inner = feature[at] >= 0
        if not inner.any():
            return length[at]
        below = values[rows, np.maximum(feature[at], 0)] <= cut[at]
        # Leaves point at themselves, so finished rows stay where they are.
        at = np.where(below, low[at], high[at])
