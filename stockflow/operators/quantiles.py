"""Exact order statistics that never gather a whole column in one task."""

from __future__ import annotations

from collections.abc import Callable
from functools import cache
from math import ceil, floor
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.functions.numbers import nan_to_null

LARGEST = 1.7976931348623157e308  # of the finite doubles
BINS = 4096
SMALL = 20_000


class Found(NamedTuple):
    value: float
    below: int  # rows strictly smaller than ``value``
    equal: int  # rows equal to it


def kth_smallest(
    df: DataFrame,
    column: str,
    ranks: Callable[[int], list[int]],
    small: int = SMALL,
) -> dict[int, Found]:
    """Values at zero-based ranks of a numeric column (nulls and NaN ignored).

    ``ranks`` maps the row count to the wanted ranks. Each pass counts the rows
    of the current interval in ``BINS`` equal bins and goes on inside the bin
    that holds the rank; the bin's own extremes are the next interval. Only bin
    counts, and at last the counts of at most ``small`` rows, reach the driver.
    """
    values = df.select(nan_to_null(F.col(column).cast("double")).alias("v")).filter("v is not null")
    low, high, n = values.agg(F.min("v"), F.max("v"), F.count("v")).first()

    @cache
    def cells(low: float, high: float, rows: int) -> list:
        inside = values.filter(F.col("v").between(low, high))
        # Halves, since the range of doubles is wider than a double; infinite
        # values are cells of their own.
        bottom, top = max(low, -LARGEST) / 2, min(high, LARGEST) / 2
        if rows <= small or top <= bottom:
            # Where halves do not differ, no more than a few values lie between.
            cell = F.col("v")
        else:
            share = (F.col("v") / 2 - bottom) / (top - bottom)
            cell = F.least(F.floor(share * BINS), F.lit(BINS - 1))
            cell = F.when(F.col("v") > LARGEST, BINS).when(F.col("v") < -LARGEST, -1).otherwise(cell)
        counted = inside.groupBy(cell.alias("cell")).agg(
            F.min("v").alias("low"), F.max("v").alias("high"), F.count("*").alias("n")
        )
        return sorted((row["low"], row["high"], row["n"]) for row in counted.collect())

    def descend(rank: int) -> Found:
        if not 0 <= rank < n:
            raise ValueError(f"rank {rank} outside 0..{n - 1}")
        interval, below = (low, high, n), 0
        while interval[0] < interval[1]:
            for cell in cells(*interval):
                if rank - below < cell[2]:
                    interval = cell
                    break
                below += cell[2]
        return Found(interval[0], below, interval[2])

    return {rank: descend(rank) for rank in ranks(n)}


def exact_percentiles(df: DataFrame, column: str, shares: list[float]) -> dict[float, float | None]:
    """Percentiles with linear interpolation between neighbouring rows."""
    spots: dict[float, float] = {}

    def ranks(n: int) -> list[int]:
        spots.update({share: share * (n - 1) for share in shares if n})
        return [edge(spot) for spot in spots.values() for edge in (floor, ceil)]

    found = kth_smallest(df, column, ranks)
    return {
        share: found[floor(spots[share])].value
        + (found[ceil(spots[share])].value - found[floor(spots[share])].value)
        * (spots[share] - floor(spots[share]))
        if share in spots
        else None
        for share in shares
    }
