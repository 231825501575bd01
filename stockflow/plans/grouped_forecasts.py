"""Trend and season for every store at once, from mergeable sums per store.

Each store's regression needs nothing of its series but the sums of outer
products of its design columns. Those are added up within tasks and then per
store, so neither a long series nor many stores gather in one task, and the
penalised fits are solved from the sums alone, a batch of stores at a time.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.fixed_values import HORIZON_DAYS, MODEL_TREND
from stockflow.functions.numbers import nan_to_null
from stockflow.functions.timestamps import plus_days
from stockflow.operators.joins import join_lookup
from stockflow.operators.series import forecast_rows, store_series
from stockflow.plans.forecasts import (
    CHANGEPOINT_PRIOR,
    CHANGEPOINT_RANGE,
    CHANGEPOINTS,
    DAY,
    SEASONS,
)
from stockflow.session import materialize, spread

ROUNDS = 2000  # of coordinate descent, at most
STILL = 1e-10  # change of a coefficient below which descent stops
STORES = 256  # solved at once, 30 KB each
PARTS = 32  # into which the rows of one store may be dealt
WIDTH = 2 + CHANGEPOINTS + 2 * sum(order for _, order, *_ in SEASONS)
STORE = ["store_location"]


def design(seconds: np.ndarray, limits: dict[str, np.ndarray]) -> np.ndarray:
    """Design columns of some rows: intercept, trend, slope changes, seasons.

    Each row has the limits of its store. Seasons that a store's history does
    not cover, or that its points are too far apart for, are zero columns.
    """
    span = np.maximum(limits["last"] - limits["first"], 1.0)
    t = (seconds - limits["first"]) / span
    spots = CHANGEPOINT_RANGE * np.arange(1, CHANGEPOINTS + 1) / CHANGEPOINTS
    columns = [np.ones_like(t), t, *np.maximum(t[:, None] - spots, 0.0).T]
    history = limits["last"] - limits["first"]
    spacing = history / np.maximum(limits["points"] - 1, 1)
    for period, order, needed, coarsest in SEASONS:
        covered = (history >= needed * DAY) & (spacing < coarsest * DAY)
        for k in range(1, order + 1):
            angle = seconds / DAY * (2.0 * math.pi * k / period)
            columns += [np.sin(angle) * covered, np.cos(angle) * covered]
    return np.stack(columns, 1)


def outer_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of outer products of design and value, a row for each run of one store."""
    store, total = None, None

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([store], pa.string()), pa.array([total.ravel()], pa.list_(pa.float64()))],
            [*STORE, "sums"],
        )

    for batch in batches:
        names = batch.column(STORE[0]).to_numpy(zero_copy_only=False)
        column = {c: batch.column(c).to_numpy() for c in ("first", "last", "points", "scale")}
        x = design(batch.column("seconds").to_numpy(), column)
        y = batch.column("quantity").to_numpy() / column["scale"]
        both = np.concatenate([x, y[:, None]], 1)
        starts = np.flatnonzero(np.append(True, names[1:] != names[:-1]))
        for low, high in zip(starts, [*starts[1:], len(names)], strict=True):
            if total is not None and names[low] != store:
                yield row()
                total = None
            store = names[low]
            own = both[low:high].T @ both[low:high]
            total = own if total is None else total + own
    if total is not None:
        yield row()


def merged_sums(group: pa.Table) -> pa.Table:
    """The sums of one store: at most one row for each part its rows were dealt to."""
    total = np.sum([np.array(s.as_py()) for s in group.column("sums")], axis=0)
    return pa.table(
        {STORE[0]: group.column(STORE[0])[:1], "sums": pa.array([total], pa.list_(pa.float64()))}
    )


def solve(sums: np.ndarray) -> np.ndarray:
    """Coefficients of each regression, from its sums of outer products.

    Least squares with an absolute penalty on slope changes alone. The penalty
    follows from the noise that a nearly unpenalised fit leaves.
    """
    n = sums[:, 0, 0]
    gram = sums[:, :WIDTH, :WIDTH] / n[:, None, None]
    moment = sums[:, :WIDTH, WIDTH] / n[:, None]
    square = sums[:, WIDTH, WIDTH] / n
    # Constant columns, as those of seasons left out, keep coefficients of zero.
    plain = np.linalg.pinv(gram + 1e-6 * np.eye(WIDTH), hermitian=True) @ moment[:, :, None]
    plain = plain[:, :, 0]
    noise = square - 2 * (plain * moment).sum(1) + np.einsum("si,sij,sj->s", plain, gram, plain)
    penalty = np.maximum(np.maximum(noise, 0.0) / (n * CHANGEPOINT_PRIOR), 1e-9)
    hinges = slice(2, 2 + CHANGEPOINTS)
    free = np.r_[0:2, 2 + CHANGEPOINTS : WIDTH]
    # The columns without a penalty are projected out, slope changes go one by one.
    inverse = np.linalg.pinv(gram[:, free[:, None], free], rcond=1e-12, hermitian=True)
    cross = gram[:, free, hinges]
    inner = gram[:, hinges, hinges] - cross.transpose(0, 2, 1) @ inverse @ cross
    target = moment[:, hinges] - np.einsum("sfh,sfg,sg->sh", cross, inverse, moment[:, free])
    weights = np.zeros((len(n), CHANGEPOINTS))
    size = np.einsum("shh->sh", inner)
    solid = size > 1e-14
    for _ in range(ROUNDS):
        largest = 0.0
        for h in range(CHANGEPOINTS):
            left = target[:, h] - np.einsum("sg,sg->s", inner[:, h], weights) + size[:, h] * weights[:, h]
            shrunk = np.sign(left) * np.maximum(np.abs(left) - penalty, 0.0)
            new = np.divide(shrunk, size[:, h], out=np.zeros_like(left), where=solid[:, h])
            largest = max(largest, np.abs(new - weights[:, h]).max(initial=0.0))
            weights[:, h] = new
        if largest < STILL:
            break
    out = np.zeros((len(n), WIDTH))
    out[:, hinges] = weights
    rest = moment[:, free] - np.einsum("sfh,sh->sf", cross, weights)
    out[:, free] = np.einsum("sfg,sg->sf", inverse, rest)
    return out


def solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Predicted values of each store for the days after its last point."""
    days = np.arange(1, HORIZON_DAYS + 1)
    for whole in batches:
        for low in range(0, whole.num_rows, STORES):
            batch = whole.slice(low, STORES)
            sums = batch.column("sums").flatten().to_numpy()
            weights = solve(sums.reshape(-1, WIDTH + 1, WIDTH + 1))
            column = {c: batch.column(c).to_numpy() for c in ("first", "last", "points", "scale")}
            store = np.repeat(np.arange(batch.num_rows), HORIZON_DAYS)
            step = np.tile(days, batch.num_rows)
            x = design(column["last"][store] + step * DAY, {c: v[store] for c, v in column.items()})
            found = (x * weights[store]).sum(1) * column["scale"][store]
            yield pa.RecordBatch.from_arrays(
                [batch.column(STORE[0]).take(pa.array(store)), pa.array(step), pa.array(found)],
                [*STORE, "step", "predicted"],
            )


def trend_seasonal_by_store(metrics: DataFrame, time: str = "event_timestamp") -> DataFrame:
    """Seven days of forecasts for each store, from its own trend and seasons.

    The model of ``trend_seasonal_forecast``, fitted to each store's series
    alone. Rows without a store, a time or a quantity do not count, and a store
    without any others has no forecast.
    """
    known = nan_to_null(F.col("quantity").cast("double"))
    series = store_series(metrics, time).withColumn("quantity", known)
    series = series.filter(F.col("quantity").isNotNull()).select(
        *STORE,
        "event_timestamp",
        (F.unix_micros(F.col("event_timestamp").cast("timestamp")) / 1e6).alias("seconds"),
        "quantity",
    )
    series = materialize(series, "series")
    stores = series.groupBy(*STORE).agg(
        F.min("seconds").alias("first"),
        F.max("seconds").alias("last"),
        F.count("*").alias("points"),
        F.max(F.abs("quantity")).alias("largest"),
        F.max("event_timestamp").alias("last_timestamp"),
    )
    scale = F.when(F.col("largest") > 0, F.col("largest")).otherwise(1.0)
    stores = materialize(stores.withColumn("scale", scale).drop("largest"), "stores")
    rows = join_lookup(series, stores.drop("last_timestamp"), STORE, written=True)
    # A long series is dealt to several tasks, each of which adds up its part.
    part = F.pmod(F.xxhash64("event_timestamp"), F.lit(PARTS))
    dealt = spread(rows.withColumn("__part", part), *STORE, "__part")
    dealt = dealt.sortWithinPartitions(*STORE).select(
        *STORE, "seconds", "quantity", "first", "last", "points", "scale"
    )
    kind = f"{STORE[0]} string, sums array<double>"
    sums = dealt.mapInArrow(outer_sums, kind).groupBy(*STORE).applyInArrow(merged_sums, kind)
    days = join_lookup(sums, stores.drop("last_timestamp"), STORE, written=True).mapInArrow(
        solved, f"{STORE[0]} string, step bigint, predicted double"
    )
    days = join_lookup(days, stores.select(*STORE, "last_timestamp"), STORE, written=True)
    return forecast_rows(
        days,
        MODEL_TREND,
        forecast_time=plus_days(F.col("last_timestamp"), F.col("step").cast("int")),
        predicted=F.col("predicted"),
        event_time=F.col("last_timestamp"),
        store=F.col(STORE[0]),
    )
