"""Exact-count sampling and keyed overrides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockflow.fixed_values import OUTLIER_PRICE, OUTLIER_QUANTITY, OUTLIER_SHARE, SEED
from stockflow.functions.numbers import fingerprint
from stockflow.operators.joins import join_lookup, latest_per_key
from stockflow.operators.quantiles import kth_smallest
from stockflow.schemas import EVENT_KEY
from stockflow.session import materialize


def sample_exact(
    df: DataFrame,
    share: float = OUTLIER_SHARE,
    seed: int = SEED,
    key: list[Column | str] | None = None,
) -> DataFrame:
    """Exactly ``max(1, int(share * n))`` rows, chosen by md5 of seed and key.

    The cut-off fingerprint is found by counting, so no sort and no single
    task sees all rows. Should more rows tie with the cut-off than there is
    room for, those are ranked, full copies as one row with a count.
    """
    columns = df.columns
    key = [F.col(k) if isinstance(k, str) else k for k in key or columns]
    drawn = df.withColumn("__draw", fingerprint(F.lit(str(seed)), *[c.cast("string") for c in key]))
    wanted = 0

    def last_rank(n: int) -> list[int]:
        nonlocal wanted
        wanted = max(1, int(share * n)) if n else 0
        return [wanted - 1] if n else []

    # Written with its rows: the source is evaluated once, and draws stay with their row.
    drawn = materialize(drawn, "draws")
    found = kth_smallest(drawn, "__draw", last_rank)
    if not found:
        return df
    cut, n_below, n_equal = found[wanted - 1]
    room = wanted - n_below
    if room == n_equal:
        return drawn.filter(F.col("__draw") <= int(cut)).select(*columns)
    below = drawn.filter(F.col("__draw") < int(cut))
    tied = drawn.filter(F.col("__draw") == int(cut)).groupBy(*columns).agg(F.count("*").alias("__n"))
    before = Window.orderBy(*columns).rowsBetween(Window.unboundedPreceding, -1)
    left = F.lit(room) - F.coalesce(F.sum("__n").over(before), F.lit(0))
    chosen = (
        tied.withColumn("__take", F.least(F.col("__n"), left))
        .filter(F.col("__take") > 0)
        .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__take"))))
    )
    return below.select(*columns).unionByName(chosen.select(*columns))


def outlier_overrides(sample: DataFrame) -> DataFrame:
    """Override rows that give the sampled keys outlying figures."""
    return sample.select(
        *EVENT_KEY,
        F.lit(OUTLIER_QUANTITY).alias("quantity"),
        F.lit(OUTLIER_PRICE).alias("price"),
    )


def apply_overrides(
    base: DataFrame, overrides: DataFrame, keys: list[str] = EVENT_KEY, **lookup: object
) -> DataFrame:
    """Replace non-null override columns in every base row that has the key.

    Null keys match nothing. Should a key be overridden twice, the greatest
    override row wins.
    """
    changed = [c for c in overrides.columns if c not in keys]
    unique = latest_per_key(overrides.dropna(subset=keys), keys, changed)
    renamed = unique.select(*keys, *[F.col(c).alias(f"__new_{c}") for c in changed])
    joined = join_lookup(base, renamed, keys, "left", **lookup)
    return joined.select(
        *[
            F.coalesce(F.col(f"__new_{c}"), F.col(c)).cast(base.schema[c].dataType).alias(c)
            if c in changed
            else F.col(c)
            for c in base.columns
        ]
    )
