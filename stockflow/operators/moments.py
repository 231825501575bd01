"""Z-scores against stored figures: new forecasts are judged without the old rows.

The figures of a group (rows, values, mean and the sum of squared deviations)
merge without loss of digits, so the table of figures after any number of
batches is that of all rows at once, and has one row per group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockflow.fixed_values import Z_THRESHOLD
from stockflow.functions.numbers import nan_to_null
from stockflow.operators.joins import join_lookup
from stockflow.operators.zscore import GROUP, flagged
from stockflow.session import materialize
from stockflow.sources.readers import read_table
from stockflow.sources.writers import replace

FIGURES = {"group_size": "bigint", "n": "bigint", "mean": "double", "m2": "double"}


def moments(
    forecasts: DataFrame, keys: list[str] = GROUP, value: str = "predicted_quantity"
) -> DataFrame:
    """Figures per group; null keys drop out, null and NaN values count as rows only."""
    rows = forecasts.dropna(subset=keys).withColumn(value, nan_to_null(F.col(value)))
    return rows.groupBy(*keys).agg(
        F.count("*").alias("group_size"),
        F.count(value).alias("n"),
        F.avg(value).alias("mean"),
        (F.var_pop(value) * F.count(value)).alias("m2"),
    )


def merged(one: DataFrame, other: DataFrame, keys: list[str] = GROUP) -> DataFrame:
    """Figures of the rows of both tables together (Chan, Golub and LeVeque 1979)."""
    a = one.select(*keys, *[F.col(c).alias(f"a_{c}") for c in FIGURES])
    b = other.select(*keys, *[F.col(c).alias(f"b_{c}") for c in FIGURES])
    both = a.join(b, keys, "full")
    zero = F.lit(0)
    size = F.coalesce("a_group_size", zero) + F.coalesce("b_group_size", zero)
    na, nb = (F.coalesce(f"{side}_n", zero) for side in "ab")
    apart = F.col("b_mean") - F.col("a_mean")
    n = na + nb
    return both.select(
        *keys,
        size.alias("group_size"),
        n.alias("n"),
        F.when(na == 0, F.col("b_mean"))
        .when(nb == 0, F.col("a_mean"))
        .otherwise(F.col("a_mean") + apart * nb / n)
        .alias("mean"),
        F.when(na == 0, F.col("b_m2"))
        .when(nb == 0, F.col("a_m2"))
        .otherwise(F.col("a_m2") + F.col("b_m2") + apart * apart * na * nb / n)
        .alias("m2"),
    )


def with_stored_zscore(
    forecasts: DataFrame,
    figures: DataFrame,
    keys: list[str] = GROUP,
    value: str = "predicted_quantity",
) -> DataFrame:
    """``zscore.with_zscore`` with the figures of a table instead of those of the rows."""
    keyed = forecasts.dropna(subset=keys).withColumn(value, nan_to_null(F.col(value)))
    known = figures.filter("group_size >= 2").select(
        *keys,
        "group_size",
        F.col("mean").alias("__mean"),
        # One value has no spread, as in ``stddev_samp``.
        F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1))).alias("__std"),
    )
    score = (F.col(value) - F.col("__mean")) / F.nullif(F.col("__std"), F.lit(0.0))
    return join_lookup(keyed, known, keys).withColumn("z_score", score).drop("__mean", "__std")


def table_of(keys: list[str]) -> T.StructType:
    return T.StructType.fromDDL(
        ", ".join([*(f"{k} string" for k in keys), *(f"{c} {t}" for c, t in FIGURES.items())])
    )


def judge_new(
    spark: SparkSession,
    forecasts: DataFrame,
    path: str,
    threshold: float = Z_THRESHOLD,
    keys: list[str] = GROUP,
) -> DataFrame:
    """Anomalies among new forecasts, judged with all that came before them.

    The stored figures at ``path`` take in the new rows first and are replaced;
    rows of earlier calls are not read. A call that failed before the figures
    were replaced may be repeated; one that succeeded must not be.
    """
    rows = materialize(forecasts, "new")
    stored = read_table(spark, path, table_of(keys))
    figures = materialize(merged(stored, moments(rows, keys), keys), "figures")
    replace(figures, path)
    return flagged(with_stored_zscore(rows, figures, keys), threshold)
