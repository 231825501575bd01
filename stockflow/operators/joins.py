"""Equi-joins against a side that has one row per key.

The big side may hold a third of its rows under one key. The lookup side is
broadcast when its measured size allows; otherwise both sides are shuffled by
key, and the keys that are frequent on the big side are spread over all
partitions, their few lookup rows repeated for each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockflow.session import materialize

BROADCAST_BYTES = 32 * 1024 * 1024
FREQUENT_SHARE = 0.002
_KEY = "__key"
_HASH = "__hash"
_SALT = "__salt"


def row_bytes(df: DataFrame) -> Column:
    """Upper estimate of the in-memory size of each row of ``df``."""
    width = F.lit(0)
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StringType | T.BinaryType):
            width = width + F.coalesce(F.octet_length(F.col(field.name)), F.lit(0)) + 16
        elif isinstance(field.dataType, T.StructType | T.ArrayType | T.MapType):
            text = F.to_json(F.struct(F.col(field.name)))
            width = width + F.coalesce(F.octet_length(text), F.lit(0)) + 32
        else:
            width = width + 16
    return width.cast("bigint")


def measured_bytes(df: DataFrame) -> int:
    """Upper estimate of the in-memory size of ``df``, from its actual rows."""
    return df.agg(F.sum(row_bytes(df))).first()[0] or 0


def frequent_keys(df: DataFrame, keys: list[str], share: float = FREQUENT_SHARE) -> list[int]:
    """Hashes of all keys with at least ``share`` of the rows (and maybe a few more).

    One narrow pass with a bounded sketch per task; at most ``1 / share``
    numbers reach the driver.
    """
    hashed = df.select(F.xxhash64(*keys).alias("h"))
    return hashed.stat.freqItems(["h"], share).first()[0]


def join_lookup(
    big: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    how: str = "inner",
    *,
    null_safe: bool = False,
    written: bool = False,
    size: int | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join ``big`` to ``lookup``, which must have one row per key.

    ``how`` is inner, left, left_semi or left_anti. With ``null_safe`` a null
    key part matches a null key part. The lookup side is evaluated once, here,
    unless it is a ``written`` table already, or its ``size`` has been measured
    and only the join reads it.
    """
    if size is None:
        if not written:
            lookup = materialize(lookup, "lookup")
        size = measured_bytes(lookup)
    fits = size <= broadcast_bytes
    columns = big.columns + [
        c for c in lookup.columns if c not in keys and how not in ("left_semi", "left_anti")
    ]
    on = list(keys)
    if not fits:
        big, lookup = _spread_frequent(big, lookup, keys)
        on.append(_SALT)
    if null_safe:
        # Structs compare field by field with null equal to null. Behind a hash a sort
        # rarely compares them.
        key, hashed = F.struct(*on), F.xxhash64(*on)
        big = big.withColumns({_KEY: key, _HASH: hashed})
        lookup = lookup.withColumns({_KEY: key, _HASH: hashed}).drop(*on)
        on = [_KEY] if fits else [_HASH, _KEY]
        lookup = lookup.drop(_HASH) if fits else lookup
    if fits:
        lookup = F.broadcast(lookup)
    return big.join(lookup, on, how).select(*columns)


def _spread_frequent(
    big: DataFrame, lookup: DataFrame, keys: list[str]
) -> tuple[DataFrame, DataFrame]:
    """Both sides with a salt: 0 for ordinary keys, all values for frequent ones."""
    frequent = frequent_keys(big, keys)
    salts = int(big.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = F.xxhash64(*keys).isin(frequent)
    # The salt depends on the row and its input partition, so a recomputed
    # task salts alike, and full copies of one row still spread out.
    rest = [F.col(c) for c in big.columns if c not in keys]
    own = F.pmod(F.xxhash64(F.spark_partition_id(), *rest), F.lit(salts)).cast("int")
    every = F.when(hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    return (
        big.withColumn(_SALT, F.when(hot, own).otherwise(F.lit(0))),
        lookup.withColumn(_SALT, F.explode(every)),
    )


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the greatest ``order`` per key, by mergeable aggregation."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    best = F.max(F.struct(*order, *rest)).alias("best")
    return df.groupBy(*keys).agg(best).select(*keys, "best.*").select(*df.columns)


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the smallest ``order`` per key, by mergeable aggregation."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    best = F.min(F.struct(*order, *rest)).alias("best")
    return df.groupBy(*keys).agg(best).select(*keys, "best.*").select(*df.columns)
