"""Stored keys by file: Bloom filters kept beside a table, so that looking for a
batch of keys opens only the files that may hold one.

``<table>/_keys`` holds one row per data file: its name, its number of rows, the
range of a column (the event time) and the number of its blocks.
``<table>/_key_blocks`` holds a Bloom filter for each block of a file's keys, about
ten bits each; the hash of a key tells its block, so that no filter, and no group
it is made from, grows with the file. Rows of ``_keys`` without blocks hold the
filter of the whole file, as they were once written. Spark's readers skip folders
that begin with an underscore. Files that the index does not know are added the
next time it is asked.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockflow.operators.ingest import new_rows
from stockflow.operators.joins import join_lookup
from stockflow.schemas import EVENT_KEY, INVENTORY
from stockflow.session import discard, materialize, spread
from stockflow.sources.readers import empty, read_table
from stockflow.sources.writers import append, publish

INDEX = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("low", T.StringType()),
        T.StructField("high", T.StringType()),
        T.StructField("bloom", T.BinaryType()),
        T.StructField("blocks", T.LongType()),
    ]
)
BLOCKS = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("blocks", T.LongType()),
        T.StructField("block", T.LongType()),
        T.StructField("bloom", T.BinaryType()),
    ]
)
BLOCK_ROWS = 1 << 16  # rows of a file for each of its blocks
KEY_BITS = 10  # of the filter for each key of a file
PROBES = 5
MOST_PROBED = 1 << 20  # keys of a batch that are broadcast (8 MiB) to be looked up in the filters


def index_path(table: str) -> str:
    return f"{table.rstrip('/')}/_keys"


def blocks_path(table: str) -> str:
    return f"{table.rstrip('/')}/_key_blocks"


def key_hash(keys: list[str]) -> Column:
    """One hash for each key; null parts are values like others."""
    return F.xxhash64(*[F.coalesce(F.concat(F.lit("="), F.col(k)), F.lit("-")) for k in keys])


def spots(hashes: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """The bits of each hash in a filter of ``2 ** bits`` bits."""
    odd = (hashes << np.uint64(32)) | (hashes >> np.uint64(32)) | np.uint64(1)
    for turn in range(PROBES):
        with np.errstate(over="ignore"):
            yield (hashes + np.uint64(turn) * odd) >> np.uint64(64 - bits)


def bloom(hashes: np.ndarray) -> bytes:
    """A Bloom filter whose size is a power of two."""
    bits = max(int(max(len(hashes), 1) * KEY_BITS - 1).bit_length(), 6)
    filled = np.zeros(1 << bits, bool)
    for spot in spots(hashes, bits):
        filled[spot.astype(np.int64)] = True
    return np.packbits(filled, bitorder="little").tobytes()


def may_hold(filled: bytes, hashes: np.ndarray) -> bool:
    """Whether the filter lets any of the hashes pass."""
    data = np.frombuffer(filled, np.uint8)
    bits = (8 * len(data)).bit_length() - 1
    passed = np.ones(len(hashes), bool)
    for spot in spots(hashes, bits):
        byte = data[(spot >> np.uint64(3)).astype(np.int64)]
        passed &= (byte >> (spot & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return bool(passed.any())


def filter_of_block(group: pa.Table) -> pa.Table:
    """The filter of the different hashes of one block, which BLOCK_ROWS bounds."""
    hashes = group.column("h").to_numpy().view(np.uint64)
    row = group.select(["file_number", "block"])[:1]
    return row.append_column("bloom", pa.array([bloom(hashes)], pa.binary()))


def block_filters(rows: DataFrame, files: DataFrame) -> DataFrame:
    """The filters of all blocks of ``files``, whose rows are ``rows``.

    Copies of a key fold before they are dealt out by block.
    """
    numbers = F.broadcast(files.select("file", "file_number", "blocks"))
    hashes = rows.join(numbers, "file").select(
        "file_number", F.pmod("h", "blocks").alias("block"), "h"
    )
    filters = spread(hashes.distinct(), "file_number", "block").groupBy("file_number", "block")
    filters = filters.applyInArrow(filter_of_block, "file_number long, block long, bloom binary")
    return filters.join(numbers, "file_number").select(*BLOCKS.names)


def file_name() -> Column:
    """The data file of a row, by the name that ``stored_files`` gives it."""
    return F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "file:///")


def stored_files(spark: SparkSession, table: str, schema: T.StructType) -> list[str]:
    """Names of the table's data files, as its reader lists them."""
    files = read_table(spark, table, schema).inputFiles()
    return sorted(re.sub("^file:/+", "file:///", f) for f in files)


def read_files(spark: SparkSession, files: list[str], schema: T.StructType) -> DataFrame:
    """The rows of some data files; names are as in URIs."""
    return spark.read.schema(schema).parquet(*map(unquote, files)) if files else empty(spark, schema)


def refresh(
    spark: SparkSession,
    table: str,
    schema: T.StructType = INVENTORY,
    keys: list[str] = EVENT_KEY,
    time: str = "event_timestamp",
) -> DataFrame:
    """The index of ``table``, with the files that it did not know added.

    Only those files are read, their keys and time alone. Rows of files that are
    gone stay unused.
    """
    files = stored_files(spark, table, schema)
    known = {row["file"] for row in read_table(spark, index_path(table), INDEX).select("file").collect()}
    missing = [f for f in files if f not in known]
    if missing:
        rows = read_files(spark, missing, schema).select(
            file_name().alias("file"), F.col(time).alias("time"), key_hash(keys).alias("h")
        )
        # A file with a missing time may match any range.
        ranged = rows.groupBy("file").agg(
            F.count("*").alias("rows"),
            F.when(F.count("time") == F.count("*"), F.min("time")).alias("low"),
            F.when(F.count("time") == F.count("*"), F.max("time")).alias("high"),
        )
        numbers = spark.createDataFrame(list(enumerate(missing)), "file_number long, file string")
        found = numbers.join(ranged, "file", "left").select(
            "file_number",
            "file",
            F.coalesce("rows", F.lit(0)).alias("rows"),  # of a file without rows
            "low",
            "high",
            F.lit(None).cast("binary").alias("bloom"),
            F.ceil(F.coalesce("rows", F.lit(0)) / BLOCK_ROWS).alias("blocks"),
        )
        found = materialize(found, "files")
        # A file is known once its row is there, after its blocks.
        append(block_filters(rows.drop("time"), found), blocks_path(table), BLOCKS)
        append(found, index_path(table), INDEX)
        discard(found)
    current = spark.createDataFrame([(f,) for f in files], "file string")
    index = read_table(spark, index_path(table), INDEX)
    return join_lookup(index, current, ["file"], "left_semi").dropDuplicates(["file"])


def files_that_may_hold(
    index: DataFrame,
    blocks: DataFrame,
    arriving: DataFrame,
    keys: list[str],
    time: str,
    most: int = MOST_PROBED,
) -> list[str]:
    """Files of ``index`` that may hold a key of ``arriving``.

    Files outside the batch's range of ``time`` go first, then those whose
    filters no key passes. Beyond ``most`` keys the range alone decides.
    """
    spark = index.sparkSession
    hashes = arriving.select(time, key_hash(keys).alias("h"))
    low, high, about = hashes.agg(F.min(time), F.max(time), F.approx_count_distinct("h")).first()
    near = index.filter("rows > 0")
    in_range = F.col("low").isNull() | ((F.col("high") >= F.lit(low)) & (F.col("low") <= F.lit(high)))
    if low is None:
        in_range = F.col("low").isNull()
    near = near.filter(in_range)  # rows without a time are in files without a range
    hashes = hashes.select("h").distinct()
    if about > 2 * most or hashes.limit(most + 1).count() > most:
        return sorted(row["file"] for row in near.select("file").collect())
    held = spark.sparkContext.broadcast(hashes.toArrow()["h"].to_numpy())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            passed = []
            for row in batch.select(["blocks", "block", "bloom"]).to_pylist():
                here = held.value[np.mod(held.value, row["blocks"]) == row["block"]]
                passed.append(may_hold(row["bloom"], here.view(np.uint64)))
            yield batch.select(["file"]).filter(pa.array(passed, pa.bool_()))

    whole = near.filter("blocks is null").select(
        "file", F.lit(1).alias("blocks"), F.lit(0).alias("block"), "bloom"
    )
    filters = join_lookup(blocks, near.select("file"), ["file"], "left_semi").union(whole)
    found = filters.mapInArrow(run, "file string").distinct()
    return sorted(row["file"] for row in found.collect())


def new_rows_indexed(
    incoming: DataFrame,
    table: str,
    schema: T.StructType = INVENTORY,
    keys: list[str] = EVENT_KEY,
    time: str = "event_timestamp",
    **options: object,
) -> tuple[DataFrame, list[str]]:
    """The same rows as ``new_rows`` against the stored table, and the files read.

    Keys are looked up exactly, in the files that may hold one.
    """
    spark = incoming.sparkSession
    index = refresh(spark, table, schema, keys, time)
    blocks = read_table(spark, blocks_path(table), BLOCKS)
    files = files_that_may_hold(index, blocks, incoming.select(*keys), keys, time)
    stored = read_files(spark, files, schema)
    return new_rows(incoming, stored, keys, prune_on=time, **options), files


def ingest_indexed(
    incoming: DataFrame, table: str, messages_path: str, **options: object
) -> int:
    """``writers.ingest`` whose reading follows the batch: append the rows not stored
    yet, publish exactly those, and index the new files; returns their number."""
    fresh, _ = new_rows_indexed(incoming.select(*INVENTORY.names), table, **options)
    fresh = materialize(fresh, "fresh")
    append(fresh, table, INVENTORY)
    publish(fresh, messages_path)
    refresh(incoming.sparkSession, table)
    count = fresh.count()
    discard(fresh)
    return count
