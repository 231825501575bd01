"""Batch readers; each enforces the fixed schema of its table."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockflow.fixed_values import ISO_Z
from stockflow.functions.timestamps import parse_lenient, render
from stockflow.operators.metrics import decode_messages, parse_events, require_columns
from stockflow.operators.reports import of_model
from stockflow.schemas import FORECASTS, INVENTORY, INVENTORY_CSV


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet table at ``path``; an empty frame if there is none yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty(spark, schema)


def read_catalog_table(spark: SparkSession, name: str, schema: T.StructType) -> DataFrame:
    """Catalog table ``name`` in the fixed schema, or an empty frame."""
    return spark.table(name).to(schema) if spark.catalog.tableExists(name) else empty(spark, schema)


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """Exported CSV events in the inventory layout, times brought to ISO form.

    Columns are found by the names in the header, in any order; others are not
    read. A missing column, or files with different headers, are an error.
    """
    reader = spark.read.option("header", True).option("inferSchema", False)
    header = require_columns(reader.csv(path), INVENTORY_CSV.names).columns
    texts = T.StructType([T.StructField(name, T.StringType()) for name in header])
    rows = reader.schema(texts).option("enforceSchema", False).csv(path)
    rows = rows.select(
        *[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in INVENTORY_CSV.fields]
    )
    time = render(parse_lenient(F.col("event_timestamp")), ISO_Z)
    return (
        rows.withColumnRenamed("store_id", "store_location")
        .withColumn("event_timestamp", time)
        .select(*INVENTORY.names)
    )


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """Files with one JSON event per line, parsed."""
    return decode_messages(spark.read.text(path))


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    driver: str | None = None,
    split_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    partitions: int = 1,
    fetch_rows: int = 10_000,
) -> DataFrame:
    """JDBC scan; with ``split_column`` and ``bounds`` it reads in parallel.

    Filters and column choices on the result are pushed to the database.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    reader = reader.option("fetchsize", fetch_rows)
    if driver:
        reader = reader.option("driver", driver)
    if split_column:
        if bounds is None:
            raise ValueError("a split column needs bounds")
        reader = (
            reader.option("partitionColumn", split_column)
            .option("lowerBound", str(bounds[0]))
            .option("upperBound", str(bounds[1]))
            .option("numPartitions", partitions)
        )
    return reader.load()


def read_events(primary: DataFrame | None, fallback: DataFrame) -> DataFrame:
    """Parsed events of the primary source, of the fallback if that is empty."""
    chosen = fallback if primary is None or primary.isEmpty() else primary
    if chosen.isEmpty():
        raise ValueError("neither source has events")
    return parse_events(chosen)


def read_forecasts(spark: SparkSession, path: str, model_name: str) -> DataFrame:
    """One model's rows of the forecast table; only its folder is listed."""
    return of_model(read_table(spark, path, FORECASTS), model_name)
