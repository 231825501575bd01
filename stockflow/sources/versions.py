"""Tables whose columns change without a rewrite: a schema version per folder.

Every version's rows lie in ``<table>/version=N`` and its schema, with defaults
for columns that older versions lack, in ``<table>/_versions/N``. Adding a
column or changing a type writes a new schema and no data; older files are
widened when they are read.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockflow.functions.numbers import decode_little_endian
from stockflow.sources.readers import empty, read_table

SCHEMAS = T.StructType(
    [
        T.StructField("version", T.IntegerType()),
        T.StructField("schema", T.StringType()),
        T.StructField("defaults", T.StringType()),
    ]
)


@dataclass(frozen=True)
class Version:
    number: int
    schema: T.StructType
    defaults: dict[str, object]


def versions(spark: SparkSession, table: str) -> list[Version]:
    """All schema versions in their order; a table has few."""
    rows = read_table(spark, f"{table.rstrip('/')}/_versions", SCHEMAS).collect()
    return [
        Version(r["version"], T.StructType.fromJson(json.loads(r["schema"])), json.loads(r["defaults"]))
        for r in sorted(rows, key=lambda r: r["version"])
    ]


def _add(spark: SparkSession, table: str, version: Version) -> None:
    row = (version.number, version.schema.json(), json.dumps(version.defaults))
    frame = spark.createDataFrame([row], SCHEMAS).coalesce(1)
    # A folder of its own: two writers of one version cannot both succeed.
    folder = f"{table.rstrip('/')}/_versions/number={version.number}"
    frame.write.mode("errorifexists").parquet(folder)


def create(spark: SparkSession, table: str, schema: T.StructType) -> None:
    """Start a table with its first version; nothing happens if there is one."""
    if not versions(spark, table):
        _add(spark, table, Version(1, schema, {}))


def latest(spark: SparkSession, table: str) -> Version:
    known = versions(spark, table)
    if not known:
        raise ValueError(f"{table} has no versions")
    return known[-1]


def add_column(
    spark: SparkSession, table: str, name: str, kind: T.DataType, default: object = None
) -> None:
    """A new column, with a default for the rows that are there; no file is written."""
    last = latest(spark, table)
    if name in last.schema.names:
        return
    schema = T.StructType([*last.schema.fields, T.StructField(name, kind)])
    _add(spark, table, Version(last.number + 1, schema, {**last.defaults, name: default}))


def change_column_type(spark: SparkSession, table: str, name: str, kind: T.DataType) -> None:
    """Another type of a column from now on; no file is written."""
    last = latest(spark, table)
    if name not in last.schema.names:
        raise ValueError(f"{table} has no column {name}")
    if last.schema[name].dataType == kind:
        return
    fields = [T.StructField(f.name, kind if f.name == name else f.dataType) for f in last.schema]
    _add(spark, table, Version(last.number + 1, T.StructType(fields), last.defaults))


def append_version(df: DataFrame, table: str) -> None:
    """Append rows in the latest version's schema."""
    last = latest(df.sparkSession, table)
    folder = f"{table.rstrip('/')}/version={last.number}"
    df.select(*last.schema.names).to(last.schema).write.mode("append").parquet(folder)


def read_versions(spark: SparkSession, table: str) -> DataFrame:
    """All rows in the latest schema; values that do not convert become null.

    Each version is a scan of its own, so column pruning, and filters on columns
    whose type stayed, reach the files of all versions.
    """
    known = versions(spark, table)
    if not known:
        raise ValueError(f"{table} has no versions")
    target = known[-1]
    parts = []
    for version in known:
        path = f"{table.rstrip('/')}/version={version.number}"
        try:
            rows = spark.read.schema(version.schema).parquet(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            continue  # no row was stored under this version
        parts.append(rows.select(*[_widened(f, version, target) for f in target.schema.fields]))
    if not parts:
        return empty(spark, target.schema)
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def _widened(field: T.StructField, version: Version, target: Version) -> Column:
    if field.name not in version.schema.names:
        return F.lit(target.defaults.get(field.name)).cast(field.dataType).alias(field.name)
    value = F.col(field.name)
    before = version.schema[field.name].dataType
    if before == field.dataType:
        return value
    if isinstance(before, T.BinaryType) and isinstance(field.dataType, T.IntegralType):
        value = decode_little_endian(value)  # whole numbers stored as bytes
    return value.try_cast(field.dataType).alias(field.name)
