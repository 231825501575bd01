"""Keyed updates of a stored table that rewrite only the files they touch.

The new versions of the touched files are written beside the table first; a
note that names the files they replace makes the update certain. Then the old
files go and the new ones take their place. An update that stopped before its
note is forgotten, one that stopped after it is completed by ``recover``, which
every update begins with. Untouched files keep their names.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockflow.operators.joins import join_lookup, latest_per_key
from stockflow.operators.sampling import apply_overrides
from stockflow.operators.series import attach_actuals
from stockflow.schemas import EVENT_KEY, FORECASTS, INVENTORY
from stockflow.session import materialize
from stockflow.sources.key_index import file_name, read_files, stored_files

PREFIX = "_update-"


class _Folder:
    """File operations on a table's folder in any file system that Spark reaches."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.jvm = spark.sparkContext._jvm
        self.root = self.path(path.rstrip("/"))
        configuration = spark.sparkContext._jsc.hadoopConfiguration()
        self.system = self.root.getFileSystem(configuration)

    def path(self, *parts: object):
        return self.jvm.org.apache.hadoop.fs.Path(*parts)

    def updates(self) -> list:
        """Folders of updates that did not end."""
        if not self.system.exists(self.root):
            return []
        found = [status.getPath() for status in self.system.listStatus(self.root)]
        return [p for p in found if p.getName().startswith(PREFIX)]

    def write_text(self, path, text: str) -> None:
        out = self.system.create(path, True)
        out.write(bytearray(text.encode()))
        out.close()

    def read_text(self, path) -> str:
        source = self.system.open(path)
        text = self.jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
        source.close()
        return text

    def data_files(self, folder) -> list:
        """Data files below ``folder``, with those of its partition folders."""
        found = []
        for status in self.system.listStatus(folder):
            if status.isDirectory():
                found += self.data_files(status.getPath())
            elif not status.getPath().getName().startswith(("_", ".")):
                found.append(status.getPath())
        return found


def recover(spark: SparkSession, table: str) -> None:
    """Complete or forget updates of ``table`` that were interrupted."""
    folder = _Folder(spark, table)
    for update in folder.updates():
        note = folder.path(update, "_replaces")
        if folder.system.exists(note):
            _complete(folder, update, json.loads(folder.read_text(note)))
        folder.system.delete(update, True)
    spark.catalog.refreshByPath(table)


def _complete(folder: _Folder, update, replaced: list[str]) -> None:
    for name in replaced:
        folder.system.delete(folder.path(name), False)
    staged = folder.path(update, "files")
    start = len(staged.toUri().getPath()) + 1
    for file in folder.data_files(staged):
        # Partition folders stay the same below the table.
        target = folder.path(folder.root, file.toUri().getPath()[start:])
        folder.system.mkdirs(target.getParent())
        if not folder.system.rename(file, target):
            raise OSError(f"{file.toString()} cannot be renamed")


def update_files(
    spark: SparkSession,
    table: str,
    schema: T.StructType,
    touched: Callable[[DataFrame], DataFrame],
    changed: Callable[[DataFrame], DataFrame],
    partitioned_by: tuple[str, ...] = (),
) -> list[str]:
    """Rewrite the files of ``table`` that hold a row of ``touched``; returns their names.

    ``touched`` picks the rows that will change, ``changed`` gives the new
    version of all rows of such files. Nothing is written if no row is touched.
    Readers see the old files, none of both, or the new ones.
    """
    recover(spark, table)
    files = stored_files(spark, table, schema)
    if not files:
        return []
    rows = spark.read.schema(schema).parquet(table).withColumn("__file", file_name())
    names = touched(rows).select("__file").distinct()
    hit = sorted(row["__file"] for row in names.collect())  # no more than the table has files
    if not hit:
        return []
    folder = _Folder(spark, table)
    update = folder.path(folder.root, f"{PREFIX}{uuid.uuid4().hex}")
    base = spark.read.option("basePath", table).schema(schema).parquet(*map(unquote, hit))
    writer = changed(base).select(*schema.names).write
    if partitioned_by:
        writer = writer.partitionBy(*partitioned_by)
    writer.parquet(folder.path(update, "files").toString())
    note = folder.path(update, "_replaces")
    # Written under another name first: the note is there as a whole or not at all.
    draft = folder.path(update, "_draft")
    folder.write_text(draft, json.dumps([unquote(f) for f in hit]))
    if not folder.system.rename(draft, note):
        raise OSError(f"{note.toString()} cannot be written")
    recover(spark, table)
    return hit


def override_stored(
    spark: SparkSession,
    table: str,
    overrides: DataFrame,
    schema: T.StructType = INVENTORY,
    keys: list[str] = EVENT_KEY,
) -> list[str]:
    """``sampling.apply_overrides`` on a stored table, file by file."""
    changed = [c for c in overrides.columns if c not in keys]
    overrides = latest_per_key(overrides.dropna(subset=keys), keys, changed)
    overrides = materialize(overrides, "overrides")

    def touched(rows: DataFrame) -> DataFrame:
        return join_lookup(
            rows.select(*keys, "__file"), overrides.select(*keys), keys, "left_semi", written=True
        )

    return update_files(
        spark, table, schema, touched, lambda rows: apply_overrides(rows, overrides, keys)
    )


def fill_stored_actuals(
    spark: SparkSession,
    table: str,
    observed: DataFrame,
    keys: list[str],
    schema: T.StructType = FORECASTS,
    partitioned_by: tuple[str, ...] = ("model_name",),
) -> list[str]:
    """``series.attach_actuals`` on a stored table: only files with a missing actual
    quantity that was observed are rewritten."""
    totals = observed.groupBy(*keys).agg(F.sum("actual_quantity").alias("actual_quantity"))
    totals = materialize(totals.filter("actual_quantity is not null"), "observed")

    def touched(rows: DataFrame) -> DataFrame:
        missing = rows.filter(F.col("actual_quantity").isNull()).select(*keys, "__file")
        return join_lookup(missing, totals.select(*keys), keys, "left_semi", written=True)

    return update_files(
        spark,
        table,
        schema,
        touched,
        lambda rows: attach_actuals(rows, totals, keys),
        partitioned_by,
    )


def backfill_stored(
    spark: SparkSession,
    table: str,
    schema: T.StructType,
    missing: Callable[[DataFrame], DataFrame],
    filled: Callable[[DataFrame], DataFrame],
) -> list[str]:
    """A column filled where it is missing, in the files where it is."""
    return update_files(spark, table, schema, missing, filled)
