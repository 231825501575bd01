"""Schema versions: mixed folders are one table, and no file is rewritten."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockflow.functions.numbers import encode_little_endian
from stockflow.sources import versions as V
from tests.conftest import rows

FIRST = T.StructType([T.StructField(n, T.StringType()) for n in ("name", "quantity")])


def data_files(path):
    return {p: p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet") if "_versions" not in str(p)}


def test_mixed_folders_are_one_table(spark, tmp_path):
    path = str(tmp_path / "t")
    V.create(spark, path, FIRST)
    V.create(spark, path, FIRST)
    V.append_version(spark.createDataFrame([("a", "1"), ("b", "x"), ("c", None)], FIRST), path)
    before = data_files(path)
    V.change_column_type(spark, path, "quantity", T.LongType())
    V.change_column_type(spark, path, "quantity", T.LongType())
    V.add_column(spark, path, "category", T.StringType(), "N/A")
    V.add_column(spark, path, "category", T.StringType(), "other")
    V.append_version(spark.createDataFrame([("d", 7, "Toys")], "name string, quantity bigint, category string"), path)
    found = V.read_versions(spark, path)
    assert found.dtypes == [("name", "string"), ("quantity", "bigint"), ("category", "string")]
    assert rows(found) == [("a", 1, "N/A"), ("b", None, "N/A"), ("c", None, "N/A"), ("d", 7, "Toys")]
    assert before.items() <= data_files(path).items()
    assert [v.number for v in V.versions(spark, path)] == [1, 2, 3]


def test_bytes_become_numbers_and_filters_reach_the_files(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = [T.StructField("name", T.StringType()), T.StructField("actual_quantity", T.BinaryType())]
    V.create(spark, path, T.StructType(schema))
    numbers = spark.createDataFrame([("a", 300), ("b", 255), ("c", None)], "name string, n bigint")
    V.append_version(numbers.select("name", encode_little_endian(F.col("n")).alias("actual_quantity")), path)
    V.change_column_type(spark, path, "actual_quantity", T.LongType())
    V.append_version(numbers.withColumnRenamed("n", "actual_quantity"), path)
    found = V.read_versions(spark, path)
    assert rows(found) == sorted([("a", 300), ("b", 255), ("c", None)] * 2, key=repr)
    plan = found.filter("name = 'a'").select("name")._jdf.queryExecution().toString()
    assert plan.count("PushedFilters: [IsNotNull(name), EqualTo(name,a)]") == 2
    assert "actual_quantity" not in plan.split("== Physical Plan ==")[1]


def test_nothing_stored_yet(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(ValueError, match="no versions"):
        V.read_versions(spark, path)
    V.create(spark, path, FIRST)
    V.add_column(spark, path, "more", T.IntegerType())
    assert V.read_versions(spark, path).columns == ["name", "quantity", "more"]
    assert V.read_versions(spark, path).isEmpty()
    with pytest.raises(ValueError, match="no column"):
        V.change_column_type(spark, path, "other", T.LongType())
