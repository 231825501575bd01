"""Every registered query with an SQL equivalent gives the same bag of rows."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from stockflow.plans.oracles import ORACLES
from stockflow.plans.registered import QUERIES
from tests.compare import connect, difference

# Fitted models and isolation forests: no SQL equivalent, tested on their own.
WITHOUT_SQL = {
    "arima_forecast",
    "gbt_forecast",
    "iforest_baseline_forecast",
    "trend_seasonal_forecast",
    "trend_seasonal_by_store",
    "iforest_group_anomalies",
    "iforest_record_anomalies",
}


@pytest.fixture(scope="module")
def tables(small):
    return connect(small)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, small, tables, name):
    only_spark, only_sql = difference(QUERIES[name](spark, small), tables, ORACLES[name])
    assert not only_spark and not only_sql


def test_every_other_query_is_a_model():
    assert set(QUERIES) - set(ORACLES) == WITHOUT_SQL
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())


def test_entry_has_rows(spark):
    result = entry(spark)
    assert result.columns[0] == "product_id"
    assert not result.isEmpty()
