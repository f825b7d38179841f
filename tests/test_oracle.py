"""Every registered query against its SQL twin."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.oracle import oracle_queries
from tests.oracle_compare import connect, duckdb_result, spark_result

SF_DIRS = ["/root/testdata/sf0.001", "/root/testdata/sf0.01"]
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def engines():
    return {d: connect(d) for d in SF_DIRS}


def test_every_query_has_a_twin():
    # Queries of the optional part have tests of their own.
    own = oracle_queries()
    assert own.keys() <= queries().keys() and own.items() <= oracle_sql().items()
    assert len(own) == 47


@pytest.mark.parametrize("sf_dir", SF_DIRS)
@pytest.mark.parametrize("name", list(oracle_queries()))
def test_query_equals_sql(spark, engines, name, sf_dir):
    names, expected, types = duckdb_result(engines[sf_dir], oracle_sql()[name])
    got_names, got, got_types = spark_result(queries()[name](spark, sf_dir))
    assert got_names == names
    assert {n: TYPES[t] for n, t in got_types.items()} == types
    assert got == expected


# Sizes of the results, counted apart from both sides.
SIZES = {
    "daily_lag_requests": 40,
    "daily_lag_viewers": 40,
    "evening_lag_requests": 40,
    "evening_lag_viewers": 40,
    "daily_worst_provinces": 93,
    "daily_worst_nodes": 65,
    "daily_lag_by_cdn": 8,
    "daily_lag_by_isp_class": 24,
    "daily_lag_matrix": 8,
    "weekly_valid_provinces": 17,
    "weekly_worst_provinces": 5,
    "weekly_best_provinces_by_cdn": 40,
    "points_valid_nodes": 38,
    "points_connect_lag": 1204,
    "points_first": 1190,
    "points_connect_lag_noip": 1105,
    "points_first_noip": 1125,
}


@pytest.mark.parametrize("name", list(SIZES))
def test_result_sizes(spark, name):
    assert queries()[name](spark, "/root/testdata/sf0.01").count() == SIZES[name]


def test_entry(spark):
    result = entry(spark)
    assert result.columns == ["cdn", "lag_ratio"]
    assert result.count() == 8
