"""The registered text queries against their SQL."""

import pytest

import __spark_entry__
from lagscope.llm.queries import oracle_sql, queries
from tests.oracle_compare import connect, duckdb_result, spark_result

SF = "/root/testdata/sf0.01"


def test_all_are_registered():
    registered, sql = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert queries().keys() | {"pipeline"} <= registered.keys()
    assert all(isinstance(text, str) for text in sql.values())
    assert sql.keys() <= registered.keys()
    assert [sum(k.startswith(f"op{n}_") for k in registered) for n in range(1, 14)] == [1] * 13


@pytest.mark.parametrize("name", list(oracle_sql()))
def test_query_equals_sql(spark, name):
    names, expected, _ = duckdb_result(connect(SF), oracle_sql()[name])
    got_names, got, _ = spark_result(queries()[name](spark, SF))
    assert got_names == names and got == expected
