"""Every report on a log of which a third is one key, against its SQL twin."""

from dataclasses import replace

import duckdb
import pytest

import __spark_entry__
from checks.oracle import oracle_queries
from tests.oracle_compare import duckdb_result, spark_result
from tests.skewed_log import minima, skewed_log

ROWS = 120_000
NAMES = [n for n in oracle_queries() if "roundtrip" not in n and not n.startswith("stored_")]


@pytest.fixture(scope="module")
def log(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("skewed") / "log")
    skewed_log(spark, ROWS).repartition(8).write.parquet(path)
    return path


def test_a_third_is_one_key(spark, log):
    rows = spark.read.parquet(log)
    for column, value in (("v1", "ws"), ("v2", "n0"), ("province", "P0"), ("device", 7)):
        assert rows.filter(rows[column] == value).count() > 0.33 * ROWS


def test_there_are_35_queries():
    assert len(NAMES) >= 35


@pytest.mark.parametrize("name", NAMES)
def test_query_on_a_skewed_log(spark, log, monkeypatch, name):
    least = minima(ROWS)
    s = replace(__spark_entry__.SETTINGS, **{f"{k}_min_rows": v for k, v in least.items()})
    monkeypatch.setattr(__spark_entry__, "SETTINGS", s)
    monkeypatch.setattr(__spark_entry__, "_log", lambda spark, sf_dir: spark.read.parquet(log))
    sql = oracle_queries(f"SELECT * FROM read_parquet('{log}/*.parquet')", least)[name]
    names, expected, _ = duckdb_result(duckdb.connect(), sql)
    got_names, got, _ = spark_result(__spark_entry__.queries()[name](spark, ""))
    assert (got_names, got) == (names, expected)
    assert expected
