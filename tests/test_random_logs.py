"""Every query on random logs against its SQL twin."""

from dataclasses import replace

import duckdb
from hypothesis import example, given

import __spark_entry__
from checks.oracle import oracle_queries
from tests.micro import arrow_log, at, micro_log
from tests.oracle_compare import duckdb_result, spark_result
from tests.random_logs import LOGS, few_logs

# A vendor whose stall counts are all NULL in one week, and in both.
NULL_VENDORS = [
    {"v1": v1, "time": at(day), "v4": v4, "device": day, "province": province}
    for v1, this, last in (("ws", None, 1), ("bd", 2, None), ("qn", None, None), ("tx", 0, 1))
    for day, v4 in ((2, last), (3, last), (9, this), (14, this))
    for province in ("A", "B")
]

SEEN: list[int] = []
MINIMA = {"province": 0, "node": 1, "weekly_province": 5, "point_node": 8}


@few_logs
@example(rows=NULL_VENDORS)
@given(rows=LOGS)
def test_queries_on_random_logs(spark, monkeypatch, rows):
    log = micro_log(spark, *rows).cache()
    s = replace(
        __spark_entry__.SETTINGS,
        **{f"{name}_min_rows": value for name, value in MINIMA.items()},
    )
    monkeypatch.setattr(__spark_entry__, "SETTINGS", s)
    monkeypatch.setattr(__spark_entry__, "_log", lambda spark, sf_dir: log)
    con = duckdb.connect()
    con.register("micro", arrow_log(*rows))
    sql = oracle_queries("SELECT * FROM micro", MINIMA)
    made = __spark_entry__.queries()
    # Stored reports write a store each time: on the first three logs.
    SEEN.append(len(rows))
    for name in sql:
        if "roundtrip" in name or name.startswith("stored_") and len(SEEN) > 3:
            continue
        query = made[name]
        names, expected, _ = duckdb_result(con, sql[name])
        got_names, got, _ = spark_result(query(spark, ""))
        assert (name, got_names, got) == (name, names, expected)
