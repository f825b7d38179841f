"""The physical plans the reports rely on."""

import pytest

from __spark_entry__ import SETTINGS, queries
from checks.oracle import oracle_queries
from lagscope.operators import rollup, views
from lagscope.sources.exports import in_window
from lagscope.sources.sample_log import exported_log

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# Queries that are one plan. The others write a table first and read it.
WRITES = ("roundtrip", "stored_", "points_connect_lag", "points_first")
PLANNED = [n for n in oracle_queries() if not any(w in n for w in WRITES)]


@pytest.fixture(scope="module")
def plans(spark):
    return {n: plan(queries()[n](spark, SF_DIR)) for n in PLANNED}


def test_no_python_no_cross_join(plans):
    for name, text in plans.items():
        assert "Python" not in text, name
        assert "CartesianProduct" not in text, name
        assert "BroadcastNestedLoopJoin" not in text, name


def test_filters_reach_the_scan(plans):
    text = plans["daily_lag_by_cdn"]
    assert "PartitionFilters: [isnotnull(event_date" in text
    pushed = text.split("PushedFilters: [")[1].split("]")[0]
    for part in ("EqualTo(tag,monitor)", "GreaterThan(v5,1)", "Not(EqualTo(client_ip,192.0.2.1))"):
        assert part in pushed
    schema = text.split("ReadSchema: struct<")[1].split(">")[0]
    columns = {c.split(":")[0] for c in schema.split(",")}
    # The day is known from the folders.
    assert columns == {"tag", "room_id", "client_ip", "v1", "v4", "v5"}


def test_node_counts_read_one_column(plans):
    schema = plans["points_valid_nodes"].split("ReadSchema: struct<")[1].split(">")[0]
    assert {c.split(":")[0] for c in schema.split(",")} == {"v2"}


def test_one_scan_for_reports_that_compare(plans):
    for name in plans:
        assert plans[name].count("FileScan parquet") == 1, name


def test_points_read_the_log_once(spark):
    """Groups and nodes come from one kept table; the log is read to make it."""
    for name in oracle_queries():
        if name.startswith(("points_connect", "points_first")):
            text = plan(queries()[name](spark, SF_DIR))
            assert "FileScan parquet" not in text, name
            assert text.count("ExistingRDD") == 2, name


def test_top_rows_are_cut_before_the_shuffle(plans):
    for name in (
        "daily_worst_provinces",
        "daily_worst_nodes",
        "weekly_worst_provinces",
        "weekly_best_provinces",
        "weekly_best_provinces_by_cdn",
        "weekly_worst_provinces_by_cdn",
    ):
        assert plans[name].count("WindowGroupLimit") == 2, name


def test_aggregates_combine_before_each_shuffle(plans):
    for name, text in plans.items():
        assert "partial_" in text or "distinct" in name or name == "udf_contains", name


def test_large_node_sets_join_groups_and_not_rows(spark):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("points_connect_lag", "points_first", "points_first_noip"):
            text = plan(queries()[name](spark, SF_DIR))
            left, right = text.partition("LeftSemi")[2].split("Scan ExistingRDD")[1:3]
            # Both sides are the groups, of which the nodes are summed up.
            assert "HashAggregate" in text.partition("LeftSemi")[2] and left and right, name
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_rollup_reads_the_log_once(spark):
    log = in_window(exported_log(spark, SF_DIR), SETTINGS.both_weeks())
    for rolled in (
        rollup.report_rollup(views.report_facts(log, SETTINGS)),
        rollup.point_groups(views.point_facts(log, SETTINGS)),
    ):
        text = plan(rolled)
        assert text.count("FileScan parquet") == 1
        assert text.count("Exchange") == 1


def test_only_bounded_frames_are_broadcast_by_hint(spark):
    for name in PLANNED:
        hinted = "ResolvedHint" in queries()[name](spark, SF_DIR)._jdf.queryExecution().analyzed().toString()
        assert hinted == (name in ("daily_lag_matrix", "daily_first_matrix")), name
