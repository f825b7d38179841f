"""A report over any rollup equals the report over the rows."""

from dataclasses import replace

import pytest
from hypothesis import given

from lagscope import jobs
from lagscope.operators import rollup, views
from lagscope.plans import daily, points, weekly
from lagscope.sources.exports import in_window, row_counts
from tests.micro import SETTINGS, at, micro_log, values
from tests.random_logs import LOGS, few_logs


def same(left, right):
    def rounded(df):
        return [tuple(round(v, 9) if isinstance(v, float) else v for v in row) for row in values(df)]

    return rounded(left) == rounded(right)


@few_logs
@given(rows=LOGS)
def test_reports_over_rows_and_rollup_agree(spark, rows):
    s = SETTINGS
    log = micro_log(spark, *rows).cache()
    both = in_window(log, s.both_weeks())
    stalls, firsts = views.stall_facts(both, s), views.first_facts(both, s)
    rolled = jobs.Rollups.of(rollup.report_rollup(views.report_facts(both, s)).cache())
    assert same(daily.lag_requests(stalls), daily.lag_requests(rolled.stalls))
    assert same(daily.evening_lag_requests(stalls), daily.evening_lag_requests(rolled.stalls))
    assert same(daily.worst_provinces(stalls, s), daily.worst_provinces(rolled.stalls, s))
    assert same(daily.worst_nodes(stalls, s), daily.worst_nodes(rolled.nodes, s))
    assert same(daily.lag_by_isp_class(stalls), daily.lag_by_isp_class(rolled.stalls))
    assert same(daily.first_matrix(firsts), daily.first_matrix(rolled.firsts))
    direct = jobs.Rollups(stalls, stalls, firsts)
    over_rows, over_rollup = jobs.weekly_reports(direct, s), jobs.weekly_reports(rolled, s)
    for name in over_rows:
        assert same(over_rows[name], over_rollup[name]), name


@few_logs
@given(rows=LOGS)
def test_points_of_one_kind_and_of_all_agree(spark, rows):
    log = micro_log(spark, *rows).cache()
    facts = views.point_facts(log, SETTINGS)
    groups = rollup.point_groups(facts).cache()
    nodes, group_nodes = (points.valid_nodes(f, SETTINGS) for f in (facts, groups))
    for by_node in (True, False):
        for report, kinds in (
            (points.connect_lag, (views.CONNECT, views.STALL)),
            (points.first, (views.FIRST,)),
        ):
            few = rollup.point_groups(views.point_facts(log, SETTINGS, kinds))
            expected = sorted(values(report(few, nodes, SETTINGS, by_node)), key=str)
            got = sorted(values(report(groups, group_nodes, SETTINGS, by_node)), key=str)
            assert got == expected


def test_day_of_month_and_date_group_alike_within_a_week(spark):
    log = micro_log(spark, *[{"time": at(d, h)} for d in range(1, 15) for h in (0, 23)])
    for window in (SETTINGS.this_week(), SETTINGS.last_week()):
        days = in_window(log, window).selectExpr("day(time) AS d", "CAST(time AS DATE) AS e")
        assert days.select("d").distinct().count() == days.distinct().count() == 7


def test_unknown_node_is_not_mistaken_for_the_other_key_set(spark):
    facts = views.report_facts(micro_log(spark, {"v2": None, "v4": 1}, {"v2": "a"}), SETTINGS)
    rolled = rollup.report_rollup(facts)
    assert values(rollup.level(rolled, "dims", views.STALL), "row_n") == [(2,)]
    nodes = values(rollup.level(rolled, "node", views.STALL), "v2", "row_n")
    assert sorted(nodes, key=str) == [("a", 1), (None, 1)]


def store_days(spark, store, window, *rows, s=SETTINGS):
    log = micro_log(spark, *rows)
    rolled = rollup.report_rollup(views.report_facts(log, s))
    rollup.write_days(rolled, row_counts(log), s, window, store)


def days(*numbers):
    return at(numbers[0]).date(), at(numbers[-1] + 1).date()


def stored_rows(spark, store, window, kind=views.STALL):
    rows = rollup.level(rollup.read_store(spark, store, window, SETTINGS), "dims", kind)
    return values(rows.groupBy("export_day").sum("row_n").orderBy("export_day"))


def test_store_replaces_a_day_and_keeps_the_others(spark, tmp_path):
    store = str(tmp_path / "store")
    first = {"time": at(14), "tag": "first"}
    store_days(spark, store, days(13, 14), {"time": at(13)}, {"time": at(14)}, first)
    store_days(spark, store, days(14), *[{"time": at(14)}] * 3)
    assert [n for _, n in stored_rows(spark, store, days(13, 14))] == [1, 3]
    assert stored_rows(spark, store, days(13, 14), views.FIRST) == []
    with pytest.raises(ValueError, match="2017-04-12"):
        rollup.read_store(spark, store, days(12, 14), SETTINGS)


def test_a_day_may_be_empty_and_become_empty(spark, tmp_path):
    store = str(tmp_path / "store")
    blocked = {"time": at(14), "client_ip": "192.0.2.1"}
    store_days(spark, store, days(13), {"time": at(13), "room_id": -1})
    assert stored_rows(spark, store, days(13)) == []
    store_days(spark, store, days(14), {"time": at(14)})
    store_days(spark, store, days(14), blocked)
    assert stored_rows(spark, store, days(13, 14)) == []
    counts = values(rollup.read_records(spark, store, days(13, 14)), "log_rows")
    assert counts == [(1,), (1,)]


@pytest.mark.parametrize(
    "other", [{"blocked_ips": ()}, {"first_max_ms": 9_000}, {"evening_hour": 18}]
)
def test_a_store_of_other_settings_is_refused(spark, tmp_path, other):
    store = str(tmp_path / "store")
    store_days(spark, store, days(14), {"time": at(14)}, s=replace(SETTINGS, **other))
    with pytest.raises(ValueError, match="other settings: 2017-04-14"):
        rollup.read_store(spark, store, days(14), SETTINGS)


def test_a_run_that_broke_off_leaves_the_day_missing(spark, tmp_path):
    store = str(tmp_path / "store")
    store_days(spark, store, days(14), {"time": at(14)})
    bad = micro_log(spark, {"time": at(14)}).selectExpr("*", "raise_error('stop') AS x")
    rolled = rollup.report_rollup(views.report_facts(bad.filter("x IS NULL"), SETTINGS))
    with pytest.raises(Exception, match="stop"):
        rollup.write_days(rolled, row_counts(bad), SETTINGS, days(14), store)
    with pytest.raises(ValueError, match="lacks 2017-04-14"):
        rollup.read_store(spark, store, days(14), SETTINGS)
