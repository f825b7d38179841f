"""Weekly report on hand-made logs."""

from dataclasses import replace

from lagscope.operators import views
from lagscope.plans import weekly
from tests.micro import SETTINGS, at, micro_log, values


def facts(spark, *rows):
    return views.stall_facts(micro_log(spark, *rows), SETTINGS)


def test_days_weigh_the_same(spark):
    rows = facts(
        spark,
        {"time": at(14), "v4": 1},
        *[{"time": at(13), "v4": 0} for _ in range(9)],
        {"time": at(2), "v4": 0},
    )
    assert values(weekly.total_trend(rows, SETTINGS)) == [(0.5, 0.0, "↑", 0.5)]


def test_weeks_are_half_open(spark):
    rows = facts(
        spark,
        {"time": at(15, 0), "v4": 9},
        {"time": at(14, 23), "v4": 1},
        {"time": at(8, 0), "v4": 1},
        {"time": at(7, 23), "v4": 2},
        {"time": at(1, 0), "v4": 2},
    )
    assert values(weekly.total_trend(rows, SETTINGS)) == [(1.0, 2.0, "↓", -1.0)]


def test_missing_week_has_no_arrow(spark):
    rows = facts(spark, {"time": at(14), "v4": 1})
    assert values(weekly.total_trend(rows, SETTINGS)) == [(1.0, None, "", None)]


def test_vendor_must_be_in_both_weeks(spark):
    rows = facts(
        spark,
        {"time": at(14), "v1": "ws"},
        {"time": at(2), "v1": "ws"},
        {"time": at(14), "v1": "bd"},
        {"time": at(2), "v1": "tx"},
    )
    assert values(weekly.cdn_trend(rows, SETTINGS)) == [("网宿", 0.0, 0.0, "", 0.0)]


def test_edu_trend_reads_only_the_education_network(spark):
    rows = facts(spark, {"isp": "教育网", "v4": 1}, {"isp": "电信"}, {"isp": "教育网", "time": at(3)})
    assert values(weekly.edu_trend(rows, SETTINGS)) == [(1.0, 0.0, "↑", 1.0)]


def test_matrix_aligns_by_vendor(spark):
    rows = facts(
        spark,
        {"v1": "ws", "platform": 1, "v4": 1},
        {"v1": "bd", "platform": 5, "v4": 2},
        {"v1": "bd", "platform": 2, "v4": 3},
        {"v1": "tx", "platform": 9},
    )
    assert values(weekly.lag_matrix(rows, SETTINGS)) == [
        ("网宿", None, 1.0, None),
        ("百度", 2.0, None, 3.0),
    ]


def test_short_education_list(spark):
    rows = facts(
        spark,
        {"province": "A", "v4": 1},
        {"province": "B", "v4": 2},
        {"province": "A", "isp": "教育网", "v4": 5},
        {"province": "中国", "v4": 9},
        {"province": None, "v4": 9},
        {"province": "X", "country": "海外", "v4": 9},
    )
    assert values(weekly.worst_provinces(rows, SETTINGS)) == [
        (1, "A", 3.0, "A", 5.0),
        (2, "B", 2.0, None, None),
    ]


def test_best_provinces_need_enough_rows_over_all_countries(spark):
    rows = facts(
        spark,
        {"province": "A", "v4": 1},
        {"province": "A", "country": "海外"},
        {"province": "B", "v4": 0},
        *[{"province": "C", "country": "海外"} for _ in range(5)],
    )
    strict = replace(SETTINGS, weekly_province_min_rows=1)
    assert sorted(values(weekly.valid_provinces(rows, strict))) == [("A",), ("C",)]
    assert values(weekly.best_provinces(rows, strict)) == [(1, "A", 1.0, None, None)]
    assert values(weekly.best_provinces_by_cdn(rows, strict)) == [(1, "七牛", "A", 1.0)]


def test_valid_rows_count_over_vendors(spark):
    rows = facts(spark, {"province": "A", "v1": "ws"}, {"province": "A", "v1": "bd"}, {"province": "B"})
    strict = replace(SETTINGS, weekly_province_min_rows=1)
    assert values(weekly.worst_provinces_by_cdn(rows, strict)) == [
        (1, "网宿", "A", 0.0),
        (1, "百度", "A", 0.0),
    ]


def test_unknown_ratio_is_never_the_best(spark):
    rows = facts(spark, {"province": "A", "v4": None}, {"province": "B", "v4": 1})
    assert values(weekly.best_provinces(rows, SETTINGS), "rank", "province", "ratio") == [
        (1, "B", 1.0),
        (2, "A", None),
    ]


def test_ties_by_province_in_both_directions(spark):
    rows = facts(spark, *[{"province": p} for p in "CAB"])
    for report in (weekly.best_provinces, weekly.worst_provinces):
        assert [r[0] for r in values(report(rows, SETTINGS), "province")] == ["A", "B", "C"]


def test_list_of_an_item_without_a_name_is_kept_out(spark):
    rows = facts(spark, {"province": None, "v4": 3})
    assert values(weekly.worst_provinces(rows, SETTINGS)) == []
