"""Daily report on hand-made logs."""

from lagscope.operators import rollup, views
from lagscope.plans import daily
from tests.micro import SETTINGS, at, micro_log, values


def facts(spark, *rows):
    return views.stall_facts(micro_log(spark, *rows), SETTINGS)


def test_filters_drop_unknown_rooms_and_addresses(spark):
    kept = facts(
        spark,
        {},
        {"room_id": -1},
        {"room_id": None},
        {"client_ip": "192.0.2.1"},
        {"client_ip": None},
        {"v5": 1},
        {"v5": None},
        {"tag": "first"},
        {"v5": 2},
    )
    assert kept.count() == 2


def test_unknown_addresses_drop_out_with_any_blocklist(spark):
    log = micro_log(spark, {"client_ip": None}, {"client_ip": "192.0.2.1"}, {})
    from dataclasses import replace

    assert views.stall_facts(log, replace(SETTINGS, blocked_ips=())).count() == 2
    assert views.stall_facts(log, SETTINGS).count() == 1


def test_first_bounds(spark):
    log = micro_log(spark, *[{"tag": "first", "v5": v} for v in (0, 1, 10000, 10001, 30000, 30001)])
    assert values(views.first_facts(log, SETTINGS), "value_sum") == [(1,), (10000,)]


def test_the_two_ratios_differ_on_missing_values(spark):
    rows = facts(spark, {"v4": 1}, {"v4": None}, {"v4": 0})
    assert values(daily.lag_requests(rows), "lag_count", "total_count", "lag_ratio") == [(1, 2, 0.5)]
    assert values(daily.lag_by_cdn(rows)) == [("七牛", 1 / 3)]


def test_only_missing_values_give_no_ratio(spark):
    rows = facts(spark, {"v4": None}, {"v4": None})
    assert values(daily.lag_requests(rows), "lag_count", "total_count", "lag_ratio") == [
        (None, 0, None)
    ]
    assert values(daily.total_lag(rows)) == [(None,)]


def test_vendor_order_and_unknown_code(spark):
    rows = facts(spark, *[{"v1": c} for c in ("zz", "js", "qn", "ws", "bd", "al", "yf", "tx", None)])
    got = [r[0] for r in values(daily.lag_by_cdn(rows))]
    assert got == ["网宿", "百度", "腾讯", "阿里", "七牛", "云帆", "金山", "未定义"]


def test_rows_are_numbered_by_vendor_then_platform(spark):
    rows = facts(spark, {"platform": 5}, {"platform": 14}, {"platform": 1}, {"v1": "ws", "platform": 9})
    got = values(daily.lag_requests(rows), "row_number", "cdn", "platform1", "total_count")
    assert got == [(1, "网宿", 9, 1), (2, "七牛", 1, 1), (3, "七牛", 5, 2)]


def test_viewers(spark):
    rows = facts(
        spark,
        {"device": 1, "v4": 0},
        {"device": 1, "v4": 3},
        {"device": 1, "v4": None},
        {"device": 2, "v4": None, "time": at(14, 20)},
        {"device": 3, "v4": -1, "time": at(14, 19)},
        {"device": 3, "v4": 0, "time": at(14, 18)},
    )
    counts = rollup.viewer_counts(rows)
    assert values(daily.lag_viewers(counts), "lag_person", "total_person") == [(2, 3)]
    assert values(daily.evening_lag_viewers(counts), "lag_person", "total_person") == [(1, 2)]


def test_viewer_counts_evening_only_when_stalled_by_day(spark):
    rows = facts(
        spark,
        {"device": 1, "v4": 1, "time": at(14, 9)},
        {"device": 1, "v4": 0, "time": at(14, 22)},
    )
    counts = rollup.viewer_counts(rows)
    assert values(daily.evening_lag_viewers(counts), "lag_person", "total_person") == [(0, 1)]


def test_no_evening_rows_give_an_empty_evening_report(spark):
    counts = rollup.viewer_counts(facts(spark, {"time": at(14, 18)}))
    assert values(daily.evening_lag_viewers(counts)) == []


def test_ties_are_broken_by_name(spark):
    rows = facts(spark, {"province": "B"}, {"province": "A"}, {"province": "C", "v4": 1})
    got = values(daily.worst_provinces(rows, SETTINGS), "row_number", "province")
    assert got == [(1, "C"), (2, "A"), (3, "B")]


def test_unknown_ratio_is_never_the_worst(spark):
    rows = facts(spark, {"v2": "a", "v4": None}, {"v2": "b", "v4": 0}, {"v2": ""}, {"v2": None})
    # A node whose values are all missing has no rows with a value.
    assert values(daily.worst_nodes(rows, SETTINGS), "row_number", "cdn_ip") == [(1, "b")]


def test_province_thresholds_and_top(spark):
    rows = facts(spark, *[{"province": f"P{i}", "v4": i} for i in range(8)])
    got = values(daily.worst_provinces(rows, SETTINGS), "row_number", "province")
    assert got == [(1, "P7"), (2, "P6"), (3, "P5"), (4, "P4"), (5, "P3")]


def test_side_by_side_pads_shorter_blocks(spark):
    rows = facts(
        spark,
        {"v1": "ws", "province": "A", "v4": 1},
        {"v1": "ws", "province": "B"},
        {"v1": "ws", "province": "C", "isp": "移动"},
        {"v1": "bd", "province": "D"},
    )
    wide = daily.worst_provinces_side_by_side(daily.worst_provinces(rows, SETTINGS))
    got = values(wide, "line", "`网宿_isp`", "`网宿_province`", "`百度_province`", "`七牛_province`")
    assert got == [
        (1, "电信", "A", "D", None),
        (2, "电信", "B", None, None),
        (3, "移动", "C", None, None),
    ]


def test_matrix_is_dense(spark):
    rows = facts(spark, {"v1": "ws", "platform": 14, "v4": 1}, {"v1": "ws", "platform": 2, "v4": None})
    got = values(daily.lag_matrix(rows))
    assert got[0] == ("网宿", 1.0, 0.0, 0.0)
    assert got[1:] == [
        (c, 0.0, 0.0, 0.0) for c in ("百度", "腾讯", "阿里", "七牛", "云帆", "金山", "未定义")
    ]


def test_isp_classes_in_order(spark):
    rows = facts(spark, {"isp": None}, {"isp": "教育网"}, {"isp": "联通"}, {"isp": "移动", "v1": "ws"})
    assert values(daily.lag_by_isp_class(rows), "cdn", "isp") == [
        ("网宿", "三大运营商"),
        ("七牛", "三大运营商"),
        ("七牛", "教育网"),
        ("七牛", "其他"),
    ]


def test_empty_day(spark):
    rows = facts(spark)
    assert values(daily.lag_requests(rows)) == []
    assert values(daily.worst_provinces_side_by_side(daily.worst_provinces(rows, SETTINGS))) == []
    assert values(daily.total_lag(rows)) == [(None,)]
    assert daily.lag_matrix(rows).count() == 8
