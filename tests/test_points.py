"""Metric points on hand-made logs."""

from dataclasses import replace

from lagscope.operators import rollup, views
from lagscope.plans import points
from tests.micro import SETTINGS, micro_log, values

CONNECT = {"tag": "connect", "v5": 200}


def run(report, log, s=SETTINGS, by_node=True):
    facts = views.point_facts(log, s)
    return report(rollup.point_groups(facts), points.valid_nodes(facts, s), s, by_node)


def test_nodes_count_rows_of_every_kind(spark):
    log = micro_log(
        spark,
        {"v2": "a", "tag": "other"},
        {"v2": "a", "room_id": -1},
        {"v2": "a", "country": "海外"},
        {"v2": "b"},
        {"v2": "b"},
        {"v2": ""},
        {"v2": ""},
        {"v2": ""},
        {"v2": None},
        {"v2": None},
        {"v2": None},
    )
    s = replace(SETTINGS, point_node_min_rows=2)
    nodes = values(points.valid_nodes(views.point_facts(log, s), s))
    assert sorted(nodes, key=str) == [("",), ("a",), (None,)]
    groups = rollup.point_groups(views.point_facts(log, s))
    assert set(values(points.valid_nodes(groups, s))) == set(nodes)


def test_connect_with_and_without_stalls(spark):
    log = micro_log(spark, CONNECT, CONNECT | {"v5": 100}, {"v4": 2}, {"v4": None}, CONNECT | {"v1": "ws"})
    got = values(
        run(points.connect_lag, log), "cdn", "connect_avg", "connect_sum", "connect_point", "lag_sum", "lag_point"
    )
    assert sorted(got, key=str) == [("七牛", 150.0, 300, 2, 2, 2), ("网宿", 200.0, 200, 1, None, None)]


def test_stalls_alone_make_no_point(spark):
    assert values(run(points.connect_lag, micro_log(spark, {}, {}))) == []


def test_unknown_keys_never_match(spark):
    log = micro_log(
        spark,
        CONNECT | {"province": None},
        {"province": None, "v4": 1},
        CONNECT | {"platform": None},
        {"platform": None, "v4": 1},
        CONNECT | {"isp": None},
        {"isp": None, "v4": 1},
    )
    for by_node in (True, False):
        got = values(run(points.connect_lag, log, by_node=by_node), "platform", "province", "isp", "lag_sum")
        assert sorted(got, key=str) == [
            (1, "P1", "其他", 1),
            (1, None, "电信", None),
            (None, "P1", "电信", None),
        ]


def test_unknown_node_makes_no_point(spark):
    assert values(run(points.connect_lag, micro_log(spark, CONNECT | {"v2": None}))) == []


def test_rows_of_invalid_nodes_do_not_count_without_node(spark):
    log = micro_log(spark, CONNECT | {"v2": "a"}, CONNECT | {"v2": "a"}, CONNECT | {"v2": "b", "v5": 900})
    s = replace(SETTINGS, point_node_min_rows=1)
    got = values(run(points.connect_lag, log, s, by_node=False), "connect_sum", "connect_point")
    assert got == [(400, 2)]


def test_first_ranges_and_bounds(spark):
    log = micro_log(spark, *[{"tag": "first", "v5": v} for v in (0, 500, 700, 2000, 30000, 30001)])
    got = values(run(points.first, log), "first_range", "first_avg", "first_sum", "first_point")
    assert sorted(got) == [(1, 600.0, 1200, 2), (2, 2000.0, 2000, 1), (3, 30000.0, 30000, 1)]


def test_blocked_addresses_stay_in_points(spark):
    log = micro_log(spark, CONNECT | {"client_ip": "192.0.2.1"}, CONNECT | {"client_ip": None})
    assert values(run(points.connect_lag, log), "connect_point") == [(2,)]


def test_stamp(spark):
    log = micro_log(spark, CONNECT)
    result = run(points.connect_lag, log)
    assert values(result, "time") == [("2017-04-14T08:00:00Z",)]
    assert result.columns == [
        "time", "cdn", "platform", "province", "isp", "cdn_ip", "connect_avg", "connect_sum",
        "connect_point", "lag_sum", "lag_point",
    ]
