"""Derived dimensions on values the sample tables do not hold."""

from lagscope.functions import dims
from lagscope.functions import labels as L


def one(spark, rows, schema, expression):
    df = spark.createDataFrame([(r,) for r in rows], schema)
    return [r[0] for r in df.selectExpr(expression).collect()]


def test_cdn_name(spark):
    codes = [*L.CDN_BY_CODE, "zz", "", None]
    names = one(spark, codes, "x string", dims.cdn_name("x"))
    assert names == [*L.CDN_BY_CODE.values(), "未定义", "未定义", "未定义"]


def test_platform_and_device(spark):
    codes = [1, 2, 5, 9, 14, 3, None]
    assert one(spark, codes, "x long", dims.fold_platform("x")) == [1, 2, 5, 9, 5, 3, None]
    names = one(spark, codes, "x long", dims.device_name("x"))
    assert names == ["Android", "iOS", "PC", "H5", "PC新秀", "其他", "其他"]


def test_isp_class(spark):
    isps = ["电信", "移动", "联通", "教育网", "铁通", "中国电信", None]
    names = one(spark, isps, "x string", dims.isp_class("x"))
    assert names == ["三大运营商"] * 3 + ["教育网"] + ["其他"] * 3


def test_isp_canonical_takes_the_first_in_priority(spark):
    isps = ["中国电信", "移动铁通", "联通移动", "教育网鹏博士", "电信通联通", "长城", "", None]
    names = one(spark, isps, "x string", dims.isp_canonical("x"))
    assert names == ["电信", "铁通", "移动", "鹏博士", "电信", "其他", "其他", "其他"]


def test_latency_range_bounds(spark):
    ms = [0, 1000, 1001, 3000, 3001, 30000]
    assert one(spark, ms, "x long", dims.latency_range("x")) == [1, 1, 2, 2, 3, 3]


def test_contains(spark):
    got = one(spark, ["中国电信", "移动", None], "x string", dims.contains("x", "电信"))
    assert got == [True, False, None]


def test_label_position(spark):
    got = one(spark, ["移动", "动", "没有", None], "x string", dims.label_position("x", ("电信", "移动")))
    assert got == [2, 0, 0, None]


def test_text_escapes(spark):
    for value in ["it's", "back\\slash", "\\'", "a\"b"]:
        assert one(spark, [value], "x string", f"x = {dims.text(value)}") == [True]


def test_trend_arrow(spark):
    df = spark.createDataFrame(
        [(2.0, 1.0), (1.0, 2.0), (1.0, 1.0), (None, 1.0)], "a double, b double"
    )
    assert [r[0] for r in df.selectExpr(dims.trend_arrow("a", "b")).collect()] == ["↑", "↓", "", ""]
