"""The daily report. Each function takes facts of one day, raw or rolled up."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from lagscope.functions import dims
from lagscope.functions import labels as L
from lagscope.functions.measures import per_row, per_value, total
from lagscope.operators.compare import dense, side_by_side
from lagscope.operators.grouping import grouped
from lagscope.operators.ranking import by_ratio, in_order, number_rows, top_per_group
from lagscope.settings import Settings

_COUNTS = {
    "lag_count": total("value_sum"),
    "total_count": total("value_n"),
    "lag_ratio": per_value(),
}
_BY_CDN = dims.cdn_position("cdn")
_BY_ISP = dims.label_position("isp", L.ISP_REPORT_ORDER)
_BY_CLASS = dims.label_position("isp", L.ISP_CLASS_ORDER)


def lag_requests(stalls: DataFrame) -> DataFrame:
    """Stalls, rows and their ratio by vendor and platform, numbered."""
    keys = {"cdn": "cdn", "platform1": dims.fold_platform("platform")}
    return number_rows(grouped(stalls, keys, _COUNTS), _BY_CDN, "platform1")


def evening_lag_requests(stalls: DataFrame) -> DataFrame:
    """:func:`lag_requests` of the evening peak."""
    return lag_requests(stalls.filter("evening"))


def lag_viewers(counts: DataFrame) -> DataFrame:
    """Affected viewers, viewers and their ratio, numbered.

    ``counts`` comes from :func:`lagscope.operators.rollup.viewer_counts`.
    """
    return _viewers(counts, "lag_person", "total_person")


def evening_lag_viewers(counts: DataFrame) -> DataFrame:
    """:func:`lag_viewers` of the evening peak."""
    return _viewers(counts, "evening_lag_person", "evening_total_person")


def _viewers(counts: DataFrame, hit: str, seen: str) -> DataFrame:
    rows = counts.filter(f"{seen} > 0").selectExpr(
        "cdn",
        "platform1",
        f"{hit} AS lag_person",
        f"{seen} AS total_person",
        f"{hit} / {seen} AS lag_ratio",
    )
    return number_rows(rows, _BY_CDN, "platform1")


def worst_provinces(stalls: DataFrame, s: Settings) -> DataFrame:
    """Provinces that stall most, for each vendor and main carrier."""
    carriers = dims.texts(L.ISP_REPORT_ORDER)
    rows = grouped(
        stalls.filter(f"country = {dims.text(s.country)} AND isp IN ({carriers})"),
        ["cdn", "isp", "province"],
        _COUNTS,
    ).filter(f"total_count > {s.province_min_rows}")
    order = [by_ratio("lag_ratio", descending=True), "province"]
    top = top_per_group(rows, ["cdn", "isp"], order, s.province_top)
    return in_order(top, _BY_CDN, _BY_ISP, "row_number")


def worst_provinces_side_by_side(worst: DataFrame) -> DataFrame:
    """:func:`worst_provinces` with one block of columns for each vendor."""
    cells = ["row_number", "cdn", "isp", "province", *_COUNTS]
    return in_order(side_by_side(worst, "cdn", L.CDN_ORDER, [_BY_ISP, "row_number"], cells), "line")


def worst_nodes(nodes: DataFrame, s: Settings) -> DataFrame:
    """Delivery nodes that stall most, for each vendor."""
    rows = grouped(nodes.filter("v2 != ''"), {"cdn": "cdn", "cdn_ip": "v2"}, _COUNTS)
    order = [by_ratio("lag_ratio", descending=True), "cdn_ip"]
    kept = rows.filter(f"total_count > {s.node_min_rows}")
    return in_order(top_per_group(kept, ["cdn"], order, s.node_top), _BY_CDN, "row_number")


def total_lag(stalls: DataFrame) -> DataFrame:
    """Stall ratio of the whole platform."""
    return grouped(stalls, [], {"lag_ratio": per_row()})


def lag_by_cdn(stalls: DataFrame) -> DataFrame:
    """Stall ratio by vendor."""
    return in_order(grouped(stalls, ["cdn"], {"lag_ratio": per_row()}), _BY_CDN)


def lag_by_isp_class(stalls: DataFrame) -> DataFrame:
    """Stall ratio by vendor and carrier class."""
    keys = {"cdn": "cdn", "isp": dims.isp_class("isp")}
    return in_order(grouped(stalls, keys, {"lag_ratio": per_row()}), _BY_CLASS, _BY_CDN)


def lag_matrix(stalls: DataFrame) -> DataFrame:
    """Stall ratio by vendor (rows) and platform class (columns), no gaps."""
    return _matrix(stalls, per_row)


def first_matrix(firsts: DataFrame) -> DataFrame:
    """Mean first-frame latency by vendor and platform class, no gaps."""
    return _matrix(firsts, per_value)


def _matrix(facts: DataFrame, measure: Callable[[str], str]) -> DataFrame:
    cells = {c: measure(dims.platform_is("platform", c)) for c in L.PLATFORM_CLASSES}
    return in_order(dense(grouped(facts, ["cdn"], cells), "cdn", L.CDN_ORDER, list(cells)), _BY_CDN)
