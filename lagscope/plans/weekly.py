"""The weekly report. Each function takes facts of the days it names, raw or
rolled up, and averages the values of the days: every day weighs the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from lagscope.functions import dims
from lagscope.functions import labels as L
from lagscope.functions.measures import per_row, per_value, total
from lagscope.operators.compare import trend_columns
from lagscope.operators.grouping import grouped
from lagscope.operators.ranking import by_mean, in_order, ranked_pair, top_per_group
from lagscope.settings import Settings
from lagscope.sources.exports import within

# Weeks are weeks of exports; within them, days are those of the rows.
_EXPORTED = "export_day"
_DAY = "event_date"
_BY_CDN = dims.cdn_position("cdn")
_BY_CLASS = dims.label_position("isp", L.ISP_CLASS_ORDER)
_IS_EDU = f"isp = {dims.text(L.ISP_EDU)}"


def _this_week(facts: DataFrame, s: Settings) -> DataFrame:
    return facts.filter(within(_EXPORTED, s.this_week()))


def valid_provinces(stalls: DataFrame, s: Settings) -> DataFrame:
    """Provinces with enough rows this week, over all countries."""
    rows = grouped(_this_week(stalls, s), {"province2": "province"}, {"n": total("row_n")})
    return rows.filter(f"n > {s.weekly_province_min_rows}").select("province2")


# Trends: both weeks in one aggregate


def total_trend(stalls: DataFrame, s: Settings) -> DataFrame:
    """Stall ratio of this week and the week before."""
    days = grouped(_two_weeks(stalls, s), _week_days(s), {"lag_ratio": per_row()})
    return grouped(days, [], _WEEK_MEANS).selectExpr(*trend_columns("this", "last"))


def edu_trend(stalls: DataFrame, s: Settings) -> DataFrame:
    """:func:`total_trend` of the education network."""
    return total_trend(stalls.filter(_IS_EDU), s)


def cdn_trend(stalls: DataFrame, s: Settings) -> DataFrame:
    """:func:`total_trend` by vendor, for vendors seen in both weeks."""
    keys = {"cdn": "cdn", **_week_days(s)}
    days = grouped(_two_weeks(stalls, s), keys, {"lag_ratio": per_row()})
    seen = {"this_days": "count_if(is_this)", "last_days": "count_if(NOT is_this)"}
    rows = grouped(days, ["cdn"], _WEEK_MEANS | seen)
    both = rows.filter("this_days > 0 AND last_days > 0")
    return in_order(both.selectExpr("cdn", *trend_columns("this", "last")), _BY_CDN)


def _two_weeks(facts: DataFrame, s: Settings) -> DataFrame:
    return facts.filter(within(_EXPORTED, s.both_weeks()))


def _week_days(s: Settings) -> dict[str, str]:
    return {"is_this": within(_EXPORTED, s.this_week()), _DAY: _DAY}


_WEEK_MEANS = {
    "this": "avg(CASE WHEN is_this THEN lag_ratio END)",
    "last": "avg(CASE WHEN NOT is_this THEN lag_ratio END)",
}


# Matrices and carrier classes


def lag_matrix(stalls: DataFrame, s: Settings) -> DataFrame:
    """Stall ratio by vendor and platform class; NULL where a class is absent."""
    return _matrix(stalls, s, per_row)


def first_matrix(firsts: DataFrame, s: Settings) -> DataFrame:
    """Mean first-frame latency by vendor and platform class."""
    return _matrix(firsts, s, per_value)


def _matrix(facts: DataFrame, s: Settings, measure: Callable[[str], str]) -> DataFrame:
    classes = list(L.PLATFORM_CLASSES)
    rows = _this_week(facts, s).filter(dims.platform_is("platform", *classes))
    by_day = {c: measure(dims.platform_is("platform", c)) for c in classes}
    days = grouped(rows, ["cdn", _DAY], by_day)
    return in_order(grouped(days, ["cdn"], {c: f"avg({c})" for c in classes}), _BY_CDN)


def isp_class(stalls: DataFrame, s: Settings) -> DataFrame:
    """Stall ratio by vendor and carrier class."""
    keys = {"cdn": "cdn", "isp": dims.isp_class("isp")}
    days = grouped(_this_week(stalls, s), keys | {_DAY: _DAY}, {"lag_ratio": per_row()})
    rows = grouped(days, list(keys), {"lag_ratio": "avg(lag_ratio)"})
    return in_order(rows, _BY_CLASS, _BY_CDN)


# Provinces: the ratio and the rows that make a province valid in one aggregate


def worst_provinces(stalls: DataFrame, s: Settings) -> DataFrame:
    """Provinces that stall most, over all carriers beside the education network."""
    provinces = _province_lists(stalls.filter(_in_province(s)), s)
    return _ranked(provinces, s, descending=True)


def best_provinces(stalls: DataFrame, s: Settings) -> DataFrame:
    """Valid provinces that stall least, as :func:`worst_provinces`."""
    provinces = _province_lists(stalls, s)
    valid = provinces.filter(f"n > {s.weekly_province_min_rows}")
    return _ranked(valid, s, descending=False)


def _in_province(s: Settings) -> str:
    country = dims.text(s.country)
    return f"country = {country} AND province != {country}"


def _province_lists(stalls: DataFrame, s: Settings) -> DataFrame:
    lists = {"all": _in_province(s), "edu": f"{_in_province(s)} AND {_IS_EDU}"}
    by_day, over_days = {"n": total("row_n")}, {"n": "sum(n)"}
    for name, where in lists.items():
        by_day |= {f"{name}_ratio": per_row(where), f"{name}_n": total("row_n", where)}
        over_days |= {f"{name}_ratio": f"avg({name}_ratio)", f"{name}_n": f"sum({name}_n)"}
    days = grouped(_this_week(stalls, s), ["province", _DAY], by_day)
    return grouped(days, ["province"], over_days)


def _ranked(provinces: DataFrame, s: Settings, descending: bool) -> DataFrame:
    return in_order(ranked_pair(provinces, "province", "all", "edu", descending, s.weekly_top), "rank")


def best_provinces_by_cdn(stalls: DataFrame, s: Settings) -> DataFrame:
    """Valid provinces that stall least, for each vendor."""
    return _provinces_by_cdn(stalls, s, descending=False)


def worst_provinces_by_cdn(stalls: DataFrame, s: Settings) -> DataFrame:
    """Valid provinces that stall most, for each vendor."""
    return _provinces_by_cdn(stalls, s, descending=True)


def _provinces_by_cdn(stalls: DataFrame, s: Settings, descending: bool) -> DataFrame:
    here = _in_province(s)
    days = grouped(
        _this_week(stalls, s),
        ["cdn", "province", _DAY],
        {"lag_ratio": per_row(here), "here": total("row_n", here), "n": total("row_n")},
    )
    rows = grouped(
        days,
        ["cdn", "province"],
        {"lag_ratio": "avg(lag_ratio)", "here": "sum(here)", "n": "sum(n)"},
    )
    # A province has at most one row per vendor: the window sums eight rows.
    valid = (
        rows.selectExpr("*", "sum(n) OVER (PARTITION BY province) AS province_n")
        .filter(f"here > 0 AND province_n > {s.weekly_province_min_rows}")
        .select("cdn", "province", "lag_ratio")
    )
    order = [by_mean("lag_ratio", descending), "province"]
    return in_order(top_per_group(valid, ["cdn"], order, s.weekly_top), _BY_CDN, "row_number")
