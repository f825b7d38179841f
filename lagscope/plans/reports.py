"""Names, titles and headings of the report tables."""

from __future__ import annotations

from dataclasses import dataclass

from lagscope.functions.labels import CDN_ORDER


@dataclass(frozen=True)
class Report:
    """``title`` may hold the report date or week; ``headings`` go column by column.

    Numbers are printed with six decimals, in a ``full`` report with all their digits.
    """

    title: str
    headings: dict[str, str]
    full: bool = False


# The titles and headings readers know.
_REQUESTS = {
    "row_number": "序号",
    "cdn": "cdn运营商",
    "platform1": "终端类型",
    "lag_count": "卡顿总次数",
    "total_count": "总请求数",
    "lag_ratio": "卡顿次数比率",
}
_VIEWERS = {
    "row_number": "序号",
    "cdn": "cdn运营商",
    "platform1": "终端类型",
    "lag_person": "卡顿人数",
    "total_person": "观看人数",
    "lag_ratio": "卡顿人数比率",
}
_PROVINCES = {
    "row_number": "序号",
    "cdn": "cdn运营商",
    "isp": "isp",
    "province": "省份",
    "lag_count": "卡顿总次数",
    "total_count": "总请求数",
    "lag_ratio": "卡顿次数比率",
}
_NODES = {
    "row_number": "序号",
    "cdn": "cdn运营商",
    "cdn_ip": "cdn_ip",
    "lag_count": "卡顿总次数",
    "total_count": "总请求数",
    "lag_ratio": "卡顿次数比率",
}
_MATRIX = {"cdn": "cdn", "pc": "PC端", "android": "Android端", "ios": "iOS端"}
_BY_ISP = {"cdn": "cdn厂商", "isp": "运营商", "lag_ratio": "卡顿次数比率"}
_TREND = {
    "lag_ratio_this": "本周卡顿率",
    "lag_ratio_last": "上周卡顿率",
    "diff": "差异",
    "trend": "趋势",
}
_PAIR = {
    "rank": "排名",
    "province": "省份",
    "ratio": "卡顿率",
    "province_edu": "教育网省份",
    "ratio_edu": "教育网卡顿率",
}
_BY_CDN = {
    "row_number": "排名",
    "cdn": "cdn厂商",
    "province": "省份",
    "lag_ratio": "本周卡顿率",
}


def _blocks() -> dict[str, str]:
    """The province headings once per vendor, an empty column between vendors."""
    headings = {}
    for i, cdn in enumerate(CDN_ORDER):
        if i:
            headings[f"gap {i}"] = " " * i
        headings |= {f"{cdn}_{name}": f"{cdn} {text}" for name, text in _PROVINCES.items()}
    return headings


#: Rows of the log behind a report, and those stamped outside their export.
LOG_ROWS = {
    "export_day": "日期",
    "log_rows": "日志行数",
    "no_time_rows": "无时间行数",
    "other_day_rows": "非当日行数",
}

DAILY = {
    "daily_lag_requests": Report("{date}_卡顿次数比率-全天", _REQUESTS),
    "daily_lag_viewers": Report("{date}_卡顿人数比率-全天", _VIEWERS),
    "evening_lag_requests": Report("{date}_卡顿次数比率-晚高峰", _REQUESTS),
    "evening_lag_viewers": Report("{date}_卡顿人数比率-晚高峰", _VIEWERS),
    "daily_worst_provinces": Report("{date}_省份卡顿次数top5", _blocks()),
    "daily_worst_nodes": Report("{date}_卡顿cdn_ip下行节点卡顿top10", _NODES),
    "daily_total_lag": Report(
        "{date}_卡顿次数比率-平台总卡顿率", {"lag_ratio": "本日平台总卡顿率"}, full=True
    ),
    "daily_lag_by_cdn": Report(
        "{date}_卡顿次数比率-全天各厂商总卡顿率", {"cdn": "cdn运营商", "lag_ratio": "卡顿次数比率"}
    ),
    "daily_lag_by_isp_class": Report("{date}_卡顿次数比率-全天各运营商卡顿率", _BY_ISP),
    "daily_lag_matrix": Report("{date}_卡顿率-各家分平台卡顿率", _MATRIX),
    "daily_first_matrix": Report("{date}_首屏数据", _MATRIX),
}

WEEKLY = {
    "weekly_total_trend": Report("卡顿率-平台总卡顿率（{week}）", _TREND),
    "weekly_edu_trend": Report("卡顿率-平台教育网总卡顿率（{week}）", _TREND),
    "weekly_cdn_trend": Report("卡顿率-各家卡顿率（{week}）", {"cdn": "cdn", **_TREND}),
    "weekly_lag_matrix": Report("卡顿率-各家分平台卡顿率（{week}）", _MATRIX),
    "weekly_isp_class": Report("卡顿次数比率-本周各运营商卡顿率（{week}）", _BY_ISP),
    "weekly_first_matrix": Report("各家分平台首屏（{week}）", _MATRIX),
    "weekly_worst_provinces": Report("省份卡顿率排名-最差TOP5（{week}）", _PAIR),
    "weekly_best_provinces": Report("省份卡顿率排名-最优TOP5（{week}）", _PAIR),
    "weekly_best_provinces_by_cdn": Report("各家CDN卡顿率-省份最优top5排名（{week}）", _BY_CDN),
    "weekly_worst_provinces_by_cdn": Report("各家CDN卡顿率-省份最差top5排名（{week}）", _BY_CDN),
}
