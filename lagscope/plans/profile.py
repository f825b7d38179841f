"""Counts that show how raw values map to derived ones, and what a scan holds."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lagscope.functions import dims
from lagscope.functions import labels as L
from lagscope.functions.measures import any_nonzero
from lagscope.operators.grouping import grouped
from lagscope.settings import Settings
from lagscope.sources.exports import in_window, within

_N = {"n": "count(*)"}


def _counted(log: DataFrame, raw: str, derived: str, name: str) -> DataFrame:
    """Rows by raw value, then the derived value of each group."""
    return grouped(log, [raw], _N).selectExpr(raw, f"{derived} AS {name}", "n")


def day_counts(log: DataFrame, s: Settings) -> DataFrame:
    """Rows by event kind on the report day."""
    return grouped(in_window(log, s.day()), ["tag"], _N)


def week_counts(log: DataFrame, s: Settings) -> DataFrame:
    """Rows by event kind in this week and the week before, from one scan."""
    period = f"if({within('CAST(time AS DATE)', s.this_week())}, 'this', 'last')"
    return grouped(in_window(log, s.both_weeks()), {"period": period, "tag": "tag"}, _N)


def cdn_names(log: DataFrame) -> DataFrame:
    return _counted(log, "v1", dims.cdn_name("v1"), "cdn")


def platform_folds(log: DataFrame) -> DataFrame:
    return _counted(log, "platform", dims.fold_platform("platform"), "platform1")


def device_names(log: DataFrame) -> DataFrame:
    return _counted(log, "platform", dims.device_name("platform"), "device_name")


def isp_classes(log: DataFrame) -> DataFrame:
    return _counted(log, "isp", dims.isp_class("isp"), "isp_class")


def canonical_isps(log: DataFrame) -> DataFrame:
    return _counted(log, "isp", dims.isp_canonical("isp"), "isp1")


def latency_ranges(log: DataFrame) -> DataFrame:
    """Rows by latency bucket, for both kinds that carry a latency."""
    kinds = dims.texts([L.TAG_FIRST, L.TAG_CONNECT])
    keys = {"tag": "tag", "latency_range": dims.latency_range("v5")}
    return grouped(log.filter(f"tag IN ({kinds})"), keys, _N)


def isps_containing(log: DataFrame, part: str) -> DataFrame:
    """Each raw carrier name and whether it contains ``part``."""
    names = log.select("isp").distinct()
    return names.selectExpr("isp", f"{dims.contains('isp', part)} AS has_telecom")


def viewers_hit(log: DataFrame) -> DataFrame:
    """Each viewer and whether any heartbeat of the viewer stalled."""
    stalls = log.filter(f"tag = {dims.text(L.TAG_STALL)}")
    return grouped(stalls, ["device"], {"lag": any_nonzero("v4")})
