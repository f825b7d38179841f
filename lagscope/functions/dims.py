"""Derived dimensions as Spark SQL expressions.

Each function takes a column name (or expression) and gives expression text, for
``selectExpr``, ``filter``, ``F.expr`` or a SQL statement. All of them are built-in
expressions, compiled into the stage that uses them.
"""

from __future__ import annotations

from collections.abc import Iterable

from lagscope.functions import labels as L


def text(value: str) -> str:
    """A string literal."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def texts(values: Iterable[str]) -> str:
    """String literals for an IN list or an array."""
    return ", ".join(text(v) for v in values)


def _case(branches: Iterable[tuple[str, str]], otherwise: str) -> str:
    whens = " ".join(f"WHEN {condition} THEN {result}" for condition, result in branches)
    return f"CASE {whens} ELSE {otherwise} END"


def cdn_name(code: str) -> str:
    """Vendor name of a raw code; unknown and NULL codes share one bucket."""
    codes: dict[str, list[str]] = {}
    for raw, name in L.CDN_BY_CODE.items():
        codes.setdefault(name, []).append(raw)
    branches = [(f"{code} IN ({texts(raws)})", text(name)) for name, raws in codes.items()]
    return _case(branches, text(L.CDN_OTHER))


def fold_platform(platform: str) -> str:
    """Counts the second PC client as PC."""
    return f"CASE WHEN {platform} = 14 THEN 5 ELSE {platform} END"


def device_name(platform: str) -> str:
    branches = [(f"{platform} = {c}", text(n)) for c, n in L.DEVICE_BY_PLATFORM.items()]
    return _case(branches, text(L.DEVICE_OTHER))


def platform_is(platform: str, *classes: str) -> str:
    """True for rows of the named report classes: ``pc``, ``android``, ``ios``."""
    codes = ", ".join(str(code) for c in classes for code in L.PLATFORM_CLASSES[c])
    return f"{platform} IN ({codes})"


def isp_class(isp: str) -> str:
    """Three carrier classes; NULL counts as other."""
    return _case(
        [
            (f"{isp} IN ({texts(L.ISP_BIG_THREE)})", text(L.ISP_BIG_THREE_CLASS)),
            (f"{isp} = {text(L.ISP_EDU)}", text(L.ISP_EDU)),
        ],
        text(L.ISP_OTHER),
    )


def contains(value: str, part: str) -> str:
    """True when the literal ``part`` occurs in ``value``; NULL stays NULL."""
    return f"contains({value}, {text(part)})"


def isp_canonical(isp: str) -> str:
    """Carrier found by substring in priority order; NULL counts as other."""
    branches = [(contains(isp, name), text(name)) for name in L.ISP_SEARCH_ORDER]
    return _case(branches, text(L.ISP_OTHER))


def latency_range(ms: str) -> str:
    """Bucket 1, 2 or 3 of a latency."""
    return _case([(f"{ms} <= {L.LATENCY_FAST_MS}", "1"), (f"{ms} <= {L.LATENCY_SLOW_MS}", "2")], "3")


def label_position(value: str, order: Iterable[str]) -> str:
    """Place of a label in a fixed order, from 1; 0 when it is not listed."""
    return f"array_position(array({texts(order)}), {value})"


def cdn_position(cdn: str) -> str:
    return label_position(cdn, L.CDN_ORDER)


def trend_arrow(this: str, last: str) -> str:
    """Arrow up or down; empty when equal or unknown."""
    return f"CASE WHEN {this} > {last} THEN '↑' WHEN {this} < {last} THEN '↓' ELSE '' END"
