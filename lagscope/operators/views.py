"""The named views of the log and the additive facts built on them.

A view keeps the log's columns and adds derived ones. Facts are the narrow form
the reports aggregate: see :mod:`lagscope.functions.measures`.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from lagscope.functions import dims
from lagscope.functions import labels as L
from lagscope.functions.sql_names import register_functions
from lagscope.settings import Settings
from lagscope.sources.exports import export_day

STALL = "stall"
FIRST = "first"
CONNECT = "connect"
_TAGS = {STALL: L.TAG_STALL, FIRST: L.TAG_FIRST, CONNECT: L.TAG_CONNECT}


def _valid_row(s: Settings) -> str:
    # NULL addresses drop out with any blocklist, the empty one included.
    condition = f"room_id != {L.NO_ROOM} AND client_ip IS NOT NULL"
    if s.blocked_ips:
        condition += f" AND client_ip NOT IN ({dims.texts(s.blocked_ips)})"
    return condition


def _is_stall() -> str:
    return f"(tag = {dims.text(L.TAG_STALL)} AND v5 > 1)"


def _is_latency(tag: str, max_ms: int) -> str:
    return f"(tag = {dims.text(tag)} AND v5 > 0 AND v5 <= {max_ms})"


def _with_labels(log: DataFrame, *more: str) -> DataFrame:
    return log.selectExpr(
        f"{dims.cdn_name('v1')} AS cdn", f"{dims.fold_platform('platform')} AS platform1", *more, "*"
    )


# Report views


def stall_view(log: DataFrame, s: Settings) -> DataFrame:
    """Valid heartbeat rows of the reports."""
    return _with_labels(log.filter(f"{_is_stall()} AND {_valid_row(s)}"))


def first_view(log: DataFrame, s: Settings) -> DataFrame:
    """Valid first-frame rows of the reports."""
    return _with_labels(
        log.filter(f"{_is_latency(L.TAG_FIRST, s.first_max_ms)} AND {_valid_row(s)}")
    )


def _report_facts(rows: DataFrame, s: Settings, kind: str, value: str) -> DataFrame:
    return rows.selectExpr(
        f"{export_day(rows)} AS export_day",
        "CAST(time AS DATE) AS event_date",
        f"hour(time) >= {s.evening_hour} AS evening",
        f"{kind} AS kind",
        f"{dims.cdn_name('v1')} AS cdn",
        "platform",
        "country",
        "province",
        "isp",
        "v2",
        "device",
        f"{value} AS value_sum",
        f"CAST({value} IS NOT NULL AS BIGINT) AS value_n",
        "1L AS row_n",
    )


def stall_facts(log: DataFrame, s: Settings) -> DataFrame:
    """Facts of :func:`stall_view`; the value is the stall count."""
    return _report_facts(stall_view(log, s), s, f"'{STALL}'", "v4")


def first_facts(log: DataFrame, s: Settings) -> DataFrame:
    """Facts of :func:`first_view`; the value is the latency."""
    return _report_facts(first_view(log, s), s, f"'{FIRST}'", "v5")


def report_facts(log: DataFrame, s: Settings) -> DataFrame:
    """Stall and first-frame facts together, from one pass over the log."""
    is_first = _is_latency(L.TAG_FIRST, s.first_max_ms)
    rows = log.filter(f"({_is_stall()} OR {is_first}) AND {_valid_row(s)}")
    stalled = f"tag = {dims.text(L.TAG_STALL)}"
    return _report_facts(
        rows, s, f"if({stalled}, '{STALL}', '{FIRST}')", f"if({stalled}, v4, v5)"
    )


# Point views: no blocklist, one country, wider latency bound


def _point_condition(kind: str, s: Settings) -> str:
    event = _is_stall() if kind == STALL else _is_latency(_TAGS[kind], s.point_max_ms)
    return f"{event} AND room_id != {L.NO_ROOM} AND country = {dims.text(s.country)}"


def point_view(log: DataFrame, s: Settings, kind: str) -> DataFrame:
    """Valid rows of one kind for the points, before the check of the node."""
    added = [f"{dims.isp_canonical('isp')} AS isp1"]
    if kind != STALL:
        added.append(f"{dims.latency_range('v5')} AS {kind}_range")
    return _with_labels(log.filter(_point_condition(kind, s)), *added)


def point_facts(log: DataFrame, s: Settings, kinds: tuple[str, ...] = ()) -> DataFrame:
    """Facts for the points, from one pass over the log.

    With ``kinds`` only their rows are read. Without, every row stays: rows of no
    kind keep only their node, as the number of rows per node counts them too.
    """
    if kinds:
        log = log.filter(" OR ".join(f"({_point_condition(k, s)})" for k in kinds))
        kind = {k: f"tag = {dims.text(_TAGS[k])}" for k in kinds}
    else:
        kind = {k: _point_condition(k, s) for k in _TAGS}
    whens = " ".join(f"WHEN {condition} THEN '{name}'" for name, condition in kind.items())
    return log.selectExpr(f"CASE {whens} END AS kind", "*").selectExpr(
        "kind",
        f"if(kind IS NOT NULL, {dims.cdn_name('v1')}, NULL) AS cdn",
        "if(kind IS NOT NULL, platform, NULL) AS platform",
        "if(kind IS NOT NULL, province, NULL) AS province",
        f"if(kind IS NOT NULL, {dims.isp_canonical('isp')}, NULL) AS isp",
        "v2 AS cdn_ip",
        f"if(kind = '{FIRST}', {dims.latency_range('v5')}, NULL) AS first_range",
        f"CASE WHEN kind = '{STALL}' THEN v4 WHEN kind IS NOT NULL THEN v5 END AS value_sum",
        "1L AS row_n",
    )


# Use of the views


def register_views(log: DataFrame, s: Settings) -> None:
    """Names the log, its views and the functions for use from SQL text."""
    register_functions(log.sparkSession)
    log.createOrReplaceTempView("playback_raw")
    stall_view(log, s).createOrReplaceTempView("playback_stall")
    first_view(log, s).createOrReplaceTempView("playback_first")
    for kind in (STALL, FIRST, CONNECT):
        point_view(log, s, kind).createOrReplaceTempView(f"playback_point_{kind}")


@contextmanager
def held(df: DataFrame) -> Iterator[DataFrame]:
    """Keeps a frame in memory, then on disk, while it is read several times."""
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()
