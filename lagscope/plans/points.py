"""The metric points, from the groups of :func:`lagscope.operators.rollup.point_groups`."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lagscope.functions.labels import LATENCY_RANGES
from lagscope.functions.measures import total
from lagscope.operators.grouping import grouped
from lagscope.settings import Settings

KEYS = ["cdn", "platform", "province", "isp"]
NODE = "cdn_ip"


def stamp(s: Settings) -> str:
    """The time all points of a run carry, with the offset of the session zone."""
    at = f"TIMESTAMP_LTZ '{s.report_date} {s.point_hour:02d}:00:00'"
    return f"date_format({at}, \"yyyy-MM-dd'T'HH:mm:ssXXX\") AS time"


def valid_nodes(rows: DataFrame, s: Settings) -> DataFrame:
    """Nodes with enough rows of any kind, from point facts or from groups."""
    rows = grouped(rows, [NODE], {"n": total("row_n")})
    return rows.filter(f"n > {s.point_node_min_rows}").select(NODE)


def connect_lag(groups: DataFrame, nodes: DataFrame, s: Settings, by_node: bool = True) -> DataFrame:
    """Connection latency of each group, with the stalls of the same group.

    A group without connections drops out. A group with an unknown platform or
    province has no equal on the other side, so its stalls stay NULL.
    """
    sums = ["connect_sum", "connect_point", "lag_sum", "lag_point"]
    rows = _points(groups, nodes, sums, by_node).filter("connect_point > 0")
    matched = "platform IS NOT NULL AND province IS NOT NULL"
    return rows.selectExpr(
        stamp(s),
        *_keys(by_node),
        "connect_sum / connect_point AS connect_avg",
        "connect_sum",
        "connect_point",
        f"if({matched}, lag_sum, NULL) AS lag_sum",
        f"if({matched}, lag_point, NULL) AS lag_point",
    )


def first(groups: DataFrame, nodes: DataFrame, s: Settings, by_node: bool = True) -> DataFrame:
    """First-frame latency of each group and latency bucket."""
    sums = [f"first{r}_{m}" for r in LATENCY_RANGES for m in ("sum", "point")]
    rows = _points(groups, nodes, sums, by_node)
    buckets = ", ".join(f"{r}, first{r}_sum, first{r}_point" for r in LATENCY_RANGES)
    stacked = f"stack({len(LATENCY_RANGES)}, {buckets}) AS (first_range, first_sum, first_point)"
    return (
        rows.selectExpr(*_keys(by_node), stacked)
        .filter("first_point > 0")
        .selectExpr(
            stamp(s),
            *_keys(by_node),
            "first_range",
            "first_sum / first_point AS first_avg",
            "first_sum",
            "first_point",
        )
    )


def _keys(by_node: bool) -> list[str]:
    return [*KEYS, NODE] if by_node else KEYS


def _points(groups: DataFrame, nodes: DataFrame, sums: list[str], by_node: bool) -> DataFrame:
    """The groups of valid nodes, with the nodes or summed over them.

    Rows are grouped before the join, so a node with a large share of the log
    brings only its groups to it. Spark moves the join in front of the grouping
    only when the nodes are small enough to be broadcast.
    """
    kept = groups.select(*KEYS, NODE, *sums).join(nodes, NODE, "left_semi")
    return kept if by_node else grouped(kept, KEYS, {name: f"sum({name})" for name in sums})
