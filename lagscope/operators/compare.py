"""Comparisons and layouts: trend, dense matrix, blocks side by side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagscope.functions import dims


def trend_columns(this: str, last: str) -> list[str]:
    """Both values, the arrow (``diff``) and the difference (``trend``)."""
    return [
        f"{this} AS lag_ratio_this",
        f"{last} AS lag_ratio_last",
        f"{dims.trend_arrow(this, last)} AS diff",
        f"{this} - {last} AS trend",
    ]


def dense(df: DataFrame, key: str, labels: Sequence[str], cells: Sequence[str]) -> DataFrame:
    """One row for each label in ``labels``, 0.0 where a cell is missing.

    ``df`` has at most one row per label, which bounds what is broadcast.
    """
    universe = df.sparkSession.range(1).selectExpr(f"explode(array({dims.texts(labels)})) AS {key}")
    return universe.join(F.broadcast(df), key, "left").selectExpr(
        key, *[f"coalesce({c}, 0D) AS {c}" for c in cells]
    )


def side_by_side(
    df: DataFrame, key: str, labels: Sequence[str], order: Sequence[str], cells: Sequence[str]
) -> DataFrame:
    """Puts the rows of each label in a block of its own, blocks beside each other.

    Line n holds the n-th row of each block; a block that has ended stays NULL.
    """
    line = f"row_number() OVER (PARTITION BY {key} ORDER BY {', '.join(order)}) AS line"
    row = f"struct({', '.join(cells)})"
    blocks = {label: f"max(CASE WHEN {key} = {dims.text(label)} THEN {row} END)" for label in labels}
    wide = (
        df.selectExpr(line, "*")
        .groupBy("line")
        .agg(*[F.expr(e).alias(label) for label, e in blocks.items()])
    )
    columns = [f"`{label}`.{cell} AS `{label}_{cell}`" for label in labels for cell in cells]
    return wide.selectExpr("line", *columns)
