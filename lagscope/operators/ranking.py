"""Order, row numbers, top rows. Sort keys are Spark SQL expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def in_order(df: DataFrame, *order: str) -> DataFrame:
    """Sorts a finished report. Its rows are as few as its labels, so they are
    brought together and sorted once, without the sampling of a range sort."""
    return df.repartition(1).sortWithinPartitions(*[F.expr(o) for o in order])


def number_rows(df: DataFrame, *order: str) -> DataFrame:
    """Puts a running number over a finished report in front of its columns."""
    return df.selectExpr(f"row_number() OVER (ORDER BY {', '.join(order)}) AS row_number", "*")


def top_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], k: int, number: str = "row_number"
) -> DataFrame:
    """The first ``k`` rows of each group with their number in front.

    The bound on the number is applied on both sides of the shuffle, so at most
    ``k`` rows per group and task move.
    """
    over = f"PARTITION BY {', '.join(keys)} ORDER BY {', '.join(order)}"
    return df.selectExpr(f"row_number() OVER ({over}) AS {number}", "*").filter(f"{number} <= {k}")


def by_ratio(ratio: str, descending: bool) -> str:
    """Sort key for an exact ratio. Unknown ratios come last."""
    return f"{ratio} {'DESC' if descending else 'ASC'} NULLS LAST"


def by_mean(ratio: str, descending: bool) -> str:
    """Sort key for a mean of ratios: its last digits depend on the order of the
    sum, so they do not decide."""
    return by_ratio(f"round({ratio}, 9)", descending)


def ranked_pair(
    df: DataFrame, item: str, left: str, right: str, descending: bool, k: int
) -> DataFrame:
    """Two top lists over the same items, n-th beside n-th.

    ``<list>_ratio`` and ``<list>_n`` hold the ratio and rows of an item in each
    list; it belongs to a list when it has rows there. The left list sets the
    length; cells of a shorter right list stay NULL.
    """
    lists = df.selectExpr(
        "inline(array("
        + ", ".join(
            f"named_struct('list', '{name}', 'item', {item}, 'ratio', {name}_ratio, 'n', {name}_n)"
            for name in (left, right)
        )
        + "))"
    ).filter("n > 0")
    ranked = top_per_group(lists, ["list"], [by_mean("ratio", descending), "item"], k, "rank")
    cells = {
        item: f"max(CASE WHEN list = '{left}' THEN item END)",
        "ratio": f"max(CASE WHEN list = '{left}' THEN ratio END)",
        f"{item}_{right}": f"max(CASE WHEN list = '{right}' THEN item END)",
        f"ratio_{right}": f"max(CASE WHEN list = '{right}' THEN ratio END)",
    }
    rows = ranked.groupBy("rank").agg(*[F.expr(e).alias(n) for n, e in cells.items()])
    return rows.filter(f"{item} IS NOT NULL")
