"""Grouping by named expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def grouped(
    df: DataFrame, keys: Sequence[str] | Mapping[str, str], sums: Mapping[str, str]
) -> DataFrame:
    """Aggregates ``sums`` (name to expression) by ``keys``.

    Keys are column names, or names with expressions. A key may reuse the name of
    a column it is computed from.
    """
    if isinstance(keys, Mapping):
        by = [F.expr(e).alias(n) if e != n else n for n, e in keys.items()]
    else:
        by = list(keys)
    return df.groupBy(*by).agg(*[F.expr(e).alias(n) for n, e in sums.items()])
