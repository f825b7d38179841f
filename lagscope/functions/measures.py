"""Aggregates over additive fact rows, as Spark SQL expressions.

Facts carry ``value_sum``, ``value_n`` (rows with a value) and ``row_n`` (rows).
A raw row has them as value, 0/1 and 1; a rolled-up row has their sums. Each
aggregate here therefore gives the same answer on raw facts and on any rollup.
"""

from __future__ import annotations


def total(name: str, where: str | None = None) -> str:
    """Sum of one additive column, over the rows that meet ``where``."""
    return f"sum({name})" if where is None else f"sum(CASE WHEN {where} THEN {name} END)"


def per_value(where: str | None = None) -> str:
    """Sum over rows with a value: NULL values do not count in the divisor."""
    return f"{total('value_sum', where)} / {total('value_n', where)}"


def per_row(where: str | None = None) -> str:
    """Sum over all rows: rows with a NULL value count in the divisor."""
    return f"{total('value_sum', where)} / {total('row_n', where)}"


def any_nonzero(value: str) -> str:
    """1 when any value differs from 0, else 0. NULL counts as 0."""
    return f"max(CASE WHEN {value} != 0 THEN 1 ELSE 0 END)"
