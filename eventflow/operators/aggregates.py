"""User aggregate functions of the reference that are not plain counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventflow.operators.accumulate import Accumulator


def truncated_mean_expr(col: str) -> Column:
    """Long sum divided by the count with integer division, widened to double (AG9)."""
    return F.expr(f"sum({col}) div count({col})").cast("double")


def truncated_mean(df: DataFrame, keys: Sequence[str], col: str, out: str = "mean") -> DataFrame:
    """Per-key truncating mean: a combinable (sum, count) accumulator, partial + final aggregate."""
    return df.groupBy(*keys).agg(truncated_mean_expr(col).alias(out))


def truncated_mean_accumulator(col: str) -> Accumulator:
    """AG9 as a user accumulator, for windows that slide (``operators.accumulate``); null values do not count."""
    def add(state, row):
        return state if row[col] is None else (state[0] + row[col], state[1] + 1)

    def result(state):
        total, n = state
        return float(total // n if total >= 0 else -(-total // n)) if n else None

    return Accumulator(create=lambda: (0, 0), add=add, merge=lambda a, b: (a[0] + b[0], a[1] + b[1]), result=result,
                       state="total long, n long", output="double")
