"""Dense grids of dates and carrying values over the gaps."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def date_grid(keys: DataFrame, start: date, end: date, out: str, step: str = "1 day") -> DataFrame:
    """Each key row once per step from ``start`` to ``end``; grown in place, without a join."""
    days = F.sequence(F.lit(start), F.lit(end), F.expr(f"interval {step}"))
    return keys.withColumn(out, F.explode(days))


def carry_forward(df: DataFrame, by: Sequence[str], order: str, value: str, out: str) -> DataFrame:
    """Gaps take the last known value. For grids: a group is as long as its date range."""
    window = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.last(value, ignorenulls=True).over(window))
