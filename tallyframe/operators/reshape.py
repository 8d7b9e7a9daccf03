"""Rows to columns, columns to rows, list columns to rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pivot_named(
    df: DataFrame,
    by: Sequence[str],
    name: str,
    value: str,
    columns: Mapping[object, str],
    agg: Callable[[Column], Column] = F.sum,
) -> DataFrame:
    """One column per entry of ``columns`` (value -> output name), in one pass."""
    wide = df.groupBy(*by).pivot(name, list(columns)).agg(agg(F.col(value)))
    return wide.select(*by, *[F.col(f"`{old}`").alias(new) for old, new in columns.items()])


def unpivot_non_null(df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str, value: str) -> DataFrame:
    """Columns to rows; cells without a value give no row."""
    long = df.unpivot([F.col(c) for c in ids], [F.col(c) for c in columns], name, value)
    return long.filter(F.col(value).isNotNull())


def explode_items(df: DataFrame, items: Column, out: str) -> DataFrame:
    """One row per array element; rows without a list disappear."""
    return df.withColumn(out, F.explode(items))
