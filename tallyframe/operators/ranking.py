"""Filters on window results: first, n-th and top rows per group.

Spark turns ``rank <= n`` into a group limit *before* the shuffle, so each map
task sends at most the rows that can still qualify, and a group that holds a
large part of the table does not travel to one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANKS = {"row_number": F.row_number, "rank": F.rank, "dense_rank": F.dense_rank}


def top_rows(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[Column],
    n: int = 1,
    ties: str = "row_number",
    rank_as: str | None = None,
) -> DataFrame:
    """Rows whose rank within ``by`` is at most ``n``.

    ``ties``: ``row_number`` keeps exactly n rows (give a unique last order
    column), ``rank`` and ``dense_rank`` keep equal rows together.
    """
    name = rank_as or "_rank"
    window = Window.partitionBy(*by).orderBy(*order)
    out = df.withColumn(name, _RANKS[ties]().over(window)).filter(F.col(name) <= n)
    return out if rank_as else out.drop(name)
