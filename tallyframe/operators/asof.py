"""As-of alignment: the nearest later (or earlier) row of another table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.operators.ranges import Cuts, free_name
from tallyframe.operators.running import fill_down, fill_up


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    time: str,
    take: Sequence[str],
    direction: str = "forward",
    strict: bool = True,
    cuts: Cuts | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """Every left row with the ``take`` columns of the closest right row of the same key.

    ``forward`` looks for the first later right row, ``backward`` for the last
    earlier one; ``strict`` leaves equal times out. Both sides hold ``by`` and
    ``time``; ``by`` may be empty: then all rows are one group. Left rows without
    a match keep NULLs; a NULL key or time on either side matches nothing. Among
    right rows of the same time the smallest ``take`` wins looking forward, the
    largest backward.

    The two sides are stacked and walked in even pieces of (key, time), each one
    a task; the match from beyond a piece is one carried row. There is neither a
    range join nor a large key, nor a table without a key, in one task.
    """
    forward = direction == "forward"
    stack_names = left.select("*", *[F.lit(None).alias(c) for c in right.columns])
    side, hit, found = (free_name(stack_names, name) for name in ("_side", "_hit", "_found"))
    # Looking forward the walk goes down in time. Rows that come later in the walk see the
    # earlier ones, so with ``strict`` right rows come after left rows in it, else before them.
    right_first = (not strict) != forward
    left_side, right_side = (1, 0) if right_first else (0, 1)
    rows = right.dropna(subset=[*by, time]).select(
        *by, time, F.lit(right_side).alias(side), F.struct(*[F.col(c) for c in take]).alias(hit)
    )
    stacked = left.withColumn(side, F.lit(left_side)).unionByName(rows, allowMissingColumns=True)
    # Equal times are one place of the order on each side; `take` decides among them.
    walk = fill_up if forward else fill_down
    out = walk(stacked, by, [time, side, hit], hit, found, cuts, ranges).filter(F.col(side) == left_side)
    return out.select(*left.columns, *[F.when(F.col(time).isNotNull(), F.col(found)[c]).alias(c) for c in take])


def next_in_list(days: DataFrame, day: str, marks: DataFrame, mark: str, out: str, strict: bool, ranges: int | None = None) -> DataFrame:
    """The as-of join without a key: each different value of ``days`` with the next one in ``marks``."""
    asked = days.select(day).distinct()
    return asof_join(asked, marks.select(F.col(mark).alias(day), F.col(mark).alias(out)), [], day, [out], "forward", strict, ranges=ranges)
