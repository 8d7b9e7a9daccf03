"""Running results over groups that may be very large, or over a table without a key.

A plain window puts each group into one task. Here the order of the whole table
is cut into even pieces (``operators.ranges``), wherever groups begin and end.
Each piece is one task; what the pieces before (or behind) hand on is one small
row per piece and group. So a group that holds a third of the table, one day of
it, or a table without any key is spread over all tasks, and there is one code
path for all sizes.

``order`` names columns; they sort ascending with NULL first. For a descending
order give the negated value (its NULL then also comes first). ``cuts`` may
bring borders from a cheaper table with the same keys (``ranges.sort_cuts``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.operators.ranges import Cuts, Ranges, free_name, in_ranges

_BEFORE = (Window.unboundedPreceding, -1)
_SO_FAR = (Window.unboundedPreceding, 0)


def _cut(
    df: DataFrame, by: Sequence[str], order: Sequence[str], cuts: Cuts | None, ranges: int | None
) -> tuple[Ranges, list[str]]:
    """The pieces, and three names for carried values that no column has."""
    return in_ranges(df, by, order, cuts, ranges), [free_name(df, name) for name in ("_carry", "_other", "_all")]


def running_sum(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str,
    cuts: Cuts | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """Sum of ``value`` from the start of the group.

    Rows with equal order share their sum (they stay in one piece); NULL values
    count as zero.
    """
    r, (before, own, _) = _cut(df, by, order, cuts, ranges)
    carried = r.carry(F.sum(value).alias(own)).withColumn(before, F.sum(own).over(r.over_pieces().rowsBetween(*_BEFORE)))
    # The default frame of an ordered window includes equal rows.
    total = F.coalesce(F.sum(value).over(r.inside(*order)), F.lit(0)) + F.coalesce(before, F.lit(0))
    return r.spread(carried, before).withColumn(out, total).drop(before, r.piece)


def running_row_number(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    out: str,
    cuts: Cuts | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """1, 2, 3 ... within the group, as long; ``order`` should be unique, equal rows are numbered in any order."""
    r, (before, own, _) = _cut(df, by, order, cuts, ranges)
    carried = r.carry(F.count("*").alias(own)).withColumn(before, F.sum(own).over(r.over_pieces().rowsBetween(*_BEFORE)))
    number = F.row_number().over(r.inside(*order)) + F.coalesce(before, F.lit(0))
    return r.spread(carried, before).withColumn(out, number.cast("long")).drop(before, r.piece)


def running_rank(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    out: str,
    dense: bool = False,
    cuts: Cuts | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """Rank within the group, as long: 1, 1, 3 ..., or 1, 1, 2 ... with ``dense``.

    Equal rows never lie in two pieces, so a piece hands on how many rows, or how
    many different places of the order, it has.
    """
    r, (before, own, _) = _cut(df, by, order, cuts, ranges)
    size = F.count_distinct(F.struct(*order)) if dense else F.count("*")
    carried = r.carry(size.alias(own)).withColumn(before, F.sum(own).over(r.over_pieces().rowsBetween(*_BEFORE)))
    local = (F.dense_rank() if dense else F.rank()).over(r.inside(*order))
    return r.spread(carried, before).withColumn(out, (local + F.coalesce(before, F.lit(0))).cast("long")).drop(before, r.piece)


def neighbour_values(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    value: str,
    before: str | None = None,
    after: str | None = None,
    cuts: Cuts | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """``value`` of the row before and/or after; ``order`` is unique."""
    r, (front, back, hold) = _cut(df, by, order, cuts, ranges)
    entry = F.struct(*order, F.struct(F.col(value).alias("v")).alias("held"))
    edges = r.carry(F.max(entry).alias(front), F.min(entry).alias(back))
    # The last entry of the piece before goes in front of a piece, the first one of the next behind it.
    edges = edges.withColumn(front, F.lag(front).over(r.over_pieces())["held"]).withColumn(
        back, F.lead(back).over(r.over_pieces())["held"]
    )
    rows = r.spread(edges, front, back).withColumn(hold, F.struct(F.col(value).alias("v")))
    inside = r.inside(*order)
    if before:
        rows = rows.withColumn(before, F.coalesce(F.lag(hold).over(inside), F.col(front))["v"])
    if after:
        rows = rows.withColumn(after, F.coalesce(F.lead(hold).over(inside), F.col(back))["v"])
    return rows.drop(front, back, hold, r.piece)


def fill_down(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str,
    cuts: Cuts | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """The last non-NULL ``value`` up to and including the row."""
    return _fill(df, by, order, value, out, cuts, ranges, backward=False)


def fill_up(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str,
    cuts: Cuts | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """The next non-NULL ``value`` from the row on, itself included."""
    return _fill(df, by, order, value, out, cuts, ranges, backward=True)


def _fill(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str,
    cuts: Cuts | None,
    ranges: int | None,
    backward: bool,
) -> DataFrame:
    r, (beyond, own, _) = _cut(df, by, order, cuts, ranges)
    known = F.when(F.col(value).isNotNull(), F.struct(*order, F.col(value).alias("held")))
    # Of rows with equal order the one that comes last in the walk counts.
    ends = r.carry((F.min if backward else F.max)(known).alias(own))
    along = r.over_pieces(backward).rowsBetween(*_BEFORE)
    ends = ends.withColumn(beyond, F.last(F.col(own)["held"], ignorenulls=True).over(along))
    walk = r.inside(*[F.col(c).desc() for c in order] if backward else order).rowsBetween(*_SO_FAR)
    found = F.coalesce(F.last(value, ignorenulls=True).over(walk), F.col(beyond))
    return r.spread(ends, beyond).withColumn(out, found).drop(beyond, r.piece)
