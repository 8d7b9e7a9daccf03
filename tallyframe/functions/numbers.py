"""Rounding, ratios, bands and equal-width bins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def money(col: Column) -> Column:
    """Exact two-digit amount, so that sums do not depend on the order of addition."""
    return col.cast(MONEY)


def round_half_up(col: Column, digits: int = 0) -> Column:
    """Round half away from zero on ten exact decimals, returned as double."""
    return F.round(col.cast("decimal(28,10)"), digits).cast("double")


def ratio(part: Column, whole: Column) -> Column:
    """Division as double; NULL when ``whole`` is zero."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def percent(part: Column, whole: Column, digits: int) -> Column:
    return round_half_up(ratio(part, whole) * 100, digits)


def percent_text(part: Column, whole: Column) -> Column:
    """``'85.71%'``: always two decimals and a percent sign; NULL stays NULL."""
    return F.format_string("%.2f%%", percent(part, whole, 2))


def band(col: Column, upper_limits: Sequence[tuple[float, str]], above: str | None = None) -> Column:
    """First label whose (exclusive) upper limit is above the value, else ``above``."""
    out: Column | None = None
    for limit, label in upper_limits:
        hit = col < F.lit(limit)
        out = F.when(hit, label) if out is None else out.when(hit, label)
    # A NULL value passes every comparison, so it must not fall into the last band.
    return out.when(col.isNotNull(), F.lit(above)) if above is not None else out


def bin_label(days: Column, width: int, bins: int, unit: str = "days") -> Column:
    """Label of the equal-width bin 1..width, width+1..2*width, ...; outside is named."""
    bucket = F.width_bucket(days, F.lit(1), F.lit(width * bins + 1), F.lit(bins))
    return (
        F.when(bucket < 1, f"under 1 {unit}")
        .when(bucket > bins, f"over {width * bins} {unit}")
        .otherwise(
            F.concat(
                ((bucket - 1) * width + 1).cast("string"),
                F.lit(" - "),
                (bucket * width).cast("string"),
                F.lit(f" {unit}"),
            )
        )
    )
