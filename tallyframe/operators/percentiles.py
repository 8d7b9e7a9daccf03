"""Exact interpolated percentiles of any measure, without gathering a group's values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.operators.ranges import all_equal
from tallyframe.operators.running import running_sum


def exact_percentiles(
    df: DataFrame, by: Sequence[str], value: str, shares: Mapping[str, float], ranges: int | None = None
) -> DataFrame:
    """One row per group with a double per entry of ``shares`` (name to share from 0 to 1).

    Between two values the result lies on the line between them. NULL values do
    not count; a group without others has no row. NULL keys are a group.

    Equal values are counted first. Running counts over the even pieces of the
    order (``operators.ranges``) then give every value its places, and only the
    values at the wanted places are kept: a group may hold any part of the table
    and any number of different values.
    """
    if not by:
        return exact_percentiles(df.withColumn("_one", F.lit(1)), ["_one"], value, shares, ranges).drop("_one")
    keys = [f"k{i}" for i in range(len(by))]
    rows = df.where(F.col(value).isNotNull()).select(*[F.col(b).alias(k) for b, k in zip(by, keys, strict=True)], F.col(value).alias("v"))
    counted = rows.groupBy(*keys, "v").agg(F.count("*").alias("m"))
    placed = running_sum(counted, keys, ["v"], "m", "upto", ranges=ranges)
    sizes = rows.groupBy(*[F.col(k).alias(f"g{i}") for i, k in enumerate(keys)]).agg(F.count("*").alias("size"))
    whole = placed.join(sizes, all_equal(placed, sizes, {k: f"g{i}" for i, k in enumerate(keys)}))

    def at(place: Column) -> Column:
        """The value at a place, counted from 0."""
        return F.max(F.when((F.col("upto") - F.col("m") <= place) & (place < F.col("upto")), F.col("v").cast("double")))

    ends = []
    for i, share in enumerate(shares.values()):
        place = (F.col("size") - 1) * F.lit(float(share))
        ends += [at(F.floor(place)).alias(f"low{i}"), at(F.ceil(place)).alias(f"high{i}"), F.max(place - F.floor(place)).alias(f"part{i}")]
    found = whole.groupBy(*keys).agg(*ends)
    between = [F.expr(f"low{i} * (1 - part{i}) + high{i} * part{i}").alias(name) for i, name in enumerate(shares)]
    return found.select(*[F.col(k).alias(b) for k, b in zip(keys, by, strict=True)], *between)
