"""Accounts that move by transfers: signed legs and balances."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.operators.running import running_sum


def signed_legs(transfers: DataFrame, to: str, origin: str, value: str, account: str = "account") -> DataFrame:
    """Each transfer as an incoming and an outgoing row, from one pass over the transfers."""
    legs = F.array(
        F.struct(F.col(to).alias("a"), F.col(value).alias("v")),
        F.struct(F.col(origin).alias("a"), (-F.col(value)).alias("v")),
    )
    keep = [c for c in transfers.columns if c not in (to, origin, value)]
    return transfers.select(*keep, F.explode(legs).alias("_leg")).select(
        *keep, F.col("_leg.a").alias(account), F.col("_leg.v").alias(value)
    )


def statement(legs: DataFrame, openings: DataFrame, ranges: int | None = None) -> DataFrame:
    """Balance after every movement.

    ``legs``: account, transaction_date, value; ``openings``: account,
    transaction_date, balance. An account starts with its opening balance
    (value NULL); on one day the highest values come first, and equal values
    show the balance after all of them. Movements without a date come before
    all others and enter every later balance.
    """
    rows = legs.select("account", "transaction_date", "value", F.col("value").alias("_change"), F.lit(1).alias("_turn"))
    starts = openings.select(
        "account", "transaction_date", F.lit(None).cast("decimal(18,2)").alias("value"), F.col("balance").alias("_change"), F.lit(0).alias("_turn")
    )
    changes = rows.unionByName(starts).withColumn("_down", -F.col("value"))
    out = running_sum(changes, ["account"], ["transaction_date", "_turn", "_down"], "_change", "balance", ranges=ranges)
    return out.select("account", "transaction_date", F.col("value").alias("transaction_value"), "balance")
