"""Account statements and balances on chosen days."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.operators.ledger import signed_legs, statement
from tallyframe.operators.scaffold import date_grid


def payment_legs(detail: DataFrame, path: DataFrame) -> DataFrame:
    """Signed movements of all payments in ``detail`` that were not cancelled."""
    paid = detail.filter("cancelled <> 'Y'").join(path, "transaction_id", "left")
    return signed_legs(paid.select("transaction_date", "account_to", "account_from", "value"), "account_to", "account_from", "value")


def ledger_statement(detail: DataFrame, path: DataFrame, accounts: DataFrame) -> DataFrame:
    openings = accounts.select(
        F.col("account_number").alias("account"), F.col("balance_date").alias("transaction_date"), "balance"
    )
    return statement(payment_legs(detail, path), openings)


def daily_balances(detail: DataFrame, path: DataFrame, accounts: DataFrame, start: date, end: date) -> DataFrame:
    """One row per account and day from ``start`` to ``end``; days without movement have no value.

    Only movements of the asked days are joined and summed, per account and
    day; what is gathered per account, and the window over it, is never longer
    than that range. Accounts that moved on other days only are found by a
    distinct over the ids.
    """
    none = F.lit(None).cast("decimal(18,2)")
    asked = F.col("transaction_date").between(F.lit(start), F.lit(end))
    moves = payment_legs(detail.filter(asked), path).select(
        "account", F.col("transaction_date").alias("date"), F.col("value").alias("moved"), none.alias("opening")
    )
    openings = accounts.select(
        F.col("account_number").alias("account"), F.col("balance_date").alias("date"), none.alias("moved"), F.col("balance").alias("opening")
    )
    per_day = moves.unionByName(openings).groupBy("account", "date").agg(
        F.sum("moved").alias("moved"), F.sum("opening").alias("opening")
    )
    in_range = F.when(F.col("date").between(F.lit(start), F.lit(end)), F.struct("date", F.struct("moved", "opening").alias("v")))
    others = payment_legs(detail.withColumn("value", none), path).select("account").distinct()
    others = others.select("account", F.lit(None).cast("date").alias("date"), none.alias("moved"), none.alias("opening"))
    per_day = per_day.unionByName(others)
    known = per_day.groupBy("account").agg(F.map_from_entries(F.collect_list(in_range)).alias("known"))
    grid = date_grid(known, start, end, "date").withColumn("day", F.try_element_at("known", F.col("date")))
    change = F.coalesce("day.moved", F.lit(0)) + F.coalesce("day.opening", F.lit(0))
    so_far = Window.partitionBy("account").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    return grid.select(
        "account", "date", F.col("day.moved").alias("transaction_value"), F.sum(change).over(so_far).alias("balance")
    )


def balance_on(detail: DataFrame, path: DataFrame, accounts: DataFrame, start: date, end: date, selected: date) -> DataFrame:
    """The rows that ``daily_balances`` has for one day, without its other days.

    What moved from ``start`` up to the day is summed per account in one pass,
    so an account is one row whatever the range; the movements of the day
    itself are its value. A day outside the range has no rows.
    """
    zero, none = F.lit(0).cast("decimal(18,2)"), F.lit(None).cast("decimal(18,2)")
    day = F.lit(selected)
    asked = F.col("transaction_date").between(F.lit(start), day)
    moves = payment_legs(detail.filter(asked), path).select(
        "account", F.when(F.col("transaction_date") == day, F.col("value")).alias("moved"), F.col("value").alias("change")
    )
    opened = F.when(F.col("balance_date").between(F.lit(start), day), F.col("balance"))
    openings = accounts.select(F.col("account_number").alias("account"), none.alias("moved"), opened.alias("change"))
    others = payment_legs(detail.withColumn("value", none), path).select("account").distinct()
    others = others.select("account", none.alias("moved"), none.alias("change"))
    return (
        moves.unionByName(openings)
        .unionByName(others)
        .filter(F.lit(start <= selected <= end))
        .groupBy("account")
        .agg(F.sum("moved").alias("transaction_value"), F.sum(F.coalesce("change", zero)).alias("balance"))
        .select("account", day.alias("date"), "transaction_value", "balance")
    )
