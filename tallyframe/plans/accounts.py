"""Customers at nodes in regions, their transactions and balances."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.functions.dates import year_month
from tallyframe.functions.numbers import percent_text, ratio, round_half_up
from tallyframe.operators.percentiles import exact_percentiles
from tallyframe.operators.scaffold import carry_forward, date_grid

# Fixed value: an end date in this year means "not ended".
OPEN_YEAR = "9999"


def unique_nodes(nodes: DataFrame) -> DataFrame:
    """Pairs of region and node; a pair with a NULL does not count."""
    return nodes.agg(F.count_distinct("region_id", "node_id").alias("nr_of_unique_nodes"))


def nodes_per_region(nodes: DataFrame) -> DataFrame:
    return nodes.groupBy("region_id").agg(F.count_distinct("node_id").alias("number_of_distinct_nodes"))


def _is_open(end: Column) -> Column:
    return end.cast("string").startswith(OPEN_YEAR)


def active_by_region(nodes: DataFrame, regions: DataFrame) -> DataFrame:
    counted = nodes.filter(_is_open(F.col("end_date"))).groupBy("region_id").agg(F.count("customer_id").alias("n"))
    return counted.join(regions, "region_id").groupBy("region_name").agg(F.sum("n").alias("customers_actively_allocated"))


def close_open_ends(nodes: DataFrame) -> DataFrame:
    """The open end date becomes NULL."""
    return nodes.withColumn("end_date", F.when(_is_open(F.col("end_date")), None).otherwise(F.col("end_date")))


def allocation_days(nodes: DataFrame) -> DataFrame:
    """Ended stays with the days between start and end."""
    return close_open_ends(nodes).filter("end_date IS NOT NULL").withColumn("days", F.datediff("end_date", "start_date"))


def _stay_lengths(nodes: DataFrame) -> DataFrame:
    """Ended stays, start and end day both counted."""
    return allocation_days(nodes).withColumn("days", F.col("days") + 1)


def avg_allocation_days(nodes: DataFrame) -> DataFrame:
    return _stay_lengths(nodes).agg(round_half_up(F.avg("days"), 1).alias("avg_days_before_reallocation"))


def amount_percentiles(transactions: DataFrame) -> DataFrame:
    """Exact interpolated percentiles of the amounts of each kind of transaction, to four digits after the point."""
    shares = {"median_amount": 0.5, "percentile_80": 0.8, "percentile_95": 0.95}
    found = exact_percentiles(transactions, ["txn_type"], "txn_amount", shares)
    return found.select("txn_type", *[round_half_up(F.col(name), 4).alias(name) for name in shares])


def allocation_percentiles(nodes: DataFrame, regions: DataFrame) -> DataFrame:
    """Exact interpolated percentiles.

    Stays are counted per region and length first, and the percentile takes
    the counts as weights: what one region gathers is its distinct lengths.
    """
    counted = _stay_lengths(nodes).groupBy("region_id", "days").agg(F.count("*").alias("n")).join(regions, "region_id")

    def at(p: float) -> Column:
        return F.percentile("days", p, F.col("n"))

    return counted.groupBy("region_name").agg(
        at(0.5).alias("median_days"), at(0.8).alias("percentile_80"), at(0.95).alias("percentile_95")
    )


def type_totals(transactions: DataFrame) -> DataFrame:
    return transactions.groupBy("txn_type").agg(
        F.count("txn_type").alias("number_of_transactions"), F.sum("txn_amount").alias("transaction_amount")
    )


def avg_deposits(transactions: DataFrame) -> DataFrame:
    """Mean over customers of their total and number of deposits."""
    per_customer = transactions.filter("txn_type = 'deposit'").groupBy("customer_id").agg(
        F.sum("txn_amount").alias("total"), F.count("txn_amount").alias("deposits")
    )
    return per_customer.agg(
        round_half_up(ratio(F.sum("total"), F.count("*")), 2).alias("avg_total_deposited"),
        round_half_up(ratio(F.sum("deposits"), F.count("*")), 2).alias("avg_deposits"),
    )


def monthly_active_customers(transactions: DataFrame) -> DataFrame:
    """Customers per month with more than one deposit and at least one purchase or withdrawal."""
    kind = F.col("txn_type")
    active = (
        transactions.groupBy("customer_id", F.trunc("txn_date", "month").alias("month"))
        .agg(F.count_if(kind == "deposit").alias("ins"), F.count_if(kind != "deposit").alias("outs"))
        .filter("ins > 1 AND outs >= 1")
    )
    counts = active.groupBy("month").agg(F.count("*").alias("customers"))
    return counts.select(year_month(F.col("month")).alias("yearmonth"), "customers")


def _signed() -> Column:
    return F.when(F.col("txn_type") == "deposit", F.col("txn_amount")).otherwise(-F.col("txn_amount"))


def month_end_balances(transactions: DataFrame) -> DataFrame:
    """Closing balance of every month in which the customer moved money.

    Months are summed first, so a customer's window is as long as its months.
    """
    months = transactions.groupBy("customer_id", F.last_day("txn_date").alias("end_of_month")).agg(
        F.sum(_signed()).alias("change"), F.max("txn_date").alias("txn_date")
    )
    so_far = Window.partitionBy("customer_id").orderBy("end_of_month").rowsBetween(Window.unboundedPreceding, 0)
    return months.select(
        "customer_id",
        year_month(F.col("end_of_month")).alias("yearmonth"),
        "txn_date",
        "end_of_month",
        F.sum("change").over(so_far).alias("balance"),
    )


def monthly_balance_series(transactions: DataFrame, first: date, last: date) -> DataFrame:
    """A balance for every customer and month from ``first`` to ``last`` (month starts).

    Months without movements carry the last balance on; what happened before
    ``first`` counts as its starting point.
    """
    grid = date_grid(transactions.select("customer_id").distinct(), first, last, "month", "1 month")
    month = F.greatest(F.trunc("end_of_month", "month"), F.lit(first))
    known = (
        month_end_balances(transactions)
        .filter(F.col("end_of_month") <= F.last_day(F.lit(last)))
        .groupBy("customer_id", month.alias("month"))
        .agg(F.max_by("balance", "end_of_month").alias("balance"))
    )
    filled = carry_forward(grid.join(known, ["customer_id", "month"], "left"), ["customer_id"], "month", "balance", "closing")
    return filled.select("customer_id", year_month(F.col("month")).alias("yearmonth"), F.col("closing").alias("balance"))


def balance_growth_share(transactions: DataFrame, first: date, last: date, over: float = 5.0) -> DataFrame:
    """Share of customers whose balance grew by more than ``over`` percent between two month ends.

    A closing balance is the sum of everything up to that month, so both come
    from one aggregation. A customer without movements by the first month end,
    or with a balance of zero there, has not grown.
    """
    def closing(month: date) -> Column:
        return F.sum(F.when(F.col("txn_date") <= F.last_day(F.lit(month)), _signed()))

    both = transactions.groupBy("customer_id").agg(closing(first).alias("a"), closing(last).alias("b"))
    growth = round_half_up(ratio(F.col("b") - F.col("a"), F.abs("a")) * 100, 2)
    grown = F.count_if(F.coalesce(growth > over, F.lit(False)))
    return both.agg(percent_text(grown, F.count("*")).alias("percentage_of_customers_with_increase"))
