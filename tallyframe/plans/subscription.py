"""Subscription plans: journeys, churn, upgrades, downgrades.

``change_id`` orders plan changes of one day.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.functions.dates import in_year, month_start
from tallyframe.functions.numbers import bin_label, percent, round_half_up
from tallyframe.operators.ranking import top_rows
from tallyframe.operators.reshape import pivot_named
from tallyframe.operators.running import neighbour_values

FREE = ("trial", "churn")
_IN_ORDER = ("start_date", "change_id")


def customer_journey(subscriptions: DataFrame, plans: DataFrame, customers: list[int] | None = None) -> DataFrame:
    """Plan changes with names, of the given customers or of all."""
    rows = subscriptions if customers is None else subscriptions.filter(F.col("customer_id").isin(*customers))
    return rows.join(plans, "plan_id").select("customer_id", "start_date", "plan_name")


def customers_ever(subscriptions: DataFrame) -> DataFrame:
    return subscriptions.agg(F.count_distinct("customer_id").alias("nr_of_customers"))


def customers_paying(subscriptions: DataFrame, plans: DataFrame) -> DataFrame:
    paid = plans.filter(~F.col("plan_name").isin(*FREE))
    return subscriptions.join(paid, "plan_id").agg(F.count_distinct("customer_id").alias("nr_of_customers"))


def trials_by_month(subscriptions: DataFrame, plans: DataFrame) -> DataFrame:
    trials = subscriptions.join(plans.filter("plan_name = 'trial'"), "plan_id")
    return trials.groupBy(month_start(F.col("start_date")).alias("month")).agg(F.count("*").alias("trials_started")).orderBy("month")


def plan_events_after(subscriptions: DataFrame, plans: DataFrame, year: int) -> DataFrame:
    later = subscriptions.filter(F.col("start_date") >= F.make_date(F.lit(year + 1), F.lit(1), F.lit(1))).groupBy("plan_id").agg(F.count("*").alias("count_of_events"))
    return later.join(plans, "plan_id").select("plan_name", "count_of_events").orderBy(F.col("count_of_events").desc(), "plan_name")


def churn_rate(subscriptions: DataFrame, plans: DataFrame) -> DataFrame:
    """Churn events against all customers, counted in one pass."""
    counts = subscriptions.join(plans, "plan_id", "left").agg(
        F.count_distinct("customer_id").alias("total_customers"),
        F.count_if(F.col("plan_name") == "churn").alias("nr_of_churned_customers"),
    )
    return counts.withColumn(
        "percentage_churned_customers", percent(F.col("nr_of_churned_customers"), F.col("total_customers"), 1)
    )


def _first_two(subscriptions: DataFrame) -> DataFrame:
    """The first two plans of every customer; each customer has exactly one first plan."""
    return top_rows(subscriptions, ["customer_id"], [F.col(c) for c in _IN_ORDER], 2, rank_as="step")


def churn_after_trial(subscriptions: DataFrame, plans: DataFrame) -> DataFrame:
    """Customers whose second plan is churn."""
    counts = _first_two(subscriptions).join(plans, "plan_id", "left").agg(
        F.count_if(F.col("step") == 1).alias("total_customers"),
        F.count_if((F.col("step") == 2) & (F.col("plan_name") == "churn")).alias("churned_after_trial"),
    )
    return counts.withColumn("churned_after_trial_perc", percent(F.col("churned_after_trial"), F.col("total_customers"), 2))


def plan_after_trial(subscriptions: DataFrame, plans: DataFrame) -> DataFrame:
    """Second plans with their share of all customers."""
    counts = _first_two(subscriptions).groupBy("step", "plan_id").agg(F.count("*").alias("n"))
    # At most two rows per plan are left for the total.
    total = F.sum(F.when(F.col("step") == 1, F.col("n"))).over(Window.partitionBy())
    second = counts.withColumn("total", total).filter("step = 2").join(plans, "plan_id")
    return second.select(
        "plan_name", F.col("n").alias("number_of_subscriptions"), percent(F.col("n"), F.col("total"), 2).alias("percentage")
    )


def plan_on_date(subscriptions: DataFrame, plans: DataFrame, day: date, digits: int = 1) -> DataFrame:
    """Customers per plan held at the end of ``day``, with their share."""
    held = top_rows(
        subscriptions.filter(F.col("start_date") <= F.lit(day)), ["customer_id"], [F.col(c).desc() for c in _IN_ORDER]
    )
    counts = held.groupBy("plan_id").agg(F.count("*").alias("nr_of_customers"))
    total = F.sum("nr_of_customers").over(Window.partitionBy())
    return (
        counts.withColumn("percentage", percent(F.col("nr_of_customers"), total, digits))
        .join(plans, "plan_id")
        .select("plan_name", "nr_of_customers", "percentage")
    )


def annual_starts(subscriptions: DataFrame, plans: DataFrame, year: int) -> DataFrame:
    """All starts of the annual plan in the year."""
    annual = subscriptions.filter(in_year(F.col("start_date"), year)).join(plans.filter("plan_name = 'pro annual'"), "plan_id")
    return annual.agg(F.count("*").alias("upgrades_to_pro_annual"))


def _days_to_annual(subscriptions: DataFrame) -> DataFrame:
    first = pivot_named(subscriptions, ["customer_id"], "plan_id", "start_date", {0: "trial", 3: "pro_annual"}, F.min)
    return first.filter("pro_annual IS NOT NULL").select("customer_id", F.datediff("pro_annual", "trial").alias("days"))


def avg_days_to_annual(subscriptions: DataFrame) -> DataFrame:
    return _days_to_annual(subscriptions).agg(round_half_up(F.avg("days"), 6).alias("avg_days_between_upgrade_to_pro_annual"))


def days_to_annual_histogram(subscriptions: DataFrame, width: int = 30, bins: int = 12) -> DataFrame:
    """Bins of exactly 30 days (1 - 30, 31 - 60, ...), with named bins below and above."""
    return (
        _days_to_annual(subscriptions)
        .groupBy(bin_label(F.col("days"), width, bins).alias("bin"))
        .agg(round_half_up(F.avg("days"), 0).alias("avg_in_days"), F.count("*").alias("nr_of_customers"))
    )


def downgrades(subscriptions: DataFrame, plans: DataFrame, year: int, old: str = "pro monthly", new: str = "basic monthly") -> DataFrame:
    """Changes from plan ``old`` straight to ``new``, both within the year."""
    rows = subscriptions.filter(in_year(F.col("start_date"), year))
    steps = neighbour_values(rows, ["customer_id"], ["start_date", "change_id"], "plan_id", before="old_id")
    before = plans.select(F.col("plan_id").alias("old_id"), F.col("plan_name").alias("old_plan"))
    after = plans.select("plan_id", F.col("plan_name").alias("new_plan"))
    return (
        steps.join(before.filter(F.col("old_plan") == old), "old_id")
        .join(after.filter(F.col("new_plan") == new), "plan_id")
        .select("customer_id", "old_plan", "new_plan")
    )


def payment_schedule(subscriptions: DataFrame, plans: DataFrame, year: int) -> DataFrame:
    """All payments of one year.

    A monthly plan is paid on its start date and the same day of every month
    until the next change. An upgrade from basic is cheaper by what was paid
    for basic. Going from pro monthly to pro annual takes effect at the end of
    the running month. Nothing is paid after a churn or for a plan that is
    replaced before its first payment.
    """
    steps = neighbour_values(
        subscriptions.withColumn("at", F.struct("start_date", "plan_id")),
        ["customer_id"],
        ["start_date", "change_id"],
        "at",
        before="before",
        after="after",
    ).withColumn("until", F.col("after.start_date"))
    priced = plans.filter(~F.col("plan_name").isin(*FREE))
    old = plans.select(F.col("plan_id").alias("old_id"), F.col("plan_name").alias("old_name"), F.col("price").alias("old_price"))
    paid = (
        steps.join(priced, "plan_id")
        .withColumn("old_id", F.col("before.plan_id"))
        .join(old, "old_id", "left")
        .withColumn("old_start", F.col("before.start_date"))
    )

    annual = F.col("plan_name") == "pro annual"
    months = (F.year("start_date") - F.year("old_start")) * 12 + F.month("start_date") - F.month("old_start")
    this_month, next_month = F.add_months("old_start", months), F.add_months("old_start", months + 1)
    end_of_period = F.when(this_month >= F.col("start_date"), this_month).otherwise(next_month)
    delayed = annual & (F.col("old_name") == "pro monthly")
    first = F.when(delayed, end_of_period).otherwise(F.col("start_date"))
    last = F.least(F.date_sub("until", 1), F.lit(date(year, 12, 31)))  # least ignores a missing next change
    every = F.when(annual, F.expr("interval 12 month")).otherwise(F.expr("interval 1 month"))
    upgraded = (F.col("old_name") == "basic monthly") & F.col("plan_name").startswith("pro") & (F.col("old_start") < F.col("start_date"))

    payments = (
        paid.withColumn("first", first)
        .withColumn("last", last)
        .filter("first <= last")
        .withColumn("payment_date", F.explode(F.sequence("first", "last", every)))
        .filter(F.year("payment_date") == year)
        .withColumn(
            "amount",
            F.col("price") - F.when(upgraded & (F.col("payment_date") == F.col("first")), F.col("old_price")).otherwise(F.lit(0)),
        )
        .select("customer_id", "plan_id", "plan_name", "payment_date", F.col("amount").cast("decimal(18,2)").alias("amount"))
    )
    # A customer has one plan at a time and at most one payment a day, so this window never exceeds a year of days.
    return payments.withColumn("payment_order", F.row_number().over(Window.partitionBy("customer_id").orderBy("payment_date")))
