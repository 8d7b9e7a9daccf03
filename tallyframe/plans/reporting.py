"""Working-day calendars: next reporting day, and aligning a second calendar to the first."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.functions.dates import is_weekend, month_label
from tallyframe.operators.asof import asof_join, next_in_list
from tallyframe.operators.running import fill_down, fill_up


# Calendars have one row per day, whatever the size of the data: they are walked in one piece.
_CALENDAR = 1


def bank_holidays(lines: DataFrame) -> DataFrame:
    """Dates of a printed list whose year stands only on the first line of its block."""
    printed = lines.withColumn("printed", F.when(F.col("year") != "", F.col("year"))).drop("year")
    return (
        fill_down(printed, [], ["line_no"], "printed", "year", ranges=_CALENDAR)
        .filter("date <> ''")
        .select(F.try_to_date(F.concat("year", "date"), "yyyydd-MMM").alias("holiday"), "bank_holiday")
    )


def reporting_flags(new_customers: DataFrame, lines: DataFrame) -> DataFrame:
    """Each joining date with its flag and the first reporting day on or after it."""
    days = new_customers.groupBy(F.to_date("date", "M/d/yy").alias("join_date")).agg(F.sum("new_customers").alias("new_customers"))
    joined = days.join(bank_holidays(lines), F.col("join_date") == F.col("holiday"), "left")
    closed = is_weekend(F.col("join_date")) | F.col("bank_holiday").isNotNull()
    flagged = joined.withColumn("reporting_flag", F.when(closed, "non-reporting day").otherwise("reporting day"))
    marked = flagged.withColumn("open_day", F.when(F.col("reporting_flag") == "reporting day", F.col("join_date")))
    ahead = fill_up(marked, [], ["join_date"], "open_day", "next_reporting_date", ranges=_CALENDAR)
    return ahead.select(
        "join_date", F.dayname("join_date").alias("day_name"), "bank_holiday", "reporting_flag", "next_reporting_date", "new_customers"
    )


def customers_per_reporting_day(new_customers: DataFrame, lines: DataFrame) -> DataFrame:
    """New customers at the reporting day that takes them; days after the last one have none."""
    return (
        reporting_flags(new_customers, lines)
        .filter("next_reporting_date IS NOT NULL")
        .groupBy(F.col("next_reporting_date").alias("reporting_date"))
        .agg(F.sum("new_customers").alias("new_customers"))
    )


def abroad_days(abroad: DataFrame) -> DataFrame:
    return abroad.select("reporting_month", "new_customers", F.to_date("reporting_date", "M/d/yy").alias("reporting_date"))


def unmatched_days(abroad: DataFrame, home_days: DataFrame) -> DataFrame:
    """Reporting days abroad that are no reporting days at home."""
    return abroad_days(abroad).join(home_days.select("reporting_date"), "reporting_date", "left_anti")


def aligned_calendar(home: DataFrame, abroad: DataFrame, lines: DataFrame, leave_out_month: str | None = None) -> DataFrame:
    """Reporting month and day at home with the counts from abroad moved to the next home day.

    The last reporting day of a month already belongs to the next month. A row
    is marked 'x' where the month reported abroad differs or is missing.
    Missing counts from abroad are 0.
    """
    home_days = customers_per_reporting_day(home, lines)
    away = abroad_days(abroad)
    to_home = next_in_list(away, "reporting_date", home_days, "reporting_date", "dates", strict=False, ranges=_CALENDAR)
    moved = (
        away.join(to_home, "reporting_date")
        .filter("dates IS NOT NULL")
        .groupBy("dates", F.col("reporting_month").alias("roi_reporting_month"))
        .agg(F.sum("new_customers").alias("roi_new_customers"))
    )
    whole_month = Window.partitionBy(F.year("dates"), F.month("dates"))
    last_day = F.max("dates").over(whole_month)
    months = home_days.select(F.col("reporting_date").alias("dates"), F.col("new_customers").alias("uk_new_customers")).withColumn(
        "reporting_month", month_label(F.when(F.col("dates") == last_day, F.add_months("dates", 1)).otherwise(F.col("dates")))
    )
    both = months.join(moved, "dates", "left")
    differs = F.col("roi_reporting_month").isNull() | (F.col("roi_reporting_month") != F.col("reporting_month"))
    numbered = Window.partitionBy("reporting_month").orderBy("dates", F.col("roi_reporting_month").asc_nulls_last())
    out = both.select(
        "reporting_month",
        F.row_number().over(numbered).alias("reporting_day"),
        "dates",
        "uk_new_customers",
        F.coalesce("roi_new_customers", F.lit(0).cast("bigint")).alias("roi_new_customers"),
        "roi_reporting_month",
        F.when(differs, "x").alias("misalignment_flag"),
    )
    return out.filter(F.col("reporting_month") != leave_out_month) if leave_out_month else out


def next_event(events: DataFrame, origin: str, target: str) -> DataFrame:
    """Each event of type ``origin`` with the first strictly later ``target`` event of the same user."""
    left = events.filter(F.col("event_type") == origin).select("user_id", "ts", "event_id")
    right = events.filter(F.col("event_type") == target).select("user_id", "ts", F.col("event_id").alias("next_event_id"))
    return asof_join(left, right, ["user_id"], "ts", ["next_event_id"]).select("event_id", "user_id", "next_event_id")


def next_event_of_anyone(events: DataFrame, origin: str, target: str) -> DataFrame:
    """Each event of type ``origin`` with the first strictly later ``target`` event of all users."""
    left = events.filter(F.col("event_type") == origin).select("ts", "event_id")
    right = events.filter(F.col("event_type") == target).select("ts", F.col("event_id").alias("next_event_id"))
    return asof_join(left, right, [], "ts", ["next_event_id"]).select("event_id", "next_event_id")


def last_known_value(events: DataFrame, event_type: str) -> DataFrame:
    """Fill-down: the value of the user's latest ``event_type`` event, on all rows from there on."""
    rows = events.select(
        "user_id",
        "event_id",
        "ts",
        F.when(F.col("event_type") == event_type, F.col("value")).alias("known"),
    )
    return fill_down(rows, ["user_id"], ["ts", "event_id"], "known", "filled").select("event_id", "user_id", "filled")
