"""Shop sales, favourite items and member points.

Amounts are summed per customer straight from the sales joined with the menu:
a map task sends one row per customer, however often one of them occurs.
Filters by joining date come before the sums.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.operators.ranking import top_rows


def customer_spend(sales: DataFrame, menu: DataFrame) -> DataFrame:
    """Total per customer only."""
    return sales.join(menu, "product_id").groupBy("customer_id").agg(F.sum("price").alias("spend"))


def visit_days(sales: DataFrame) -> DataFrame:
    return sales.groupBy("customer_id").agg(F.count_distinct("order_date").alias("nr_of_visits"))


def first_item(sales: DataFrame) -> DataFrame:
    """Item of the first sale; on one day the smallest item id."""
    return top_rows(sales, ["customer_id"], [F.col("order_date"), F.col("product_id")]).select("customer_id", "product_id")


def top_item(sales: DataFrame, menu: DataFrame) -> DataFrame:
    counted = sales.groupBy("product_id").agg(F.count("*").alias("n"))
    named = counted.join(menu, "product_id").groupBy("product_name").agg(F.sum("n").alias("times_ordered"))
    return named.orderBy(F.col("times_ordered").desc(), "product_name").limit(1)


def favourite_item(sales: DataFrame, menu: DataFrame) -> DataFrame:
    """Most bought item per customer, with ties."""
    named = sales.join(menu, "product_id").groupBy("customer_id", "product_name").agg(F.count("*").alias("times_ordered"))
    return top_rows(named, ["customer_id"], [F.col("times_ordered").desc()], ties="dense_rank")


def _around_joining(sales: DataFrame, menu: DataFrame, members: DataFrame, kept: Column, nearest: Callable) -> DataFrame:
    """The sales of one day per member: a date per customer is found first, then the sales of that date pass as they are."""
    rows = sales.join(menu.select("product_id", "product_name"), "product_id")
    days = rows.join(members, "customer_id").filter(kept).groupBy("customer_id").agg(nearest("order_date").alias("order_date"))
    return rows.join(days, ["customer_id", "order_date"]).select("customer_id", "product_name")


def first_item_after_join(sales: DataFrame, menu: DataFrame, members: DataFrame) -> DataFrame:
    """All sales of the first day on or after the joining date."""
    return _around_joining(sales, menu, members, F.col("join_date") <= F.col("order_date"), F.min)


def last_item_before_join(sales: DataFrame, menu: DataFrame, members: DataFrame) -> DataFrame:
    """All sales of the last day before the joining date."""
    return _around_joining(sales, menu, members, F.col("join_date") > F.col("order_date"), F.max)


def pre_join_totals(sales: DataFrame, menu: DataFrame, members: DataFrame) -> DataFrame:
    """Items and amount before joining; customers who never joined count with everything.

    An item without a menu entry counts but has no price.
    """
    rows = sales.join(menu, "product_id", "left").join(members, "customer_id", "left")
    before = rows.filter(F.col("join_date").isNull() | (F.col("join_date") > F.col("order_date")))
    return before.groupBy("customer_id").agg(F.count("*").alias("total_items"), F.sum("price").alias("total_spend"))


def _points(double: Column) -> Column:
    return F.when(double, 20).otherwise(10)


def points(sales: DataFrame, menu: DataFrame, double_item: str) -> DataFrame:
    """Ten points per unit of money, twenty for one item."""
    earned = F.col("price") * _points(F.col("product_name") == double_item)
    return sales.join(menu, "product_id", "left").groupBy("customer_id").agg(F.sum(earned).alias("points"))


def first_week_points(
    sales: DataFrame, menu: DataFrame, members: DataFrame, double_item: str, until: date | None = None
) -> DataFrame:
    """Twenty points on everything in the seven days from joining on, else as ``points``; sales up to ``until``."""
    if until is not None:
        sales = sales.filter(F.col("order_date") <= F.lit(until))
    rows = sales.join(menu, "product_id").join(members, "customer_id", "left")
    first_week = F.coalesce(F.datediff("order_date", "join_date").between(0, 6), F.lit(False))
    earned = F.col("price") * _points(first_week | (F.col("product_name") == double_item))
    return rows.groupBy("customer_id").agg(F.sum(earned).alias("points"))
