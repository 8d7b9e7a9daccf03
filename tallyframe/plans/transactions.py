"""Bank transactions: totals at several levels, targets, identifiers, monthly ranks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.functions.numbers import round_half_up
from tallyframe.functions.text import before, prefix_before
from tallyframe.operators.ranking import top_rows
from tallyframe.operators.reshape import pivot_named, unpivot_non_null

# Codes of the transaction channel.
CHANNELS = {1: "online", 2: "in-person"}
TARGET_CHANNELS = {1: "Online", 2: "In-Person"}


def _channel(col: Column, names: dict[int, str]) -> Column:
    out = F
    for code, name in names.items():
        out = out.when(col == code, name)
    return out


def labelled_transactions(transactions: DataFrame) -> DataFrame:
    """Bank from the code prefix, channel name and weekday from the date text."""
    day = F.to_date(F.left("transaction_date", F.lit(10)), "dd/MM/yyyy")
    return transactions.select(
        prefix_before(F.col("transaction_code"), "-").alias("bank"),
        _channel(F.col("online_or_in_person"), CHANNELS).alias("online_or_in_person"),
        F.dayname(day).alias("weekday"),
        "value",
        "customer_code",
    )


def value_by(transactions: DataFrame, *levels: str) -> DataFrame:
    return labelled_transactions(transactions).groupBy(*levels).agg(F.sum("value").alias("value"))


def value_grouping_sets(transactions: DataFrame) -> DataFrame:
    """The three levels of detail in one scan; ``level`` tells them apart, unused keys are NULL."""
    rows = labelled_transactions(transactions)
    bank, day, channel, customer = (F.col(c) for c in ("bank", "weekday", "online_or_in_person", "customer_code"))
    sets = rows.groupingSets(
        [[bank], [bank, day, channel], [bank, customer]], bank, day, channel, customer
    ).agg(F.sum("value").alias("value"), F.grouping_id().alias("_set"))
    level = F.when(F.col("_set") == 7, "bank").when(F.col("_set") == 1, "bank_day_channel").otherwise("bank_customer")
    return sets.withColumn("level", level).drop("_set")


def account_identifiers(transfers: DataFrame, swift: DataFrame, country: str = "GB") -> DataFrame:
    """Country, check digits, bank code, sort code without dashes and account number in one text."""
    parts = [F.lit(country), "check_digits", "swift_code", F.replace(F.col("sort_code"), F.lit("-"), F.lit("")), "account_number"]
    return transfers.join(swift, "bank").select("transaction_id", F.concat(*parts).alias("iban"))


def quarterly_target_variance(transactions: DataFrame, targets: DataFrame, code: str) -> DataFrame:
    """Value per channel and quarter of one bank against its target; missing targets give no row."""
    goals = unpivot_non_null(targets, ["online_or_inperson"], ["q1", "q2", "q3", "q4"], "quarter", "target").select(
        "online_or_inperson", F.replace("quarter", F.lit("q"), F.lit("")).cast("int").alias("quarter"), "target"
    )
    # Summing before the join leaves eight rows to match with the targets.
    actual = (
        transactions.filter(F.col("transaction_code").contains(code))
        .groupBy(
            _channel(F.col("online_or_in_person"), TARGET_CHANNELS).alias("online_or_inperson"),
            F.quarter(F.to_date("transaction_date", "dd/MM/yyyy HH:mm:ss")).alias("quarter"),
        )
        .agg(F.sum("value").alias("value"))
    )
    return actual.join(goals, ["online_or_inperson", "quarter"]).select(
        "online_or_inperson", "quarter", "value", "target", (F.col("value") - F.col("target")).alias("variance")
    )


def earliest_customer_record(facts: DataFrame, year: int) -> DataFrame:
    """Attribute rows of all monthly sheets to one row per customer, at the earliest joining date."""
    month = F.month(F.to_date(F.concat(F.lit(str(year)), F.col("period")), "yyyyMMM"))
    dated = facts.select(
        "id", F.make_date(F.lit(year), month, F.col("joining_day")).alias("joined_date"), "demographic", "value"
    )
    columns = {"Ethnicity": "ethnicity", "Account Type": "account_type", "Date of Birth": "date_of_birth"}
    wide = pivot_named(dated, ["id", "joined_date"], "demographic", "value", columns, F.max)
    return top_rows(wide, ["id"], [F.col("joined_date").asc()]).withColumn(
        "date_of_birth", F.col("date_of_birth").cast("date")
    )


def monthly_rank_enrichment(transactions: DataFrame) -> DataFrame:
    """Rank of each bank per month, with the average rank per bank and the average value per rank.

    Ranks and averages run on one row per bank and month, so the windows are small.
    """
    month_name = F.date_format(F.make_date(F.lit(2000), F.col("sortmonth"), F.lit(1)), "MMMM")
    summary = (
        transactions.groupBy(
            F.month("transaction_date").alias("sortmonth"), before(F.col("transaction_code"), "-").alias("bank")
        )
        .agg(F.sum("value").alias("value"))
        .withColumn("transaction_month", month_name)
    )
    ranked = summary.withColumn(
        "transaction_rank", F.rank().over(Window.partitionBy("sortmonth").orderBy(F.col("value").desc()))
    )

    def mean(name: str, per: str) -> Column:
        w = Window.partitionBy(per)
        return round_half_up(F.sum(name).over(w).cast("double") / F.count(name).over(w), 2)

    return (
        ranked.withColumn("transaction_rank_avg", mean("value", "transaction_rank"))
        .withColumn("bank_rank_avg", mean("transaction_rank", "bank"))
        .orderBy("sortmonth", "transaction_rank", "bank")
        .drop("sortmonth")
    )
