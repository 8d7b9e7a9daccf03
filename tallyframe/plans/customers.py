"""Customer surveys, account holders, share purchases, nearest branches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.functions.numbers import band, percent, round_half_up
from tallyframe.functions.text import blank_to_null, list_items, scaled_amount
from tallyframe.operators.nearest import nearest_site
from tallyframe.operators.ranking import top_rows
from tallyframe.operators.reshape import explode_items
from tallyframe.operators.ranges import sort_cuts
from tallyframe.operators.running import running_row_number

PLATFORMS = ("mobile_app", "online_interface")
# Exclusive upper limits of the two classifications.
MARKET_CAP_BANDS = ((1e8, "Small"), (1e9, "Medium"), (1e11, "Large"))
PRICE_BANDS = ((25000.0, "Low"), (50000.0, "Medium"), (75000.0, "High"))
PRICE_LIMIT = 100000.0


def platform_ratings(survey: DataFrame) -> DataFrame:
    """One row per customer and question, a column per platform; overall ratings are left out.

    The columns of a question are paired by name within the row, so nothing is
    shuffled; a question without any rating gives no row.
    """
    asked = [c for c in survey.columns if c != "customer_id" and not c.endswith("overall_rating")]
    topics = dict.fromkeys(c.removeprefix(f"{p}_") for p in PLATFORMS for c in asked if c.startswith(f"{p}_"))
    none = F.lit(None).cast("int")

    def question(topic: str) -> Column:
        cells = [(F.col(f"{p}_{topic}") if f"{p}_{topic}" in asked else none).alias(p) for p in PLATFORMS]
        return F.struct(F.lit(topic.replace("_", " ").lower()).alias("category"), *cells)

    rows = survey.select("customer_id", F.inline(F.array(*map(question, topics))))
    return rows.filter(F.coalesce(*PLATFORMS).isNotNull())


def rating_segments(survey: DataFrame, digits: int = 1) -> DataFrame:
    """Share of customers per preference class, by the difference of their two average ratings."""
    means = platform_ratings(survey).groupBy("customer_id").agg(
        *[(F.sum(p) / F.count(p)).alias(p) for p in PLATFORMS]
    )
    lead = F.col("mobile_app") - F.col("online_interface")
    segment = (
        F.when(lead <= -2, "Online Interface Superfan")
        .when(lead >= 2, "Mobile App Superfan")
        .when(lead <= -1, "Online Interface Fan")
        .when(lead >= 1, "Mobile App Fan")
        .otherwise("Neutral")
    )
    counts = means.groupBy(segment.alias("customer_category")).agg(F.count("*").alias("n"))
    # At most five rows are left, so the total over all of them is a tiny window.
    total = F.sum("n").over(Window.partitionBy())
    return counts.select("customer_category", percent(F.col("n"), total, digits).alias("percentage"))


def holder_payments(
    accounts: DataFrame, holders: DataFrame, path: DataFrame, detail: DataFrame, min_value: int, excluded_type: str = "Platinum"
) -> DataFrame:
    """Large, not cancelled payments with one row per holder of the paying account.

    Filters come before the joins: payments first lose the small and cancelled ones.
    """
    paid = detail.filter((F.col("value") > min_value) & (F.col("cancelled") == "N")).join(path, "transaction_id")
    owners = explode_items(
        accounts.filter(F.col("account_type") != excluded_type), list_items(F.col("account_holder_id")), "holder"
    )
    owners = owners.withColumn("account_holder_id", F.col("holder").cast("long")).join(holders, "account_holder_id")
    return paid.join(owners, paid["account_from"] == owners["account_number"]).select(
        "transaction_id",
        "account_to",
        "transaction_date",
        "value",
        "account_number",
        "account_type",
        "balance_date",
        "balance",
        "name",
        F.col("dob").alias("day_of_birth"),
        F.concat(F.lit("0"), F.col("contact_number").cast("string")).alias("contact_number"),
        "first_line_of_address",
    )


def banded_purchases(purchases: DataFrame, year: int, n: int = 5) -> DataFrame:
    """The n highest purchases (with ties) per file month, capitalisation and price class."""
    clean = (
        purchases.withColumn("market_cap", blank_to_null(F.col("market_cap"), ("n/a",)))
        .filter("market_cap IS NOT NULL")
        .select(
            F.to_date(F.concat(F.lit(f"{year}-"), F.lpad(F.col("file").cast("string"), 2, "0"), F.lit("-01"))).alias("file_date"),
            scaled_amount(F.col("market_cap")).alias("market_cap"),
            scaled_amount(F.col("purchase_price")).alias("purchase_price"),
            "ticker",
            "sector",
            "market",
            "stock_name",
        )
    )
    price = F.col("purchase_price")
    classed = clean.withColumn("market_cap_categorization", band(F.col("market_cap"), MARKET_CAP_BANDS, "Huge")).withColumn(
        "purchase_price_categorization",
        F.coalesce(band(price, PRICE_BANDS), F.when(price <= PRICE_LIMIT, "Very High")),
    )
    group = ["file_date", "market_cap_categorization", "purchase_price_categorization"]
    return top_rows(classed, group, [price.desc()], n, "rank", rank_as="rank")


def branch_priorities(customers: DataFrame, sites: DataFrame) -> DataFrame:
    """Nearest branch of each customer; per branch the customers are numbered from the closest on."""
    near = nearest_site(customers, sites, "address_lat", "address_long", "branch", "branch_lat", "branch_long")
    near = near.select("branch", "customer", "distance")
    # A branch may be nearest to very many customers. There is one row per customer, so those are counted instead.
    cuts = sort_cuts(near, ["branch", "distance", "customer"], size=customers.count())
    ranked = running_row_number(near, ["branch"], ["distance", "customer"], "customer_priority", cuts)
    return ranked.select("branch", "customer", round_half_up(F.col("distance"), 2).alias("distance"), "customer_priority")
