"""The test tables in the shape that the queries expect.

Every adapter is a projection (or one natural join) of the given Parquet
tables; keys decide all made-up values, so the SQL checks can repeat them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.sources.tables import inline_rows, stack_tagged, table

# Month names in calendar order.
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")
# The subscription plans (id, name, monthly or yearly price).
PLANS = (
    (0, "trial", "0.00"),
    (1, "basic monthly", "9.90"),
    (2, "pro monthly", "19.90"),
    (3, "pro annual", "199.00"),
    (4, "churn", None),
)
# Quarterly targets per channel; the empty cell has no target.
TARGETS = (("Online", 16000000, 15500000, 15000000, 15200000), ("In-Person", 15000000, None, 14800000, 15100000))
HOLIDAY_YEARS = range(2023, 2030)
# Fixed value: weekdays repeat after 28 years, so order dates moved by it suit two-digit years.
_SHIFT_MONTHS = 28 * 12
# Public holidays that fall on the same date every year.
HOLIDAYS = (("01-Jan", "New Year"), ("25-Dec", "Christmas Day"), ("26-Dec", "Boxing Day"))


# --- bank transactions -------------------------------------------------------

def bank_transactions(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").selectExpr(
        "concat(substr(o_orderpriority, 3, 3), '-', o_orderkey) AS transaction_code",
        "CAST(o_orderkey % 2 + 1 AS INT) AS online_or_in_person",
        "date_format(o_orderdate, 'dd/MM/yyyy HH:mm:ss') AS transaction_date",
        "CAST(o_totalprice AS DECIMAL(18,2)) AS value",
        "o_custkey AS customer_code",
    )


def dated_transactions(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").selectExpr(
        "concat(substr(o_orderpriority, 3, 3), '-', o_orderkey) AS transaction_code",
        "CAST(o_orderdate AS DATE) AS transaction_date",
        "CAST(o_totalprice AS DECIMAL(18,2)) AS value",
    )


def account_transfers(spark: SparkSession, d: str) -> DataFrame:
    places = table(spark, d, "nation").join(table(spark, d, "region"), F.expr("n_regionkey = r_regionkey"))
    customers = table(spark, d, "customer").join(places, F.expr("c_nationkey = n_nationkey"))
    return (
        table(spark, d, "orders")
        .join(customers, F.expr("o_custkey = c_custkey"))
        .selectExpr(
            "o_orderkey AS transaction_id",
            "r_name AS bank",
            "concat_ws('-', substr(CAST(100000 + o_custkey % 900000 AS STRING), 1, 2),"
            " substr(CAST(100000 + o_custkey % 900000 AS STRING), 3, 2),"
            " substr(CAST(100000 + o_custkey % 900000 AS STRING), 5, 2)) AS sort_code",
            "CAST(10000000 + o_custkey AS STRING) AS account_number",
        )
    )


def swift_codes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "region").selectExpr(
        "r_name AS bank", "lpad(CAST(r_regionkey AS STRING), 2, '0') AS check_digits", "substr(r_name, 1, 4) AS swift_code"
    )


def quarterly_targets(spark: SparkSession) -> DataFrame:
    return inline_rows(spark, TARGETS, "online_or_inperson string, q1 long, q2 long, q3 long, q4 long")


def new_customer_sheets(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """A sheet of customers per month; every tenth customer is in two sheets.

    One sheet spells a column differently, so they only match by position.
    """
    sheets = "CASE WHEN c_custkey % 10 = 0 THEN array(c_custkey % 12, (c_custkey + 5) % 12) ELSE array(c_custkey % 12) END"
    people = table(spark, d, "customer")

    def sheet(number: int) -> DataFrame:
        return people.filter(F.array_contains(F.expr(sheets), F.lit(number).cast("bigint"))).selectExpr(
            "c_custkey AS id",
            "CAST(c_custkey % 28 + 1 AS INT) AS joining_day",
            f"c_mktsegment AS {'ethnicty' if number == 7 else 'ethnicity'}",
            "c_nationkey AS account_type",
            "CAST(date_add(DATE'1950-01-01', CAST(c_custkey % 18000 AS INT)) AS STRING) AS date_of_birth",
        )

    return {month: sheet(number) for number, month in enumerate(MONTHS)}


def new_customer_facts(spark: SparkSession, d: str) -> DataFrame:
    """All sheets on top of one another, then one join with the names, as three attribute rows per customer."""
    stacked = stack_tagged(new_customer_sheets(spark, d), "period")
    return stacked.join(table(spark, d, "nation"), F.expr("account_type = n_nationkey")).selectExpr(
        "id",
        "joining_day",
        "period",
        "explode(map('Ethnicity', ethnicity, 'Account Type', n_name, 'Date of Birth', date_of_birth)) AS (demographic, value)",
    )


def survey_ratings(spark: SparkSession, d: str) -> DataFrame:
    topics = ("ease_of_use", "ease_of_access", "navigation", "likelihood_to_recommend", "overall_rating")
    names = [f"{p}_{t}" for p in ("mobile_app", "online_interface") for t in topics]
    scores = [f"CAST((c_custkey * {k}) % 11 AS INT) AS {name}" for k, name in enumerate(names, 1)]
    return table(spark, d, "customer").selectExpr("c_custkey AS customer_id", *scores)


# --- accounts and payments ---------------------------------------------------

def account_information(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").selectExpr(
        "c_custkey AS account_number",
        "CASE WHEN c_mktsegment = 'BUILDING' THEN 'Platinum' ELSE c_mktsegment END AS account_type",
        "CASE WHEN c_custkey % 11 = 0 THEN NULL"
        " WHEN c_custkey % 3 = 0 THEN concat(c_custkey, ', ', c_custkey + 1)"
        " ELSE CAST(c_custkey AS STRING) END AS account_holder_id",
        "DATE'2023-12-31' AS balance_date",
        "CAST(c_acctbal AS DECIMAL(18,2)) AS balance",
    )


def account_holders(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").selectExpr(
        "c_custkey AS account_holder_id",
        "c_name AS name",
        "date_add(DATE'1950-01-01', CAST(c_custkey % 18000 AS INT)) AS dob",
        "7000000000 + c_custkey % 999999 AS contact_number",
        "concat(c_custkey % 200 + 1, ' ', c_mktsegment, ' Street') AS first_line_of_address",
    )


def payment_path(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").selectExpr(
        "event_id AS transaction_id", "user_id + 1 + event_id % 7 AS account_to", "user_id AS account_from"
    )


def payment_detail(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").selectExpr(
        "event_id AS transaction_id",
        "CAST(ts AS DATE) AS transaction_date",
        "CAST(value AS DECIMAL(18,2)) AS value",
        "CASE WHEN event_type = 'error' THEN 'Y' ELSE 'N' END AS cancelled",
    )


def share_purchases(spark: SparkSession, d: str) -> DataFrame:
    """The purchases of all months in one scan, each with the number of its monthly file."""
    cents = "(p_partkey * 7919) % 10000001"
    columns = [
        "CASE WHEN p_partkey % 10 = 9 THEN 'n/a'"
        " WHEN p_partkey % 4 = 0 THEN concat('$', p_partkey % 997 + 1, '.5B')"
        " WHEN p_partkey % 4 = 3 THEN concat('$', (p_partkey % 997 + 1) * 1000000)"
        " ELSE concat('$', p_partkey % 997 + 1, '.5M') END AS market_cap",
        f"concat('$', {cents} DIV 100, '.', lpad(CAST({cents} % 100 AS STRING), 2, '0')) AS purchase_price",
        "concat('T', p_partkey) AS ticker",
        "p_type AS sector",
        "p_brand AS market",
        "p_name AS stock_name",
        "CAST(p_partkey % 12 + 1 AS INT) AS file",
    ]
    return table(spark, d, "part").selectExpr(*columns)


# --- places and calendars ----------------------------------------------------

def customer_locations(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").selectExpr(
        "c_custkey AS customer",
        "CAST(-6 + (c_custkey * 7 % 800) / 100.0D AS DOUBLE) AS address_long",
        "CAST(50 + (c_custkey % 900) / 100.0D AS DOUBLE) AS address_lat",
    )


def branches(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "supplier").selectExpr(
        "s_suppkey AS branch",
        "CAST(50 + (s_suppkey * 37 % 900) / 100.0D AS DOUBLE) AS branch_lat",
        "CAST(-6 + (s_suppkey * 101 % 800) / 100.0D AS DOUBLE) AS branch_long",
    )


def holiday_lines(spark: SparkSession) -> DataFrame:
    """A printed holiday list: the year stands only on the first line of its block, blocks end with a blank line."""
    lines, number = [], 0
    for year in HOLIDAY_YEARS:
        for i, (day, name) in enumerate((*HOLIDAYS, ("", ""))):
            number += 1
            lines.append((number, str(year) if i == 0 else "", day, name))
    return inline_rows(spark, lines, "line_no int, year string, date string, bank_holiday string")


# Orders that the calendar abroad takes; the one at home takes all others. No Tuesdays after the 20th abroad.
_ABROAD = "coalesce(o_orderstatus = 'F' AND NOT (dayofweek(o_orderdate) = 3 AND day(o_orderdate) > 20), false)"


def home_new_customers(spark: SparkSession, d: str) -> DataFrame:
    return (
        table(spark, d, "orders")
        .filter(f"NOT {_ABROAD}")
        .groupBy(F.date_format(F.add_months("o_orderdate", _SHIFT_MONTHS), "M/d/yy").alias("date"))
        .agg(F.count("*").alias("new_customers"))
    )


def abroad_new_customers(spark: SparkSession, d: str) -> DataFrame:
    """Already reported by the other calendar, with its own month rule."""
    return (
        table(spark, d, "orders")
        .filter(_ABROAD)
        .groupBy(F.add_months("o_orderdate", _SHIFT_MONTHS).alias("day"))
        .agg(F.count("*").alias("new_customers"))
        .selectExpr(
            "date_format(date_add(day, 2), 'MMM-yy') AS reporting_month",
            "day(day) AS reporting_day",
            "new_customers",
            "date_format(day, 'M/d/yy') AS reporting_date",
        )
    )


# --- shop --------------------------------------------------------------------

def sales(spark: SparkSession, d: str) -> DataFrame:
    return (
        table(spark, d, "lineitem")
        .join(table(spark, d, "orders"), F.expr("l_orderkey = o_orderkey"))
        .selectExpr("o_custkey AS customer_id", "CAST(o_orderdate AS DATE) AS order_date", "l_partkey AS product_id")
    )


def menu(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").selectExpr(
        "p_partkey AS product_id", "p_type AS product_name", "CAST(p_retailprice AS DECIMAL(18,2)) AS price"
    )


def members(spark: SparkSession, d: str) -> DataFrame:
    return (
        table(spark, d, "customer")
        .filter("c_mktsegment <> 'FURNITURE'")
        .selectExpr("c_custkey AS customer_id", "date_add(DATE'1996-01-01', CAST(c_custkey % 1500 AS INT)) AS join_date")
    )


# --- delivery ----------------------------------------------------------------

_LINE_COLUMNS = {
    "order_id": "l_orderkey AS order_id",
    "pizza_id": "l_partkey AS pizza_id",
    "exclusions": (
        "CASE l_linenumber WHEN 1 THEN 'null' WHEN 2 THEN '' WHEN 3 THEN CAST(l_partkey % 25 AS STRING)"
        " WHEN 7 THEN concat((l_partkey + 5) % 25, ', ', l_suppkey % 25) END AS exclusions"
    ),
    "extras": (
        "CASE l_suppkey % 4 WHEN 1 THEN 'null' WHEN 2 THEN CAST(l_suppkey % 25 AS STRING)"
        " WHEN 3 THEN concat((l_partkey + 10) % 25, ',', (l_suppkey + 1) % 25) END AS extras"
    ),
    # Sorts the lines of an order; equal lines may swap places without effect.
    "line_slice": "l_partkey % 256 AS line_slice",
    "line_sort": "struct(l_partkey, l_suppkey, l_linenumber) AS line_sort",
}


def order_lines(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """One row per ordered pizza, with the asked columns."""
    return table(spark, d, "lineitem").selectExpr(*[_LINE_COLUMNS[c] for c in columns])


def order_headers(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").selectExpr(
        "o_orderkey AS order_id",
        "o_custkey AS customer_id",
        "o_orderdate + make_interval(0, 0, 0, 0, 0, CAST(o_orderkey % 1440 AS INT)) AS order_time",
    )


def runner_orders(spark: SparkSession, d: str) -> DataFrame:
    """Raw delivery log: numbers in three spellings, 'null' and '' for missing."""
    cancelled = "o_orderpriority = '5-LOW'"
    pickup = (
        "o_orderdate + make_interval(0, 0, 0, 0, 0, CAST(o_orderkey % 1440 + 5 + o_orderkey % 37 AS INT),"
        " CAST(o_orderkey % 60 AS INT))"
    )
    km = "concat(o_orderkey % 25 + 1, '.', o_orderkey % 10)"
    minutes = "CAST(10 + o_orderkey % 40 AS STRING)"
    return table(spark, d, "orders").selectExpr(
        "o_orderkey AS order_id",
        "CAST(o_orderkey % 10 + 1 AS INT) AS runner_id",
        f"CASE WHEN {cancelled} THEN 'null' ELSE date_format({pickup}, 'yyyy-MM-dd HH:mm:ss') END AS pickup_time",
        f"CASE WHEN {cancelled} THEN 'null' WHEN o_orderkey % 3 = 0 THEN concat({km}, 'km')"
        f" WHEN o_orderkey % 3 = 1 THEN concat({km}, ' km') ELSE {km} END AS distance",
        f"CASE WHEN {cancelled} THEN 'null' WHEN o_orderkey % 3 = 0 THEN concat({minutes}, ' minutes')"
        f" WHEN o_orderkey % 3 = 1 THEN concat({minutes}, 'mins') ELSE {minutes} END AS duration",
        f"CASE WHEN {cancelled} THEN 'Restaurant Cancellation' WHEN o_orderkey % 3 = 0 THEN 'null'"
        " WHEN o_orderkey % 3 = 1 THEN '' END AS cancellation",
    )


def runners(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "supplier").selectExpr(
        "s_suppkey + 1 AS runner_id", "date_add(DATE'2021-01-01', CAST(s_suppkey % 28 AS INT)) AS registration_date"
    )


def pizza_names(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").selectExpr(
        "p_partkey AS pizza_id", "CASE WHEN p_partkey % 2 = 0 THEN 'Meatlovers' ELSE 'Vegetarian' END AS pizza_name"
    )


def pizza_recipes(spark: SparkSession, d: str) -> DataFrame:
    """Topping ids as text, with and without a blank after the comma."""
    ids = ", ".join(f"(p_partkey + {step}) % 25" for step in (0, 5, 10, 17))
    return table(spark, d, "part").selectExpr(
        "p_partkey AS pizza_id",
        f"concat_ws(CASE WHEN p_partkey % 2 = 0 THEN ',' ELSE ', ' END, transform(array({ids}), t -> CAST(t AS STRING))) AS toppings",
    )


def pizza_toppings(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "nation").selectExpr("n_nationkey AS topping_id", "n_name AS topping_name")


def order_ratings(spark: SparkSession, d: str) -> DataFrame:
    return (
        table(spark, d, "orders")
        .filter("o_orderpriority <> '5-LOW'")
        .selectExpr("o_orderkey AS order_id", "CAST(o_orderkey % 5 + 1 AS INT) AS rating")
    )


# --- subscriptions -----------------------------------------------------------

def subscriptions(spark: SparkSession, d: str) -> DataFrame:
    """Plan changes; ``change_id`` orders the changes of one day."""
    return table(spark, d, "events").selectExpr(
        "user_id AS customer_id",
        "CASE event_type WHEN 'signup' THEN 0 WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'purchase' THEN 3 ELSE 4 END AS plan_id",
        "CAST(ts AS DATE) AS start_date",
        "event_id AS change_id",
    )


def plans(spark: SparkSession) -> DataFrame:
    return inline_rows(spark, PLANS, "plan_id int, plan_name string, price string").withColumn(
        "price", F.col("price").cast("decimal(18,2)")
    )


# --- accounts in regions -----------------------------------------------------

def customer_nodes(spark: SparkSession, d: str) -> DataFrame:
    """Stays at a node; 9999-12-31 marks one that has not ended."""
    return table(spark, d, "orders").selectExpr(
        "o_custkey AS customer_id",
        "CAST(o_custkey % 5 AS INT) AS region_id",
        "CAST(o_orderkey % 5 + 1 AS INT) AS node_id",
        "CAST(o_orderdate AS DATE) AS start_date",
        "CASE WHEN o_orderkey % 9 = 0 THEN DATE'9999-12-31'"
        " ELSE date_add(CAST(o_orderdate AS DATE), CAST(o_orderkey % 30 AS INT)) END AS end_date",
    )


def regions(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "region").selectExpr("r_regionkey AS region_id", "r_name AS region_name")


def customer_transactions(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").selectExpr(
        "o_custkey AS customer_id",
        "CAST(o_orderdate AS DATE) AS txn_date",
        "CASE o_orderstatus WHEN 'O' THEN 'deposit' WHEN 'F' THEN 'withdrawal' ELSE 'purchase' END AS txn_type",
        "CAST(o_totalprice AS DECIMAL(18,2)) AS txn_amount",
    )


# --- lookups -----------------------------------------------------------------

def incident_reports(spark: SparkSession, d: str) -> DataFrame:
    people = table(spark, d, "customer").join(table(spark, d, "nation"), F.expr("c_nationkey = n_nationkey"))
    return (
        table(spark, d, "events")
        .join(people, F.expr("user_id = c_custkey"))
        .selectExpr(
            "event_id AS report_id",
            "CAST(date_format(ts, 'yyyyMMdd') AS INT) AS date",
            "CAST(ts AS DATE) AS day",
            "event_type AS type",
            "props AS description",
            "n_name AS city",
        )
    )


def person(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").selectExpr(
        "c_custkey AS id",
        "c_name AS name",
        "c_custkey AS license_id",
        "CAST(c_custkey % 977 AS INT) AS address_number",
        "concat('Street ', c_nationkey) AS address_street_name",
        "100000000 + c_custkey AS ssn",
    )


def interviews(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "conversations").selectExpr("conv_id AS person_id", "turn", "text AS transcript")


def gym_members(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").selectExpr(
        "concat(c_custkey % 50, substr(c_mktsegment, 1, 1), c_custkey) AS id",
        "c_custkey AS person_id",
        "CASE c_nationkey % 3 WHEN 0 THEN 'gold' WHEN 1 THEN 'silver' ELSE 'regular' END AS membership_status",
    )


def drivers_license(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").selectExpr(
        "p_partkey AS id",
        "concat(substr(p_type, 1, 1), p_partkey % 50, 'W', p_size) AS plate_number",
        "CASE WHEN p_partkey % 3 = 0 THEN 'red' WHEN p_partkey % 3 = 1 THEN 'brown' ELSE 'black' END AS hair_color",
        "CASE WHEN p_partkey % 2 = 0 THEN 'female' ELSE 'male' END AS gender",
        "CAST(p_size + 30 AS INT) AS height",
        "CASE WHEN p_partkey % 4 < 3 THEN 'Alpha' ELSE 'Beta' END AS car_make",
        "CASE WHEN p_partkey % 4 < 3 THEN 'Model A' ELSE 'Model B' END AS car_model",
    )


def event_checkins(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").selectExpr(
        "user_id AS person_id", "event_type AS event_name", "CAST(ts AS DATE) AS day"
    )
