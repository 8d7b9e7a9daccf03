"""Rules of the queries on tiny tables: edge cases that the large tables may not contain."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from tallyframe.plans import accounts, customers, delivery, loyalty, lookup, reporting, statements, subscription, transactions


def make(spark, data, schema):
    """Whole numbers become decimals where the schema says so."""
    frame = spark.createDataFrame(data, schema.replace("decimal(18,2)", "int"))
    casts = {part.split()[0]: "decimal(18,2)" for part in schema.split(", ") if part.endswith("decimal(18,2)")}
    return frame.withColumns({name: frame[name].cast(kind) for name, kind in casts.items()})


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((v is not None, str(v)) for v in t))


# --- delivery ----------------------------------------------------------------

NAMES = [(1, "Meatlovers"), (2, "Vegetarian")]
RECIPES = [(1, "1, 2,3"), (2, "2, 4")]
TOPPINGS = [(1, "Bacon"), (2, "Cheese"), (3, "Beef"), (4, "Peppers"), (5, "Mushrooms")]
RUNS = [
    (1, 1, "2020-01-01 18:15:34", "20km", "32 minutes", ""),
    (2, 1, "2020-01-01 19:10:54", "13.4 km", "20 mins", "null"),
    (3, 2, "null", "null", "null", "Restaurant Cancellation"),
    (4, 2, "2020-01-04 13:53:03", "23.4", "40", None),
]
LINES = [
    (1, 101, 1, None, "", datetime(2020, 1, 1, 18, 5, 2)),
    (1, 101, 1, "2", "null", datetime(2020, 1, 1, 18, 5, 2)),
    (2, 101, 1, "null", "1", datetime(2020, 1, 1, 19, 0, 52)),
    (3, 102, 2, "4", "1", datetime(2020, 1, 2, 23, 51, 23)),
    (4, 103, 1, "2, 1", "5,4", datetime(2020, 1, 4, 13, 23, 46)),
    (4, 103, 2, "5", None, datetime(2020, 1, 4, 13, 23, 46)),
]


@pytest.fixture(scope="module")
def shop(spark):
    lines = [(*line, 0, i) for i, line in enumerate(LINES)]
    customer_orders = spark.createDataFrame(
        lines,
        "order_id int, customer_id int, pizza_id int, exclusions string, extras string, order_time timestamp_ntz, line_slice int, line_sort int",
    )
    return {
        "lines": customer_orders.drop("customer_id", "order_time"),
        "headers": delivery.order_headers(customer_orders),
        "runs": spark.createDataFrame(
            RUNS, "order_id int, runner_id int, pickup_time string, distance string, duration string, cancellation string"
        ),
        "names": spark.createDataFrame(NAMES, "pizza_id int, pizza_name string"),
        "recipes": spark.createDataFrame(RECIPES, "pizza_id int, toppings string"),
        "toppings": spark.createDataFrame(TOPPINGS, "topping_id int, topping_name string"),
    }


def test_cleaning_keeps_time_of_day(shop):
    out = {r.order_id: r for r in delivery.clean_runner_orders(shop["runs"]).collect()}
    assert out[1].pickup_time == datetime(2020, 1, 1, 18, 15, 34)
    assert out[3].pickup_time is None and out[3].distance is None
    assert [out[i].cancellation for i in (1, 2, 3, 4)] == [None, None, "Restaurant Cancellation", None]


def test_labels(shop):
    out = sorted(r.label for r in delivery.order_item_labels(shop["lines"], shop["headers"], shop["names"], shop["toppings"]).collect())
    assert out == [
        "Meatlovers",
        "Meatlovers - Exclude Bacon, Cheese - Extra Mushrooms, Peppers",
        "Meatlovers - Exclude Cheese",
        "Meatlovers - Extra Bacon",
        "Vegetarian - Exclude Mushrooms",
        "Vegetarian - Exclude Peppers - Extra Bacon",
    ]


def test_ingredient_lists(shop):
    out = delivery.ingredient_lists(shop["lines"], shop["headers"], shop["names"], shop["recipes"], shop["toppings"])
    assert [(r.order_id, r.pizza_number_within_order, r.ingredient_list) for r in out.orderBy("order_id", "pizza_number_within_order").collect()] == [
        (1, 1, "Meatlovers: Bacon, Beef, Cheese"),
        (1, 2, "Meatlovers: Bacon, Beef"),
        (2, 1, "Meatlovers: 2xBacon, Beef, Cheese"),
        (3, 1, "Vegetarian: Bacon, Cheese"),
        (4, 1, "Meatlovers: Beef, Mushrooms, Peppers"),
        # Leaving out what is not on the pizza changes nothing.
        (4, 2, "Vegetarian: Cheese, Peppers"),
    ]


def test_ingredient_totals_of_delivered(shop):
    out = delivery.ingredient_totals(shop["lines"], shop["runs"], shop["recipes"], shop["toppings"])
    assert [tuple(r) for r in out.collect()] == [("Bacon", 4), ("Beef", 4), ("Cheese", 3), ("Peppers", 2), ("Mushrooms", 1)]


def test_changes_count_exclusions_too(shop):
    assert rows(delivery.changed_unchanged(shop["lines"], shop["headers"], shop["runs"])) == [(101, 2, 1), (103, 2, 0)]
    assert rows(delivery.both_changes(shop["lines"], shop["runs"])) == [(1,)]


def test_times_are_per_order(shop):
    assert rows(delivery.avg_pickup_minutes(shop["lines"], shop["headers"], shop["runs"])) == [(1, 10.0), (2, 30.0)]
    assert rows(delivery.prep_time_by_size(shop["lines"], shop["headers"], shop["runs"])) == [(1, 10.0), (2, 20.0)]
    assert rows(delivery.duration_spread(shop["runs"])) == [(20.0, 40.0, 20.0)]


def test_success_share(shop):
    assert rows(delivery.success_percentage(shop["runs"])) == [(1, 2, 2, "100.00%"), (2, 2, 1, "50.00%")]


def test_money(shop, spark):
    assert rows(delivery.revenue_fixed_price(shop["lines"], shop["runs"], shop["names"])) == [(58,)]
    assert rows(delivery.revenue_with_extras(shop["lines"], shop["runs"], shop["names"], shop["toppings"])) == [(58, 3, 61)]
    revenue, costs, profit = rows(delivery.profit_after_costs(shop["lines"], shop["runs"], shop["names"]))[0]
    assert (revenue, costs, profit) == (58, Decimal("17.0400"), Decimal("40.9600"))
    other = spark.createDataFrame([(1, "Calzone"), (2, "Vegetarian")], "pizza_id int, pizza_name string")
    with pytest.raises(SparkRuntimeException, match="no price for Calzone"):
        delivery.revenue_fixed_price(shop["lines"], shop["runs"], other).collect()


def test_no_extras_is_zero(shop):
    lines = shop["lines"].filter("order_id = 1")
    assert rows(delivery.revenue_with_extras(lines, shop["runs"], shop["names"], shop["toppings"])) == [(24, 0, 24)]


def test_summary_joins_ratings_by_order(shop, spark):
    ratings = spark.createDataFrame([(1, 2), (2, 1), (4, 3)], "order_id int, rating int")
    out = {r.order_id: r for r in delivery.delivery_summary(shop["lines"], shop["headers"], shop["runs"], ratings).collect()}
    assert out[1].rating == 2 and out[1].order_time == "18:05:02" and out[1].total_number_of_pizzas == 2
    assert out[2].time_between_order_and_pickup == 10 and out[2].speed_in_kmh == 40.2


# --- subscriptions -----------------------------------------------------------

PLANS = [(0, "trial"), (1, "basic monthly"), (2, "pro monthly"), (3, "pro annual"), (4, "churn")]
# Journeys: trial then basic; trial then annual; trial then churn; trial, pro, basic; two changes on one day.
CHANGES = [
    (1, 0, date(2020, 8, 1)),
    (1, 1, date(2020, 8, 8)),
    (2, 0, date(2020, 9, 20)),
    (2, 3, date(2020, 9, 27)),
    (11, 0, date(2020, 11, 19)),
    (11, 4, date(2020, 11, 26)),
    (15, 0, date(2020, 3, 17)),
    (15, 2, date(2020, 3, 24)),
    (15, 1, date(2020, 4, 29)),
    (19, 0, date(2020, 12, 30)),
    (19, 2, date(2020, 12, 30)),
    (19, 1, date(2021, 1, 5)),
    (19, 3, date(2021, 12, 29)),
]


@pytest.fixture(scope="module")
def subs(spark):
    return spark.createDataFrame([(*c, i) for i, c in enumerate(CHANGES)], "customer_id int, plan_id int, start_date date, change_id int")


@pytest.fixture(scope="module")
def plans(spark):
    return spark.createDataFrame(PLANS, "plan_id int, plan_name string")


def test_journey_of_some_customers(subs, plans):
    assert rows(subscription.customer_journey(subs, plans, [1])) == [(1, date(2020, 8, 1), "trial"), (1, date(2020, 8, 8), "basic monthly")]


def test_after_trial(subs, plans):
    assert rows(subscription.churn_after_trial(subs, plans)) == [(5, 1, 20.0)]
    assert rows(subscription.plan_after_trial(subs, plans)) == [
        ("basic monthly", 1, 20.0),
        ("churn", 1, 20.0),
        ("pro annual", 1, 20.0),
        ("pro monthly", 2, 40.0),
    ]


def test_plan_on_date_takes_last_change_of_the_day(subs, plans):
    assert rows(subscription.plan_on_date(subs, plans, date(2020, 12, 31))) == [
        ("basic monthly", 2, 40.0),
        ("churn", 1, 20.0),
        ("pro annual", 1, 20.0),
        ("pro monthly", 1, 20.0),
    ]


def test_downgrade_needs_both_plans_in_the_year(subs, plans):
    assert rows(subscription.downgrades(subs, plans, 2020)) == [(15, "pro monthly", "basic monthly")]


def test_days_to_annual(subs):
    assert rows(subscription.avg_days_to_annual(subs)) == [(185.5,)]
    assert rows(subscription.days_to_annual_histogram(subs)) == [("1 - 30 days", 7.0, 1), ("over 360 days", 364.0, 1)]


def test_churn_rate(subs, plans):
    assert rows(subscription.churn_rate(subs, plans)) == [(5, 1, 20.0)]


def test_payment_schedule(spark):
    journeys = {
        1: [(0, "08-01"), (1, "08-08")],
        2: [(0, "09-20"), (3, "09-27")],
        13: [(0, "12-15"), (1, "12-22")],
        15: [(0, "03-17"), (2, "03-24"), (4, "04-29")],
        16: [(0, "05-31"), (1, "06-07"), (3, "10-21")],
        18: [(0, "07-06"), (2, "07-13")],
        19: [(0, "06-22"), (2, "06-29"), (3, "08-29")],
        # Month ends, an annual plan that starts at the end of the period, one that is replaced before.
        50: [(2, "01-31"), (3, "04-10")],
        51: [(2, "01-15"), (3, "01-20"), (4, "02-15")],
    }
    changes = [(c, p, date.fromisoformat(f"2020-{d}"), i) for c, steps in journeys.items() for i, (p, d) in enumerate(steps)]
    changes.append((13, 2, date(2021, 3, 29), 9))
    subs = spark.createDataFrame(changes, "customer_id int, plan_id int, start_date date, change_id int")
    prices = [(0, "trial", "0"), (1, "basic monthly", "9.90"), (2, "pro monthly", "19.90"), (3, "pro annual", "199.00"), (4, "churn", None)]
    plans = spark.createDataFrame(prices, "plan_id int, plan_name string, price string").selectExpr(
        "plan_id", "plan_name", "CAST(price AS DECIMAL(18,2)) AS price"
    )
    out = {}
    for r in subscription.payment_schedule(subs, plans, 2020).orderBy("customer_id", "payment_order").collect():
        out.setdefault(r.customer_id, []).append((r.payment_date.strftime("%m-%d"), float(r.amount)))
    monthly = lambda first, last, day, amount: [(f"{m:02d}-{day:02d}", amount) for m in range(first, last + 1)]
    assert out == {
        1: monthly(8, 12, 8, 9.9),
        2: [("09-27", 199.0)],
        13: [("12-22", 9.9)],
        15: monthly(3, 4, 24, 19.9),
        16: monthly(6, 10, 7, 9.9) + [("10-21", 189.1)],
        18: monthly(7, 12, 13, 19.9),
        19: monthly(6, 7, 29, 19.9) + [("08-29", 199.0)],
        50: [("01-31", 19.9), ("02-29", 19.9), ("03-31", 19.9), ("04-30", 199.0)],
        51: [("01-15", 19.9)],
    }


# --- statements --------------------------------------------------------------

@pytest.fixture(scope="module")
def bank(spark):
    detail = [(1, date(2023, 2, 1), 100, "N"), (2, date(2023, 2, 1), 50, "N"), (3, date(2023, 2, 3), 30, "N"), (4, date(2023, 2, 3), 9, "Y")]
    path = [(1, 11, 10), (2, 10, 11), (3, 12, 10), (4, 10, 12)]  # to, from
    accounts_ = [(10, date(2023, 1, 31), 1000), (11, date(2023, 1, 31), 0)]
    return (
        make(spark, detail, "transaction_id int, transaction_date date, value decimal(18,2), cancelled string"),
        spark.createDataFrame(path, "transaction_id int, account_to int, account_from int"),
        make(spark, accounts_, "account_number int, balance_date date, balance decimal(18,2)"),
    )




def test_statement(bank):
    out = [(r.account, r.transaction_date.day, r.transaction_value, r.balance) for r in statements.ledger_statement(*bank).collect()]
    assert sorted(out, key=str) == sorted(
        [
            (10, 31, None, 1000),
            (10, 1, 50, 1050),
            (10, 1, -100, 950),
            (10, 3, -30, 920),
            (11, 31, None, 0),
            (11, 1, 100, 100),
            (11, 1, -50, 50),
            (12, 3, 30, 30),
        ],
        key=str,
    )


def test_every_day_has_a_balance(bank):
    out = statements.daily_balances(*bank, date(2023, 1, 31), date(2023, 2, 4))
    got = {(r.account, r.date.day): (r.transaction_value, r.balance) for r in out.collect()}
    assert len(got) == 15
    assert got[10, 31] == (None, 1000) and got[10, 1] == (-50, 950) and got[10, 2] == (None, 950) and got[10, 4] == (None, 920)
    assert got[12, 2] == (None, 0) and got[12, 3] == (30, 30)
    one = statements.balance_on(*bank, date(2023, 1, 31), date(2023, 2, 4), date(2023, 2, 2))
    assert sorted((r.account, r.balance) for r in one.collect()) == [(10, 950), (11, 50), (12, 0)]


def test_one_day_equals_the_grid(bank):
    """A selected day has the rows of the grid on that day, before, on and after the movements, and none outside."""
    first, last = date(2023, 1, 31), date(2023, 2, 4)
    grid = [tuple(r) for r in statements.daily_balances(*bank, first, last).collect()]
    for day in (first, date(2023, 2, 1), date(2023, 2, 3), last, date(2023, 2, 5)):
        one = [tuple(r) for r in statements.balance_on(*bank, first, last, day).collect()]
        assert sorted(one, key=str) == sorted((r for r in grid if r[1] == day), key=str)


# --- accounts ----------------------------------------------------------------

@pytest.fixture(scope="module")
def moves(spark):
    data = [
        (1, date(2020, 1, 2), "deposit", 100),
        (1, date(2020, 1, 2), "purchase", 40),
        (1, date(2020, 3, 9), "deposit", 5),
        (2, date(2020, 2, 1), "deposit", 70),
        (3, date(2020, 1, 5), "deposit", 10),
        (3, date(2020, 1, 6), "withdrawal", 10),
        (3, date(2020, 3, 6), "deposit", 10),
    ]
    return make(spark, data, "customer_id int, txn_date date, txn_type string, txn_amount decimal(18,2)")


def test_month_end_with_two_moves_on_the_last_day(moves):
    out = {(r.customer_id, r.yearmonth): (r.txn_date, r.balance) for r in accounts.month_end_balances(moves).collect()}
    assert out[1, "202001"] == (date(2020, 1, 2), 60) and out[1, "202003"] == (date(2020, 3, 9), 65)


def test_series_carries_over_several_months_and_from_before(moves):
    out = {(r.customer_id, r.yearmonth): r.balance for r in accounts.monthly_balance_series(moves, date(2020, 2, 1), date(2020, 4, 1)).collect()}
    assert out[1, "202002"] == 60 and out[1, "202004"] == 65 and out[2, "202002"] == 70 and len(out) == 9
    first = {(r.customer_id, r.yearmonth): r.balance for r in accounts.monthly_balance_series(moves, date(2020, 1, 1), date(2020, 2, 1)).collect()}
    assert first[2, "202001"] is None


def test_growth_share_without_base_is_no_growth(moves):
    # Customer 1 grows by 8.33 %, 2 has no balance in January, 3 starts at zero.
    assert rows(accounts.balance_growth_share(moves, date(2020, 1, 1), date(2020, 3, 1))) == [("33.33%",)]


def test_active_needs_two_deposits_and_something_out(moves, spark):
    more = spark.createDataFrame([(3, date(2020, 1, 7), "deposit", 1)], "customer_id int, txn_date date, txn_type string, txn_amount int")
    assert rows(accounts.monthly_active_customers(moves.unionByName(more))) == [("202001", 1)]


def test_open_stays(spark):
    stays = [(1, 1, 4, date(2020, 1, 1), date(2020, 1, 10)), (1, 1, 5, date(2020, 1, 11), date(9999, 12, 31)), (2, None, 5, date(2020, 1, 1), date(2020, 1, 2))]
    nodes = spark.createDataFrame(stays, "customer_id int, region_id int, node_id int, start_date date, end_date date")
    regions = spark.createDataFrame([(1, "North")], "region_id int, region_name string")
    assert rows(accounts.unique_nodes(nodes)) == [(2,)]
    assert rows(accounts.active_by_region(nodes, regions)) == [("North", 1)]
    assert rows(accounts.avg_allocation_days(nodes)) == [(6.0,)]
    assert rows(accounts.allocation_percentiles(nodes, regions)) == [("North", 10.0, 10.0, 10.0)]


def test_percentiles_interpolate(spark):
    stays = [(1, 1, 1, date(2020, 1, 1), date(2020, 1, d)) for d in (1, 2, 3, 4, 4)]
    nodes = spark.createDataFrame(stays, "customer_id int, region_id int, node_id int, start_date date, end_date date")
    regions = spark.createDataFrame([(1, "North")], "region_id int, region_name string")
    name, median, p80, p95 = rows(accounts.allocation_percentiles(nodes, regions))[0]
    assert (median, p80, p95) == (3.0, 4.0, 4.0)


# --- reporting ---------------------------------------------------------------

@pytest.fixture(scope="module")
def holidays(spark):
    lines = [(1, "2021", "27-Dec", "Christmas"), (2, "", "28-Dec", "Boxing Day"), (3, "", "", ""), (4, "2022", "03-Jan", "New Year")]
    return spark.createDataFrame(lines, "line_no int, year string, date string, bank_holiday string")


def test_years_are_filled_down(holidays):
    assert [r.holiday for r in reporting.bank_holidays(holidays).orderBy("holiday").collect()] == [
        date(2021, 12, 27),
        date(2021, 12, 28),
        date(2022, 1, 3),
    ]


def test_last_working_day_counts_for_the_next_month(spark, holidays):
    days = [f"12/{d}/21" for d in range(24, 32)] + [f"1/{d}/22" for d in range(1, 6)]
    home = spark.createDataFrame([(d, 1) for d in days], "date string, new_customers long")
    away = spark.createDataFrame(
        [("Dec-21", 1, 5, "12/28/21"), ("Jan-22", 2, 7, "1/3/22"), ("Jan-22", 3, 2, "1/4/22"), ("Jan-22", 4, 9, "1/6/22")],
        "reporting_month string, reporting_day int, new_customers long, reporting_date string",
    )
    out = {r.dates: r for r in reporting.aligned_calendar(home, away, holidays).collect()}
    assert sorted(out) == [date(2021, 12, d) for d in (24, 29, 30, 31)] + [date(2022, 1, 4), date(2022, 1, 5)]
    # 25 to 28 December go to the 29th; Friday the 31st already is January; so is 5 January February (last day known).
    assert out[date(2021, 12, 29)].uk_new_customers == 5
    assert out[date(2021, 12, 31)].reporting_month == "Jan-22" and out[date(2021, 12, 31)].reporting_day == 1
    assert out[date(2021, 12, 30)].reporting_month == "Dec-21" and out[date(2021, 12, 30)].reporting_day == 3
    # The abroad counts of a closed day move to the next open one; 6 January has none.
    assert out[date(2021, 12, 29)].roi_new_customers == 5 and out[date(2021, 12, 29)].misalignment_flag is None
    assert out[date(2022, 1, 4)].roi_new_customers == 9
    assert out[date(2021, 12, 24)].roi_new_customers == 0 and out[date(2021, 12, 24)].misalignment_flag == "x"
    home_days = reporting.customers_per_reporting_day(home, holidays)
    assert sorted(r.reporting_date for r in reporting.unmatched_days(away, home_days).collect()) == [date(2021, 12, 28), date(2022, 1, 3), date(2022, 1, 6)]


# --- shop, surveys, transactions, lookups --------------------------------------

def test_joining_day_and_ties(spark):
    sales = spark.createDataFrame(
        [("A", date(2021, 1, 1), 1), ("A", date(2021, 1, 7), 2), ("A", date(2021, 1, 7), 2), ("A", date(2021, 1, 6), 3), ("A", date(2021, 1, 6), 1), ("B", date(2021, 1, 2), 1)],
        "customer_id string, order_date date, product_id int",
    )
    menu = make(spark, [(1, "sushi", 10), (2, "curry", 15), (3, "ramen", 12)], "product_id int, product_name string, price decimal(18,2)")
    members = spark.createDataFrame([("A", date(2021, 1, 7))], "customer_id string, join_date date")
    assert rows(loyalty.first_item_after_join(sales, menu, members)) == [("A", "curry"), ("A", "curry")]
    assert rows(loyalty.last_item_before_join(sales, menu, members)) == [("A", "ramen"), ("A", "sushi")]
    assert rows(loyalty.pre_join_totals(sales, menu, members)) == [("A", 3, 32), ("B", 1, 10)]
    assert rows(loyalty.favourite_item(sales, menu)) == [("A", "curry", 2), ("A", "sushi", 2), ("B", "sushi", 1)]
    assert rows(loyalty.points(sales, menu, "sushi")) == [("A", 820), ("B", 200)]
    # First week: both curries double; before joining only sushi.
    assert rows(loyalty.first_week_points(sales, menu, members, "sushi")) == [("A", 1120), ("B", 200)]
    assert rows(loyalty.first_week_points(sales, menu, members, "sushi", until=date(2021, 1, 1))) == [("A", 200)]


def test_missing_target_gives_no_row(spark):
    txns = make(
        spark,
        [("ABC-1", 1, "20/03/2023 00:00:00", 5, 1), ("ABC-2", 2, "20/03/2023 00:00:00", 7, 1), ("XXX-3", 1, "20/03/2023 00:00:00", 9, 1)],
        "transaction_code string, online_or_in_person int, transaction_date string, value decimal(18,2), customer_code int",
    )
    targets = spark.createDataFrame([("Online", 10, None, None, None), ("In-Person", None, 1, 1, 1)], "online_or_inperson string, q1 int, q2 int, q3 int, q4 int")
    assert rows(transactions.quarterly_target_variance(txns, targets, "ABC")) == [("Online", 1, 5, 10, -5)]


def test_earliest_record_wins(spark):
    data = [
        (i, d, k, v, p)
        for i, d, p in ((1, 5, "Mar"), (1, 9, "Feb"), (2, 1, "Dec"))
        for k, v in (("Ethnicity", "e"), ("Account Type", f"type {p}"), ("Date of Birth", "1980-02-03"))
    ]
    facts = spark.createDataFrame(data, "id int, joining_day int, demographic string, value string, period string")
    assert rows(transactions.earliest_customer_record(facts, 2023)) == [
        (1, date(2023, 2, 9), "e", "type Feb", date(1980, 2, 3)),
        (2, date(2023, 12, 1), "e", "type Dec", date(1980, 2, 3)),
    ]


def test_segment_edges(spark):
    topics = ("ease_of_use", "ease_of_access", "navigation", "likelihood_to_recommend", "overall_rating")
    names = [f"{p}_{t}" for p in ("mobile_app", "online_interface") for t in topics]
    # Averages differ by 2, 1, 0.75 and -2; the overall rating must not count.
    data = [(1, *[4] * 4, 0, *[2] * 4, 9), (2, *[4] * 4, 0, *[3] * 4, 9), (3, 4, 4, 4, 3, 0, *[3] * 4, 9), (4, *[2] * 4, 9, *[4] * 4, 0)]
    survey = spark.createDataFrame(data, "customer_id int, " + ", ".join(f"{n} int" for n in names))
    assert rows(customers.rating_segments(survey)) == [
        ("Mobile App Fan", 25.0),
        ("Mobile App Superfan", 25.0),
        ("Neutral", 25.0),
        ("Online Interface Superfan", 25.0),
    ]


def test_lookups(spark):
    people = spark.createDataFrame(
        [(1, "Ann P", 10, 5, "Main"), (2, "BERTA M", 11, 5, "Main"), (3, "Bob", 12, 1, "Main")],
        "id int, name string, license_id int, address_number int, address_street_name string",
    )
    assert [r.id for r in lookup.last_house(people, "Main").collect()] == [1]
    assert [r.id for r in lookup.name_search(people, "Main", "berta").collect()] == [2]
    members = spark.createDataFrame([("12q1", 1, "gold"), ("12Q2", 2, "silver"), ("49Z3", 3, "gold")], "id string, person_id int, membership_status string")
    cars = spark.createDataFrame([(10, "0k77X0"), (11, "K77X"), (12, "K77X")], "id int, plate_number string")
    assert rows(lookup.member_plate_match(members, people, cars, "12Q", "gold", "K77X")) == [("Ann P", 1)]


# --- rules that hold on every size --------------------------------------------


def test_unknown_and_doubled_toppings(shop, spark):
    lines = spark.createDataFrame(
        [(1, 1, "98", "1, 99", 0, 0), (2, 1, "2", "98,99", 0, 0)],
        "order_id int, pizza_id int, exclusions string, extras string, line_slice int, line_sort int",
    )
    doubled = shop["toppings"].union(spark.createDataFrame([(1, "Ham")], "topping_id int, topping_name string"))
    label = lambda toppings: sorted(r.label for r in delivery.order_item_labels(lines, shop["headers"], shop["names"], toppings).collect())
    assert label(shop["toppings"]) == ["Meatlovers - Exclude Cheese", "Meatlovers - Extra Bacon"]
    assert label(doubled) == ["Meatlovers - Exclude Cheese", "Meatlovers - Extra Bacon, Ham"]
    many = shop["toppings"].union(spark.range(1000, 2500).selectExpr("CAST(id AS INT) AS topping_id", "concat('T', id) AS topping_name"))
    assert label(many) == label(shop["toppings"])
    bare = spark.createDataFrame([(1, "97")], "pizza_id int, toppings string")
    out = delivery.ingredient_lists(lines.filter("order_id = 2"), shop["headers"], shop["names"], bare, shop["toppings"])
    assert [r.ingredient_list for r in out.collect()] == ["Meatlovers: "]


def test_rows_without_lists_are_dealt_evenly(spark, shop):
    """Most rows have no list; they must not meet in the task of NULL."""
    rows = spark.range(4_000).selectExpr("id", "CASE WHEN id % 10 = 0 THEN CAST(id % 5 AS STRING) END AS extras")
    plain = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in plain}
    for k, v in plain.items():
        spark.conf.set(k, v)
    try:
        named = delivery._names_of(rows, "extras", shop["toppings"], "names")
        # The names are counted too, or Spark would leave out the join.
        parts = named.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.count("names").alias("named"))
        sizes = [r.n for r in parts.collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(sizes) == 4_000 and max(sizes) < 2_000
    known = {str(r.topping_id): [r.topping_name] for r in shop["toppings"].collect()}
    assert all(r.names == (known.get(r.extras) if r.extras else None) for r in named.collect())


def test_undated_movement_comes_first(spark):
    from tallyframe.operators.ledger import statement

    legs = make(spark, [(1, date(2024, 1, 2), 10), (1, None, 7)], "account int, transaction_date date, value decimal(18,2)")
    openings = make(spark, [(1, date(2024, 1, 1), 100)], "account int, transaction_date date, balance decimal(18,2)")
    assert sorted(r.balance for r in statement(legs, openings).collect()) == [7, 107, 117]


def test_units_in_any_case(spark):
    trips = spark.createDataFrame(
        [(1, 1, "2020-01-01 18:15:34", "10KM", "20 Minutes", None), (2, 1, "2020-01-01 18:15:34", "10 km", "20", None)],
        "order_id int, runner_id int, pickup_time string, distance string, duration string, cancellation string",
    )
    assert rows(delivery.duration_spread(trips)) == [(20.0, 20.0, 0.0)]
    odd = trips.selectExpr("order_id", "runner_id", "pickup_time", "'1.2.3' AS distance", "duration", "cancellation")
    with pytest.raises(SparkRuntimeException, match="not a number"):
        odd.select(delivery.leading_number(odd["distance"])).collect()


def test_rewritten_table_shows_its_new_columns(spark, tmp_path):
    from tallyframe.sources.tables import table

    spark.range(2).write.parquet(f"{tmp_path}/t.parquet")
    assert table(spark, str(tmp_path), "t").columns == ["id"]
    spark.range(2).selectExpr("id", "id AS b").write.mode("overwrite").parquet(f"{tmp_path}/t.parquet")
    assert table(spark, str(tmp_path), "t").columns == ["id", "b"]


@pytest.mark.parametrize(
    "name, bound",
    [
        ("annual_starts", "LessThan(ts"),
        ("plan_events_after", "GreaterThanOrEqual(ts"),
        ("downgrades", "LessThan(ts"),
        ("report_lookup", "LessThan(ts"),
        ("attendance_profile", "LessThan(ts"),
        ("daily_balance_scaffold", "LessThan(ts"),
        ("daily_balance_series", "LessThan(ts"),
    ],
)
def test_dates_reach_the_scan(spark, name, bound):
    from tallyframe.plans.registry import QUERIES

    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert bound in plan[plan.index("PushedFilters") :], plan


def test_a_large_key_among_small_ones(spark):
    """A third of the rows in one key, NULLs in every nullable column: against DuckDB."""
    import duckdb

    from tallyframe.operators.running import fill_down, running_sum

    data = spark.range(6000).selectExpr(
        "id",
        "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 50 = 1 THEN NULL ELSE concat('k', id % 40) END AS k",
        "CASE WHEN id % 17 = 0 THEN NULL ELSE CAST(id * 7919 % 30 AS INT) END AS day",
        "CASE WHEN id % 5 = 0 THEN NULL ELSE CAST(id % 11 AS INT) END AS v",
    )
    con = duckdb.connect()
    con.register("t", data.toPandas().astype({"day": "Int64", "v": "Int64"}))
    over = "OVER (PARTITION BY k ORDER BY day NULLS FIRST, id ROWS UNBOUNDED PRECEDING)"
    want = con.sql(f"SELECT id, CAST(coalesce(sum(v) {over}, 0) AS BIGINT), CAST(last_value(v IGNORE NULLS) {over} AS BIGINT) FROM t").fetchall()
    out = running_sum(data, ["k"], ["day", "id"], "v", "s", ranges=9)
    out = fill_down(out, ["k"], ["day", "id"], "v", "f", ranges=9)
    assert sorted((r.id, r.s, r.f) for r in out.collect()) == sorted(want)
