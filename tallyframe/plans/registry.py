"""Every query by name, wired to the test tables: ``name -> f(spark, folder)``."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.plans import accounts, customers, delivery, loyalty, lookup, reporting, statements, subscription, transactions
from tallyframe.sources import adapters as a
from tallyframe.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]


def amounts_as_double(df: DataFrame) -> DataFrame:
    """Sums are exact decimals inside; the delivered columns are doubles."""
    return df.select(
        *[F.col(f.name).cast("double") if isinstance(f.dataType, T.DecimalType) else F.col(f.name) for f in df.schema.fields]
    )


def _exact(query: Query) -> Query:
    return lambda s, d: amounts_as_double(query(s, d))


def _lines(*columns: str) -> Query:
    return lambda s, d: a.order_lines(s, d, *columns)


def _sales_menu(f: Callable) -> Query:
    return lambda s, d: f(a.sales(s, d), a.menu(s, d))


def _sales_menu_members(f: Callable) -> Query:
    return lambda s, d: f(a.sales(s, d), a.menu(s, d), a.members(s, d))


def _changes_plans(f: Callable, *args) -> Query:
    return lambda s, d: f(a.subscriptions(s, d), a.plans(s), *args)


TRANSACTIONS: dict[str, Query] = {
    "txn_value_by_code": lambda s, d: transactions.value_by(a.bank_transactions(s, d), "bank"),
    "txn_value_by_code_day_channel": lambda s, d: transactions.value_by(
        a.bank_transactions(s, d), "bank", "online_or_in_person", "weekday"
    ),
    "txn_value_by_code_customer": lambda s, d: transactions.value_by(a.bank_transactions(s, d), "bank", "customer_code"),
    "txn_value_grouping_sets": lambda s, d: transactions.value_grouping_sets(a.bank_transactions(s, d)),
    "identifier_concat": lambda s, d: transactions.account_identifiers(a.account_transfers(s, d), a.swift_codes(s, d)),
    "quarterly_target_variance": lambda s, d: transactions.quarterly_target_variance(
        a.bank_transactions(s, d), a.quarterly_targets(s), "URG"
    ),
    "period_stack_pivot_dedup": lambda s, d: transactions.earliest_customer_record(a.new_customer_facts(s, d), 2023),
    "monthly_rank_enrichment": lambda s, d: transactions.monthly_rank_enrichment(a.dated_transactions(s, d)),
}

CUSTOMERS: dict[str, Query] = {
    "rating_segments_pct": lambda s, d: customers.rating_segments(a.survey_ratings(s, d)),
    "split_holders_join": lambda s, d: customers.holder_payments(
        a.account_information(s, d), a.account_holders(s, d), a.payment_path(s, d), a.payment_detail(s, d), min_value=100
    ),
    "band_and_top5": lambda s, d: customers.banded_purchases(a.share_purchases(s, d), 2023),
    "nearest_site_priority": lambda s, d: customers.branch_priorities(a.customer_locations(s, d), a.branches(s, d)),
}

STATEMENTS: dict[str, Query] = {
    "ledger_statement": lambda s, d: statements.ledger_statement(
        a.payment_detail(s, d), a.payment_path(s, d), a.account_information(s, d)
    ),
    "daily_balance_scaffold": lambda s, d: statements.balance_on(
        a.payment_detail(s, d),
        a.payment_path(s, d),
        a.account_information(s, d),
        date(2023, 12, 31),
        date(2024, 1, 14),
        date(2024, 1, 12),
    ),
    "daily_balance_series": lambda s, d: statements.daily_balances(
        a.payment_detail(s, d), a.payment_path(s, d), a.account_information(s, d), date(2023, 12, 31), date(2024, 1, 14)
    ),
}

REPORTING: dict[str, Query] = {
    "reporting_calendar_alignment": lambda s, d: reporting.aligned_calendar(
        a.home_new_customers(s, d), a.abroad_new_customers(s, d), a.holiday_lines(s), leave_out_month="Aug-29"
    ),
    "next_reporting_day": lambda s, d: reporting.reporting_flags(a.home_new_customers(s, d), a.holiday_lines(s)),
    "anti_join_unmatched": lambda s, d: reporting.unmatched_days(
        a.abroad_new_customers(s, d), reporting.customers_per_reporting_day(a.home_new_customers(s, d), a.holiday_lines(s))
    ),
    "asof_next": lambda s, d: reporting.next_event(table(s, d, "events"), "signup", "purchase"),
    "asof_next_any": lambda s, d: reporting.next_event_of_anyone(table(s, d, "events"), "signup", "purchase"),
    "fill_down": lambda s, d: reporting.last_known_value(table(s, d, "events"), "signup"),
}

LOYALTY: dict[str, Query] = {
    "customer_spend": _sales_menu(loyalty.customer_spend),
    "customer_visit_days": lambda s, d: loyalty.visit_days(a.sales(s, d)),
    "first_item": lambda s, d: loyalty.first_item(a.sales(s, d)),
    "top_item": _sales_menu(loyalty.top_item),
    "favourite_item": _sales_menu(loyalty.favourite_item),
    "first_item_after_join": _sales_menu_members(loyalty.first_item_after_join),
    "last_item_before_join": _sales_menu_members(loyalty.last_item_before_join),
    "pre_join_totals": _sales_menu_members(loyalty.pre_join_totals),
    "points_multiplier": lambda s, d: loyalty.points(a.sales(s, d), a.menu(s, d), "PROMO"),
    "first_week_points": lambda s, d: loyalty.first_week_points(
        a.sales(s, d), a.menu(s, d), a.members(s, d), "PROMO", until=date(2000, 1, 31)
    ),
}

DELIVERY: dict[str, Query] = {
    "clean_sentinels": lambda s, d: delivery.clean_runner_orders(a.runner_orders(s, d)),
    "items_total": lambda s, d: delivery.items_total(_lines("order_id")(s, d)),
    "orders_distinct": lambda s, d: delivery.orders_distinct(_lines("order_id")(s, d)),
    "success_by_runner": lambda s, d: delivery.success_by_runner(a.runner_orders(s, d)),
    "delivered_by_type": lambda s, d: delivery.delivered_by_type(_lines("order_id", "pizza_id")(s, d), a.runner_orders(s, d)),
    "delivered_by_customer_type": lambda s, d: delivery.delivered_by_customer_type(
        _lines("order_id", "pizza_id")(s, d), a.order_headers(s, d), a.runner_orders(s, d), a.pizza_names(s, d)
    ),
    "largest_order": lambda s, d: delivery.largest_order(_lines("order_id")(s, d)),
    "changed_unchanged": lambda s, d: delivery.changed_unchanged(
        _lines("order_id", "exclusions", "extras")(s, d), a.order_headers(s, d), a.runner_orders(s, d)
    ),
    "both_changes": lambda s, d: delivery.both_changes(_lines("order_id", "exclusions", "extras")(s, d), a.runner_orders(s, d)),
    "volume_by_hour": lambda s, d: delivery.volume_by_hour(_lines("order_id")(s, d), a.order_headers(s, d)),
    "volume_by_weekday": lambda s, d: delivery.volume_by_weekday(_lines("order_id")(s, d), a.order_headers(s, d)),
    "signups_by_shifted_week": lambda s, d: delivery.signups_by_week(a.runners(s, d)),
    "avg_pickup_minutes": lambda s, d: delivery.avg_pickup_minutes(
        _lines("order_id")(s, d), a.order_headers(s, d), a.runner_orders(s, d)
    ),
    "prep_time_by_size": lambda s, d: delivery.prep_time_by_size(
        _lines("order_id")(s, d), a.order_headers(s, d), a.runner_orders(s, d)
    ),
    "avg_distance_by_customer": lambda s, d: delivery.avg_distance_by_customer(
        _lines("order_id")(s, d), a.order_headers(s, d), a.runner_orders(s, d)
    ),
    "duration_spread": lambda s, d: delivery.duration_spread(a.runner_orders(s, d)),
    "speed_per_delivery": lambda s, d: delivery.speed_per_delivery(a.runner_orders(s, d)),
    "success_pct": lambda s, d: delivery.success_percentage(a.runner_orders(s, d)),
    "standard_ingredients": lambda s, d: delivery.standard_ingredients(
        a.pizza_recipes(s, d), a.pizza_names(s, d), a.pizza_toppings(s, d)
    ),
    "top_extra": lambda s, d: delivery.top_extra(_lines("extras")(s, d), a.pizza_toppings(s, d)),
    "top_exclusion": lambda s, d: delivery.top_exclusion(_lines("exclusions")(s, d), a.pizza_toppings(s, d)),
    "order_item_label": lambda s, d: delivery.order_item_labels(
        _lines("order_id", "pizza_id", "exclusions", "extras")(s, d), a.order_headers(s, d), a.pizza_names(s, d), a.pizza_toppings(s, d)
    ),
    "ingredient_list": lambda s, d: delivery.ingredient_lists(
        _lines("order_id", "pizza_id", "exclusions", "extras", "line_slice", "line_sort")(s, d),
        a.order_headers(s, d),
        a.pizza_names(s, d),
        a.pizza_recipes(s, d),
        a.pizza_toppings(s, d),
    ),
    "ingredient_totals": lambda s, d: delivery.ingredient_totals(
        _lines("order_id", "pizza_id", "exclusions", "extras")(s, d), a.runner_orders(s, d), a.pizza_recipes(s, d), a.pizza_toppings(s, d)
    ),
    "revenue_fixed_price": lambda s, d: delivery.revenue_fixed_price(
        _lines("order_id", "pizza_id")(s, d), a.runner_orders(s, d), a.pizza_names(s, d)
    ),
    "revenue_with_extras": lambda s, d: delivery.revenue_with_extras(
        _lines("order_id", "pizza_id", "extras")(s, d), a.runner_orders(s, d), a.pizza_names(s, d), a.pizza_toppings(s, d)
    ),
    "delivery_summary": lambda s, d: delivery.delivery_summary(
        _lines("order_id")(s, d), a.order_headers(s, d), a.runner_orders(s, d), a.order_ratings(s, d)
    ),
    "profit_after_costs": lambda s, d: delivery.profit_after_costs(
        _lines("order_id", "pizza_id")(s, d), a.runner_orders(s, d), a.pizza_names(s, d)
    ),
}

SUBSCRIPTION: dict[str, Query] = {
    "customer_journey": _changes_plans(subscription.customer_journey),
    "customers_ever": lambda s, d: subscription.customers_ever(a.subscriptions(s, d)),
    "customers_paying": _changes_plans(subscription.customers_paying),
    "trials_by_month": _changes_plans(subscription.trials_by_month),
    "plan_events_after": _changes_plans(subscription.plan_events_after, 2023),
    "churn_rate": _changes_plans(subscription.churn_rate),
    "churn_after_trial": _changes_plans(subscription.churn_after_trial),
    "plan_after_trial": _changes_plans(subscription.plan_after_trial),
    "plan_on_date": _changes_plans(subscription.plan_on_date, date(2024, 1, 15)),
    "annual_starts": _changes_plans(subscription.annual_starts, 2024),
    "avg_days_to_annual": lambda s, d: subscription.avg_days_to_annual(a.subscriptions(s, d)),
    "days_to_annual_histogram": lambda s, d: subscription.days_to_annual_histogram(a.subscriptions(s, d)),
    "downgrades": _changes_plans(subscription.downgrades, 2024),
    "payment_schedule": _changes_plans(subscription.payment_schedule, 2024),
}

ACCOUNTS: dict[str, Query] = {
    "unique_nodes": lambda s, d: accounts.unique_nodes(a.customer_nodes(s, d)),
    "nodes_per_region": lambda s, d: accounts.nodes_per_region(a.customer_nodes(s, d)),
    "active_by_region": lambda s, d: accounts.active_by_region(a.customer_nodes(s, d), a.regions(s, d)),
    "allocation_days": lambda s, d: accounts.allocation_days(a.customer_nodes(s, d)),
    "avg_allocation_days": lambda s, d: accounts.avg_allocation_days(a.customer_nodes(s, d)),
    "allocation_percentiles": lambda s, d: accounts.allocation_percentiles(a.customer_nodes(s, d), a.regions(s, d)),
    "amount_percentiles": lambda s, d: accounts.amount_percentiles(a.customer_transactions(s, d)),
    "txn_type_totals": lambda s, d: accounts.type_totals(a.customer_transactions(s, d)),
    "avg_deposits": lambda s, d: accounts.avg_deposits(a.customer_transactions(s, d)),
    "monthly_active_customers": lambda s, d: accounts.monthly_active_customers(a.customer_transactions(s, d)),
    "month_end_balance": lambda s, d: accounts.month_end_balances(a.customer_transactions(s, d)),
    "monthly_balance_series": lambda s, d: accounts.monthly_balance_series(
        a.customer_transactions(s, d), date(1998, 1, 1), date(1998, 3, 1)
    ),
    "balance_growth_share": lambda s, d: accounts.balance_growth_share(
        a.customer_transactions(s, d), date(1998, 1, 1), date(1998, 12, 1)
    ),
}

LOOKUP: dict[str, Query] = {
    "report_lookup": lambda s, d: lookup.report_lookup(a.incident_reports(s, d), date(2024, 1, 15), "NATION_3", "error"),
    "last_house": lambda s, d: lookup.last_house(a.person(s, d), "Street 7"),
    "name_search": lambda s, d: lookup.name_search(a.person(s, d), "Street 7", "CUSTOMER#0000000"),
    "lookup_by_ids": lambda s, d: lookup.by_ids(a.interviews(s, d), [3, 14]),
    "member_plate_match": lambda s, d: lookup.member_plate_match(
        a.gym_members(s, d), a.person(s, d), a.drivers_license(s, d), "4", "gold", "1w"
    ),
    "lookup_by_string_id": lambda s, d: lookup.by_text_id(a.interviews(s, d), "7"),
    "attendance_profile": lambda s, d: lookup.attendance_profile(
        a.event_checkins(s, d),
        a.person(s, d),
        a.drivers_license(s, d),
        event="purchase",
        month=202401,
        times=13,
        make="Alpha",
        model="Model A",
        gender="female",
        hair="red",
        height=(31, 81),
    ),
}

FAMILIES = {
    "transactions": TRANSACTIONS,
    "customers": CUSTOMERS,
    "statements": STATEMENTS,
    "reporting": REPORTING,
    "loyalty": LOYALTY,
    "delivery": DELIVERY,
    "subscription": SUBSCRIPTION,
    "accounts": ACCOUNTS,
    "lookup": LOOKUP,
}

QUERIES: dict[str, Query] = {name: _exact(query) for family in FAMILIES.values() for name, query in family.items()}
