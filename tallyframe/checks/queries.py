"""For each query of the registry the same question in SQL."""

from __future__ import annotations

from tallyframe.checks.shapes import over, rounded

_ALL = {}

_ALL |= {
    "txn_value_by_code": over("txns named_txns", "SELECT bank, sum(value)::DOUBLE AS value FROM named_txns GROUP BY bank"),
    "txn_value_by_code_day_channel": over(
        "txns named_txns",
        "SELECT bank, online_or_in_person, weekday, sum(value)::DOUBLE AS value FROM named_txns GROUP BY ALL",
    ),
    "txn_value_by_code_customer": over(
        "txns named_txns", "SELECT bank, customer_code, sum(value)::DOUBLE AS value FROM named_txns GROUP BY ALL"
    ),
    "txn_value_grouping_sets": over(
        "txns named_txns",
        """SELECT bank, NULL::VARCHAR AS weekday, NULL::VARCHAR AS online_or_in_person, NULL::BIGINT AS customer_code, sum(value)::DOUBLE AS value,
        'bank' AS level FROM named_txns GROUP BY bank
        UNION ALL SELECT bank, weekday, online_or_in_person, NULL, sum(value)::DOUBLE, 'bank_day_channel' FROM named_txns GROUP BY 1, 2, 3
        UNION ALL SELECT bank, NULL, NULL, customer_code, sum(value)::DOUBLE, 'bank_customer' FROM named_txns GROUP BY bank, customer_code""",
    ),
    "identifier_concat": over(
        "transfers swift",
        "SELECT transaction_id, 'GB' || check_digits || swift_code || digits || account_number AS iban FROM transfers JOIN swift USING (bank)",
    ),
    "quarterly_target_variance": over(
        "txns goals",
        """SELECT g.online_or_inperson, g.quarter, sum(value)::DOUBLE AS value, g.target, (sum(value) - g.target)::DOUBLE AS variance
        FROM txns t JOIN goals g ON g.quarter = quarter(strptime(t.transaction_date, '%d/%m/%Y %H:%M:%S'))
          AND g.online_or_inperson = CASE t.online_or_in_person WHEN 1 THEN 'Online' ELSE 'In-Person' END
        WHERE contains(transaction_code, 'URG') GROUP BY g.online_or_inperson, g.quarter, g.target""",
    ),
    "period_stack_pivot_dedup": over(
        "facts",
        """SELECT id, min(joined_date) AS joined_date, any_value(ethnicity) AS ethnicity, any_value(account_type) AS account_type,
        any_value(date_of_birth) AS date_of_birth FROM facts GROUP BY id""",
    ),
    "monthly_rank_enrichment": over(
        "txns",
        f"""SELECT transaction_month, bank, transaction_rank, v::DOUBLE AS value,
        {rounded('sum(v) OVER (PARTITION BY transaction_rank)::DOUBLE / count(*) OVER (PARTITION BY transaction_rank)', 2)} AS transaction_rank_avg,
        {rounded('sum(transaction_rank) OVER (PARTITION BY bank)::DOUBLE / count(*) OVER (PARTITION BY bank)', 2)} AS bank_rank_avg
        FROM (SELECT *, rank() OVER (PARTITION BY transaction_month ORDER BY v DESC)::INT AS transaction_rank FROM (
          SELECT monthname(strptime(transaction_date, '%d/%m/%Y %H:%M:%S')) AS transaction_month, split_part(transaction_code, '-', 1) AS bank, sum(value) AS v
          FROM txns GROUP BY 1, 2))""",
    ),
}

_ALL |= {
    "rating_segments_pct": over(
        "survey",
        f"""SELECT customer_category, {rounded('count(*) * 100.0 / sum(count(*)) OVER ()', 1)} AS percentage FROM (
        SELECT CASE WHEN d <= -8 THEN 'Online Interface Superfan' WHEN d >= 8 THEN 'Mobile App Superfan'
          WHEN d <= -4 THEN 'Online Interface Fan' WHEN d >= 4 THEN 'Mobile App Fan' ELSE 'Neutral' END AS customer_category
        FROM (SELECT (mobile_app_ease_of_use + mobile_app_ease_of_access + mobile_app_navigation + mobile_app_likelihood_to_recommend)
          - (online_interface_ease_of_use + online_interface_ease_of_access + online_interface_navigation + online_interface_likelihood_to_recommend) AS d
          FROM survey)) GROUP BY customer_category""",
    ),
    "split_holders_join": over(
        "accounts holders payments",
        """SELECT transaction_id, account_to, transaction_date, value::DOUBLE AS value, account_number, account_type, balance_date,
        balance::DOUBLE AS balance, name, dob AS day_of_birth, '0' || contact_number AS contact_number, first_line_of_address
        FROM (SELECT *, unnest(string_split(holders, ', '))::BIGINT AS holder FROM accounts WHERE account_type <> 'Platinum') a
        JOIN holders h ON a.holder = h.account_holder_id JOIN payments p ON p.account_from = a.account_number
        WHERE p.value > 100 AND p.cancelled = 'N'""",
    ),
    "band_and_top5": over(
        "purchases",
        """SELECT * FROM (SELECT make_date(2023, file, 1) AS file_date, market_cap, purchase_price, ticker, sector, market, stock_name,
          m AS market_cap_categorization, p AS purchase_price_categorization,
          rank() OVER (PARTITION BY file, m, p ORDER BY purchase_price DESC)::INT AS rank FROM (
          SELECT *, CASE WHEN market_cap < 1e8 THEN 'Small' WHEN market_cap < 1e9 THEN 'Medium' WHEN market_cap < 1e11 THEN 'Large' ELSE 'Huge' END AS m,
            CASE WHEN purchase_price < 25000 THEN 'Low' WHEN purchase_price < 50000 THEN 'Medium' WHEN purchase_price < 75000 THEN 'High'
              WHEN purchase_price <= 100000 THEN 'Very High' END AS p
          FROM purchases WHERE market_cap IS NOT NULL)) WHERE rank <= 5""",
    ),
    "nearest_site_priority": over(
        "places branches",
        f"""SELECT branch, customer, {rounded('distance', 2)} AS distance,
          row_number() OVER (PARTITION BY branch ORDER BY distance, customer) AS customer_priority
        FROM (SELECT customer, d.distance, branch, row_number() OVER (PARTITION BY customer ORDER BY d.distance, branch) AS rn
          FROM (SELECT customer, branch, round(3963 * acos(greatest(-1.0, least(1.0, sin(radians(p.lat)) * sin(radians(b.lat))
             + cos(radians(p.lat)) * cos(radians(b.lat)) * cos(radians(b.lon) - radians(p.lon))))), 3) AS distance
             FROM places p CROSS JOIN branches b) d) WHERE rn = 1""",
    ),
}

_DAILY = """SELECT a.account_number AS account, g.day::DATE AS date,
    (SELECT sum(l.value) FROM per_day l WHERE l.account = a.account_number AND l.transaction_date = g.day)::DOUBLE AS transaction_value,
    (coalesce(CASE WHEN a.balance_date BETWEEN DATE '2023-12-31' AND g.day THEN a.balance END, 0)
     + coalesce((SELECT sum(l.value) FROM per_day l WHERE l.account = a.account_number AND l.transaction_date BETWEEN DATE '2023-12-31' AND g.day), 0))::DOUBLE AS balance
    FROM (SELECT account AS account_number, any_value(balance_date) AS balance_date, any_value(balance) AS balance FROM (
        SELECT account_number AS account, balance_date, balance FROM accounts UNION ALL SELECT DISTINCT account, NULL, NULL FROM legs) GROUP BY account) a
    CROSS JOIN (SELECT unnest(generate_series(DATE '2023-12-31', DATE '2024-01-14', INTERVAL 1 DAY))::DATE AS day) g"""
_PER_DAY = "accounts payments legs"


def _daily(where: str) -> str:
    head = over(_PER_DAY, "")
    per_day = ", per_day AS (SELECT account, transaction_date, sum(value) AS value FROM legs GROUP BY 1, 2)\n"
    return head.rstrip() + per_day + f"SELECT * FROM ({_DAILY}) {where}"


_ALL |= {
    "ledger_statement": over(
        "accounts payments legs",
        """SELECT account, transaction_date, value::DOUBLE AS transaction_value,
        (sum(change) OVER (PARTITION BY account ORDER BY transaction_date, turn, value DESC))::DOUBLE AS balance FROM (
        SELECT account, transaction_date, value, value AS change, 1 AS turn FROM legs
        UNION ALL SELECT account_number, balance_date, NULL, balance, 0 FROM accounts)""",
    ),
    "daily_balance_scaffold": _daily("WHERE date = DATE '2024-01-12'"),
    "daily_balance_series": _daily(""),
}

_CALENDAR = "home_days holidays flags open_days uk"
_ALL |= {
    "next_reporting_day": over(
        _CALENDAR,
        """SELECT f.day AS join_date, left(dayname(f.day), 3) AS day_name, f.name AS bank_holiday,
        CASE WHEN closed THEN 'non-reporting day' ELSE 'reporting day' END AS reporting_flag,
        (SELECT min(o.day) FROM open_days o WHERE o.day >= f.day) AS next_reporting_date, f.n AS new_customers FROM flags f""",
    ),
    "anti_join_unmatched": over(
        _CALENDAR + " away_days",
        "SELECT reporting_month, new_customers, day AS reporting_date FROM away_days WHERE day NOT IN (SELECT day FROM uk)",
    ),
    "reporting_calendar_alignment": over(
        _CALENDAR + " away_days",
        """SELECT reporting_month, row_number() OVER (PARTITION BY reporting_month ORDER BY dates, roi_reporting_month NULLS LAST)::INT AS reporting_day,
        dates, uk_new_customers, roi_new_customers, roi_reporting_month,
        CASE WHEN roi_reporting_month IS DISTINCT FROM reporting_month THEN 'x' END AS misalignment_flag
        FROM (SELECT u.day AS dates, u.n AS uk_new_customers, coalesce(r.n, 0) AS roi_new_customers, r.reporting_month AS roi_reporting_month,
            strftime(CASE WHEN u.day = max(u.day) OVER (PARTITION BY date_trunc('month', u.day)) THEN u.day + INTERVAL 1 MONTH ELSE u.day END, '%b-%y') AS reporting_month
          FROM uk u LEFT JOIN (SELECT target, reporting_month, sum(new_customers)::BIGINT AS n FROM (
              SELECT *, (SELECT min(u.day) FROM uk u WHERE u.day >= a.day) AS target FROM away_days a) GROUP BY 1, 2) r ON u.day = r.target)
        WHERE reporting_month <> 'Aug-29'""",
    ),
    "asof_next": """SELECT a.event_id, a.user_id, b.event_id AS next_event_id
        FROM (SELECT * FROM events WHERE event_type = 'signup') a
        ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') b ON a.user_id = b.user_id AND a.ts < b.ts""",
    "asof_next_any": """SELECT a.event_id, b.event_id AS next_event_id
        FROM (SELECT * FROM events WHERE event_type = 'signup') a
        ASOF LEFT JOIN (SELECT ts, min(event_id) AS event_id FROM events WHERE event_type = 'purchase' GROUP BY ts) b ON a.ts < b.ts""",
    "fill_down": """SELECT event_id, user_id, last_value(CASE WHEN event_type = 'signup' THEN value END IGNORE NULLS) OVER (
        PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS filled FROM events""",
}

_SHOP = "sales menu members"
_AROUND = """SELECT customer_id, product_name FROM (
    SELECT s.customer_id, product_name, dense_rank() OVER (PARTITION BY s.customer_id ORDER BY order_date {order}) AS r
    FROM sales s JOIN members m ON s.customer_id = m.customer_id JOIN menu USING (product_id) WHERE {kept}) WHERE r = 1"""
_ALL |= {
    "customer_spend": over("sales menu", "SELECT customer_id, sum(price)::DOUBLE AS spend FROM sales JOIN menu USING (product_id) GROUP BY customer_id"),
    "customer_visit_days": over("sales", "SELECT customer_id, count(DISTINCT order_date) AS nr_of_visits FROM sales GROUP BY customer_id"),
    "first_item": over(
        "sales",
        """SELECT customer_id, product_id FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY order_date, product_id) AS r FROM sales) WHERE r = 1""",
    ),
    "top_item": over(
        "sales menu",
        "SELECT product_name, count(*) AS times_ordered FROM sales JOIN menu USING (product_id) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1",
    ),
    "favourite_item": over(
        "sales menu",
        """SELECT customer_id, product_name, n AS times_ordered FROM (
        SELECT customer_id, product_name, count(*) AS n, max(count(*)) OVER (PARTITION BY customer_id) AS top
        FROM sales JOIN menu USING (product_id) GROUP BY 1, 2) WHERE n = top""",
    ),
    "first_item_after_join": over(_SHOP, _AROUND.format(order="ASC", kept="join_date <= order_date")),
    "last_item_before_join": over(_SHOP, _AROUND.format(order="DESC", kept="join_date > order_date")),
    "pre_join_totals": over(
        _SHOP,
        """SELECT s.customer_id, count(*) AS total_items, sum(price)::DOUBLE AS total_spend
        FROM sales s LEFT JOIN members m ON s.customer_id = m.customer_id LEFT JOIN menu USING (product_id)
        WHERE join_date > order_date OR join_date IS NULL GROUP BY 1""",
    ),
    "points_multiplier": over(
        "sales menu",
        "SELECT customer_id, sum(price * CASE product_name WHEN 'PROMO' THEN 20 ELSE 10 END)::DOUBLE AS points FROM sales JOIN menu USING (product_id) GROUP BY 1",
    ),
    "first_week_points": over(
        _SHOP,
        """SELECT s.customer_id, sum(price * CASE WHEN order_date - join_date BETWEEN 0 AND 6 OR product_name = 'PROMO' THEN 20 ELSE 10 END)::DOUBLE AS points
        FROM sales s JOIN menu USING (product_id) LEFT JOIN members m ON s.customer_id = m.customer_id
        WHERE order_date <= DATE '2000-01-31' GROUP BY 1""",
    ),
}

_DONE = "lines runs done_lines"
_TIMED = """SELECT r.runner_id, o.n, date_diff('minute', o.order_time, r.pickup_time) AS m
    FROM (SELECT order_id, count(*) AS n, min(order_time) AS order_time FROM lines GROUP BY 1) o JOIN runs r USING (order_id) WHERE NOT r.cancelled"""
_ALL |= {
    "clean_sentinels": over("runs", "SELECT order_id, runner_id, pickup_time, distance, duration, cancellation FROM runs"),
    "items_total": over("lines", "SELECT count(*) AS pizzas_ordered FROM lines"),
    "orders_distinct": over("lines", "SELECT count(DISTINCT order_id) AS number_of_orders FROM lines"),
    "success_by_runner": over("runs", "SELECT runner_id, count(*) AS successful_orders FROM runs WHERE cancellation IS NULL GROUP BY 1"),
    "delivered_by_type": over(_DONE, "SELECT pizza_id, count(*) AS nr_delivered FROM done_lines GROUP BY 1"),
    "delivered_by_customer_type": over(
        _DONE + " kinds", "SELECT customer_id, pizza_name, count(*) AS nr_delivered FROM done_lines JOIN kinds USING (pizza_id) GROUP BY 1, 2"
    ),
    "largest_order": over("lines", "SELECT order_id, count(*) AS pizzas_ordered FROM lines GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1"),
    "changed_unchanged": over(
        _DONE,
        """SELECT customer_id, count(*) FILTER (extras IS NOT NULL OR exclusions IS NOT NULL) AS changed,
        count(*) FILTER (extras IS NULL AND exclusions IS NULL) AS not_changed FROM done_lines GROUP BY 1""",
    ),
    "both_changes": over(_DONE, "SELECT count(*) AS exclusions_and_extras FROM done_lines WHERE extras IS NOT NULL AND exclusions IS NOT NULL"),
    "volume_by_hour": over("lines", "SELECT hour(order_time)::INT AS hour, count(*) AS pizzas_ordered FROM lines GROUP BY 1"),
    "volume_by_weekday": over(
        "lines",
        "SELECT dayofweek(order_time)::INT AS dow, left(dayname(order_time), 3) AS day, count(*) AS pizzas_ordered FROM lines GROUP BY 1, 2",
    ),
    "signups_by_shifted_week": """SELECT (DATE '2021-01-01' + ((s_suppkey % 28)::INT // 7) * 7)::DATE AS start_of_week, count(*) AS runner_signups
        FROM supplier GROUP BY 1""",
    "avg_pickup_minutes": over("lines runs", f"SELECT runner_id, {rounded('sum(m)::DOUBLE / count(*)', 2)} AS avg_pick_up_time FROM ({_TIMED}) GROUP BY 1"),
    "prep_time_by_size": over(
        "lines runs", f"SELECT n AS pizzas_ordered, {rounded('sum(m)::DOUBLE / count(*)', 2)} AS avg_preparation_time FROM ({_TIMED}) GROUP BY 1"
    ),
    "avg_distance_by_customer": over(
        "lines runs",
        f"""SELECT customer_id, {rounded('sum(km)::DOUBLE / count(km)', 6)} AS avg_distance_travelled
        FROM runs LEFT JOIN (SELECT DISTINCT order_id, customer_id FROM lines) USING (order_id) GROUP BY 1""",
    ),
    "duration_spread": over(
        "runs", "SELECT min(minutes) AS shortest_delivery, max(minutes) AS longest_delivery, max(minutes) - min(minutes) AS diff FROM runs"
    ),
    "speed_per_delivery": over(
        "runs",
        f"""SELECT runner_id, order_id, minutes AS duration_cleaned, km::DOUBLE AS distance_cleaned, {rounded('km::DOUBLE * 60 / minutes', 2)} AS speed_in_kmh
        FROM runs WHERE duration IS NOT NULL""",
    ),
    "success_pct": over(
        "runs",
        f"""SELECT runner_id, count(*) AS orders_received, count(duration) AS orders_delivered,
        printf('%.2f%%', {rounded('count(duration)::DOUBLE / count(*) * 100', 2)}) AS successful_delivery_percentage FROM runs GROUP BY 1""",
    ),
    "standard_ingredients": over(
        "kinds recipe_items toppings", "SELECT pizza_name, topping_name FROM recipe_items JOIN kinds USING (pizza_id) JOIN toppings USING (topping_id)"
    ),
    "top_extra": over(
        "lines extra_items toppings",
        "SELECT topping_name, count(*) AS times_ordered FROM extra_items JOIN toppings USING (topping_id) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1",
    ),
    "top_exclusion": over(
        "lines exclusion_items toppings",
        "SELECT topping_name, count(*) AS times_excluded FROM exclusion_items JOIN toppings USING (topping_id) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1",
    ),
    "order_item_label": over(
        "lines extra_items exclusion_items toppings kinds",
        """SELECT l.order_id, l.customer_id, pizza_name,
        pizza_name || coalesce(' - Exclude ' || x.names, '') || coalesce(' - Extra ' || e.names, '') AS label FROM lines l JOIN kinds USING (pizza_id)
        LEFT JOIN (SELECT order_id, line_no, string_agg(topping_name, ', ' ORDER BY topping_name) AS names FROM exclusion_items JOIN toppings USING (topping_id) GROUP BY 1, 2) x
          ON l.order_id = x.order_id AND l.line_no = x.line_no
        LEFT JOIN (SELECT order_id, line_no, string_agg(topping_name, ', ' ORDER BY topping_name) AS names FROM extra_items JOIN toppings USING (topping_id) GROUP BY 1, 2) e
          ON l.order_id = e.order_id AND l.line_no = e.line_no""",
    ),
    "ingredient_list": over(
        "lines extra_items exclusion_items recipe_items toppings kinds net",
        """SELECT l.order_id, l.customer_id, l.pizza_id, l.line_no AS pizza_number_within_order, pizza_name || ': ' || items AS ingredient_list
        FROM lines l JOIN kinds USING (pizza_id) JOIN (
          SELECT order_id, line_no, string_agg(CASE WHEN amount > 1 THEN amount || 'x' ELSE '' END || topping_name, ', ' ORDER BY topping_name) AS items
          FROM net GROUP BY 1, 2) n ON l.order_id = n.order_id AND l.line_no = n.line_no""",
    ),
    "ingredient_totals": over(
        "lines runs extra_items exclusion_items recipe_items toppings net",
        "SELECT topping_name, sum(amount)::BIGINT AS topping_amount FROM net JOIN runs USING (order_id) WHERE NOT cancelled GROUP BY 1",
    ),
    "revenue_fixed_price": over(
        _DONE + " kinds",
        "SELECT sum(CASE pizza_name WHEN 'Meatlovers' THEN 12 ELSE 10 END)::BIGINT AS revenue FROM done_lines JOIN kinds USING (pizza_id)",
    ),
    "revenue_with_extras": over(
        _DONE + " kinds",
        """SELECT *, pizza_revenue + extras_revenue AS total_revenue FROM (
        SELECT sum(CASE pizza_name WHEN 'Meatlovers' THEN 12 ELSE 10 END)::BIGINT AS pizza_revenue,
          sum(CASE WHEN extras IS NULL THEN 0 ELSE len(string_split(extras, ',')) END)::BIGINT AS extras_revenue
        FROM done_lines JOIN kinds USING (pizza_id))""",
    ),
    "delivery_summary": over(
        "lines runs",
        f"""SELECT customer_id, r.order_id, runner_id, (r.order_id % 5 + 1)::INT AS rating, strftime(order_time, '%H:%M:%S') AS order_time,
        strftime(pickup_time, '%H:%M:%S') AS pickup_time, date_diff('minute', o.order_time, r.pickup_time) AS time_between_order_and_pickup,
        minutes AS delivery_duration, {rounded('km::DOUBLE * 60 / minutes', 2)} AS speed_in_kmh, n AS total_number_of_pizzas
        FROM runs r LEFT JOIN (SELECT order_id, customer_id, order_time, count(*) AS n FROM lines GROUP BY 1, 2, 3) o ON r.order_id = o.order_id
        WHERE NOT cancelled""",
    ),
    "profit_after_costs": over(
        "lines runs kinds",
        """SELECT revenue, costs::DOUBLE AS runner_costs, (revenue - costs)::DOUBLE AS profit FROM (
        SELECT sum(order_revenue)::BIGINT AS revenue, sum(km * 0.30) AS costs
        FROM runs LEFT JOIN (SELECT order_id, sum(CASE pizza_name WHEN 'Meatlovers' THEN 12 ELSE 10 END) AS order_revenue
          FROM lines JOIN kinds USING (pizza_id) GROUP BY 1) USING (order_id) WHERE NOT cancelled)""",
    ),
}

_ALL |= {
    "customer_journey": over("subs", "SELECT customer_id, start_date, plan_name FROM subs"),
    "customers_ever": over("subs", "SELECT count(DISTINCT customer_id) AS nr_of_customers FROM subs"),
    "customers_paying": over("subs", "SELECT count(DISTINCT customer_id) AS nr_of_customers FROM subs WHERE plan_id IN (1, 2, 3)"),
    "trials_by_month": over("subs", "SELECT date_trunc('month', start_date)::DATE AS month, count(*) AS trials_started FROM subs WHERE plan_id = 0 GROUP BY 1"),
    "plan_events_after": over("subs", "SELECT plan_name, count(*) AS count_of_events FROM subs WHERE year(start_date) > 2023 GROUP BY 1"),
    "churn_rate": over(
        "subs",
        f"""SELECT total_customers, nr_of_churned_customers, {rounded('nr_of_churned_customers::DOUBLE / total_customers * 100', 1)} AS percentage_churned_customers
        FROM (SELECT count(DISTINCT customer_id) AS total_customers, count(*) FILTER (plan_name = 'churn') AS nr_of_churned_customers FROM subs)""",
    ),
    "churn_after_trial": over(
        "subs steps",
        f"""SELECT *, {rounded('churned_after_trial::DOUBLE / total_customers * 100', 2)} AS churned_after_trial_perc FROM (
        SELECT count(DISTINCT customer_id) AS total_customers, count(*) FILTER (step = 2 AND plan_name = 'churn') AS churned_after_trial FROM steps)""",
    ),
    "plan_after_trial": over(
        "subs steps",
        f"""SELECT plan_name, count(*) AS number_of_subscriptions,
        {rounded('count(*)::DOUBLE / (SELECT count(DISTINCT customer_id) FROM subs) * 100', 2)} AS percentage FROM steps WHERE step = 2 GROUP BY 1""",
    ),
    "plan_on_date": over(
        "subs",
        f"""SELECT plan_name, count(*) AS nr_of_customers, {rounded('count(*)::DOUBLE / sum(count(*)) OVER () * 100', 1)} AS percentage FROM (
        SELECT customer_id, arg_max(plan_name, change_id) AS plan_name FROM (
          SELECT *, max(start_date) OVER (PARTITION BY customer_id) AS last_day FROM subs WHERE start_date <= DATE '2024-01-15') WHERE start_date = last_day
        GROUP BY 1) GROUP BY 1""",
    ),
    "annual_starts": over("subs", "SELECT count(*) AS upgrades_to_pro_annual FROM subs WHERE plan_id = 3 AND year(start_date) = 2024"),
    "avg_days_to_annual": over(
        "subs to_annual", f"SELECT {rounded('sum(days)::DOUBLE / count(days)', 6)} AS avg_days_between_upgrade_to_pro_annual FROM to_annual"
    ),
    "days_to_annual_histogram": over(
        "subs to_annual",
        f"""SELECT CASE WHEN days < 1 THEN 'under 1 days' WHEN days > 360 THEN 'over 360 days'
          ELSE ((days - 1) // 30 * 30 + 1) || ' - ' || ((days - 1) // 30 * 30 + 30) || ' days' END AS bin,
        {rounded('sum(days)::DOUBLE / count(days)', 0)} AS avg_in_days, count(*) AS nr_of_customers FROM to_annual GROUP BY 1""",
    ),
    "downgrades": over(
        "subs",
        """SELECT customer_id, old_plan, plan_name AS new_plan FROM (
        SELECT *, lag(plan_name) OVER (PARTITION BY customer_id ORDER BY start_date, change_id) AS old_plan FROM subs WHERE year(start_date) = 2024)
        WHERE old_plan = 'pro monthly' AND plan_name = 'basic monthly'""",
    ),
    "payment_schedule": over(
        "subs",
        """SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY payment_date)::INT AS payment_order FROM (
        SELECT customer_id, plan_id, plan_name, payment_date, (CASE plan_id WHEN 1 THEN 9.90 WHEN 2 THEN 19.90 ELSE 199.00 END
          - CASE WHEN old_plan = 'basic monthly' AND plan_id > 1 AND old_start < start_date AND payment_date = first THEN 9.90 ELSE 0 END)::DOUBLE AS amount
        FROM (SELECT *, (first + to_months(unnest(range(0, 13, CASE plan_id WHEN 3 THEN 12 ELSE 1 END))::INT))::DATE AS payment_date FROM (
          SELECT *, CASE WHEN plan_id = 3 AND old_plan = 'pro monthly'
            THEN (SELECT min((old_start + to_months(k::INT))::DATE) FROM range(0, 14) AS r(k) WHERE (old_start + to_months(k::INT))::DATE >= start_date)
            ELSE start_date END AS first
          FROM (SELECT *, lag(plan_name) OVER w AS old_plan, lag(start_date) OVER w AS old_start, lead(start_date) OVER w AS until
            FROM subs WINDOW w AS (PARTITION BY customer_id ORDER BY start_date, change_id))
          WHERE plan_id IN (1, 2, 3)))
        WHERE year(payment_date) = 2024 AND (until IS NULL OR payment_date < until))""",
    ),
}

_ALL |= {
    "unique_nodes": over(
        "nodes", "SELECT count(*) AS nr_of_unique_nodes FROM (SELECT DISTINCT region_id, node_id FROM nodes WHERE region_id IS NOT NULL AND node_id IS NOT NULL)"
    ),
    "nodes_per_region": over("nodes", "SELECT region_id, count(DISTINCT node_id) AS number_of_distinct_nodes FROM nodes GROUP BY 1"),
    "active_by_region": over(
        "nodes",
        "SELECT r_name AS region_name, count(customer_id) AS customers_actively_allocated FROM nodes JOIN region ON region_id = r_regionkey WHERE end_date IS NULL GROUP BY 1",
    ),
    "allocation_days": over("nodes", "SELECT *, (end_date - start_date)::INT AS days FROM nodes WHERE end_date IS NOT NULL"),
    "avg_allocation_days": over(
        "nodes", f"SELECT {rounded('sum(end_date - start_date + 1)::DOUBLE / count(*)', 1)} AS avg_days_before_reallocation FROM nodes WHERE end_date IS NOT NULL"
    ),
    "allocation_percentiles": over(
        "nodes",
        """SELECT r_name AS region_name, median(days)::DOUBLE AS median_days, quantile_cont(days, 0.8)::DOUBLE AS percentile_80, quantile_cont(days, 0.95)::DOUBLE AS percentile_95
        FROM (SELECT region_id, (end_date - start_date + 1)::DOUBLE AS days FROM nodes WHERE end_date IS NOT NULL) JOIN region ON region_id = r_regionkey GROUP BY 1""",
    ),
    "amount_percentiles": over(
        "ledger",
        f"""SELECT txn_type, {rounded('quantile_cont(v, 0.5)', 4)} AS median_amount, {rounded('quantile_cont(v, 0.8)', 4)} AS percentile_80,
        {rounded('quantile_cont(v, 0.95)', 4)} AS percentile_95
        FROM (SELECT txn_type, txn_amount::DOUBLE AS v FROM ledger) GROUP BY 1""",
    ),
    "txn_type_totals": over("ledger", "SELECT txn_type, count(*) AS number_of_transactions, sum(txn_amount)::DOUBLE AS transaction_amount FROM ledger GROUP BY 1"),
    "avg_deposits": over(
        "ledger",
        f"""SELECT {rounded('sum(txn_amount)::DOUBLE / count(DISTINCT customer_id)', 2)} AS avg_total_deposited,
        {rounded('count(*)::DOUBLE / count(DISTINCT customer_id)', 2)} AS avg_deposits FROM ledger WHERE txn_type = 'deposit'""",
    ),
    "monthly_active_customers": over(
        "ledger",
        """SELECT yearmonth, count(*) AS customers FROM (SELECT customer_id, strftime(txn_date, '%Y%m') AS yearmonth FROM ledger GROUP BY 1, 2
        HAVING count(*) FILTER (txn_type = 'deposit') > 1 AND count(*) FILTER (txn_type <> 'deposit') >= 1) GROUP BY 1""",
    ),
    "month_end_balance": over(
        "ledger",
        """SELECT customer_id, strftime(txn_date, '%Y%m') AS yearmonth, txn_date, last_day(txn_date) AS end_of_month, balance::DOUBLE AS balance FROM (
        SELECT customer_id, txn_date, sum(signed) OVER (PARTITION BY customer_id ORDER BY txn_date) AS balance,
          row_number() OVER (PARTITION BY customer_id, strftime(txn_date, '%Y%m') ORDER BY txn_date DESC) AS r FROM ledger) WHERE r = 1""",
    ),
    "monthly_balance_series": over(
        "ledger",
        """SELECT c.customer_id, strftime(m.month, '%Y%m') AS yearmonth,
        (SELECT sum(signed) FROM ledger l WHERE l.customer_id = c.customer_id AND l.txn_date <= last_day(m.month))::DOUBLE AS balance
        FROM (SELECT DISTINCT customer_id FROM ledger) c CROSS JOIN (VALUES (DATE '1998-01-01'), (DATE '1998-02-01'), (DATE '1998-03-01')) AS m(month)""",
    ),
    "balance_growth_share": over(
        "ledger",
        f"""SELECT printf('%.2f%%', {rounded('count(*) FILTER (grown > 5)::DOUBLE / count(*) * 100', 2)}) AS percentage_of_customers_with_increase FROM (
        SELECT customer_id, {rounded('(b - a)::DOUBLE / nullif(abs(a), 0)::DOUBLE * 100', 2)} AS grown FROM (
          SELECT customer_id, sum(signed) FILTER (txn_date <= DATE '1998-01-31') AS a, sum(signed) FILTER (txn_date <= DATE '1998-12-31') AS b FROM ledger GROUP BY 1))""",
    ),
}

_ALL |= {
    "report_lookup": """SELECT event_id AS report_id, strftime(ts, '%Y%m%d')::INT AS date, event_type AS type, props AS description, n_name AS city
        FROM events JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey
        WHERE ts::DATE = DATE '2024-01-15' AND event_type = 'error' AND n_name = 'NATION_3'""",
    "last_house": over("person", "SELECT * FROM person WHERE address_street_name = 'Street 7' ORDER BY address_number DESC, id LIMIT 1"),
    "name_search": over("person", "SELECT * FROM person WHERE address_street_name = 'Street 7' AND lower(name) LIKE '%customer#0000000%'"),
    "lookup_by_ids": "SELECT conv_id AS person_id, turn, text AS transcript FROM conversations WHERE conv_id IN (3, 14)",
    "lookup_by_string_id": "SELECT conv_id AS person_id, turn, text AS transcript FROM conversations WHERE conv_id = '7'::BIGINT",
    "member_plate_match": over(
        "gym person licence",
        """SELECT p.name, p.id FROM gym g JOIN person p ON p.id = g.person_id JOIN licence d ON d.id = p.license_id
        WHERE g.id LIKE '4%' AND g.membership_status = 'gold' AND lower(d.plate_number) LIKE '%1w%'""",
    ),
    "attendance_profile": over(
        "person licence",
        """SELECT e.user_id AS person_id, count(*) AS attendances, any_value(p.name) AS name, any_value(hair_color) AS hair_color, any_value(gender) AS gender,
        any_value(height) AS height, any_value(car_make) AS car_make, any_value(car_model) AS car_model
        FROM events e JOIN person p ON p.id = e.user_id JOIN licence d ON d.id = p.license_id
        WHERE event_type = 'purchase' AND strftime(ts, '%Y%m') = '202401' AND car_make = 'Alpha' AND car_model = 'Model A' AND gender = 'female'
          AND hair_color = 'red' AND height BETWEEN 31 AND 81 GROUP BY 1 HAVING count(*) = 13""",
    ),
}

CHECKS: dict[str, str] = dict(_ALL)
