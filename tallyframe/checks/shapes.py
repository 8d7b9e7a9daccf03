"""The adapters once more, as named SQL subqueries over the test tables."""

from __future__ import annotations

_MONTHS = "['Jan','Feb','Mar','Apr','May','Jun','Jul','Aug','Sep','Oct','Nov','Dec']"
_HOLIDAY_VALUES = ", ".join(
    f"({(year - 2023) * 4 + i + 1}, '{year if i == 0 else ''}', '{day}', '{name}')"
    for year in range(2023, 2030)
    for i, (day, name) in enumerate((("01-Jan", "New Year"), ("25-Dec", "Christmas Day"), ("26-Dec", "Boxing Day"), ("", "")))
)
_TOPICS = ("ease_of_use", "ease_of_access", "navigation", "likelihood_to_recommend", "overall_rating")
_SURVEY = ", ".join(
    f"((c_custkey * {k}) % 11)::INT AS {name}"
    for k, name in enumerate([f"{p}_{t}" for p in ("mobile_app", "online_interface") for t in _TOPICS], 1)
)
_KM = "((o_orderkey % 25 + 1) || '.' || (o_orderkey % 10))"
_MIN = "((10 + o_orderkey % 40) || '')"

SHAPES: dict[str, str] = {
    "txns": """SELECT substr(o_orderpriority, 3, 3) || '-' || o_orderkey AS transaction_code, o_orderkey % 2 + 1 AS online_or_in_person,
        strftime(o_orderdate, '%d/%m/%Y %H:%M:%S') AS transaction_date, o_totalprice::DECIMAL(18,2) AS value, o_custkey AS customer_code
        FROM orders""",
    "named_txns": """SELECT split_part(transaction_code, '-', 1) AS bank,
        CASE online_or_in_person WHEN 1 THEN 'online' WHEN 2 THEN 'in-person' END AS online_or_in_person,
        left(dayname(strptime(left(transaction_date, 10), '%d/%m/%Y')), 3) AS weekday, value, customer_code FROM txns""",
    "transfers": """SELECT o_orderkey AS transaction_id, r_name AS bank, (100000 + o_custkey % 900000)::VARCHAR AS digits,
        (10000000 + o_custkey)::VARCHAR AS account_number
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "swift": "SELECT r_name AS bank, lpad(r_regionkey::VARCHAR, 2, '0') AS check_digits, left(r_name, 4) AS swift_code FROM region",
    "goals": """SELECT online_or_inperson, quarter, target::BIGINT AS target FROM (VALUES ('Online', 1, 16000000), ('Online', 2, 15500000), ('Online', 3, 15000000), ('Online', 4, 15200000),
        ('In-Person', 1, 15000000), ('In-Person', 2, NULL), ('In-Person', 3, 14800000), ('In-Person', 4, 15100000))
        AS v(online_or_inperson, quarter, target) WHERE target IS NOT NULL""",
    "facts": f"""SELECT c_custkey AS id, c_mktsegment AS ethnicity, n_name AS account_type,
        DATE '1950-01-01' + (c_custkey % 18000)::INT AS date_of_birth,
        strptime('2023' || {_MONTHS}[(m % 12) + 1] || (c_custkey % 28 + 1), '%Y%b%d')::DATE AS joined_date
        FROM (SELECT *, unnest(CASE WHEN c_custkey % 10 = 0 THEN [c_custkey % 12, (c_custkey + 5) % 12] ELSE [c_custkey % 12] END) AS m FROM customer)
        JOIN nation ON c_nationkey = n_nationkey""",
    "survey": f"SELECT c_custkey AS customer_id, {_SURVEY} FROM customer",
    "accounts": """SELECT c_custkey AS account_number, CASE WHEN c_mktsegment = 'BUILDING' THEN 'Platinum' ELSE c_mktsegment END AS account_type,
        CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 3 = 0 THEN c_custkey || ', ' || (c_custkey + 1) ELSE c_custkey::VARCHAR END AS holders,
        DATE '2023-12-31' AS balance_date, c_acctbal::DECIMAL(18,2) AS balance FROM customer""",
    "holders": """SELECT c_custkey AS account_holder_id, c_name AS name, DATE '1950-01-01' + (c_custkey % 18000)::INT AS dob,
        7000000000 + c_custkey % 999999 AS contact_number, (c_custkey % 200 + 1) || ' ' || c_mktsegment || ' Street' AS first_line_of_address
        FROM customer""",
    "payments": """SELECT event_id AS transaction_id, ts::DATE AS transaction_date, value::DECIMAL(18,2) AS value,
        CASE WHEN event_type = 'error' THEN 'Y' ELSE 'N' END AS cancelled, user_id + 1 + event_id % 7 AS account_to, user_id AS account_from
        FROM events""",
    "legs": """SELECT transaction_date, account_to AS account, value FROM payments WHERE cancelled = 'N'
        UNION ALL SELECT transaction_date, account_from, -value FROM payments WHERE cancelled = 'N'""",
    "purchases": """SELECT (p_partkey % 12 + 1)::INT AS file,
        CASE WHEN p_partkey % 10 = 9 THEN NULL WHEN p_partkey % 4 = 0 THEN (p_partkey % 997 + 1.5) * 1e9
             WHEN p_partkey % 4 = 3 THEN (p_partkey % 997 + 1) * 1e6 ELSE (p_partkey % 997 + 1.5) * 1e6 END::DOUBLE AS market_cap,
        (((p_partkey * 7919) % 10000001)::DECIMAL(18,2) / 100)::DECIMAL(18,2)::DOUBLE AS purchase_price,
        'T' || p_partkey AS ticker, p_type AS sector, p_brand AS market, p_name AS stock_name FROM part""",
    "places": """SELECT c_custkey AS customer, -6 + (c_custkey * 7 % 800) / 100.0::DOUBLE AS lon, 50 + (c_custkey % 900) / 100.0::DOUBLE AS lat FROM customer""",
    "branches": """SELECT s_suppkey AS branch, 50 + (s_suppkey * 37 % 900) / 100.0::DOUBLE AS lat, -6 + (s_suppkey * 101 % 800) / 100.0::DOUBLE AS lon FROM supplier""",
    "holidays": f"""SELECT strptime(y || d, '%Y%d-%b')::DATE AS day, name FROM (
        SELECT max(nullif(y, '')) OVER (ORDER BY n) AS y, d, name FROM (VALUES {_HOLIDAY_VALUES}) AS v(n, y, d, name)) WHERE d <> ''""",
    "home_days": """SELECT (o_orderdate + INTERVAL 336 MONTH)::DATE AS day, count(*) AS n FROM orders
        WHERE NOT coalesce(o_orderstatus = 'F' AND NOT (dayofweek(o_orderdate) = 2 AND day(o_orderdate) > 20), false) GROUP BY 1""",
    "away_days": """SELECT strftime(day + 2, '%b-%y') AS reporting_month, n AS new_customers, day FROM (
        SELECT (o_orderdate + INTERVAL 336 MONTH)::DATE AS day, count(*) AS n FROM orders
        WHERE o_orderstatus = 'F' AND NOT (dayofweek(o_orderdate) = 2 AND day(o_orderdate) > 20) GROUP BY 1)""",
    "flags": """SELECT h.day, h.n, b.name, dayofweek(h.day) IN (0, 6) OR b.name IS NOT NULL AS closed
        FROM home_days h LEFT JOIN holidays b ON h.day = b.day""",
    "open_days": "SELECT day FROM flags WHERE NOT closed",
    "uk": """SELECT target AS day, sum(n)::BIGINT AS n FROM (
        SELECT n, (SELECT min(o.day) FROM open_days o WHERE o.day >= f.day) AS target FROM flags f) WHERE target IS NOT NULL GROUP BY 1""",
    "sales": "SELECT o_custkey AS customer_id, o_orderdate::DATE AS order_date, l_partkey AS product_id FROM lineitem JOIN orders ON l_orderkey = o_orderkey",
    "menu": "SELECT p_partkey AS product_id, p_type AS product_name, p_retailprice::DECIMAL(18,2) AS price FROM part",
    "members": "SELECT c_custkey AS customer_id, DATE '1996-01-01' + (c_custkey % 1500)::INT AS join_date FROM customer WHERE c_mktsegment <> 'FURNITURE'",
    "lines": """SELECT l_orderkey AS order_id, o_custkey AS customer_id, l_partkey AS pizza_id,
        o_orderdate + to_minutes(o_orderkey % 1440) AS order_time,
        CASE l_linenumber WHEN 3 THEN (l_partkey % 25)::VARCHAR WHEN 7 THEN ((l_partkey + 5) % 25) || ', ' || (l_suppkey % 25) END AS exclusions,
        CASE l_suppkey % 4 WHEN 2 THEN (l_suppkey % 25)::VARCHAR WHEN 3 THEN ((l_partkey + 10) % 25) || ',' || ((l_suppkey + 1) % 25) END AS extras,
        row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey % 256, l_partkey, l_suppkey, l_linenumber) AS line_no
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "runs": f"""SELECT o_orderkey AS order_id, (o_orderkey % 10 + 1)::INT AS runner_id, o_orderpriority = '5-LOW' AS cancelled,
        CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderdate + to_minutes(o_orderkey % 1440 + 5 + o_orderkey % 37) + to_seconds(o_orderkey % 60) END AS pickup_time,
        CASE WHEN o_orderpriority = '5-LOW' THEN NULL WHEN o_orderkey % 3 = 0 THEN {_KM} || 'km' WHEN o_orderkey % 3 = 1 THEN {_KM} || ' km' ELSE {_KM} END AS distance,
        CASE WHEN o_orderpriority = '5-LOW' THEN NULL WHEN o_orderkey % 3 = 0 THEN {_MIN} || ' minutes' WHEN o_orderkey % 3 = 1 THEN {_MIN} || 'mins' ELSE {_MIN} END AS duration,
        CASE WHEN o_orderpriority = '5-LOW' THEN 'Restaurant Cancellation' END AS cancellation,
        CASE WHEN o_orderpriority <> '5-LOW' THEN {_KM}::DECIMAL(10,2) END AS km, CASE WHEN o_orderpriority <> '5-LOW' THEN {_MIN}::DOUBLE END AS minutes
        FROM orders""",
    "done_lines": "SELECT l.* FROM lines l JOIN runs r ON l.order_id = r.order_id WHERE NOT r.cancelled",
    "kinds": "SELECT p_partkey AS pizza_id, CASE WHEN p_partkey % 2 = 0 THEN 'Meatlovers' ELSE 'Vegetarian' END AS pizza_name FROM part",
    "recipe_items": "SELECT p_partkey AS pizza_id, unnest([p_partkey % 25, (p_partkey + 5) % 25, (p_partkey + 10) % 25, (p_partkey + 17) % 25]) AS topping_id FROM part",
    "toppings": "SELECT n_nationkey AS topping_id, n_name AS topping_name FROM nation",
    "extra_items": "SELECT order_id, line_no, trim(unnest(string_split(extras, ',')))::INT AS topping_id FROM lines",
    "exclusion_items": "SELECT order_id, line_no, trim(unnest(string_split(exclusions, ',')))::INT AS topping_id FROM lines",
    "net": """SELECT order_id, line_no, topping_name, sum(c)::INT AS amount FROM (
        SELECT l.order_id, l.line_no, r.topping_id, 1 AS c FROM lines l JOIN recipe_items r ON l.pizza_id = r.pizza_id
        UNION ALL SELECT order_id, line_no, topping_id, 1 FROM extra_items
        UNION ALL SELECT order_id, line_no, topping_id, -1 FROM exclusion_items) JOIN toppings USING (topping_id)
        GROUP BY ALL HAVING sum(c) > 0""",
    "subs": """SELECT user_id AS customer_id, ts::DATE AS start_date, event_id AS change_id,
        CASE event_type WHEN 'signup' THEN 0 WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'purchase' THEN 3 ELSE 4 END AS plan_id,
        CASE event_type WHEN 'signup' THEN 'trial' WHEN 'view' THEN 'basic monthly' WHEN 'click' THEN 'pro monthly'
             WHEN 'purchase' THEN 'pro annual' ELSE 'churn' END AS plan_name FROM events""",
    "steps": "SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY start_date, change_id) AS step FROM subs",
    "to_annual": """SELECT customer_id, (min(start_date) FILTER (plan_id = 3)) - (min(start_date) FILTER (plan_id = 0)) AS days FROM subs
        GROUP BY customer_id HAVING min(start_date) FILTER (plan_id = 3) IS NOT NULL""",
    "nodes": """SELECT o_custkey AS customer_id, (o_custkey % 5)::INT AS region_id, (o_orderkey % 5 + 1)::INT AS node_id, o_orderdate::DATE AS start_date,
        CASE WHEN o_orderkey % 9 <> 0 THEN o_orderdate::DATE + (o_orderkey % 30)::INT END AS end_date FROM orders""",
    "ledger": """SELECT o_custkey AS customer_id, o_orderdate::DATE AS txn_date,
        CASE o_orderstatus WHEN 'O' THEN 'deposit' WHEN 'F' THEN 'withdrawal' ELSE 'purchase' END AS txn_type,
        o_totalprice::DECIMAL(18,2) AS txn_amount, CASE WHEN o_orderstatus = 'O' THEN 1 ELSE -1 END * o_totalprice::DECIMAL(18,2) AS signed FROM orders""",
    "person": """SELECT c_custkey AS id, c_name AS name, c_custkey AS license_id, (c_custkey % 977)::INT AS address_number,
        'Street ' || c_nationkey AS address_street_name, 100000000 + c_custkey AS ssn FROM customer""",
    "gym": """SELECT (c_custkey % 50) || left(c_mktsegment, 1) || c_custkey AS id, c_custkey AS person_id,
        CASE c_nationkey % 3 WHEN 0 THEN 'gold' WHEN 1 THEN 'silver' ELSE 'regular' END AS membership_status FROM customer""",
    "licence": """SELECT p_partkey AS id, left(p_type, 1) || (p_partkey % 50) || 'W' || p_size AS plate_number,
        CASE p_partkey % 3 WHEN 0 THEN 'red' WHEN 1 THEN 'brown' ELSE 'black' END AS hair_color,
        CASE WHEN p_partkey % 2 = 0 THEN 'female' ELSE 'male' END AS gender, (p_size + 30)::INT AS height,
        CASE WHEN p_partkey % 4 < 3 THEN 'Alpha' ELSE 'Beta' END AS car_make, CASE WHEN p_partkey % 4 < 3 THEN 'Model A' ELSE 'Model B' END AS car_model FROM part""",
}


def over(shapes: str, query: str) -> str:
    """``query`` with the named shapes (space separated, in order of use) in front."""
    return "WITH " + ",\n".join(f"{name} AS ({SHAPES[name]})" for name in shapes.split()) + "\n" + query


def rounded(expression: str, digits: int) -> str:
    """Round half away from zero on ten exact decimals."""
    return f"round(({expression})::DECIMAL(28,10), {digits})::DOUBLE"
