"""Food deliveries: cleaning, volumes, times, ingredients, revenue.

``lines`` hold one row per ordered pizza, ``headers`` the customer and time of
each order (``order_headers`` takes them from a table that repeats them).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.dates import clock, minute_steps, week_start, weekday_from_sunday
from tallyframe.functions.numbers import percent_text, ratio, round_half_up
from tallyframe.functions.text import blank_to_null, leading_number, list_ids
from tallyframe.operators.ranges import free_name
from tallyframe.operators.reshape import explode_items
from tallyframe.operators.running import running_row_number

# Price per kind of pizza, charge per extra, pay per kilometre.
PRICES = {"Meatlovers": 12, "Vegetarian": 10}
EXTRA_CHARGE = 1
PAY_PER_KM = "0.30"


# --- cleaning ----------------------------------------------------------------

def clean_runner_orders(raw: DataFrame) -> DataFrame:
    """NULL markers become NULL and the pick-up text a timestamp (the time of day is kept)."""
    out = raw
    for name in ("pickup_time", "distance", "duration", "cancellation"):
        out = out.withColumn(name, blank_to_null(F.col(name)))
    return out.withColumn("pickup_time", F.to_timestamp_ntz("pickup_time", F.lit("yyyy-MM-dd HH:mm:ss")))


def clean_customer_orders(raw: DataFrame) -> DataFrame:
    out = raw
    for name in ("exclusions", "extras"):
        if name in raw.columns:
            out = out.withColumn(name, blank_to_null(F.col(name)))
    return out


def delivered(runner_orders: DataFrame) -> DataFrame:
    return clean_runner_orders(runner_orders).filter("cancellation IS NULL")


def order_headers(customer_orders: DataFrame) -> DataFrame:
    """Customer and time of each order, from a table that repeats them on every line."""
    return customer_orders.select("order_id", "customer_id", "order_time").distinct()


def _delivered_lines(lines: DataFrame, runner_orders: DataFrame) -> DataFrame:
    """Order lines of delivered orders; the order number is unique in the delivery log."""
    return clean_customer_orders(lines).join(delivered(runner_orders).select("order_id"), "order_id")


def _order_sizes(lines: DataFrame) -> DataFrame:
    """Lines are counted per order before any join, so an order with very many lines is one row."""
    return lines.groupBy("order_id").agg(F.count("*").alias("pizzas_ordered"))


# --- volumes -----------------------------------------------------------------

def items_total(lines: DataFrame) -> DataFrame:
    return lines.agg(F.count("*").alias("pizzas_ordered"))


def orders_distinct(lines: DataFrame) -> DataFrame:
    return lines.agg(F.count_distinct("order_id").alias("number_of_orders"))


def success_by_runner(runner_orders: DataFrame) -> DataFrame:
    return delivered(runner_orders).groupBy("runner_id").agg(F.count("*").alias("successful_orders"))


def delivered_by_type(lines: DataFrame, runner_orders: DataFrame) -> DataFrame:
    return _delivered_lines(lines, runner_orders).groupBy("pizza_id").agg(F.count("*").alias("nr_delivered"))


def delivered_by_customer_type(lines: DataFrame, headers: DataFrame, runner_orders: DataFrame, names: DataFrame) -> DataFrame:
    # Order tables meet first, so the lines are joined once per key and a large order can be split.
    orders = headers.join(delivered(runner_orders).select("order_id"), "order_id")
    rows = lines.join(orders, "order_id").join(names, "pizza_id")
    return rows.groupBy("customer_id", "pizza_name").agg(F.count("*").alias("nr_delivered"))


def largest_order(lines: DataFrame) -> DataFrame:
    """The order with the most lines; the smallest number among equals."""
    return _order_sizes(lines).orderBy(F.col("pizzas_ordered").desc(), "order_id").limit(1)


def changed_unchanged(lines: DataFrame, headers: DataFrame, runner_orders: DataFrame) -> DataFrame:
    """A pizza is changed if it has extras or exclusions."""
    changed = F.col("extras").isNotNull() | F.col("exclusions").isNotNull()
    per_order = clean_customer_orders(lines).groupBy("order_id").agg(
        F.count_if(changed).alias("changed"), F.count_if(~changed).alias("not_changed")
    )
    rows = per_order.join(delivered(runner_orders).select("order_id"), "order_id").join(headers, "order_id")
    return rows.groupBy("customer_id").agg(F.sum("changed").alias("changed"), F.sum("not_changed").alias("not_changed"))


def both_changes(lines: DataFrame, runner_orders: DataFrame) -> DataFrame:
    both = F.col("extras").isNotNull() & F.col("exclusions").isNotNull()
    return _delivered_lines(lines, runner_orders).agg(F.count_if(both).alias("exclusions_and_extras"))


def volume_by_hour(lines: DataFrame, headers: DataFrame) -> DataFrame:
    rows = _order_sizes(lines).join(headers, "order_id")
    return rows.groupBy(F.hour("order_time").alias("hour")).agg(F.sum("pizzas_ordered").alias("pizzas_ordered")).orderBy("hour")


def volume_by_weekday(lines: DataFrame, headers: DataFrame) -> DataFrame:
    day = F.to_date("order_time")
    return (
        _order_sizes(lines)
        .join(headers, "order_id")
        .groupBy(weekday_from_sunday(day).alias("dow"), F.dayname(day).alias("day"))
        .agg(F.sum("pizzas_ordered").alias("pizzas_ordered"))
        .orderBy("dow")
    )


# --- runners and times -------------------------------------------------------

def signups_by_week(runners: DataFrame, shift: int = 4) -> DataFrame:
    """Weeks that start on Friday (four days after Monday), like 2021-01-01."""
    week = week_start(F.col("registration_date"), shift)
    return runners.groupBy(week.alias("start_of_week")).agg(F.count("*").alias("runner_signups"))


def _timed_orders(lines: DataFrame, headers: DataFrame, runner_orders: DataFrame) -> DataFrame:
    """One row per delivered order: runner, size and minutes from order to pick-up."""
    picked = delivered(runner_orders).select("order_id", "runner_id", "pickup_time")
    orders = _order_sizes(lines).join(headers, "order_id").join(picked, "order_id")
    return orders.withColumn("minutes", minute_steps(F.col("order_time"), F.col("pickup_time")))


def avg_pickup_minutes(lines: DataFrame, headers: DataFrame, runner_orders: DataFrame) -> DataFrame:
    """Averaged over orders, not over their lines."""
    return _timed_orders(lines, headers, runner_orders).groupBy("runner_id").agg(
        round_half_up(F.avg("minutes"), 2).alias("avg_pick_up_time")
    )


def prep_time_by_size(lines: DataFrame, headers: DataFrame, runner_orders: DataFrame) -> DataFrame:
    return _timed_orders(lines, headers, runner_orders).groupBy("pizzas_ordered").agg(
        round_half_up(F.avg("minutes"), 2).alias("avg_preparation_time")
    )


def avg_distance_by_customer(lines: DataFrame, headers: DataFrame, runner_orders: DataFrame) -> DataFrame:
    """Each order once. Cancelled orders have no distance; orders without lines have no customer."""
    trips = clean_runner_orders(runner_orders).select("order_id", leading_number(F.col("distance")).cast("decimal(10,2)").alias("km"))
    owners = lines.select("order_id").distinct().join(headers.select("order_id", "customer_id"), "order_id")
    mean = F.sum("km").cast("double") / F.count("km")
    return trips.join(owners, "order_id", "left").groupBy("customer_id").agg(
        round_half_up(F.when(F.count("km") > 0, mean), 6).alias("avg_distance_travelled")
    )


def duration_spread(runner_orders: DataFrame) -> DataFrame:
    minutes = leading_number(F.col("duration"))
    ends = clean_runner_orders(runner_orders).agg(
        F.min(minutes).alias("shortest_delivery"), F.max(minutes).alias("longest_delivery")
    )
    return ends.withColumn("diff", F.col("longest_delivery") - F.col("shortest_delivery"))


def _speed(minutes: Column, km: Column) -> Column:
    return round_half_up(ratio(km * 60, minutes), 2)


def speed_per_delivery(runner_orders: DataFrame) -> DataFrame:
    return (
        clean_runner_orders(runner_orders)
        .filter("duration IS NOT NULL")
        .select(
            "runner_id",
            "order_id",
            leading_number(F.col("duration")).alias("duration_cleaned"),
            leading_number(F.col("distance")).alias("distance_cleaned"),
        )
        .withColumn("speed_in_kmh", _speed(F.col("duration_cleaned"), F.col("distance_cleaned")))
    )


def success_percentage(runner_orders: DataFrame) -> DataFrame:
    counts = clean_runner_orders(runner_orders).groupBy("runner_id").agg(
        F.count("*").alias("orders_received"), F.count("duration").alias("orders_delivered")
    )
    share = percent_text(F.col("orders_delivered"), F.col("orders_received"))
    return counts.withColumn("successful_delivery_percentage", share)


# --- ingredients -------------------------------------------------------------

def standard_ingredients(recipes: DataFrame, names: DataFrame, toppings: DataFrame) -> DataFrame:
    return (
        explode_items(recipes, list_ids(F.col("toppings")), "topping_id")
        .join(names, "pizza_id")
        .join(toppings, "topping_id")
        .select("pizza_name", "topping_name")
    )


def _top_topping(lines: DataFrame, toppings: DataFrame, column: str, out: str) -> DataFrame:
    # Counting ids first leaves one row per topping to name.
    counted = explode_items(clean_customer_orders(lines), list_ids(F.col(column)), "topping_id").groupBy("topping_id").agg(
        F.count("*").alias(out)
    )
    named = counted.join(toppings, "topping_id").groupBy("topping_name").agg(F.sum(out).alias(out))
    return named.orderBy(F.col(out).desc(), "topping_name").limit(1)


def top_extra(lines: DataFrame, toppings: DataFrame) -> DataFrame:
    return _top_topping(lines, toppings, "extras", "times_ordered")


def top_exclusion(lines: DataFrame, toppings: DataFrame) -> DataFrame:
    return _top_topping(lines, toppings, "exclusions", "times_excluded")


def _names_of(rows: DataFrame, column: str, toppings: DataFrame, out: str, texts: DataFrame | None = None) -> DataFrame:
    """``out``: the sorted topping names of a list column, NULL for a list without a known name.

    Every distinct list text is named once and joined back. Ids without a name
    are left out; an id with several names has them all. ``texts`` is a cheaper
    table with the same list texts, if there is one. Rows without a list find
    nothing, so a hash of the row deals them evenly over the tasks; the names
    are shuffled once more, so that Spark knows their size at the join and can
    broadcast them or split the rows of a frequent text.
    """
    texts = (rows if texts is None else texts).select(F.col(column).alias("list_text")).filter("list_text IS NOT NULL").distinct()
    deal, found = free_name(rows, "_deal"), free_name(rows, "_found")
    named = (
        explode_items(texts, list_ids(F.col("list_text")), "topping_id")
        .join(toppings, "topping_id")
        .groupBy(F.col("list_text").alias(found))
        # An aggregate and not a constant, which Spark would take out of the join's keys.
        .agg(F.sort_array(F.collect_list("topping_name")).alias(out), F.min(F.lit(0).cast("long")).alias(deal))
        .repartition(found, deal)
    )
    dealt = rows.withColumn(deal, F.when(F.col(column).isNull(), F.xxhash64(*rows.columns)).otherwise(F.lit(0)))
    same = (dealt[column] == named[found]) & (dealt[deal] == named[deal])
    return dealt.join(named, same, "left").select(*[dealt[c] for c in rows.columns], named[out])


def _with_names(rows: DataFrame, lines: DataFrame, toppings: DataFrame) -> DataFrame:
    """``rows``, made of the cleaned ``lines``, with the names of their exclusions and extras."""
    named = _names_of(rows, "exclusions", toppings, "out_names", lines)
    return _names_of(named, "extras", toppings, "in_names", lines)


def order_item_labels(lines: DataFrame, headers: DataFrame, names: DataFrame, toppings: DataFrame) -> DataFrame:
    """``Name``, ``Name - Exclude A, B``, ``Name - Extra C`` or both, for every line."""
    clean = clean_customer_orders(lines)
    rows = _with_names(clean, clean, toppings).join(names, "pizza_id", "left").join(headers, "order_id")
    label = F.concat(
        "pizza_name",
        F.coalesce(F.concat(F.lit(" - Exclude "), F.array_join("out_names", ", ")), F.lit("")),
        F.coalesce(F.concat(F.lit(" - Extra "), F.array_join("in_names", ", ")), F.lit("")),
    )
    return rows.select("order_id", "customer_id", "pizza_name", label.alias("label"))


def _times(item: Column, array: Column) -> Column:
    return F.size(array) - F.size(F.array_remove(array, item))


def _list_text(on_it: Column, off_it: Column) -> Column:
    """``2xBacon, Beef``: names by alphabet with their amount if it is more than one."""
    counted = F.transform(
        F.sort_array(F.array_distinct(on_it)),
        lambda name: F.struct(name.alias("name"), (_times(name, on_it) - _times(name, off_it)).alias("n")),
    )
    items = F.transform(
        F.filter(counted, lambda c: c["n"] > 0),
        lambda c: F.when(c["n"] > 1, F.concat(c["n"].cast("string"), F.lit("x"), c["name"])).otherwise(c["name"]),
    )
    return F.array_join(items, ", ")


def ingredient_lists(lines: DataFrame, headers: DataFrame, names: DataFrame, recipes: DataFrame, toppings: DataFrame) -> DataFrame:
    """``Name: 2xBacon, Beef`` for every line, numbered within its order.

    Recipes are named and written out once per pizza; only lines with changes
    make a text of their own. ``line_slice`` and then ``line_sort`` give the
    lines of an order their order.
    """
    none = F.array().cast("array<string>")
    named_recipes = _names_of(recipes, "toppings", toppings, "recipe").withColumn("recipe", F.coalesce("recipe", none)).select(
        "pizza_id", "recipe", _list_text(F.col("recipe"), none).alias("standard")
    )
    clean = clean_customer_orders(lines)
    numbered = running_row_number(
        clean, ["order_id"], ["line_slice", "line_sort"], "pizza_number_within_order"
    )
    rows = (
        _with_names(numbered.drop("line_slice", "line_sort").join(headers, "order_id"), clean, toppings)
        .join(named_recipes, "pizza_id")
        .join(names, "pizza_id")
        .withColumn("on_it", F.concat("recipe", F.coalesce("in_names", none)))
        .withColumn("off_it", F.coalesce("out_names", none))
    )
    unchanged = F.col("exclusions").isNull() & F.col("extras").isNull()
    text = F.when(unchanged, F.col("standard")).otherwise(_list_text(F.col("on_it"), F.col("off_it")))
    return rows.select(
        "order_id",
        "customer_id",
        "pizza_id",
        "pizza_number_within_order",
        F.concat("pizza_name", F.lit(": "), text).alias("ingredient_list"),
    )


_SHAPE = ["pizza_id", "exclusions", "extras"]


def _net_toppings(shapes: DataFrame, recipes: DataFrame) -> DataFrame:
    """Toppings that end up on each distinct kind of line: recipe plus extras minus exclusions.

    Only positive amounts stay: leaving out what was never there changes nothing.
    """
    empty = F.array().cast("array<int>")
    rows = (
        shapes.join(recipes.select("pizza_id", list_ids(F.col("toppings")).alias("recipe")), "pizza_id")
        .withColumn("on_it", F.concat("recipe", F.coalesce(list_ids(F.col("extras")), empty)))
        .withColumn("off_it", F.coalesce(list_ids(F.col("exclusions")), empty))
        .withColumn("topping_id", F.explode(F.array_distinct("on_it")))
    )
    amount = _times(F.col("topping_id"), F.col("on_it")) - _times(F.col("topping_id"), F.col("off_it"))
    return rows.withColumn("amount", amount).filter("amount > 0").drop("recipe", "on_it", "off_it")


def ingredient_totals(lines: DataFrame, runner_orders: DataFrame, recipes: DataFrame, toppings: DataFrame) -> DataFrame:
    """Quantity of each topping on delivered pizzas, most used first."""
    shapes = _delivered_lines(lines, runner_orders).groupBy(*_SHAPE).agg(F.count("*").alias("n"))
    used = _net_toppings(shapes, recipes).groupBy("topping_id").agg(F.sum(F.col("amount") * F.col("n")).alias("topping_amount"))
    return (
        used.join(toppings, "topping_id")
        .groupBy("topping_name")
        .agg(F.sum("topping_amount").alias("topping_amount"))
        .orderBy(F.col("topping_amount").desc(), "topping_name")
    )


# --- money -------------------------------------------------------------------

def _price(name: Column) -> Column:
    """Price of a kind; a kind without a price stops the query."""
    out = F
    for kind, price in PRICES.items():
        out = out.when(name == kind, price)
    return out.otherwise(F.raise_error(F.concat(F.lit("no price for "), name)))


def revenue_fixed_price(lines: DataFrame, runner_orders: DataFrame, names: DataFrame) -> DataFrame:
    sold = _delivered_lines(lines, runner_orders).groupBy("pizza_id").agg(F.count("*").alias("n"))
    return sold.join(names, "pizza_id").agg(F.sum(F.col("n") * _price(F.col("pizza_name"))).alias("revenue"))


def revenue_with_extras(lines: DataFrame, runner_orders: DataFrame, names: DataFrame, toppings: DataFrame) -> DataFrame:
    """Fixed prices plus one per extra; no extras at all count as 0."""
    sold = _delivered_lines(lines, runner_orders).groupBy("pizza_id", "extras").agg(F.count("*").alias("n")).join(names, "pizza_id")
    rows = _names_of(sold, "extras", toppings, "in_names")
    extras = F.when(F.col("in_names").isNull(), 0).otherwise(F.size("in_names"))
    return rows.agg(
        F.sum(F.col("n") * _price(F.col("pizza_name"))).alias("pizza_revenue"),
        F.sum(F.col("n") * extras * EXTRA_CHARGE).alias("extras_revenue"),
    ).withColumn("total_revenue", F.col("pizza_revenue") + F.col("extras_revenue"))


def delivery_summary(lines: DataFrame, headers: DataFrame, runner_orders: DataFrame, ratings: DataFrame) -> DataFrame:
    """One row per rated delivery; ratings belong to orders."""
    sizes = _order_sizes(lines).withColumnRenamed("pizzas_ordered", "total_number_of_pizzas").join(headers, "order_id")
    rows = delivered(runner_orders).join(ratings, "order_id").join(sizes, "order_id", "left")
    minutes, km = leading_number(F.col("duration")), leading_number(F.col("distance"))
    return rows.select(
        "customer_id",
        "order_id",
        "runner_id",
        "rating",
        clock(F.col("order_time")).alias("order_time"),
        clock(F.col("pickup_time")).alias("pickup_time"),
        minute_steps(F.col("order_time"), F.col("pickup_time")).alias("time_between_order_and_pickup"),
        minutes.alias("delivery_duration"),
        _speed(minutes, km).alias("speed_in_kmh"),
        "total_number_of_pizzas",
    )


def profit_after_costs(lines: DataFrame, runner_orders: DataFrame, names: DataFrame) -> DataFrame:
    """Revenue of delivered orders minus the pay for their kilometres."""
    per_order = lines.join(names, "pizza_id").groupBy("order_id").agg(F.sum(_price(F.col("pizza_name"))).alias("order_revenue"))
    km = leading_number(F.col("distance")).cast("decimal(10,2)")
    totals = delivered(runner_orders).join(per_order, "order_id", "left").agg(
        F.sum("order_revenue").alias("revenue"), F.sum(km * F.lit(PAY_PER_KM).cast("decimal(4,2)")).alias("runner_costs")
    )
    return totals.withColumn("profit", F.col("revenue") - F.col("runner_costs"))
