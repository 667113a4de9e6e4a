"""Delivery queries A01-E02 plus ``*_intended`` corrections.

Two families of predicates are used on purpose:

* as-written queries reproduce the source SQL's comparisons exactly
  (case-insensitive, blank-padded: :func:`text_ne` / :func:`text_not_in`),
  including its defects (e.g. ``''`` counts as a change in A07);
* ``*_intended`` queries use the cleaned meaning (:func:`has_value`).

Scale shape: ``customer_orders`` is the item-grain fact (one row per item,
billions of rows), everything else is order grain or a dimension. Item rows
are reduced before they meet a dimension -- to per-pizza, per-variant or
per-list-text counts -- so the large joins and the final shuffles run on
compact pre-aggregates, and list explosion happens once per distinct list.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.lists import int_tokens, ordered_concat, repeat_join, token_count
from tillroll.functions.money import price_map
from tillroll.functions.temporal import (
    hour_of_day, minute_boundaries, parse_timestamp, week_start_anchored, week_start_monday,
    weekday_name, weekday_number,
)
from tillroll.functions.text import (
    as_col, binary_text, double_from_digits, has_value, int_from_digits, null_token, number_from_text, text_eq, text_ne, text_not_in,
)
from tillroll.operators import (
    daily_sketches, distinct_estimate, labelled_tokens, net_quantities, not_in, null_safe_join, pivot_counts, quantity_list, recipe_arrays, recipe_entries, recipe_positions,
    string_agg, token_frequency, top_n_with_ties, topping_dictionary, variant_quantities,
)
from tillroll.operators.distinct import near
from tillroll.sources.tables import DeliveryTables

VARIANT = ["pizza_id", "exclusions", "extras"]


# ------------------------------------------------------------ predicates
def picked_up(c="pickup_time") -> Column:
    """As-written delivered test: ``pickup_time != 'null'`` (NULL -> not delivered)."""
    return text_ne(c, "null")


def listed(c) -> Column:
    """As-written "has a list": ``c IS NOT NULL AND LTRIM(RTRIM(c)) NOT IN ('null', ' ')``."""
    cc = F.col(c) if isinstance(c, str) else c
    return cc.isNotNull() & text_not_in(F.trim(cc), "null", " ")


def _delivered(t: DeliveryTables, intended: bool = False) -> DataFrame:
    ro = t.runner_orders
    return ro.filter(has_value("pickup_time") if intended else picked_up())


def _delivered_items(t: DeliveryTables, intended: bool = False, ro_cols: Sequence[str] = ()) -> DataFrame:
    """Items joined to their delivered order row (inner join on order_id, multiplicity kept)."""
    ro = _delivered(t, intended).select("order_id", *ro_cols)
    return t.customer_orders.join(ro, "order_id")


def _km_decimal(c="distance") -> Column:
    """Exact kilometres: sums of them don't depend on the order of the rows."""
    return number_from_text(F.trim(as_col(c))).try_cast("decimal(24,10)")


# ------------------------------------------------------------------ A
def a01_items_ordered(t: DeliveryTables) -> DataFrame:
    return t.customer_orders.agg(F.count("order_id").alias("total_pizzas_ordered"))


def a02_distinct_orders(t: DeliveryTables) -> DataFrame:
    return t.customer_orders.agg(F.countDistinct("order_id").alias("unique_customer_orders"))


def a02_distinct_orders_sketched(t: DeliveryTables) -> DataFrame:
    """A02 from one sketch per order day, united, beside the exact count: whether it lies within three
    standard errors."""
    sketches = daily_sketches(t.customer_orders.withColumn("order_day", F.to_date("order_time")), "order_day", "order_id")
    estimate = distinct_estimate(sketches, "order_day").scalar()
    exact = F.col("unique_customer_orders")
    return a02_distinct_orders(t).select(exact, near(estimate, exact).alias("estimate_holds"))


def a03_delivered_per_runner(t: DeliveryTables) -> DataFrame:
    return (_delivered(t).groupBy("runner_id")
                         .agg(F.count("order_id").alias("delivered_orders"))
                         .orderBy("runner_id"))


def _not_cancelled_items(t: DeliveryTables) -> DataFrame:
    """Items whose order is NOT IN the orders with ``pickup_time = 'null'`` (SQL NULL rules)."""
    cancelled = t.runner_orders.filter(text_eq("pickup_time", "null")).select("order_id")
    return not_in(t.customer_orders, "order_id", cancelled, "order_id")


def a04_delivered_by_type(t: DeliveryTables) -> DataFrame:
    per_pizza = (_not_cancelled_items(t).groupBy("pizza_id")
                 .agg(F.count("pizza_id").alias("n")))
    return (per_pizza.join(t.pizza_names, "pizza_id")
                     .groupBy("pizza_name").agg(F.sum("n").alias("total_pizzas_delivered"))
                     .orderBy("pizza_name"))


def a05a_by_customer_and_type(t: DeliveryTables) -> DataFrame:
    return (t.customer_orders.join(t.pizza_names, "pizza_id")
                 .groupBy("customer_id", "pizza_name").agg(F.count("pizza_id").alias("total_pizzas_ordered"))
                 .orderBy("customer_id", "pizza_name"))


def a05b_by_customer_wide(t: DeliveryTables, pivot_col: str, values: Mapping) -> DataFrame:
    """One column per pivot value; other values of the column are not counted. ``pivot_col`` may live on
    the items or on ``pizza_names`` (left-joined, so a customer of unnamed pizzas still shows, with 0)."""
    items = t.customer_orders
    if pivot_col not in items.columns:
        items = items.join(t.pizza_names.select("pizza_id", pivot_col), "pizza_id", "left")
    out = pivot_counts(items, ["customer_id"], pivot_col, values)
    return out.orderBy("customer_id")


def _delivered_counts_per_order(t: DeliveryTables) -> DataFrame:
    return (_not_cancelled_items(t).groupBy("order_id")
            .agg(F.count("pizza_id").alias("total_pizzas_delivered")))


def a06a_largest_order(t: DeliveryTables) -> DataFrame:
    """TOP (1) by delivered items; ties broken by order_id (the source has no tie-break)."""
    return (_delivered_counts_per_order(t)
            .orderBy(F.desc("total_pizzas_delivered"), "order_id").limit(1))


def a06b_largest_orders_with_ties(t: DeliveryTables) -> DataFrame:
    return top_n_with_ties(_delivered_counts_per_order(t), "total_pizzas_delivered", 1).orderBy("order_id")


def _changes_per_customer(t: DeliveryTables, changed: Column, unchanged: Column, ro: DataFrame) -> DataFrame:
    """Items of both kinds per customer. They are counted side by side, one row per order and customer: a row per
    kind would be more groups in the aggregates and the sort of that stage."""
    items = (t.customer_orders.groupBy("order_id", "customer_id")
             .agg(F.count_if(changed).alias("c"), F.count_if(unchanged).alias("u")))
    return (items.join(ro, "order_id").groupBy("customer_id")
                 .agg(F.sum("c").alias("pizzas_with_changes"), F.sum("u").alias("pizzas_without_changes"))
                 .orderBy("customer_id"))


def a07_changes_per_customer(t: DeliveryTables) -> DataFrame:
    """As written: ``''`` counts as a change and the pickup filter keeps cancelled orders."""
    ex, xt = F.col("exclusions"), F.col("extras")
    changed = (ex.isNotNull() & text_ne(F.trim(ex), "null")) | (xt.isNotNull() & text_ne(F.trim(xt), "null"))
    unchanged = ((ex.isNull() | text_eq(F.trim(ex), "null")) & (xt.isNull() | text_eq(F.trim(xt), "null")))
    pu = F.col("pickup_time")
    ro = t.runner_orders.filter(pu.isNotNull() | text_ne(F.trim(pu), "null")).select("order_id")
    return _changes_per_customer(t, changed, unchanged, ro)


def a07_changes_per_customer_intended(t: DeliveryTables) -> DataFrame:
    """Delivered items only; a change is a real exclusion or extra."""
    changed = has_value("exclusions") | has_value("extras")
    return _changes_per_customer(t, changed, ~changed, _delivered(t, intended=True).select("order_id"))


def a08_exclusions_and_extras(t: DeliveryTables) -> DataFrame:
    items = t.customer_orders.filter(listed("exclusions") & listed("extras"))
    pu = F.col("pickup_time")
    ro = t.runner_orders.filter(pu.isNotNull() & text_ne(F.trim(pu), "null")).select("order_id")
    return items.join(ro, "order_id").agg(F.count("pizza_id").alias("pizzas_with_exclusions_and_extras"))


def a09_by_hour(t: DeliveryTables) -> DataFrame:
    return (t.customer_orders.groupBy(hour_of_day("order_time").alias("order_hour"))
            .agg(F.count("order_id").alias("total_pizzas_ordered"))
            .orderBy("order_hour"))


def a10_by_weekday(t: DeliveryTables) -> DataFrame:
    return (t.customer_orders
            .groupBy(weekday_name("order_time").alias("order_day"), weekday_number("order_time").alias("__dow"))
            .agg(F.count("order_id").alias("total_pizzas_ordered"))
            .orderBy("__dow").drop("__dow"))


# ------------------------------------------------------------------ B
def b01_signups_per_week(t: DeliveryTables) -> DataFrame:
    """Weeks as the source computes them: Monday starts, a Sunday belongs to the next week."""
    return (t.runners.groupBy(week_start_monday("registration_date").alias("signup_week_start"))
            .agg(F.count("runner_id").alias("total_runners_signed_up"))
            .orderBy("signup_week_start"))


def b01_signups_per_week_intended(t: DeliveryTables, anchor: dt.date) -> DataFrame:
    """Weeks that start on ``anchor`` (the question's 2021-01-01) and every 7 days after."""
    return (t.runners.groupBy(week_start_anchored("registration_date", anchor).alias("signup_week_start"))
            .agg(F.count("runner_id").alias("total_runners_signed_up"))
            .orderBy("signup_week_start"))


def b02_pickup_minutes(t: DeliveryTables) -> DataFrame:
    """Mean minutes (boundary count) from order to pickup per runner, one row per order.

    DISTINCT over a join of two projections equals the join of the two
    de-duplicated projections. Both sides are reduced to sets per order, so
    each is shuffled once, by the key that they then join on. Rows without an
    order id, which may be any number, meet no item: their runners only show.
    """
    known = F.col("order_id").isNotNull()
    ro = (_delivered(t).filter(known).groupBy("order_id").agg(F.collect_set(F.struct("runner_id", binary_text("pickup_time").alias("pickup_time"))).alias("__r"))
          .select("order_id", F.inline("__r")))
    times = (t.customer_orders.filter(known).groupBy("order_id").agg(F.collect_set("order_time").alias("__t"))
             .select("order_id", F.explode("__t").alias("order_time")))
    mins = minute_boundaries(F.col("order_time"), parse_timestamp("pickup_time")).cast("double")
    per_order = ro.join(times, "order_id", "left").select("runner_id", mins.alias("mins"))
    rest = _delivered(t).filter(~known).select("runner_id", F.lit(None).cast("double").alias("mins"))
    return (per_order.unionByName(rest).groupBy("runner_id").agg(F.avg("mins").alias("average_pickup_time"))
             .orderBy("runner_id"))


def b03_prep_minutes_by_size(t: DeliveryTables) -> DataFrame:
    """Mean preparation minutes by number of items in the order.

    (The source counts ``a.pizza_id`` on the runner table, which has no such
    column; the items are what it means and what is counted here.)
    """
    items = (t.customer_orders.groupBy("order_id", "order_time")
             .agg(F.count("pizza_id").alias("n")))
    per_order = (items.join(_delivered(t).select("order_id", "pickup_time"), "order_id")
                      .groupBy("order_id", "order_time", "pickup_time")
                      .agg(F.sum("n").alias("pizza_count")))
    prep = minute_boundaries(F.col("order_time"), parse_timestamp("pickup_time"))
    return (per_order.groupBy("pizza_count")
                     .agg(F.avg(prep.cast("double")).alias("average_preparation_time"))
                     .orderBy("pizza_count"))


def b04_distance_per_customer(t: DeliveryTables) -> DataFrame:
    """As written: averaged per item row and scaled by 0.1."""
    items = t.customer_orders.groupBy("order_id", "customer_id").agg(F.count(F.lit(1)).alias("n"))
    j = items.join(_delivered(t).select("order_id", _km_decimal().alias("km")), "order_id")
    # Summed exactly: in doubles the last digits would depend on the order of the tasks.
    total = F.sum(F.col("km") * F.col("n").cast("decimal(10,0)")).cast("double")
    avg = total * F.lit(0.1) / F.sum(F.when(F.col("km").isNotNull(), F.col("n")))
    return (j.groupBy("customer_id").agg(avg.alias("average_distance_km"))
             .orderBy("customer_id"))


def b04_distance_per_customer_intended(t: DeliveryTables) -> DataFrame:
    """Mean kilometres per delivered order (each order once) for each customer."""
    orders = t.customer_orders.select("order_id", "customer_id").distinct()
    j = orders.join(_delivered(t, intended=True).select("order_id", _km_decimal().alias("km")), "order_id")
    mean = F.sum("km").cast("double") / F.count("km")
    return (j.groupBy("customer_id").agg(F.when(F.count("km") > 0, mean).alias("average_distance_km"))
             .orderBy("customer_id"))


def b05_duration_range(t: DeliveryTables) -> DataFrame:
    d = int_from_digits("duration")
    return _delivered(t).agg((F.max(d) - F.min(d)).alias("delivery_time_difference"))


def b06_speeds(t: DeliveryTables) -> DataFrame:
    km = number_from_text(F.trim(F.col("distance")))
    mins = int_from_digits("duration")
    return (_delivered(t)
            .select("runner_id", "order_id", km.alias("distance_km"), mins.alias("delivery_time"),
                    (F.try_divide(km, mins) * 60).cast("double").alias("average_speed_kmh"))
            .orderBy("runner_id", "order_id"))


def b07_success_rate(t: DeliveryTables) -> DataFrame:
    ok = F.sum(F.when(picked_up(), 1).otherwise(0))
    stats = (t.runner_orders.groupBy("runner_id")
             .agg(ok.alias("successful_deliveries"), F.count("order_id").alias("total_orders")))
    pct = F.try_divide(F.col("successful_deliveries").cast("double"), F.col("total_orders")) * 100
    return (stats.select("runner_id", "successful_deliveries", "total_orders",
                         pct.cast("double").alias("successful_delivery_percentage"))
                 .orderBy("runner_id"))


# ------------------------------------------------------------------ C
def c01_recipes(t: DeliveryTables) -> DataFrame:
    """Ingredient list per pizza name, ordered by topping id."""
    ent = recipe_entries(t.pizza_recipes, t.pizza_toppings)
    named = t.pizza_names.select("pizza_id", "pizza_name").join(ent, "pizza_id")
    return string_agg(named, ["pizza_name"], "topping_name", ["topping_id"], out="ingredients").orderBy("pizza_name")


def _list_frequency(t: DeliveryTables, list_col: str, out: str) -> DataFrame:
    freq = token_frequency(t.customer_orders.filter(listed(list_col)), list_col, out="topping_id")
    return (freq.join(t.pizza_toppings, "topping_id")
                .groupBy("topping_name").agg(F.sum("n").alias(out))
                .orderBy(F.desc(out), "topping_name"))


def c02_extras_frequency(t: DeliveryTables) -> DataFrame:
    return _list_frequency(t, "extras", "extra_count")


def c03_exclusions_frequency(t: DeliveryTables) -> DataFrame:
    return _list_frequency(t, "exclusions", "exclusion_count")


def c04_order_item_labels(t: DeliveryTables) -> DataFrame:
    """'Name - Exclude <ids> - Extra <ids>' per item, list texts copied as stored."""
    label = F.concat(
        F.col("pizza_name"),
        F.when(listed("exclusions"), F.concat(F.lit(" - Exclude "), F.col("exclusions"))).otherwise(F.lit("")),
        F.when(listed("extras"), F.concat(F.lit(" - Extra "), F.col("extras"))).otherwise(F.lit("")))
    return (t.customer_orders.join(t.pizza_names, "pizza_id")
            .select("order_id", label.alias("order_item"))
            .orderBy("order_id", "order_item"))


def c04_order_item_labels_intended(t: DeliveryTables) -> DataFrame:
    """Same labels with topping names instead of ids (in list order).

    The id->name rendering runs once per distinct list text, the label's end once per distinct pair of
    lists; the items meet it in one join. Items without a list (most of them) are spread over that join
    by their order, as they match nothing.
    """
    co = t.customer_orders
    lists = [F.when(has_value(c), F.col(c)).alias(c) for c in ("exclusions", "extras")]
    any_list = F.col("exclusions").isNotNull() | F.col("extras").isNotNull()
    pairs = co.select(*lists).filter(any_list).distinct()
    texts = pairs.select(F.explode(F.array("exclusions", "extras")).alias("txt")).filter("txt is not null")
    labels = labelled_tokens(texts, "txt", t.pizza_toppings)
    ex = labels.select(F.col("txt").alias("exclusions"), F.col("label").alias("ex_label"))
    xt = labels.select(F.col("txt").alias("extras"), F.col("label").alias("xt_label"))

    def part(c: str, word: str, label: str) -> Column:
        return F.when(F.col(c).isNotNull(), F.concat(F.lit(word), F.coalesce(label, F.lit("")))).otherwise(F.lit(""))

    ends = pairs.join(ex, "exclusions", "left").join(xt, "extras", "left").select(
        "exclusions", "extras", F.lit(None).cast("string").alias("spread"),
        F.concat(part("exclusions", " - Exclude ", "ex_label"), part("extras", " - Extra ", "xt_label")).alias("end"))
    items = co.join(t.pizza_names, "pizza_id").select("order_id", "pizza_name", *lists)
    items = items.withColumn("spread", F.when(~any_list, F.coalesce(F.col("order_id").cast("string"), F.lit(""))))
    j = null_safe_join(items, ends, ["exclusions", "extras", "spread"], "left")
    return (j.select("order_id", F.concat(binary_text("pizza_name"), F.coalesce("end", F.lit(""))).alias("order_item"))
             .orderBy("order_id", "order_item"))


def c05_ingredient_lists(t: DeliveryTables) -> DataFrame:
    """As written: one list per (order, pizza name); an extra of any item in the order doubles the
    ingredient for every item of the order, and each matching extra row repeats it.

    Built from bounded pieces instead of exploding item x ingredient rows:
    items are counted once per (order, pizza, extras text); each pizza's recipe is one sorted
    array (recipe-sized); each order's extras are one map topping -> rows
    (at most one entry per topping). The final group per (order, name) only
    merges the rows of pizzas sharing that name. It is sorted once for the
    extras and twice for the group, so its rows hold no text but the name: the
    recipe as positions in the dictionary, and how often each was asked for.
    ``(label, repeats)`` per ingredient are made where the finished list is.
    Both reads of the counts keep all their columns, so the items are scanned
    and shuffled once.
    """
    counts = t.customer_orders.groupBy("order_id", "pizza_id", "extras").agg(F.count(F.lit(1)).alias("n"))
    items = counts.groupBy("order_id", "pizza_id").agg(F.sum("n").alias("n_items"))
    # per order: its extras texts with their row counts (bounded by the variants of one order), turned
    # in-row into topping id -> rows
    texts = counts.groupBy("order_id").agg(F.collect_list(
        F.when(listed("extras"), F.struct("extras", "n"))).alias("__t")).filter(F.size("__t") > 0)
    pairs = F.flatten(F.transform("__t", lambda e: F.transform(
        int_tokens(e["extras"]), lambda i: F.struct(i.alias("id"), e["n"].alias("n")))))
    extras = texts.select("order_id", pairs.alias("__p")).select(
        "order_id", F.map_from_arrays(
            F.array_distinct(F.transform("__p", lambda p: p["id"])),
            F.transform(F.array_distinct(F.transform("__p", lambda p: p["id"])),
                        lambda d: F.aggregate(F.filter("__p", lambda p: p["id"] == d), F.lit(0).cast("bigint"),
                                              lambda acc, p: acc + p["n"]))).alias("xmap"))
    dictionary = topping_dictionary(t.pizza_toppings)
    if dictionary is not None:
        recipe = recipe_positions(recipe_arrays(t.pizza_recipes, dictionary), dictionary)
    else:
        ent = recipe_entries(t.pizza_recipes, t.pizza_toppings)
        recipe = ent.groupBy("pizza_id").agg(F.collect_list(F.struct(
            F.lower("topping_name").alias("k0"), F.col("topping_name").alias("k1"), F.col("topping_id").alias("id"))
        ).alias("recipe"))
    recipe = recipe.filter(F.size("recipe") > 0)  # a recipe without a known topping joins nothing
    menu = t.pizza_names.select("pizza_id", "pizza_name").join(recipe, "pizza_id")  # pizza grain
    # NULL-safe only so that no IS NOT NULL reaches one scan of the items and not the other.
    j = null_safe_join(items, menu.filter("pizza_id is not null"), ["pizza_id"]).join(extras, "order_id", "left")

    def with_dictionary(df: DataFrame) -> DataFrame:
        return df if dictionary is None else df.withColumn("__d", dictionary)

    def known(x: Column) -> Column:
        return x if dictionary is None else F.get(F.col("__d"), x)

    def entry(x, n_items, e):
        label = F.when(e.isNotNull(), F.concat(F.lit("2x"), x["k1"])).otherwise(x["k1"])
        return F.struct(x["k0"].alias("k0"), x["k1"].alias("k1"), label.alias("label"),
                        (n_items * F.coalesce(e, F.lit(1))).alias("n"))

    times = F.when(F.col("xmap").isNotNull(), F.transform("recipe", lambda x: F.try_element_at(F.col("xmap"), known(x)["id"])))
    per_row = with_dictionary(j).select("order_id", "pizza_name", F.struct("n_items", "recipe", times.alias("times")).alias("__row"))
    groups = per_row.groupBy("order_id", "pizza_name").agg(F.collect_list("__row").alias("__rows"))
    merged = F.array_sort(F.flatten(F.transform("__rows", lambda g: F.transform(
        g["recipe"], lambda x, i: entry(known(x), g["n_items"], F.get(g["times"], i))))))
    return (with_dictionary(groups)
            .select("order_id", F.concat(F.col("pizza_name"), F.lit(": "), repeat_join(merged)).alias("ingredient_list"))
            .orderBy("order_id", "ingredient_list"))


def _variant_lists(t: DeliveryTables, variants: DataFrame) -> DataFrame:
    """Per variant key with at least one ingredient, the alphabetical list with 'Nx' above one."""
    rid = recipe_entries(t.pizza_recipes, t.pizza_toppings, match="int").select("pizza_id", "topping_id")
    qty = variant_quantities(variants, rid, VARIANT)
    named = qty.join(t.pizza_toppings, "topping_id")
    label = F.when(F.col("qty") > 1, F.concat(F.col("qty").cast("string"), F.lit("x"), F.col("topping_name"))) \
             .otherwise(F.col("topping_name"))
    return named.groupBy(*VARIANT).agg(
        ordered_concat(label, F.lower("topping_name"), F.col("topping_name")).alias("__list"))


def _known_recipes(t: DeliveryTables, dictionary: Column) -> DataFrame:
    return recipe_arrays(t.pizza_recipes, dictionary, match="int")


def _net() -> Column:
    """What an item (or variant) with a ``recipe`` array and the ``dictionary`` uses, by its texts of exclusions and extras."""
    dictionary = F.col("dictionary")
    none = F.filter(dictionary, lambda e: F.lit(False))
    return net_quantities(dictionary, F.coalesce("recipe", none), int_tokens(null_token("exclusions"), distinct=True),
                          int_tokens(null_token("extras")))


def c05_ingredient_lists_intended(t: DeliveryTables) -> DataFrame:
    """One list per item: recipe minus exclusions plus extras ('2xBacon' when doubled).

    Each pizza carries its recipe as one array in the alphabetical order of the
    toppings and its plain list; the items are scanned once and meet it in one
    join. Items with changes get their list by arithmetic on those arrays, the
    others the plain one (an item with no ingredient left gets an empty list).
    Beyond ``DICTIONARY_ROWS`` toppings the lists are computed per distinct
    variant by joins.
    """
    dictionary = topping_dictionary(t.pizza_toppings)
    if dictionary is None:
        return _c05_intended_by_variant(t)
    menu = t.pizza_names.select("pizza_id", "pizza_name").join(_known_recipes(t, dictionary), "pizza_id", "left")
    menu = menu.withColumn("plain", F.coalesce(F.array_join(F.col("recipe.k1"), ", "), F.lit("")))
    changed = null_token("exclusions").isNotNull() | null_token("extras").isNotNull()
    text = F.when(changed, quantity_list(_net())).otherwise(F.col("plain"))
    return (t.customer_orders.select("order_id", *VARIANT).join(menu, "pizza_id").withColumn("dictionary", dictionary)
             .select("order_id", F.concat(binary_text("pizza_name"), F.lit(": "), text).alias("ingredient_list"))
             .orderBy("order_id", "ingredient_list"))


def _c05_intended_by_variant(t: DeliveryTables) -> DataFrame:
    """The same lists for a dimension of toppings of any size, once per distinct variant."""
    co = t.customer_orders
    variants = co.select(*VARIANT).distinct()
    named = variants.join(t.pizza_names.select("pizza_id", "pizza_name"), "pizza_id")  # variant grain
    labelled = null_safe_join(named, _variant_lists(t, variants), VARIANT, "left").select(
        *VARIANT, F.concat(F.col("pizza_name"), F.lit(": "), F.coalesce(F.col("__list"), F.lit("")))
        .alias("ingredient_list"))
    return (null_safe_join(co.select("order_id", *VARIANT), labelled, VARIANT)
            .select("order_id", "ingredient_list").orderBy("order_id", "ingredient_list"))


def c06_ingredient_totals(t: DeliveryTables) -> DataFrame:
    """As written: recipe ingredients of delivered items (exclusions and extras ignored)."""
    per_pizza = _delivered_items(t).groupBy("pizza_id").agg(F.count(F.lit(1)).alias("n"))
    ent = recipe_entries(t.pizza_recipes, t.pizza_toppings).select("pizza_id", "topping_id")
    return (per_pizza.join(ent, "pizza_id").join(t.pizza_toppings, "topping_id")
            .groupBy("topping_name").agg(F.sum("n").alias("total_quantity"))
            .orderBy(F.desc("total_quantity"), "topping_name"))


def c06_ingredient_totals_intended(t: DeliveryTables) -> DataFrame:
    """Ingredients actually used by delivered items: recipe - exclusions + extras.

    Items are counted per variant; what a variant uses is arithmetic on its
    recipe's array, and only the quantities that are left become rows.
    """
    variants = (_delivered_items(t, intended=True).groupBy(*VARIANT).agg(F.count(F.lit(1)).alias("n")))
    dictionary = topping_dictionary(t.pizza_toppings)
    if dictionary is None:
        rid = recipe_entries(t.pizza_recipes, t.pizza_toppings, match="int").select("pizza_id", "topping_id")
        qty = variant_quantities(variants, rid, VARIANT, carry=["n"])
        used = qty.select("topping_id", (F.col("qty") * F.col("n")).alias("q")).join(t.pizza_toppings, "topping_id")
    else:
        recipes = _known_recipes(t, dictionary)
        used = (variants.join(recipes, "pizza_id", "left").withColumn("dictionary", dictionary)
                        .select("n", F.inline(_net()))
                        .select(F.col("k1").alias("topping_name"), (F.col("qty") * F.col("n")).alias("q")))
    return (used.groupBy("topping_name").agg(F.sum("q").alias("total_quantity"))
                .orderBy(F.desc("total_quantity"), "topping_name"))


# ------------------------------------------------------------------ D
def d01_revenue(t: DeliveryTables, price_col: str, prices: Mapping) -> DataFrame:
    per_pizza = _delivered_items(t).groupBy("pizza_id").agg(F.count(F.lit(1)).alias("n"))
    price = price_map(price_col, prices)
    return (per_pizza.join(t.pizza_names, "pizza_id")
            .agg(F.sum(price * F.col("n")).alias("total_revenue")))


def d02_revenue_with_extras(t: DeliveryTables, price_col: str, prices: Mapping, fee: int = 1) -> DataFrame:
    """As written: +fee per item that has any extra."""
    per_pizza = (_delivered_items(t).groupBy("pizza_id", listed("extras").alias("x"))
                 .agg(F.count(F.lit(1)).alias("n")))
    charge = price_map(price_col, prices) + F.when(F.col("x"), F.lit(fee)).otherwise(F.lit(0))
    return (per_pizza.join(t.pizza_names, "pizza_id")
            .agg(F.sum(charge * F.col("n")).alias("total_revenue_with_extras")))


def d02_revenue_with_extras_intended(t: DeliveryTables, price_col: str, prices: Mapping,
                                     fee: int = 1) -> DataFrame:
    """+fee per extra topping (a list of two extras pays twice)."""
    per_pizza = (_delivered_items(t, intended=True)
                 .groupBy("pizza_id", token_count(F.when(has_value("extras"), F.col("extras"))).alias("x"))
                 .agg(F.count(F.lit(1)).alias("n")))
    charge = price_map(price_col, prices) + F.col("x") * F.lit(fee)
    return (per_pizza.join(t.pizza_names, "pizza_id")
            .agg(F.sum(charge * F.col("n")).alias("total_revenue_with_extras")))


def d03_ratings(t: DeliveryTables) -> DataFrame:
    """The ratings table to be written (see :func:`tillroll.sources.sinks.overwrite_table`)."""
    return t.customer_ratings.select("order_id", "customer_id", "runner_id", "rating")


def _report(t: DeliveryTables, customer_from_orders: bool, intended: bool) -> DataFrame:
    co, cr = t.customer_orders, t.customer_ratings
    item_keys = ["order_id", "order_time"] + (["customer_id"] if customer_from_orders else [])
    items = co.groupBy(*item_keys).agg(F.count("pizza_id").alias("n"))
    ro = _delivered(t, intended).select("order_id", "pickup_time", "duration", "distance")
    rat = cr.select("order_id", "runner_id", "rating",
                    *([] if customer_from_orders else ["customer_id"]))
    j = rat.join(items, "order_id").join(ro, "order_id")
    keys = ["customer_id", "order_id", "runner_id", "rating", "order_time", "pickup_time", "duration", "distance"]
    g = j.groupBy(*keys).agg(F.sum("n").alias("total_number_of_pizzas"))
    km = number_from_text(F.trim(F.col("distance")))
    speed = F.try_divide(km, double_from_digits("duration")) * 60
    return (g.select("customer_id", "order_id", "runner_id", "rating", "order_time", "pickup_time",
                     minute_boundaries(F.col("order_time"), parse_timestamp("pickup_time"))
                     .alias("time_between_order_and_pickup"),
                     "duration", speed.cast("double").alias("average_speed_kmh"), "total_number_of_pizzas")
             .orderBy("order_id", "customer_id"))


def d04_delivery_report(t: DeliveryTables) -> DataFrame:
    """As written: customer_id comes from the ratings table."""
    return _report(t, customer_from_orders=False, intended=False)


def d04_delivery_report_intended(t: DeliveryTables) -> DataFrame:
    """customer_id taken from the orders the items belong to."""
    return _report(t, customer_from_orders=True, intended=True)


def _profit(revenue: Column, km: Column, rate: float) -> Column:
    return (revenue - km.cast("decimal(30,10)") * F.lit(Decimal(str(rate)))).cast("double")


def d05_profit(t: DeliveryTables, price_col: str, prices: Mapping, rate: float = 0.30) -> DataFrame:
    """As written: the order's distance is paid once per item (join fan-out). Money is summed in decimal."""
    per_pizza = (_delivered_items(t, ro_cols=["distance"]).groupBy("pizza_id")
                 .agg(F.count(F.lit(1)).alias("n"), F.sum(_km_decimal()).alias("km")))
    j = per_pizza.join(t.pizza_names, "pizza_id")
    return j.agg(_profit(F.sum(price_map(price_col, prices) * F.col("n")), F.sum("km"), rate).alias("total_profit"))


def d05_profit_intended(t: DeliveryTables, price_col: str, prices: Mapping, rate: float = 0.30) -> DataFrame:
    """Revenue per item, distance paid once per delivered order with an item on the menu.

    An order counts if any of its pizzas is on the menu: items meet one row per
    menu id, and each order's revenue meets its runner rows. The items are not
    counted per (order, pizza) before: an order seldom repeats a pizza, so that
    would hold every item in two more maps of the stage that joins them.
    """
    delivered = _delivered(t, intended=True).select("order_id", _km_decimal().alias("km"))
    menu = t.pizza_names.groupBy("pizza_id").agg(F.sum(price_map(price_col, prices)).alias("price"))
    priced = t.customer_orders.select("order_id", "pizza_id").join(menu, "pizza_id")
    per_order = priced.groupBy("order_id").agg(F.sum("price").alias("rev"))
    j = per_order.join(delivered, "order_id")
    return j.agg(_profit(F.sum("rev"), F.sum("km"), rate).alias("total_profit"))


# ------------------------------------------------------------------ E
def _new_pizza_id(t: DeliveryTables, new_id: int | None) -> Column:
    if new_id is not None:
        return F.lit(new_id).cast(t.pizza_names.schema["pizza_id"].dataType)
    return t.pizza_names.agg(F.max("pizza_id") + 1).scalar()


def next_pizza_id(t: DeliveryTables) -> int:
    """One above the largest id of the names table."""
    return (t.pizza_names.agg(F.max("pizza_id")).first()[0] or 0) + 1


def e02_new_pizza(t: DeliveryTables, name: str, new_id: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Both inserts of a new pizza (names and recipes tables) under one id, which is read once, here:
    writing the first table can't change the id of the second."""
    new_id = next_pizza_id(t) if new_id is None else new_id
    return e02_new_pizza_name(t, name, new_id), e02_new_pizza_recipe(t, new_id)


def e02_new_pizza_name(t: DeliveryTables, name: str, new_id: int | None = None) -> DataFrame:
    """The names table after inserting a pizza called ``name`` (id ``new_id`` or one above the largest)."""
    return t.pizza_names.unionByName(e02_name_row(t, name, new_id))


def e02_name_row(t: DeliveryTables, name: str, new_id: int | None = None) -> DataFrame:
    """The row that the names table gains."""
    names = t.pizza_names
    pid = F.max("pizza_id") + 1 if new_id is None else F.lit(new_id)
    row = names.agg(pid.cast(names.schema["pizza_id"].dataType).alias("pizza_id"))
    return row.select("pizza_id", F.lit(name).alias("pizza_name"),
                      *[F.lit(None).cast(f.dataType).alias(f.name) for f in names.schema.fields
                        if f.name not in ("pizza_id", "pizza_name")])


def e02_new_pizza_recipe(t: DeliveryTables, new_id: int | None = None) -> DataFrame:
    """The recipes table after inserting the new pizza with every topping ('1,2,...' by id)."""
    return t.pizza_recipes.select("pizza_id", "toppings").unionByName(e02_recipe_row(t, new_id))


def e02_recipe_row(t: DeliveryTables, new_id: int | None = None) -> DataFrame:
    """The row that the recipes table gains.

    The new list is one group over the toppings dimension, a fixed-size table
    (12 toppings in the case study, the 25 nations in the testdata).
    """
    every = t.pizza_toppings.agg(
        ordered_concat(F.col("topping_id").cast("string"), F.col("topping_id"), sep=",").alias("toppings"))
    return every.select(_new_pizza_id(t, new_id).alias("pizza_id"), "toppings")
