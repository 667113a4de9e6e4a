"""Tables whose text columns are declared with the server's collation."""

import datetime as dt
from dataclasses import replace

import pytest

from tests import seed
from tillroll.plans import delivery as P
from tillroll.sources.tables import collated

NAME_PRICES = {"Meatlovers": 12, "Vegetarian": 10}
QUERIES = {
    "a01": P.a01_items_ordered, "a02": P.a02_distinct_orders, "a03": P.a03_delivered_per_runner, "a04": P.a04_delivered_by_type,
    "a05a": P.a05a_by_customer_and_type, "a05b": lambda t: P.a05b_by_customer_wide(t, "pizza_name", {"Meatlovers": "m", "Vegetarian": "v"}),
    "a06a": P.a06a_largest_order, "a06b": P.a06b_largest_orders_with_ties, "a07": P.a07_changes_per_customer,
    "a07i": P.a07_changes_per_customer_intended, "a08": P.a08_exclusions_and_extras, "a09": P.a09_by_hour, "a10": P.a10_by_weekday,
    "b01": P.b01_signups_per_week, "b02": P.b02_pickup_minutes, "b03": P.b03_prep_minutes_by_size, "b04": P.b04_distance_per_customer,
    "b04i": P.b04_distance_per_customer_intended, "b05": P.b05_duration_range, "b06": P.b06_speeds, "b07": P.b07_success_rate,
    "c01": P.c01_recipes, "c02": P.c02_extras_frequency, "c03": P.c03_exclusions_frequency, "c04": P.c04_order_item_labels,
    "c04i": P.c04_order_item_labels_intended, "c05": P.c05_ingredient_lists, "c05i": P.c05_ingredient_lists_intended,
    "c06": P.c06_ingredient_totals, "c06i": P.c06_ingredient_totals_intended,
    "d01": lambda t: P.d01_revenue(t, "pizza_name", NAME_PRICES), "d02": lambda t: P.d02_revenue_with_extras(t, "pizza_name", NAME_PRICES),
    "d02i": lambda t: P.d02_revenue_with_extras_intended(t, "pizza_name", NAME_PRICES), "d04": P.d04_delivery_report,
    "d05": lambda t: P.d05_profit(t, "pizza_name", NAME_PRICES), "d05i": lambda t: P.d05_profit_intended(t, "pizza_name", NAME_PRICES),
}


@pytest.fixture(scope="module")
def plain(spark):
    return seed.delivery(spark)


@pytest.mark.parametrize("key", QUERIES)
def test_same_answers_on_the_seed(plain, key):
    rows = lambda t: sorted((tuple(r) for r in QUERIES[key](t).collect()), key=repr)
    assert rows(collated(plain)) == rows(plain)


@pytest.fixture(scope="module")
def mixed(spark, plain):
    """Two spellings of one name on two pizzas, upper-case markers, a recipe and toppings of mixed case."""
    time = dt.datetime(2020, 2, 1, 12)
    items = [(11, 101, 1, "NULL", "Null ", time), (11, 101, 3, "", "1", time), (12, 102, 3, "4", None, time), (12, 102, 2, "", "", time)]
    runs = [(11, 1, "2020-02-01 12:15:00", "20KM", "30 MINUTES", "NULL"), (12, 2, "NULL ", "null", "null", "x")]
    make = spark.createDataFrame
    return collated(replace(
        plain, customer_orders=make(items, plain.customer_orders.schema), runner_orders=make(runs, plain.runner_orders.schema),
        pizza_names=make([(1, "Meatlovers"), (2, "Vegetarian"), (3, "MEATLOVERS ")], plain.pizza_names.schema),
        pizza_recipes=make([(1, "1, 2"), (2, "4"), (3, "2")], plain.pizza_recipes.schema)))


def folded(df):
    return sorted(tuple(x.lower().rstrip() if isinstance(x, str) else x for x in r) for r in df.collect())


def test_group_by_merges_spellings(mixed):
    assert folded(P.a04_delivered_by_type(mixed)) == [("meatlovers", 2)]  # 'NULL ' is the marker, too
    assert folded(P.a05a_by_customer_and_type(mixed)) == [(101, "meatlovers", 2), (102, "meatlovers", 1), (102, "vegetarian", 1)]
    assert folded(P.c01_recipes(mixed)) == [("meatlovers", "bacon, bbq sauce, bbq sauce"), ("vegetarian", "cheese")]


def test_price_names_and_joins_ignore_case(mixed, spark):
    assert P.d01_revenue(mixed, "pizza_name", NAME_PRICES).first()[0] == 24
    assert P.d02_revenue_with_extras(mixed, "pizza_name", {"meatLOVERS": 12}).first()[0] == 25
    assert folded(P.a05b_by_customer_wide(mixed, "pizza_name", {"Meatlovers": "m", "Vegetarian": "v"})) == [(101, 2, 0), (102, 1, 1)]
    other = collated_names(spark)
    assert mixed.pizza_names.join(other, "pizza_name").count() == 2


def collated_names(spark):
    from pyspark.sql import functions as F
    return spark.createDataFrame([("meatlovers",)], "pizza_name string").select(F.collate("pizza_name", "UTF8_LCASE_RTRIM").alias("pizza_name"))


def test_measures_are_read_under_the_collation(mixed):
    assert [tuple(r) for r in P.b06_speeds(mixed).collect()] == [(1, 11, 20.0, 30, 40.0)]
    assert P.a07_changes_per_customer_intended(mixed).collect()[0].pizzas_with_changes == 1
