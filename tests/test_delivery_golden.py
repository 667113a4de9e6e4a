"""Tier 1: delivery queries on the seed rows vs the FIXTURES goldens, as written and intended."""

import datetime as dt

import pytest

from tests import seed
from tillroll.plans import delivery as P

D = dt.date
TS = dt.datetime.fromisoformat


@pytest.fixture(scope="module")
def t(spark):
    return seed.delivery(spark)


def rows(df):
    """The rows, with doubles at the six decimals of the golden answers (plans don't round)."""
    return [tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect()]


def test_a01_a02(t):
    assert rows(P.a01_items_ordered(t)) == [(14,)]
    assert rows(P.a02_distinct_orders(t)) == [(10,)]


def test_a03(t):
    assert rows(P.a03_delivered_per_runner(t)) == [(1, 4), (2, 3), (3, 1)]


def test_a04(t):
    assert rows(P.a04_delivered_by_type(t)) == [("Meatlovers", 9), ("Vegetarian", 3)]


def test_a05a_long_has_no_zero_rows(t):
    assert rows(P.a05a_by_customer_and_type(t)) == [
        (101, "Meatlovers", 2), (101, "Vegetarian", 1), (102, "Meatlovers", 2), (102, "Vegetarian", 1),
        (103, "Meatlovers", 3), (103, "Vegetarian", 1), (104, "Meatlovers", 3), (105, "Vegetarian", 1)]


def test_a05b_wide(t):
    out = P.a05b_by_customer_wide(t, "pizza_id", seed.PIVOT)
    assert out.columns == ["customer_id", "Meatlovers", "Vegetarian"]
    assert rows(out) == [(101, 2, 1), (102, 2, 1), (103, 3, 1), (104, 3, 0), (105, 0, 1)]


def test_a05b_pivot_on_names_column(t):
    out = P.a05b_by_customer_wide(t, "pizza_name", {"Meatlovers": "Meatlovers", "Vegetarian": "Vegetarian"})
    assert rows(out) == [(101, 2, 1), (102, 2, 1), (103, 3, 1), (104, 3, 0), (105, 0, 1)]


def test_a06(t):
    assert rows(P.a06a_largest_order(t)) == [(4, 3)]
    assert rows(P.a06b_largest_orders_with_ties(t)) == [(4, 3)]


def test_a07_as_written_and_intended(t):
    assert rows(P.a07_changes_per_customer(t)) == [(101, 2, 1), (102, 2, 1), (103, 4, 0), (104, 2, 1), (105, 1, 0)]
    assert rows(P.a07_changes_per_customer_intended(t)) == [
        (101, 0, 2), (102, 0, 3), (103, 3, 0), (104, 2, 1), (105, 1, 0)]


def test_a08(t):
    assert rows(P.a08_exclusions_and_extras(t)) == [(1,)]


def test_a09(t):
    assert rows(P.a09_by_hour(t)) == [(11, 1), (13, 3), (18, 3), (19, 1), (21, 3), (23, 3)]


def test_a10(t):
    assert rows(P.a10_by_weekday(t)) == [("Wednesday", 5), ("Thursday", 3), ("Friday", 1), ("Saturday", 5)]


def test_b01(t):
    assert rows(P.b01_signups_per_week(t)) == [(D(2020, 12, 28), 1), (D(2021, 1, 4), 2), (D(2021, 1, 11), 1)]
    assert rows(P.b01_signups_per_week_intended(t, seed.WEEK_ANCHOR)) == [
        (D(2021, 1, 1), 2), (D(2021, 1, 8), 1), (D(2021, 1, 15), 1)]


def test_b02_minute_boundaries(t):
    assert rows(P.b02_pickup_minutes(t)) == [(1, 14.25), (2, 20.333333), (3, 10.0)]


def test_b03(t):
    assert rows(P.b03_prep_minutes_by_size(t)) == [(1, 12.2), (2, 18.5), (3, 30.0)]


def test_b04(t):
    assert rows(P.b04_distance_per_customer(t)) == [(101, 2.0), (102, 1.673333), (103, 2.34), (104, 1.0),
                                                    (105, 2.5)]
    assert rows(P.b04_distance_per_customer_intended(t)) == [(101, 20.0), (102, 18.4), (103, 23.4), (104, 10.0),
                                                             (105, 25.0)]


def test_b05(t):
    assert rows(P.b05_duration_range(t)) == [(30,)]


def test_b06(t):
    got = {r[1]: r[4] for r in rows(P.b06_speeds(t))}
    assert got == {1: 37.5, 2: 44.444444, 3: 40.2, 10: 60.0, 4: 35.1, 7: 60.0, 8: 93.6, 5: 40.0}
    assert [r[:2] for r in rows(P.b06_speeds(t))] == [(1, 1), (1, 2), (1, 3), (1, 10), (2, 4), (2, 7), (2, 8), (3, 5)]


def test_b07(t):
    assert rows(P.b07_success_rate(t)) == [(1, 4, 4, 100.0), (2, 3, 4, 75.0), (3, 1, 2, 50.0)]


def test_c01(t):
    assert rows(P.c01_recipes(t)) == [
        ("Meatlovers", "Bacon, BBQ Sauce, Beef, Cheese, Chicken, Mushrooms, Pepperoni, Salami"),
        ("Vegetarian", "Cheese, Mushrooms, Onions, Peppers, Tomatoes, Tomato Sauce")]


def test_c02_c03(t):
    assert rows(P.c02_extras_frequency(t)) == [("Bacon", 4), ("Cheese", 1), ("Chicken", 1)]
    assert rows(P.c03_exclusions_frequency(t)) == [("Cheese", 4), ("BBQ Sauce", 1), ("Mushrooms", 1)]


def test_c04(t):
    got = rows(P.c04_order_item_labels(t))
    assert len(got) == 14
    assert [x for o, x in got if o == 4] == ["Meatlovers - Exclude 4"] * 2 + ["Vegetarian - Exclude 4"]
    assert [x for o, x in got if o == 9] == ["Meatlovers - Exclude 4 - Extra 1, 5"]
    assert [x for o, x in got if o == 10] == ["Meatlovers", "Meatlovers - Exclude 2, 6 - Extra 1, 4"]
    assert [x for o, x in got if o == 3] == ["Meatlovers", "Vegetarian"]
    assert [x for o, x in got if o == 6] == ["Vegetarian"]


def test_c04_intended(t):
    got = rows(P.c04_order_item_labels_intended(t))
    assert [x for o, x in got if o == 10] == ["Meatlovers", "Meatlovers - Exclude BBQ Sauce, Mushrooms - Extra Bacon, Cheese"]
    assert [x for o, x in got if o == 9] == ["Meatlovers - Exclude Cheese - Extra Bacon, Chicken"]


M = ["Bacon", "BBQ Sauce", "Beef", "Cheese", "Chicken", "Mushrooms", "Pepperoni", "Salami"]
V = ["Cheese", "Mushrooms", "Onions", "Peppers", "Tomato Sauce", "Tomatoes"]


def lst(name, items):
    return f"{name}: " + ", ".join(items)


def test_c05_as_written(t):
    got = rows(P.c05_ingredient_lists(t))
    assert len(got) == 12
    by = {}
    for o, x in got:
        by.setdefault(o, []).append(x)
    m, v = lst("Meatlovers", M), lst("Vegetarian", V)
    assert by[1] == [m] and by[2] == [m] and by[8] == [m]
    assert by[3] == [m, v]
    assert by[6] == [v] and by[7] == [v]
    assert sorted(by[4]) == [lst("Meatlovers", [x for x in M for _ in (0, 1)]), v]
    assert by[5] == [lst("Meatlovers", ["2xBacon"] + M[1:])]
    assert by[9] == [lst("Meatlovers", ["2xBacon", "BBQ Sauce", "Beef", "Cheese", "2xChicken", "Mushrooms",
                                        "Pepperoni", "Salami"])]
    ten = []
    for x in M:
        if x in ("Bacon", "Cheese"):
            ten += [f"2x{x}"] * 2
        else:
            ten += [x, x]
    assert by[10] == [lst("Meatlovers", ten)]


def test_c05_intended(t):
    got = rows(P.c05_ingredient_lists_intended(t))
    assert len(got) == 14
    by = {}
    for o, x in got:
        by.setdefault(o, []).append(x)
    no_cheese = [x for x in M if x != "Cheese"]
    assert sorted(by[4]) == sorted([lst("Meatlovers", no_cheese)] * 2 + [lst("Vegetarian", [x for x in V if x != "Cheese"])])
    assert by[5] == [lst("Meatlovers", ["2xBacon"] + M[1:])]
    assert by[7] == [lst("Vegetarian", ["Bacon"] + V)]
    assert by[9] == [lst("Meatlovers", ["2xBacon", "BBQ Sauce", "Beef", "2xChicken", "Mushrooms", "Pepperoni", "Salami"])]
    assert sorted(by[10]) == sorted([lst("Meatlovers", M),
                                     lst("Meatlovers", ["2xBacon", "Beef", "2xCheese", "Chicken", "Pepperoni", "Salami"])])


def test_c06(t):
    got = dict(rows(P.c06_ingredient_totals(t)))
    assert got == {"Cheese": 12, "Mushrooms": 12, "BBQ Sauce": 9, "Bacon": 9, "Beef": 9, "Chicken": 9,
                   "Pepperoni": 9, "Salami": 9, "Onions": 3, "Peppers": 3, "Tomato Sauce": 3, "Tomatoes": 3}
    assert [r[0] for r in rows(P.c06_ingredient_totals(t))][:2] == ["Cheese", "Mushrooms"]


def test_c06_intended(t):
    got = dict(rows(P.c06_ingredient_totals_intended(t)))
    assert got == {"Bacon": 12, "Mushrooms": 11, "Cheese": 10, "Beef": 9, "Chicken": 9, "Pepperoni": 9,
                   "Salami": 9, "BBQ Sauce": 8, "Onions": 3, "Peppers": 3, "Tomato Sauce": 3, "Tomatoes": 3}


def test_d01_d02(t):
    assert rows(P.d01_revenue(t, "pizza_name", seed.PRICES)) == [(138,)]
    assert rows(P.d02_revenue_with_extras(t, "pizza_name", seed.PRICES)) == [(141,)]
    assert rows(P.d02_revenue_with_extras_intended(t, "pizza_name", seed.PRICES)) == [(142,)]


def test_d03(t):
    assert P.d03_ratings(t).count() == 8


def test_d04(t):
    got = rows(P.d04_delivery_report(t))
    assert len(got) == 8
    by = {r[1]: (r[6], r[7], r[8], r[9]) for r in got}
    assert by == {1: (10, "32 minutes", 37.5, 1), 2: (10, "27 minutes", 44.444444, 1), 3: (21, "20 mins", 40.2, 2),
                  4: (30, "40", 35.1, 3), 5: (10, "15", 40.0, 1), 7: (10, "25mins", 60.0, 1),
                  8: (21, "15 minute", 93.6, 1), 10: (16, "10minutes", 60.0, 2)}
    assert {r[1]: r[0] for r in got} == {1: 1, 2: 1, 3: 1, 4: 2, 5: 3, 7: 2, 8: 2, 10: 1}
    assert got[0][4] == TS("2020-01-01 18:05:02") and got[0][5] == "2020-01-01 18:15:34"


def test_d04_intended(t):
    got = rows(P.d04_delivery_report_intended(t))
    assert [r[0] for r in got] == [101, 101, 102, 103, 104, 105, 102, 104]


def test_d05(t):
    assert rows(P.d05_profit(t, "pizza_name", seed.PRICES)) == [(73.38,)]
    assert rows(P.d05_profit_intended(t, "pizza_name", seed.PRICES)) == [(94.44,)]


def test_e02(t):
    names = rows(P.e02_new_pizza_name(t, "Supreme", 3))
    assert names == [(1, "Meatlovers"), (2, "Vegetarian"), (3, "Supreme")]
    rec = rows(P.e02_new_pizza_recipe(t, 3))
    assert rec[-1] == (3, "1,2,3,4,5,6,7,8,9,10,11,12")
    # default id: one above the largest
    assert rows(P.e02_new_pizza_name(t, "Supreme"))[-1] == (3, "Supreme")
