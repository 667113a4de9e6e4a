"""The list queries' two ways, dictionary arithmetic and joins, against brute force on random lists."""

import random
from collections import Counter
from types import SimpleNamespace

import pytest

from tillroll.operators import lists
from tillroll.plans import delivery as P

TOPPINGS = [(1, "Bacon"), (2, "beef"), (3, "Cheese"), (4, "BBQ"), (5, "cheese"), (7, "Ham")]
LISTS = [None, "", "null", " ", "1", "1, 5", "2,2", "9", "4, 1, 1", "x, 3", "03", "7 , 2"]


def tables(spark, seed, n=150):
    r = random.Random(seed)
    items = [(r.randint(1, 30), r.choice([1, 2, 3, 4, None]), r.choice(LISTS), r.choice(LISTS)) for _ in range(n)]
    names = [(1, "Meat"), (2, "Plain"), (3, "Meat"), (3, "Other"), (4, "Bare")]
    recipes = [(1, "1, 2, 3"), (2, "3,5"), (3, "7"), (3, "1, 7"), (5, "2")]
    picked = [(o, r.choice(["null", "2021-01-01 10:00:00", None, ""])) for o in range(1, 31)]
    make = spark.createDataFrame
    t = SimpleNamespace(
        customer_orders=make(items, "order_id int, pizza_id int, exclusions string, extras string"),
        pizza_names=make(names, "pizza_id int, pizza_name string"),
        pizza_recipes=make(recipes, "pizza_id int, toppings string"),
        pizza_toppings=make(TOPPINGS, "topping_id int, topping_name string"),
        runner_orders=make(picked, "order_id int, pickup_time string"))
    return t, items, names, recipes, dict(picked)


def ids(text):
    text = (text or "").strip()
    parts = [] if text.lower() in ("", "null") else [x.strip() for x in text.split(",")]
    return [int(x) for x in parts if x.isdigit()]


def net(pizza, removes, adds, recipes):
    has = {i for p, text in recipes if p == pizza for i in ids(text)}
    left = Counter({i: (i in has) - (i in set(ids(removes))) + ids(adds).count(i) for i, _ in TOPPINGS})
    order = sorted((n.lower(), n, i) for i, n in TOPPINGS)
    return [(name, left[i]) for _, name, i in order if left[i] > 0]


@pytest.mark.parametrize("few", [True, False])
@pytest.mark.parametrize("seed", range(3))
def test_intended_lists_and_totals(spark, seed, few, monkeypatch):
    if not few:
        monkeypatch.setattr(P, "topping_dictionary", lambda t: lists.topping_dictionary(t, most=3))
    t, items, names, recipes, picked = tables(spark, seed)
    want, total = [], Counter()
    for o, p, ex, xt in items:
        used = net(p, ex, xt, recipes)
        text = ", ".join(n if q == 1 else f"{q}x{n}" for n, q in used)
        want += [(o, f"{name}: {text}") for i, name in names if i == p]
        if (picked[o] or "").strip() not in ("", "null"):
            total.update(dict(used))
    assert sorted(map(tuple, P.c05_ingredient_lists_intended(t).collect())) == sorted(want)
    got = [tuple(r) for r in P.c06_ingredient_totals_intended(t).collect()]
    assert got == sorted(total.items(), key=lambda x: (-x[1], x[0]))


@pytest.mark.parametrize("few", [True, False])
def test_lists_as_written(spark, few, monkeypatch):
    if not few:
        monkeypatch.setattr(P, "topping_dictionary", lambda t: None)
    t, items, names, recipes, _ = tables(spark, 7)
    extras = Counter()
    for o, _, _, xt in items:
        if xt is not None and xt.strip() not in ("", "null"):
            extras.update((o, int(x)) for x in xt.split(",") if x.strip().isdigit())
    groups = {}
    for o, p, _, _ in items:
        for name in [n for i, n in names if i == p]:
            for text in [text for i, text in recipes if i == p]:
                for i, topping in TOPPINGS:
                    if str(i) in {x.strip() for x in text.split(",")}:
                        n = extras.get((o, i))
                        entry = (topping.lower(), topping, f"2x{topping}" if n else topping)
                        groups.setdefault((o, name), []).extend([entry] * (n or 1))
    want = sorted((o, f"{name}: " + ", ".join(e[2] for e in sorted(es))) for (o, name), es in groups.items())
    assert sorted(map(tuple, P.c05_ingredient_lists(t).collect())) == want


def test_items_are_scanned_once(spark, tmp_path):
    """One scan of the items, and besides the final sort one shuffle of them, for the menu."""
    t, *_ = tables(spark, 1)
    t.customer_orders.write.parquet(f"{tmp_path}/items")
    t.customer_orders = spark.read.parquet(f"{tmp_path}/items")
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    try:
        for k in old:
            spark.conf.set(k, "-1")
        for query, joins in ((P.c05_ingredient_lists_intended, 2), (P.c06_ingredient_totals_intended, 2)):
            df = query(t)
            df.collect()
            logical = df._jdf.queryExecution().optimizedPlan().toString()
            assert logical.count(" parquet") == 1 and "explode(" not in logical, logical
            assert logical.count("Join ") == joins, logical
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_lists_as_written_are_labelled_after_grouping(spark):
    """What is sorted and grouped by (order, name) are places in the dictionary; labels are made of the finished groups."""
    t, *_ = tables(spark, 1)
    plan = P.c05_ingredient_lists(t)._jdf.queryExecution().optimizedPlan().toString()
    labelled, below = plan.split("collect_list(", 1)
    assert "2x" in labelled and "2x" not in below.split("\n", 1)[1], plan


def test_places_in_the_dictionary(spark):
    toppings = spark.createDataFrame([*TOPPINGS, (7, "Ham"), (8, None), (9, "Ham")], "topping_id int, topping_name string")
    recipes = spark.createDataFrame([(1, "7, 9, 4"), (1, "8"), (2, "99"), (None, "1")], "pizza_id int, toppings string")
    d = lists.topping_dictionary(toppings)
    entries = lists.recipe_arrays(recipes, d)
    got = entries.withColumnRenamed("recipe", "full").join(lists.recipe_positions(entries, d), "pizza_id").withColumn("d", d)
    rows = got.collect()
    assert {r.pizza_id: len(r.full) for r in rows} == {1: 5, 2: 0}
    assert all([r.d[i] for i in r.recipe] == r.full for r in rows)
