"""Named queries over the testdata adapters: key -> (spark, sf_dir) -> DataFrame.

Keys follow the inventory: L01-L12 (loyalty), A01-D05 (delivery, as written),
``*_intended`` (the question's meaning where the source SQL has a defect),
D03 / E02_* (the write tasks: tables written under ``spark.checkpoint.dir`` and read back).

Outputs are normalised at this boundary only: DECIMAL -> DOUBLE, doubles to six
decimals and 8/16/32-bit integers -> BIGINT, so the same query compares equal to
the SQL oracle.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.plans import delivery as P
from tillroll.plans import loyalty as L
from tillroll.session import ensure_checkpoint_dir
from tillroll.sources import testdata as TD
from tillroll.sources.store import TableStore

Query = Callable[[SparkSession, str], DataFrame]
DECIMALS = 6
#: Parameters of the two forms that name customers and pizzas.
LISTED_CUSTOMERS = tuple(range(1, 11))
PIVOT_PIZZAS = {1: "pizza_1", 2: "pizza_2"}


def normalise(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DecimalType, T.DoubleType)):
            c = F.round(c.cast("double"), DECIMALS)
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _loyalty(fn: Callable) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return normalise(fn(TD.loyalty_tables(spark, sf_dir), TD.loyalty_params()))
    run.__doc__ = fn.__doc__
    return run


def _delivery(fn: Callable) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return normalise(fn(TD.delivery_tables(spark, sf_dir), TD.delivery_params()))
    run.__doc__ = fn.__doc__
    return run


def _stored(write: Callable, name: str) -> Query:
    """Run a write task on a store of its own in the shared folder and read a table back."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        t, p = TD.delivery_tables(spark, sf_dir), TD.delivery_params()
        bases = {"pizza_names": t.pizza_names, "pizza_recipes": t.pizza_recipes.select("pizza_id", "toppings")}
        store = TableStore(spark, f"{ensure_checkpoint_dir(spark)}/tables/{uuid.uuid4().hex}", bases)
        write(store, t, p)
        return normalise(store.read(name))
    run.__doc__ = write.__doc__
    return run


def _write_ratings(store: TableStore, t, p) -> None:
    """The ratings table, recreated."""
    store.replace({"customer_ratings": P.d03_ratings(t)})


def _insert_pizza(store: TableStore, t, p) -> None:
    """A pizza with every topping: its rows of both tables under one id, seen together; the tables stay in place."""
    new_id = _both_ids(t, p)
    store.insert({"pizza_names": P.e02_name_row(t, p.new_pizza_name, new_id),
                  "pizza_recipes": P.e02_recipe_row(t, new_id)}, write_id=f"pizza-{new_id}")


def _both_ids(t, p) -> int:
    """One id for both inserts of E02."""
    return p.new_pizza_id if p.new_pizza_id is not None else P.next_pizza_id(t)


QUERIES: dict[str, Query] = {
    # loyalty
    "L01": _loyalty(lambda t, p: L.l01_total_spend(t)),
    "L02": _loyalty(lambda t, p: L.l02_visit_days(t)),
    "L02_sketch": _loyalty(lambda t, p: L.l02_visit_days_sketched(t)),
    "L03": _loyalty(lambda t, p: L.l03_first_day_items(t)),
    "L04": _loyalty(lambda t, p: L.l04_most_purchased(t)),
    "L05": _loyalty(lambda t, p: L.l05_favourite_items(t)),
    "L06": _loyalty(lambda t, p: L.l06_first_after_joining(t)),
    "L07": _loyalty(lambda t, p: L.l07_last_before_joining(t)),
    "L08": _loyalty(lambda t, p: L.l08_before_joining_totals(t)),
    "L09": _loyalty(lambda t, p: L.l09_points(t, p.featured)),
    "L10": _loyalty(lambda t, p: L.l10_points_first_week(t, p.featured, p.cutoff, p.customers)),
    "L10_customers": _loyalty(lambda t, p: L.l10_points_first_week(t, p.featured, p.cutoff, LISTED_CUSTOMERS)),
    "L11": _loyalty(lambda t, p: L.l11_member_timeline(t)),
    "L12": _loyalty(lambda t, p: L.l12_member_ranking(t)),
    # delivery: pizza metrics
    "A01": _delivery(lambda t, p: P.a01_items_ordered(t)),
    "A02": _delivery(lambda t, p: P.a02_distinct_orders(t)),
    "A02_sketch": _delivery(lambda t, p: P.a02_distinct_orders_sketched(t)),
    "A03": _delivery(lambda t, p: P.a03_delivered_per_runner(t)),
    "A04": _delivery(lambda t, p: P.a04_delivered_by_type(t)),
    "A05a": _delivery(lambda t, p: P.a05a_by_customer_and_type(t)),
    "A05b": _delivery(lambda t, p: P.a05b_by_customer_wide(t, p.pivot_col, p.pivot_values)),
    "A05b_items": _delivery(lambda t, p: P.a05b_by_customer_wide(t, "pizza_id", PIVOT_PIZZAS)),
    "A06a": _delivery(lambda t, p: P.a06a_largest_order(t)),
    "A06b": _delivery(lambda t, p: P.a06b_largest_orders_with_ties(t)),
    "A07": _delivery(lambda t, p: P.a07_changes_per_customer(t)),
    "A07_intended": _delivery(lambda t, p: P.a07_changes_per_customer_intended(t)),
    "A08": _delivery(lambda t, p: P.a08_exclusions_and_extras(t)),
    "A09": _delivery(lambda t, p: P.a09_by_hour(t)),
    "A10": _delivery(lambda t, p: P.a10_by_weekday(t)),
    # runner and customer experience
    "B01": _delivery(lambda t, p: P.b01_signups_per_week(t)),
    "B01_intended": _delivery(lambda t, p: P.b01_signups_per_week_intended(t, p.week_anchor)),
    "B02": _delivery(lambda t, p: P.b02_pickup_minutes(t)),
    "B03": _delivery(lambda t, p: P.b03_prep_minutes_by_size(t)),
    "B04": _delivery(lambda t, p: P.b04_distance_per_customer(t)),
    "B04_intended": _delivery(lambda t, p: P.b04_distance_per_customer_intended(t)),
    "B05": _delivery(lambda t, p: P.b05_duration_range(t)),
    "B06": _delivery(lambda t, p: P.b06_speeds(t)),
    "B07": _delivery(lambda t, p: P.b07_success_rate(t)),
    # ingredient optimisation
    "C01": _delivery(lambda t, p: P.c01_recipes(t)),
    "C02": _delivery(lambda t, p: P.c02_extras_frequency(t)),
    "C03": _delivery(lambda t, p: P.c03_exclusions_frequency(t)),
    "C04": _delivery(lambda t, p: P.c04_order_item_labels(t)),
    "C04_intended": _delivery(lambda t, p: P.c04_order_item_labels_intended(t)),
    "C05": _delivery(lambda t, p: P.c05_ingredient_lists(t)),
    "C05_intended": _delivery(lambda t, p: P.c05_ingredient_lists_intended(t)),
    "C06": _delivery(lambda t, p: P.c06_ingredient_totals(t)),
    "C06_intended": _delivery(lambda t, p: P.c06_ingredient_totals_intended(t)),
    # pricing and ratings
    "D01": _delivery(lambda t, p: P.d01_revenue(t, p.price_col, p.prices)),
    "D02": _delivery(lambda t, p: P.d02_revenue_with_extras(t, p.price_col, p.prices, p.extra_fee)),
    "D02_intended": _delivery(lambda t, p: P.d02_revenue_with_extras_intended(t, p.price_col, p.prices,
                                                                              p.extra_fee)),
    "D03": _stored(_write_ratings, "customer_ratings"),
    "D04": _delivery(lambda t, p: P.d04_delivery_report(t)),
    "D04_intended": _delivery(lambda t, p: P.d04_delivery_report_intended(t)),
    "D05": _delivery(lambda t, p: P.d05_profit(t, p.price_col, p.prices, p.rate_per_km)),
    "D05_intended": _delivery(lambda t, p: P.d05_profit_intended(t, p.price_col, p.prices, p.rate_per_km)),
    # bonus: insert a pizza with every topping
    "E02_names": _stored(_insert_pizza, "pizza_names"),
    "E02_recipes": _stored(_insert_pizza, "pizza_recipes"),
}

FLAGSHIP = "L12"
