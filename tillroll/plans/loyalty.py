"""Loyalty queries L01-L12: spend, visits, first/last/most popular items, points,
membership timeline.

Every plan takes a :class:`LoyaltyTables` bundle (+ parameters) and returns a
lazy DataFrame. Shared shape: additive measures pre-aggregate the purchase
rows to (customer, product[, day]) counts *before* joining the menu, so the
dimension join and the final shuffle see one row per pair instead of one per
purchase, and a hot customer is reduced map-side.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.money import points
from tillroll.operators import (
    attach_membership, daily_sketches, distinct_estimate, masked_dense_rank, most_frequent_per_key, null_safe_join, rows_at_extreme,
)
from tillroll.operators.distinct import near
from tillroll.sources.tables import LoyaltyTables


def _pg_order(*cols: str) -> list[Column]:
    """ORDER BY as the loyalty queries' dialect sorts: ascending with NULLs last."""
    return [F.col(c).asc_nulls_last() for c in cols]


def _pair_counts(sales: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Purchases reduced to one row per ``keys`` with the number of rows ``n``."""
    return sales.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def l01_total_spend(t: LoyaltyTables) -> DataFrame:
    """Total amount each customer spent."""
    pairs = _pair_counts(t.sales, ["customer_id", "product_id"])
    return (pairs.join(t.menu, "product_id")
                 .groupBy("customer_id")
                 .agg(F.sum(F.col("price") * F.col("n")).alias("total_purchase"))
                 .orderBy(*_pg_order("customer_id")))


def l02_visit_days(t: LoyaltyTables) -> DataFrame:
    """Distinct days each customer visited."""
    return (t.sales.groupBy("customer_id")
                   .agg(F.countDistinct("order_date").alias("total_visits"))
                   .orderBy(*_pg_order("customer_id")))


def l02_visit_days_sketched(t: LoyaltyTables) -> DataFrame:
    """L02 from one sketch per customer and month, united, beside the exact count."""
    sales = t.sales.select("customer_id", "order_date", F.trunc("order_date", "month").alias("month"))
    estimate = distinct_estimate(daily_sketches(sales, "month", "order_date", ["customer_id"]), "month", ["customer_id"])
    both = null_safe_join(l02_visit_days(t), estimate, ["customer_id"])
    return both.select("customer_id", "total_visits", near(F.col("estimate"), F.col("total_visits")).alias("estimate_holds")) \
               .orderBy(*_pg_order("customer_id"))


def l03_first_day_items(t: LoyaltyTables) -> DataFrame:
    """Items bought on each customer's first day (ties and repeated rows kept)."""
    first = rows_at_extreme(t.sales, ["customer_id"], "order_date", "min")
    return (first.join(t.menu, "product_id")
                 .select("customer_id", "product_name", "order_date")
                 .orderBy(*_pg_order("customer_id", "product_name")))


def l04_most_purchased(t: LoyaltyTables) -> DataFrame:
    """The single most purchased item (ties broken by name) and its purchase count."""
    per_product = _pair_counts(t.sales, ["product_id"])
    return (per_product.join(t.menu, "product_id")
                       .groupBy("product_name")
                       .agg(F.sum("n").alias("total_item_purchase"))
                       .orderBy(F.col("total_item_purchase").desc_nulls_first(), *_pg_order("product_name"))
                       .limit(1))


def l05_favourite_items(t: LoyaltyTables) -> DataFrame:
    """Most purchased item(s) per customer, ties kept (ranked before the menu join)."""
    top = most_frequent_per_key(t.sales, ["customer_id"], "product_id")
    return (top.join(t.menu, "product_id")
               .select("customer_id", "product_id", "product_name")
               .orderBy(*_pg_order("customer_id", "product_name")))


def _dated(after: bool) -> Column:
    return F.col("order_date") >= F.col("join_date") if after else F.col("order_date") < F.col("join_date")


def _purchases_on_extreme_day(t: LoyaltyTables, after: bool, which: str) -> DataFrame:
    """Purchases on each member's first or last day on one side of the join date. The day is found
    among distinct (customer, day) rows; the purchases meet it by (customer, day), which spreads a
    hot customer over its days."""
    days = t.sales.select("customer_id", "order_date").distinct()
    on_side = days.join(t.members.select("customer_id", "join_date"), "customer_id").filter(_dated(after))
    day = rows_at_extreme(on_side.select("customer_id", "order_date"), ["customer_id"], "order_date", which)
    return (t.sales.join(day, ["customer_id", "order_date"])
                   .join(t.menu, "product_id")
                   .select("customer_id", "product_id", "product_name", "order_date")
                   .orderBy(*_pg_order("customer_id", "product_name")))


def l06_first_after_joining(t: LoyaltyTables) -> DataFrame:
    """First item(s) bought on or after the join date."""
    return _purchases_on_extreme_day(t, after=True, which="min")


def l07_last_before_joining(t: LoyaltyTables) -> DataFrame:
    """Last item(s) bought strictly before the join date."""
    return _purchases_on_extreme_day(t, after=False, which="max")


def l08_before_joining_totals(t: LoyaltyTables) -> DataFrame:
    """Items and spend per member before joining (purchases reduced to day counts before the join)."""
    days = _pair_counts(t.sales, ["customer_id", "product_id", "order_date"])
    before = days.join(t.members.select("customer_id", "join_date"), "customer_id").filter(_dated(after=False))
    return (before.join(t.menu, "product_id")
                  .groupBy("customer_id")
                  .agg(F.sum("n").alias("total_items"),
                       F.sum(F.col("price") * F.col("n")).alias("total_amount_spent"))
                  .orderBy(*_pg_order("customer_id")))


def l09_points(t: LoyaltyTables, featured: Column) -> DataFrame:
    """10 points per unit of price, 20 for featured products (``featured`` is over menu columns)."""
    pairs = _pair_counts(t.sales, ["customer_id", "product_id"])
    pts = points(F.col("price"), featured) * F.col("n")
    return (pairs.join(t.menu, "product_id")
                 .groupBy("customer_id").agg(F.sum(pts).alias("total_points"))
                 .orderBy(*_pg_order("customer_id")))


def l10_points_first_week(t: LoyaltyTables, featured: Column, cutoff: dt.date,
                          customers: Sequence | None = None, first_days: int = 7) -> DataFrame:
    """Points with 2x on everything during the first ``first_days`` days of membership (join day
    included), purchases after ``cutoff`` earn 0 but keep the customer in the result."""
    sales = t.sales if customers is None else t.sales.filter(F.col("customer_id").isin(*customers))
    days = _pair_counts(sales, ["customer_id", "product_id", "order_date"])
    sw = attach_membership(days.join(t.menu, "product_id"), t.members, first_days=first_days)
    boosted = F.col("in_first_days") | F.coalesce(featured, F.lit(False))
    pts = F.when(F.col("order_date") <= F.lit(cutoff), points(F.col("price"), boosted)).otherwise(F.lit(0))
    return (sw.groupBy("customer_id").agg(F.sum(pts * F.col("n")).alias("total_points"))
              .orderBy(*_pg_order("customer_id")))


def _timeline(t: LoyaltyTables) -> DataFrame:
    tl = attach_membership(t.sales.join(t.menu, "product_id"), t.members)
    return tl.select("customer_id", "order_date", "product_name", "price",
                     F.when(F.col("is_member"), F.lit("YES")).otherwise(F.lit("NO")).alias("member"))


def l11_member_timeline(t: LoyaltyTables) -> DataFrame:
    """Every purchase with product, price and a YES/NO member flag."""
    return _timeline(t).orderBy(*_pg_order("customer_id", "order_date", "product_name"))


def l12_member_ranking(t: LoyaltyTables) -> DataFrame:
    """L11 plus a dense rank of purchase days among member purchases (NULL for non-member rows).

    Membership and rank belong to the (customer, day): they are found among those, and the purchases
    meet them by both, so a hot customer is spread over its days and members join once.
    """
    sales = t.sales.join(t.menu, "product_id")
    days = attach_membership(sales.select("customer_id", "order_date").distinct(), t.members)
    days = days.select("customer_id", "order_date",
                       F.when(F.col("is_member"), F.lit("YES")).otherwise(F.lit("NO")).alias("member"))
    ranked = masked_dense_rank(days, ["customer_id", "member"], "order_date", F.col("member") == "YES", few_rows=True)
    return (null_safe_join(sales, ranked, ["customer_id", "order_date"])
                  .select("customer_id", "order_date", "product_name", "price", "member", "ranks")
                  .orderBy(*_pg_order("customer_id", "order_date", "product_name")))
