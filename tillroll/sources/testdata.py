"""Adapters: driver testdata parquet (TPC-H-like tables + events) -> the two domains.

Every adapter is a lazy projection/filter/join of the parquet scans, so column
pruning and filter pushdown reach the files (``event_type = 'purchase'`` is a
parquet ``PushedFilter``), and every query built on them grows with the data.

Loyalty
  sales    <- events (event_type = 'purchase'): user, day, product key from props.k
  menu     <- part: product_name = p_name + ' #' + key, price = p_retailprice (decimal)
  members  <- events (signup) joined to customer in three market segments; join_date = last signup day
Delivery
  customer_orders <- lineitem joined to orders (one row per line = item)
  runner_orders   <- orders: runner, pickup text, distance/duration texts, cancellation
  pizza_names / pizza_recipes <- part; pizza_toppings <- nation; runners <- supplier
  customer_ratings <- orders that are not pending
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.sources.tables import DeliveryTables, LoyaltyTables

# Fixed values for the testdata mapping.
MEMBER_SEGMENTS = ("BUILDING", "MACHINERY", "HOUSEHOLD")
FEATURED_TYPE = "PROMO"
POINTS_CUTOFF = dt.date(2024, 1, 25)
WEEK_ANCHOR = dt.date(2021, 1, 1)
RUNNER_EPOCH = dt.date(2021, 1, 1)
PIZZA_TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
PRICE_BY_TYPE = {"LARGE": 12, "MEDIUM": 10}
RUNNER_RATE_PER_KM = 0.30
NEW_PIZZA_NAME = "Supreme"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table as it stands now: each call lists the files anew, so appended ones are seen."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---------------------------------------------------------------- loyalty
def sales(spark, sf_dir) -> DataFrame:
    ev = read(spark, sf_dir, "events")
    return (ev.filter(F.col("event_type") == "purchase")
              .select(F.col("user_id").alias("customer_id"),
                      F.col("ts").cast("date").alias("order_date"),
                      F.get_json_object("props", "$.k").try_cast("bigint").alias("product_id")))


def menu(spark, sf_dir) -> DataFrame:
    part = read(spark, sf_dir, "part")
    return part.select(
        F.col("p_partkey").alias("product_id"),
        F.concat(F.col("p_name"), F.lit(" #"), F.col("p_partkey").cast("string")).alias("product_name"),
        F.col("p_retailprice").cast("decimal(12,2)").alias("price"),
        F.col("p_type").alias("product_type"))


def members(spark, sf_dir) -> DataFrame:
    ev = read(spark, sf_dir, "events").filter(F.col("event_type") == "signup")
    cust = read(spark, sf_dir, "customer").filter(F.col("c_mktsegment").isin(*MEMBER_SEGMENTS))
    return (ev.join(cust, ev.user_id == cust.c_custkey)
              .groupBy(F.col("c_custkey").alias("customer_id"))
              .agg(F.max("ts").cast("date").alias("join_date")))


class _Lazy:
    """Table bundle whose members are built on first access (a query only pays for what it reads)."""

    _builders: dict = {}

    def __init__(self, spark, sf_dir):
        self._spark, self._dir, self._built = spark, sf_dir, {}

    def __getattr__(self, name):
        builders = type(self)._builders
        if name not in builders:
            raise AttributeError(name)
        if name not in self._built:
            self._built[name] = builders[name](self._spark, self._dir)
        return self._built[name]


class _LazyLoyalty(_Lazy):
    _builders = {"sales": lambda s, d: sales(s, d), "menu": lambda s, d: menu(s, d),
                 "members": lambda s, d: members(s, d)}


def loyalty_tables(spark, sf_dir) -> LoyaltyTables:
    """A :class:`LoyaltyTables`-shaped bundle over the testdata (members built lazily)."""
    return _LazyLoyalty(spark, sf_dir)


# --------------------------------------------------------------- delivery
def _orders(spark, sf_dir) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("st"),
        F.timestamp_add("SECOND", ((F.col("o_orderkey") * 7919) % 86400).cast("int"),
                        F.col("o_orderdate")).alias("order_time"))


def runner_orders(spark, sf_dir) -> DataFrame:
    o = _orders(spark, sf_dir)
    k = F.col("order_id")
    pending = F.col("st") == "P"
    pickup = F.date_format(F.timestamp_add("SECOND", (300 + (k * 31) % 2400).cast("int"), F.col("order_time")),
                           "yyyy-MM-dd HH:mm:ss")
    distance = F.concat((5 + k % 20).cast("string"), F.lit(".4"),
                        F.when(k % 3 == 0, "km").when(k % 3 == 1, " km").otherwise(""))
    duration = F.concat((10 + k % 31).cast("string"),
                        F.when(k % 4 == 0, " minutes").when(k % 4 == 1, "mins")
                         .when(k % 4 == 2, " minute").otherwise(""))
    cancellation = (F.when(pending, "Customer Cancellation").when(k % 3 == 0, "")
                     .when(k % 3 == 1, "null").otherwise(F.lit(None).cast("string")))
    return o.select(
        k,
        (k % 20 + 1).alias("runner_id"),
        F.when(pending, "null").otherwise(pickup).alias("pickup_time"),
        F.when(pending, "null").otherwise(distance).alias("distance"),
        F.when(pending, "null").otherwise(duration).alias("duration"),
        cancellation.alias("cancellation"))


def customer_orders(spark, sf_dir) -> DataFrame:
    li = read(spark, sf_dir, "lineitem")
    o = _orders(spark, sf_dir).drop("st")
    ln, pk = F.col("l_linenumber"), F.col("l_partkey")
    excl = (F.when(ln % 4 == 0, "null").when(ln % 4 == 1, "")
             .when(ln % 4 == 2, ((pk * 3 + 1) % 25).cast("string")).otherwise(F.lit(None).cast("string")))
    extras = (F.when(pk % 4 == 0, "null").when(pk % 4 == 1, "")
               .when(pk % 4 == 2, F.concat(((pk * 3 + 1) % 25).cast("string"), F.lit(", "),
                                           ((pk * 3 + 2) % 25).cast("string")))
               .otherwise(F.lit(None).cast("string")))
    return (li.join(o, li.l_orderkey == o.order_id)
              .select(F.col("order_id"), F.col("customer_id"), pk.alias("pizza_id"),
                      excl.alias("exclusions"), extras.alias("extras"), F.col("order_time")))


def pizza_names(spark, sf_dir) -> DataFrame:
    part = read(spark, sf_dir, "part")
    return part.select(
        F.col("p_partkey").alias("pizza_id"),
        F.concat(F.col("p_name"), F.lit(" #"), F.col("p_partkey").cast("string")).alias("pizza_name"),
        F.col("p_type").alias("pizza_type"))


def pizza_recipes(spark, sf_dir) -> DataFrame:
    pk = F.col("p_partkey")
    return read(spark, sf_dir, "part").select(
        pk.alias("pizza_id"),
        F.concat_ws(", ", ((pk * 3 + 1) % 25).cast("string"), ((pk * 3 + 4) % 25).cast("string"),
                    ((pk * 3 + 9) % 25).cast("string")).alias("toppings"))


def pizza_toppings(spark, sf_dir) -> DataFrame:
    return read(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("int").alias("topping_id"), F.col("n_name").alias("topping_name"))


def runners(spark, sf_dir) -> DataFrame:
    s = read(spark, sf_dir, "supplier")
    return s.select((F.col("s_suppkey") + 1).alias("runner_id"),
                    F.date_add(F.lit(RUNNER_EPOCH), ((F.col("s_suppkey") * 7) % 60).cast("int"))
                     .alias("registration_date"))


def customer_ratings(spark, sf_dir) -> DataFrame:
    o = _orders(spark, sf_dir)
    k = F.col("order_id")
    return o.filter(F.col("st") != "P").select(
        k, F.col("customer_id"), (k % 20 + 1).alias("runner_id"), ((k * 13) % 5 + 1).alias("rating"))


class _LazyDelivery(_Lazy):
    _builders = {"customer_orders": lambda s, d: customer_orders(s, d),
                 "runner_orders": lambda s, d: runner_orders(s, d),
                 "pizza_names": lambda s, d: pizza_names(s, d),
                 "pizza_recipes": lambda s, d: pizza_recipes(s, d),
                 "pizza_toppings": lambda s, d: pizza_toppings(s, d),
                 "runners": lambda s, d: runners(s, d),
                 "customer_ratings": lambda s, d: customer_ratings(s, d)}


def delivery_tables(spark, sf_dir) -> DeliveryTables:
    """A :class:`DeliveryTables`-shaped bundle over the testdata (members built lazily)."""
    return _LazyDelivery(spark, sf_dir)


# ------------------------------------------------------------ parameters
@dataclass(frozen=True)
class LoyaltyParams:
    """Points rules: ``featured`` is a predicate over menu columns."""
    featured: Column
    cutoff: dt.date
    customers: tuple | None = None


@dataclass(frozen=True)
class DeliveryParams:
    price_col: str
    prices: dict
    pivot_col: str
    pivot_values: dict
    week_anchor: dt.date = WEEK_ANCHOR
    rate_per_km: float = RUNNER_RATE_PER_KM
    new_pizza_name: str = NEW_PIZZA_NAME
    new_pizza_id: int | None = None   # None: one above the largest id
    extra_fee: int = 1
    options: dict = field(default_factory=dict)


def loyalty_params() -> LoyaltyParams:
    return LoyaltyParams(featured=F.col("product_type") == FEATURED_TYPE, cutoff=POINTS_CUTOFF)


def delivery_params() -> DeliveryParams:
    return DeliveryParams(price_col="pizza_type", prices=dict(PRICE_BY_TYPE),
                          pivot_col="pizza_type", pivot_values={t: t for t in PIZZA_TYPES})
