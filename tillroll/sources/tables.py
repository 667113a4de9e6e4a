"""Table bundles passed to the plans, with their declared schemas.

The plans only see these column names; where the data comes from (seed rows
in tests, the parquet adapters in ``testdata``) is up to the caller.
"""

from __future__ import annotations

from dataclasses import dataclass, fields, replace
from typing import TypeVar

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Text compares by lower case and without trailing blanks, as the delivery dialect's servers do by default.
SERVER_COLLATION = "UTF8_LCASE_RTRIM"
Tables = TypeVar("Tables")

# Declared schemas of the two domains (all columns nullable, no keys guaranteed).
SALES = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("order_date", T.DateType()),
    T.StructField("product_id", T.IntegerType()),
])
MENU = T.StructType([
    T.StructField("product_id", T.IntegerType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("price", T.IntegerType()),
])
MEMBERS = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("join_date", T.DateType()),
])
RUNNERS = T.StructType([
    T.StructField("runner_id", T.IntegerType()),
    T.StructField("registration_date", T.DateType()),
])
CUSTOMER_ORDERS = T.StructType([
    T.StructField("order_id", T.IntegerType()),
    T.StructField("customer_id", T.IntegerType()),
    T.StructField("pizza_id", T.IntegerType()),
    T.StructField("exclusions", T.StringType()),
    T.StructField("extras", T.StringType()),
    T.StructField("order_time", T.TimestampNTZType()),
])
RUNNER_ORDERS = T.StructType([
    T.StructField("order_id", T.IntegerType()),
    T.StructField("runner_id", T.IntegerType()),
    T.StructField("pickup_time", T.StringType()),
    T.StructField("distance", T.StringType()),
    T.StructField("duration", T.StringType()),
    T.StructField("cancellation", T.StringType()),
])
PIZZA_NAMES = T.StructType([
    T.StructField("pizza_id", T.IntegerType()),
    T.StructField("pizza_name", T.StringType()),
])
PIZZA_RECIPES = T.StructType([
    T.StructField("pizza_id", T.IntegerType()),
    T.StructField("toppings", T.StringType()),
])
PIZZA_TOPPINGS = T.StructType([
    T.StructField("topping_id", T.IntegerType()),
    T.StructField("topping_name", T.StringType()),
])
CUSTOMER_RATINGS = T.StructType([
    T.StructField("order_id", T.IntegerType()),
    T.StructField("customer_id", T.IntegerType()),
    T.StructField("runner_id", T.IntegerType()),
    T.StructField("rating", T.IntegerType()),
])


@dataclass(frozen=True)
class LoyaltyTables:
    """sales(customer_id, order_date, product_id), menu(product_id, product_name, price, ...),
    members(customer_id, join_date)."""
    sales: DataFrame
    menu: DataFrame
    members: DataFrame


@dataclass(frozen=True)
class DeliveryTables:
    """customer_orders: one row per item; runner_orders: one row per order (text measures);
    pizza_names / pizza_recipes / pizza_toppings: dimensions; runners; customer_ratings."""
    customer_orders: DataFrame
    runner_orders: DataFrame
    pizza_names: DataFrame
    pizza_recipes: DataFrame
    pizza_toppings: DataFrame
    runners: DataFrame
    customer_ratings: DataFrame


def collated(tables: Tables, collation: str = SERVER_COLLATION) -> Tables:
    """The same tables with every text column under a collation: it then holds in comparisons, GROUP BY,
    DISTINCT, joins and ORDER BY of any plan, and a merged group shows one of its spellings."""
    def declared(df: DataFrame) -> DataFrame:
        return df.select(*[F.collate(f"`{c}`", collation).alias(c) if kind.startswith("string") else F.col(f"`{c}`") for c, kind in df.dtypes])
    return replace(tables, **{f.name: declared(getattr(tables, f.name)) for f in fields(tables)})
