"""Price and points rules."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillroll.functions.text import as_col


def price_map(key, prices: Mapping, default=0) -> Column:
    """Price looked up from a small literal map as a CASE chain (no join, stays in codegen)."""
    k = as_col(key)
    expr = None
    for value, price in prices.items():
        expr = F.when(k == F.lit(value), F.lit(price)) if expr is None else expr.when(k == F.lit(value), F.lit(price))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def points(price, boosted: Column, base_rate: int = 10, boost_rate: int = 20) -> Column:
    """``price * boost_rate`` where ``boosted`` is TRUE, else ``price * base_rate``."""
    p = as_col(price)
    return F.when(boosted, p * boost_rate).otherwise(p * base_rate)
