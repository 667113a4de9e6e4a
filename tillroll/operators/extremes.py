"""Rows at a per-key extreme, and top-n with ties.

``rows_at_extreme`` is a ``rank() = 1`` filter over a window partitioned by
the key. Spark plans that filter as a *partial* WindowGroupLimit before the
shuffle and a final one after it: each map task sorts its own rows and sends
only the rows at its local extreme per key, so a customer holding a third of
all rows contributes a handful of candidate rows per task, not its rows, and
the fact is scanned once. ``top_n_with_ties`` is the same filter in two stages.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def rows_at_extreme(df: DataFrame, keys: Sequence[str], value: str, which: str = "min") -> DataFrame:
    """All rows whose ``value`` equals the per-key min (``which='min'``) or max.

    Ties and duplicate rows are kept; rows with a NULL key or NULL value never
    qualify (the semantics of ``JOIN (SELECT k, MIN(v) ...) ON k AND v``).
    """
    order = {"min": F.col(value).asc(), "max": F.col(value).desc()}[which]
    present = F.col(value).isNotNull()
    for k in keys:
        present = present & F.col(k).isNotNull()
    w = Window.partitionBy(*keys).orderBy(order)
    return (df.filter(present)
              .withColumn("__rank", F.rank().over(w))
              .filter(F.col("__rank") == 1)
              .drop("__rank"))


def top_n_with_ties(df: DataFrame, value: str, n: int = 1, descending: bool = True) -> DataFrame:
    """``TOP (n) WITH TIES ... ORDER BY value [DESC]``: the first n rows plus every row tied with the n-th.

    NULL is the smallest value, as in the delivery dialect: last in descending
    order, first in ascending order, and tied with other NULLs.

    Rank <= n is just that set, and it holds for a part of the rows if it holds
    for all. So two stages select: every task keeps the rows of rank <= n among
    its own (a partial WindowGroupLimit, before any shuffle), then the same
    among what is left. ``df`` is evaluated once, however it was computed; the
    last task reads n rows of each task and the rows tied with them.
    """
    order = F.col(value).desc_nulls_last() if descending else F.col(value).asc_nulls_first()
    spread = Window.partitionBy("__part").orderBy(order)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    columns = [F.col(f"`{c}`") for c in df.columns if df.schema[c].dataType.typeName() not in ("map", "variant")]
    local = (df.withColumn("__part", F.pmod(F.xxhash64(*columns), F.lit(parts)))
               .withColumn("__rank", F.rank().over(spread)).filter(F.col("__rank") <= n).drop("__rank", "__part"))
    return (local.withColumn("__rank", F.rank().over(Window.orderBy(order)))
                 .filter(F.col("__rank") <= n).drop("__rank"))


def most_frequent_per_key(df: DataFrame, keys: Sequence[str], item: str, count_col: str = "cnt") -> DataFrame:
    """Per key, the item(s) with the highest row count (ties kept): ``keys, item, count_col``.

    A hash aggregate (counts per (key, item), combined map-side), then a rank
    over the counts. As with ``PARTITION BY``, a NULL key is a group of its own.
    """
    counts = df.groupBy(*keys, item).agg(F.count(F.lit(1)).alias(count_col))
    w = Window.partitionBy(*keys).orderBy(F.col(count_col).desc())
    return counts.withColumn("__rank", F.rank().over(w)).filter(F.col("__rank") == 1).drop("__rank")
