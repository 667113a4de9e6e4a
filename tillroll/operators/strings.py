"""STRING_AGG ... WITHIN GROUP over groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.lists import repeat_join
from tillroll.functions.text import as_col


def string_agg(df: DataFrame, keys: Sequence[str], value, order_by: Sequence, sep: str = ", ", out: str = "text") -> DataFrame:
    """``(*keys, out)``: the values of each group joined in order (then by value); NULL values are left
    out, a group of them only gives ''.

    No group becomes one array. Equal entries are counted first; the entries are
    range-partitioned by key and order, so a large group lies in consecutive
    partitions and each of its ranges is concatenated apart; the ranges' texts
    are then joined in the order of their partitions. Only the finished text is
    ever in one place, and a task holds no more entries than a range.
    """
    order = [as_col(c).alias(f"__o{i}") for i, c in enumerate(order_by)]
    names = [f"__o{i}" for i in range(len(order))]
    entries = df.select(*keys, *order, as_col(value).cast("string").alias("__v")).groupBy(*keys, *names, "__v").agg(
        F.count(F.lit(1)).alias("__n"))
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = entries.repartitionByRange(n, *keys, *names, "__v").withColumn("__part", F.spark_partition_id())

    def text(e: Column) -> Column:
        return repeat_join(F.transform(F.array_sort(e), lambda s: F.struct(s["v"].alias("label"), s["n"].alias("n"))), sep)

    entry = F.when(F.col("__v").isNotNull(), F.struct(*names, F.col("__v").alias("v"), F.col("__n").alias("n")))
    ranges = ranged.groupBy(*keys, "__part").agg(F.collect_list(entry).alias("__e")).select(
        *keys, F.when(F.size("__e") > 0, F.struct("__part", text(F.col("__e")).alias("t"))).alias("__r"))
    return ranges.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list("__r")), lambda r: r["t"]), sep).alias(out))
