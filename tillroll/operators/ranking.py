"""Dense rank restricted to a subset of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.operators.joins import null_safe_join


def masked_dense_rank(df: DataFrame, partition: Sequence[str], order: str, mask: Column,
                      out: str = "ranks", few_rows: bool = False, spread: bool = False) -> DataFrame:
    """Add ``out`` = DENSE_RANK() OVER (PARTITION BY partition ORDER BY order) over the rows where
    ``mask`` holds; NULL elsewhere.

    A dense rank only depends on the distinct ``(partition, order)`` values, so
    the window runs over those (de-duplicated with a partial aggregate), not
    over the rows: a window group then holds at most one row per distinct
    order value (e.g. one per calendar day), whatever the number of purchases.
    The ranks are joined back on (partition, order) -- an equi-join that spreads
    a hot partition over its order values. ``few_rows``: the rows are already
    that few per partition, so they are ranked in place without the join.
    ``spread``: a partition may hold any number of order values, so they are
    ranked in ranges (:func:`ranged_dense_rank`), not in one window task.
    """
    if few_rows:
        masked = Window.partitionBy(*partition, F.coalesce(mask, F.lit(False))).orderBy(F.col(order).asc_nulls_first())
        return df.withColumn(out, F.when(mask, F.dense_rank().over(masked).cast("bigint")))
    keys = [*partition, order]
    flagged = df.withColumn("__m", F.coalesce(mask, F.lit(False)))
    distinct_keys = flagged.filter(F.col("__m")).select(*keys).distinct()
    if spread:
        ranked = ranged_dense_rank(distinct_keys, partition, order, out).withColumn("__m", F.lit(True))
    else:
        w = Window.partitionBy(*partition).orderBy(F.col(order).asc_nulls_first())
        ranked = distinct_keys.select(*keys, F.dense_rank().over(w).cast("bigint").alias(out),
                                      F.lit(True).alias("__m"))
    # NULL-safe key equality: window partitions group NULLs together.
    return null_safe_join(flagged, ranked, [*keys, "__m"], "left").drop("__m")


def ranged_dense_rank(distinct_keys: DataFrame, partition: Sequence[str], order: str, out: str = "ranks") -> DataFrame:
    """``(*partition, order, out)`` of distinct keys: the place of each among its partition's order values.

    The keys are range-partitioned, so a large partition lies in consecutive
    ranges; each range numbers its own keys, and the keys of a partition's
    earlier ranges, a row for each range, are added as an offset. The ranged
    keys are checkpointed (``spark.checkpoint.dir``): both readings must see the
    same ranges, also after a lost executor.
    """
    from tillroll.session import ensure_checkpoint_dir
    spark = distinct_keys.sparkSession
    ensure_checkpoint_dir(spark)
    by = [F.col(c).asc_nulls_first() for c in (*partition, order)]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = distinct_keys.select(*partition, order).repartitionByRange(n, *by).withColumn("__range", F.spark_partition_id()).checkpoint()
    earlier = Window.partitionBy(*partition).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy(*partition, "__range").agg(F.count(F.lit(1)).alias("__n")).withColumn(
        "__before", F.coalesce(F.sum("__n").over(earlier), F.lit(0))).drop("__n")
    own = Window.partitionBy(*partition, "__range").orderBy(F.col(order).asc_nulls_first())
    placed = null_safe_join(ranged.withColumn("__own", F.row_number().over(own)), offsets, [*partition, "__range"])
    return placed.select(*partition, order, (F.col("__before") + F.col("__own")).cast("bigint").alias(out))
