"""Attach membership (join date) to dated facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.operators.joins import null_safe_join


def attach_membership(facts: DataFrame, members: DataFrame, key: str = "customer_id",
                      date_col: str = "order_date", join_col: str = "join_date",
                      how: str = "left", first_days: int | None = None) -> DataFrame:
    """Equi-join facts to members on ``key`` and add flags (never a range join).

    Adds ``is_member`` (fact dated on/after the join date; FALSE when not a
    member) and, if ``first_days`` is given, ``in_first_days`` (date within
    ``[join_date, join_date + first_days - 1]``).
    """
    m = members.select(key, join_col)
    out = facts.join(m, on=key, how=how)
    jd, d = F.col(join_col), F.col(date_col)
    out = out.withColumn("is_member", F.coalesce(jd.isNotNull() & (d >= jd), F.lit(False)))
    if first_days is not None:
        out = out.withColumn("in_first_days", F.coalesce(
            jd.isNotNull() & d.between(jd, F.date_add(jd, first_days - 1)), F.lit(False)))
    return out


def attach_membership_as_of(facts: DataFrame, members: DataFrame, key: str = "customer_id", date_col: str = "order_date",
                            join_col: str = "join_date", first_days: int | None = None) -> DataFrame:
    """:func:`attach_membership` for customers who may join several times: each fact meets the latest
    joining date that isn't after it.

    Facts never fan out over joining dates. The distinct (key, date) pairs of
    the facts and the joining dates form one sequence of events per key, along
    which the last joining date is carried forward; the facts then meet their
    pair by equality, which spreads a hot key over its dates. A key's sequence
    holds a row for each of its calendar days. A NULL key or date is no member's.
    """
    days = facts.select(F.col(key).alias("__k"), F.col(date_col).alias("__d")).distinct()
    joins = members.select(F.col(key).alias("__k"), F.col(join_col).alias("__d")).filter("__d is not null").distinct()
    events = days.withColumn("__j", F.lit(None).cast(joins.schema["__d"].dataType)).withColumn("__fact", F.lit(1)).unionByName(
        joins.withColumn("__j", F.col("__d")).withColumn("__fact", F.lit(0)))
    carried = Window.partitionBy("__k").orderBy("__d", "__fact").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    as_of = events.withColumn(join_col, F.last("__j", ignorenulls=True).over(carried)).filter("__fact = 1")
    as_of = as_of.select(F.col("__k").alias(key), F.col("__d").alias(date_col),
                         F.when(F.col("__k").isNotNull() & F.col("__d").isNotNull(), F.col(join_col)).alias(join_col))
    out = null_safe_join(facts, as_of, [key, date_col], "left")
    out = out.withColumn("is_member", F.col(join_col).isNotNull())
    if first_days is not None:
        out = out.withColumn("in_first_days", F.coalesce(
            F.col(date_col) <= F.date_add(F.col(join_col), first_days - 1), F.lit(False)))
    return out
