"""``NOT IN (subquery)`` with SQL's NULL rules, without requiring a broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, StringType, TimestampNTZType, TimestampType


def not_in(left: DataFrame, left_key: str, right: DataFrame, right_key: str) -> DataFrame:
    """Rows of ``left`` where ``left_key NOT IN (SELECT right_key FROM right)``.

    SQL semantics: if the subquery yields any NULL, no row qualifies; a NULL
    left key qualifies only when the subquery is empty. Spark plans a literal
    NOT IN as a null-aware anti join, which needs the right side broadcast (or
    falls back to a nested loop).

    Here the subquery is grouped once into its distinct keys, with how many
    NULLs each group stands for. Both uses, the anti join and the scalar that
    holds the two NULL flags, read all columns of that aggregate, so its
    shuffle is planned once and reused. A NULL takes an ordinary key: it may
    only match rows that go anyway, as with a NULL every row goes. The join is
    on the plain key, so a left side that is already partitioned by it (items
    joined to their orders) isn't shuffled again.
    """
    key = right.schema[right_key].dataType
    text = "" if isinstance(key, StringType) else "0" if isinstance(key, NumericType) else \
        "1970-01-01" if isinstance(key, (DateType, TimestampType, TimestampNTZType)) else None
    stand_in = F.lit(text).try_cast(key)  # any value of the type; without one a NULL key stays NULL and matches nothing
    c = F.col(right_key)
    keys = right.groupBy(F.coalesce(c, stand_in).alias("__k")).agg(
        F.count(F.lit(1)).alias("__rows"), F.count_if(c.isNull()).alias("__nulls"))
    flags = keys.agg(F.struct((F.coalesce(F.sum("__rows"), F.lit(0)) > 0).alias("any"),
                              (F.coalesce(F.sum("__nulls"), F.lit(0)) > 0).alias("null"))).scalar()
    counted = F.col("__rows") + F.col("__nulls") > 0  # true: it keeps both columns in the join's side
    kept = left.join(keys, (F.col(left_key) == F.col("__k")) & counted, "left_anti")
    return kept.filter(~flags["null"] & (F.col(left_key).isNotNull() | ~flags["any"]))
