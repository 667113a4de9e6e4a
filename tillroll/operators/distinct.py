"""COUNT(DISTINCT) from sketches that are kept per day and united when asked, next to the exact form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: log2 of a sketch's registers: a relative standard error of about 1.04 / sqrt(2^12) = 1.6 %.
LOG_REGISTERS = 12
STANDARD_ERROR = 1.04 / 2 ** (LOG_REGISTERS / 2)


def daily_sketches(df: DataFrame, day: str, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """``(*keys, day, sketch)``: a HyperLogLog sketch of the non-null values of each day. Appending a
    day's rows touches no other day's sketch."""
    hashed = F.col(value) if dict(df.dtypes)[value] in ("int", "bigint", "string", "binary") else F.col(value).cast("string")
    return df.groupBy(*keys, day).agg(F.hll_sketch_agg(hashed, F.lit(LOG_REGISTERS)).alias("sketch"))


def distinct_estimate(sketches: DataFrame, day: str, keys: Sequence[str] = (), first=None, last=None, out: str = "estimate") -> DataFrame:
    """``(*keys, out)``: distinct values over the days ``first``..``last`` (either may be open), from the
    days' sketches alone. No sketch at all counts zero when there are no keys."""
    if first is not None:
        sketches = sketches.filter(F.col(day) >= F.lit(first))
    if last is not None:
        sketches = sketches.filter(F.col(day) <= F.lit(last))
    united = F.hll_sketch_estimate(F.hll_union_agg("sketch", F.lit(False)))
    return sketches.groupBy(*keys).agg(F.coalesce(united, F.lit(0)).cast("bigint").alias(out))


def near(estimate: Column, exact: Column) -> Column:
    """Whether an estimate lies within three standard errors of the exact count (or one, for small counts)."""
    return F.abs(estimate - exact) <= F.greatest(F.lit(1.0), 3 * STANDARD_ERROR * exact)
