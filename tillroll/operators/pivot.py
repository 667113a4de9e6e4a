"""Counts pivoted into one column per value."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pivot_counts(df: DataFrame, keys: Sequence[str], pivot_col: str, values: Mapping) -> DataFrame:
    """One row per key; column ``values[v]`` counts rows with ``pivot_col = v`` (0 when none).

    Conditional counts in a single hash aggregate (what ``pivot`` with a fixed
    value list compiles to, minus the null-filling step).
    """
    return df.groupBy(*keys).agg(*[
        F.count(F.when(F.col(pivot_col) == F.lit(v), F.lit(1))).alias(name) for v, name in values.items()
    ])
