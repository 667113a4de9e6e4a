"""Equi-join on keys that may be NULL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` with ``<=>`` (NULL matches NULL); the output keeps ``left``'s key columns.

    Spark plans ``<=>`` keys as ordinary hash/sort-merge join keys, so this
    shuffles like a plain equi-join. The right keys are renamed first, so the
    two sides may come from the same source DataFrame.
    """
    ren = {k: f"__nsj_{i}" for i, k in enumerate(keys)}
    r = right.select(*[F.col(c).alias(ren[c]) if c in ren else F.col(c) for c in right.columns])
    cond = [F.col(k).eqNullSafe(F.col(ren[k])) for k in keys]
    return left.join(r, cond, how).drop(*ren.values())
