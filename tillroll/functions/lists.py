"""Lists stored as comma-separated text, and ordered concatenation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillroll.functions.text import as_col, binary_text


def split_tokens(c, sep: str = ",") -> Column:
    """``'1, 5'`` -> ``['1', '5']`` (each token trimmed). NULL stays NULL, ``''`` gives ``['']``."""
    return F.transform(F.split(binary_text(c), sep), lambda t: F.trim(t))


def int_tokens(c, sep: str = ",", distinct: bool = False) -> Column:
    """Tokens cast to int; tokens that are not integers are dropped."""
    ids = F.filter(F.transform(split_tokens(c, sep), lambda t: t.try_cast("int")),
                   lambda x: x.isNotNull())
    return F.array_distinct(ids) if distinct else ids


def token_count(c, sep: str = ",") -> Column:
    """Number of integer tokens in a list text (0 for NULL)."""
    ids = int_tokens(c, sep)
    return F.when(ids.isNull(), F.lit(0)).otherwise(F.size(ids))


def ordered_concat(value, *order_by, sep: str = ", ") -> Column:
    """Aggregate: join ``value`` over a group, ordered by ``order_by`` (then by value).

    Implemented as ``collect_list(struct) -> array_sort -> transform -> array_join``;
    only use it where the group size is bounded (a recipe, a list).
    """
    keys = [as_col(k).alias(f"k{i}") for i, k in enumerate(order_by)]
    items = F.array_sort(F.collect_list(F.struct(*keys, as_col(value).alias("v"))))
    return F.array_join(F.transform(items, lambda s: s["v"]), sep)


def repeat_join(entries: Column, sep: str = ", ") -> Column:
    """Join an array of ``struct(label, n)`` as each label repeated ``n`` times.

    Lets a group hold one entry per distinct label with a count instead of
    one array element per input row.
    """
    parts = F.transform(entries, lambda s: F.array_join(F.array_repeat(s["label"], s["n"].cast("int")), sep))
    return F.array_join(parts, sep)
