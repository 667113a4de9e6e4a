"""Text columns that carry measures and null markers.

Two families:

* *Cleaning* (``null_token``, ``has_value``, ``number_from_text``): the
  meaning the data intends -- ``NULL``, ``''`` and the string ``'null'`` all
  mean "absent".
* *Dialect comparisons* (``text_eq``, ``text_ne``, ``text_not_in``): the
  result a case-insensitive, blank-padding SQL comparison gives, used by the
  as-written queries (a trailing-blank-insensitive ``'' = ' '`` is TRUE there;
  it is FALSE with Spark's binary string equality).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings that mean "absent" once trimmed and lower-cased.
NULL_MARKERS = ("null", "")


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def binary_text(c) -> Column:
    """The text without a declared collation, for what reads its characters (patterns, splits, numbers)."""
    return F.collate(as_col(c), "UTF8_BINARY")


def null_token(c) -> Column:
    """Trimmed text, or NULL when the value is NULL, blank or a 'null' marker."""
    t = F.trim(as_col(c))
    return F.when(F.lower(t).isin(*NULL_MARKERS), F.lit(None).cast("string")).otherwise(t)


def has_value(c) -> Column:
    """TRUE when the text holds something other than a null marker (never NULL)."""
    return null_token(c).isNotNull()


def _padded(c) -> Column:
    # case-insensitive, trailing blanks ignored
    return F.lower(F.rtrim(as_col(c)))


def text_eq(c, literal: str) -> Column:
    """``c = literal`` under a case-insensitive collation with blank padding (NULL stays NULL)."""
    return _padded(c) == F.lit(literal.lower().rstrip(" "))


def text_ne(c, literal: str) -> Column:
    """``c <> literal`` with the same rules as :func:`text_eq` (NULL stays NULL)."""
    return _padded(c) != F.lit(literal.lower().rstrip(" "))


def text_not_in(c, *literals: str) -> Column:
    """``c NOT IN (literals)`` with blank padding and case folding (NULL stays NULL)."""
    return ~_padded(c).isin(*[x.lower().rstrip(" ") for x in literals])


def strip_unit(c, unit: str) -> Column:
    """Remove every occurrence of ``unit`` (case-insensitive), like REPLACE under a CI collation."""
    return F.regexp_replace(binary_text(c), "(?i)\\Q" + unit + "\\E", "")


def number_from_text(c, unit: str = "km") -> Column:
    """Double from a text measure such as ``'20km'``, ``'23.4 km'`` or ``'10'``; NULL if unparsable."""
    return F.trim(strip_unit(c, unit)).try_cast("double")


def digits_only(c) -> Column:
    """Drop ASCII letters and blanks: ``'32 minutes'`` -> ``'32'``, ``'25mins'`` -> ``'25'``."""
    return F.regexp_replace(binary_text(c), "[A-Za-z ]", "")


def int_from_digits(c) -> Column:
    """Integer minutes from a duration text; NULL when nothing numeric is left."""
    return digits_only(c).try_cast("int")


def double_from_digits(c) -> Column:
    """Like :func:`int_from_digits` but as double (a CAST ... AS FLOAT of the cleaned text)."""
    return digits_only(c).try_cast("double")
