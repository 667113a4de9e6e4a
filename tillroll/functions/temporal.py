"""Calendar and clock helpers."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillroll.functions.text import as_col


def parse_timestamp(c) -> Column:
    """Text -> TIMESTAMP_NTZ with the standard cast grammar; NULL when unparsable ('null', '')."""
    return as_col(c).try_cast("timestamp_ntz")


def minute_boundaries(start, end) -> Column:
    """Minute boundaries crossed between two timestamps (a DATEDIFF(minute, ...) count).

    10:59:59 -> 11:00:00 is 1, unlike the elapsed-minutes count which is 0.
    """
    return F.timestamp_diff("MINUTE", F.date_trunc("minute", as_col(start)),
                            F.date_trunc("minute", as_col(end)))


def minutes_elapsed(start, end) -> Column:
    """Whole minutes elapsed between two timestamps."""
    return F.timestamp_diff("MINUTE", as_col(start), as_col(end))


def week_start_monday(d) -> Column:
    """Start of the week counted in Sunday boundaries from a Monday epoch.

    Monday..Saturday map to that week's Monday; a Sunday maps to the next day.
    """
    return F.date_trunc("week", F.date_add(as_col(d), 1)).cast("date")


def week_start_anchored(d, anchor: _dt.date | str) -> Column:
    """Start of the 7-day bucket, counted from ``anchor``, that holds ``d``."""
    a = F.lit(anchor if isinstance(anchor, _dt.date) else _dt.date.fromisoformat(anchor))
    return F.date_add(a, (F.floor(F.datediff(as_col(d), a) / 7) * 7).cast("int"))


def weekday_name(ts) -> Column:
    """English weekday name, e.g. 'Wednesday'."""
    return F.date_format(as_col(ts), "EEEE")


def weekday_number(ts) -> Column:
    """1 = Sunday ... 7 = Saturday."""
    return F.dayofweek(as_col(ts))


def hour_of_day(ts) -> Column:
    return F.hour(as_col(ts))
