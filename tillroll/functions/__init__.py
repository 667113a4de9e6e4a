"""Column-level helpers. Every function takes Columns (or column names) and
returns a Column built only from ``pyspark.sql.functions``, so it stays
inside whole-stage codegen."""

from tillroll.functions.text import (  # noqa: F401
    as_col, null_token, has_value, text_eq, text_ne, text_not_in,
    strip_unit, number_from_text, digits_only, int_from_digits, double_from_digits,
)
from tillroll.functions.lists import (  # noqa: F401
    split_tokens, int_tokens, token_count, ordered_concat, repeat_join,
)
from tillroll.functions.temporal import (  # noqa: F401
    parse_timestamp, minute_boundaries, minutes_elapsed, week_start_monday,
    week_start_anchored, weekday_name, weekday_number, hour_of_day,
)
from tillroll.functions.money import price_map, points  # noqa: F401
