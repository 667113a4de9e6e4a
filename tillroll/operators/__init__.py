"""DataFrame -> DataFrame operators. Column names are parameters; nothing here
knows about a particular domain. No operator collects to the driver, and no
operator gathers an unbounded group into one task: extremes are rank filters
that Spark limits map-side before the shuffle, top-k with ties uses a scalar
threshold, ranks are taken over de-duplicated keys, list work runs once per
distinct list text."""

from tillroll.operators.extremes import rows_at_extreme, top_n_with_ties, most_frequent_per_key  # noqa: F401
from tillroll.operators.ranking import masked_dense_rank, ranged_dense_rank  # noqa: F401
from tillroll.operators.membership import attach_membership, attach_membership_as_of  # noqa: F401
from tillroll.operators.antijoin import not_in  # noqa: F401
from tillroll.operators.lists import (  # noqa: F401
    explode_tokens, token_frequency, recipe_entries, variant_quantities, labelled_tokens,
    topping_dictionary, recipe_arrays, recipe_positions, net_quantities, quantity_list,
)
from tillroll.operators.pivot import pivot_counts  # noqa: F401
from tillroll.operators.joins import null_safe_join  # noqa: F401
from tillroll.operators.strings import string_agg  # noqa: F401
from tillroll.operators.distinct import daily_sketches, distinct_estimate  # noqa: F401
