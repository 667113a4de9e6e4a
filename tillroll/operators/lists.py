"""Operators over list-in-text columns (``'1, 5'``).

Scale rule used throughout: list texts repeat a lot (a handful of distinct
texts over billions of item rows), so each operator first reduces the rows to
*distinct list texts with a count* (a partial+final hash aggregate that
survives any hot key), explodes only those, and carries the count as a weight.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.lists import int_tokens, split_tokens
from tillroll.functions.text import binary_text, null_token


def explode_tokens(df: DataFrame, list_col: str, out: str = "token", keep: Sequence[str] = ()) -> DataFrame:
    """One row per token of ``list_col`` (trimmed text, duplicates kept), like a lateral split.

    NULL lists give no rows; ``''`` gives one empty token.
    """
    return df.select(*keep, F.explode(split_tokens(list_col)).alias(out))


def token_frequency(df: DataFrame, list_col: str, out: str = "token_id", weight: Column | None = None) -> DataFrame:
    """Occurrences of each integer token across all rows' lists: ``(out, n)``.

    Tokens are matched as integers (implicit text->int comparison); tokens that
    are not integers match nothing. Duplicated tokens in one list count twice.
    """
    w = F.lit(1) if weight is None else weight
    lists = df.groupBy(list_col).agg(F.sum(w).alias("__n"))
    toks = explode_tokens(lists, list_col, "__t", keep=["__n"])
    return (toks.groupBy(F.col("__t").try_cast("int").alias(out))
                .agg(F.sum("__n").alias("n"))
                .filter(F.col(out).isNotNull()))


def recipe_entries(recipes: DataFrame, toppings: DataFrame, key: str = "pizza_id", list_col: str = "toppings",
                   id_col: str = "topping_id", name_col: str = "topping_name", match: str = "text") -> DataFrame:
    """``(key, id_col, name_col)``: every toppings row whose id is in a recipe's list.

    Membership is a semi join per recipe row (a repeated id counts once).
    ``match='text'`` compares the id rendered as text with the trimmed token
    (``CAST(id AS VARCHAR) IN (SELECT TRIM(value) ...)``: '01' does not match 1);
    ``match='int'`` parses tokens as integers. The recipe side is exploded once
    per recipe row, never per order.
    """
    if match == "text":
        ent = recipes.select(key, F.explode(F.array_distinct(split_tokens(list_col))).alias("__tok"))
        cond = F.col(id_col).cast("string") == F.col("__tok")
    else:
        ent = recipes.select(key, F.explode(int_tokens(list_col, distinct=True)).alias("__tok"))
        cond = F.col(id_col) == F.col("__tok")
    return ent.join(toppings.select(id_col, name_col), cond).select(key, id_col, name_col)


def variant_quantities(variants: DataFrame, recipe_ids: DataFrame, keys: Sequence[str],
                       pizza_key: str = "pizza_id", removes: str = "exclusions", adds: str = "extras",
                       id_col: str = "topping_id", carry: Sequence[str] = ()) -> DataFrame:
    """Per variant (``keys`` = pizza + raw removes/adds texts), the quantity of each ingredient.

    quantity = [in recipe] - [in removes] + (occurrences in adds); only positive
    quantities are returned: ``(*keys, *carry, id_col, qty)``. ``variants`` must
    hold distinct keys; ``carry`` columns (e.g. a row count per variant) ride
    along unchanged. ``recipe_ids`` is ``(pizza_key, id_col)``.

    ``variants`` is read once: each variant gets its recipe as one array
    (recipe-sized, from a per-pizza aggregate), and a single explode of
    ``recipe (+1) ++ removes (-1) ++ adds (+1)`` feeds one aggregate.
    """
    cols = [*keys, *carry]
    recipes = recipe_ids.groupBy(pizza_key).agg(F.array_distinct(F.collect_list(id_col)).alias("__rids"))
    delta_t = "array<struct<id:bigint,d:int>>"

    def tagged(ids: Column, d: int) -> Column:
        return F.coalesce(F.transform(ids, lambda x: F.struct(x.cast("bigint").alias("id"), F.lit(d).alias("d"))),
                          F.array().cast(delta_t))

    deltas = F.concat(tagged(F.col("__rids"), 1),
                      tagged(int_tokens(null_token(removes), distinct=True), -1),
                      tagged(int_tokens(null_token(adds)), 1))
    return (variants.join(recipes, pizza_key, "left")
                    .select(*cols, F.explode(deltas).alias("__e"))
                    .groupBy(*cols, F.col("__e.id").alias(id_col)).agg(F.sum("__e.d").alias("qty"))
                    .filter(F.col("qty") > 0))


def labelled_tokens(texts: DataFrame, text_col: str, toppings: DataFrame, id_col: str = "topping_id",
                    name_col: str = "topping_name", sep: str = ", ", out: str = "label") -> DataFrame:
    """Map each distinct list text to the names of its ids, in list order: ``(text_col, out)``.

    ``'2, 6'`` -> ``'BBQ Sauce, Mushrooms'``. Empty tokens are dropped; a token
    without a matching id keeps its text; a duplicated id in the dimension uses
    its smallest name. Runs over distinct texts only.
    """
    names = toppings.groupBy(id_col).agg(F.min(binary_text(name_col)).alias("__name"))
    toks = (texts.select(text_col).distinct()
                 .select(text_col, F.posexplode(split_tokens(text_col)).alias("__pos", "__tok"))
                 .filter(F.col("__tok") != ""))
    named = toks.join(names, F.col("__tok").try_cast("int") == F.col(id_col), "left")
    word = F.coalesce(F.col("__name"), F.col("__tok"))
    parts = F.array_sort(F.collect_list(F.struct(F.col("__pos"), word.alias("w"))))
    return named.groupBy(text_col).agg(F.array_join(F.transform(parts, lambda s: s["w"]), sep).alias(out))


# ------------------------------------------------------- dictionary arithmetic
#: Most toppings of a dictionary that rides along as one value. Larger dimensions are joined instead.
DICTIONARY_ROWS = 2000


def topping_dictionary(toppings: DataFrame, id_col: str = "topping_id", name_col: str = "topping_name",
                       most: int = DICTIONARY_ROWS) -> Column | None:
    """The toppings in alphabetical order as one scalar, ``array<struct<k0, k1, id>>`` (k1 the name, k0 its
    lower case); None if there are more than ``most``, which is checked on the table as it stands."""
    if toppings.select(F.lit(1)).limit(most + 1).count() > most:
        return None
    name = binary_text(name_col)
    entry = F.struct(F.lower(name).alias("k0"), name.alias("k1"), F.col(id_col).alias("id"))
    return toppings.agg(F.array_sort(F.collect_list(entry)).alias("d")).scalar()


def listed_entries(dictionary: Column, tokens: Column, match: str = "int") -> Column:
    """The dictionary's entries whose id is among ``tokens``, in its order (none for NULL)."""
    def hit(e):
        return F.array_contains(tokens, e["id"] if match == "int" else e["id"].cast("string"))
    return F.coalesce(F.filter(dictionary, hit), F.filter(dictionary, lambda e: F.lit(False)))


def recipe_arrays(recipes: DataFrame, dictionary: Column, key: str = "pizza_id", list_col: str = "toppings",
                  match: str = "text", out: str = "recipe") -> DataFrame:
    """``(key, out)``: the entries of each recipe as one array in the dictionary's order.

    The array form of :func:`recipe_entries`: no explode and no join with the
    toppings. With ``match='text'`` a repeated recipe row repeats its entries,
    as a join would; with ``match='int'`` ids are a set.
    """
    d = F.col("__d")  # a subquery can't stand inside of a lambda's function, a column can
    if match == "int":
        ids = recipes.groupBy(key).agg(F.flatten(F.collect_set(int_tokens(list_col, distinct=True))).alias("__ids"))
        return ids.withColumn("__d", dictionary).select(key, listed_entries(d, F.col("__ids")).alias(out))
    tokens = F.array_distinct(split_tokens(list_col))
    per_text = recipes.groupBy(key, list_col).agg(F.count(F.lit(1)).alias("__n")).withColumn("__d", dictionary)
    rows = per_text.select(key, F.flatten(F.array_repeat(listed_entries(d, tokens, "text"), F.col("__n").cast("int"))).alias("__e"))
    return rows.groupBy(key).agg(F.array_sort(F.flatten(F.collect_list("__e"))).alias(out))


def recipe_positions(recipes: DataFrame, dictionary: Column, out: str = "recipe") -> DataFrame:
    """:func:`recipe_arrays` with each entry as its place in the dictionary (from 0), for plans that sort
    or group many rows with their recipes. Equal entries share a place."""
    place = F.transform(out, lambda e: F.array_position(F.col("__d"), e).cast("int") - 1)
    return recipes.withColumn("__d", dictionary).withColumn(out, place).drop("__d")


def net_quantities(dictionary: Column, recipe: Column, removes: Column, adds: Column) -> Column:
    """``array<struct<k1, qty>>`` of what is left of a recipe: [in recipe] - [in removes] + occurrences in
    adds, entries above zero, in the dictionary's order. ``recipe`` holds entries, the others ids."""
    nothing = F.array().cast("array<int>")
    removes, adds = F.coalesce(removes, nothing), F.coalesce(adds, nothing)
    ids = F.transform(recipe, lambda e: e["id"])

    def qty(e):
        return (F.when(F.array_contains(ids, e["id"]), 1).otherwise(0) - F.when(F.array_contains(removes, e["id"]), 1).otherwise(0)
                + F.size(F.filter(adds, lambda a: a == e["id"])))

    touched = F.filter(dictionary, lambda e: F.array_contains(F.concat(ids.cast("array<int>"), adds), e["id"].cast("int")))
    return F.filter(F.transform(touched, lambda e: F.struct(e["k1"].alias("k1"), qty(e).alias("qty"))), lambda e: e["qty"] > 0)


def quantity_list(entries: Column, sep: str = ", ") -> Column:
    """'2xBacon, Cheese' from ``array<struct<k1, qty>>``."""
    return F.array_join(F.transform(entries, lambda e: F.when(
        e["qty"] > 1, F.concat(e["qty"].cast("string"), F.lit("x"), e["k1"])).otherwise(e["k1"])), sep)
