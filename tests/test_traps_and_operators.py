"""Tier 2: one test per dialect trap and per operator edge case."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tillroll import functions as TF
from tillroll import operators as O

D = dt.date
TS = dt.datetime.fromisoformat


def one(spark, col, value, dtype="string"):
    df = spark.createDataFrame([(value,)], f"x {dtype}")
    return df.select(col.alias("r")).first()["r"]


# T1 / T8: blank padding and case folding ------------------------------------
@pytest.mark.parametrize("v,expected", [(None, None), ("", None), ("  ", None), ("null", None), ("NULL ", None),
                                        (" 4 ", "4"), ("1, 5", "1, 5")])
def test_null_token(spark, v, expected):
    assert one(spark, TF.null_token("x"), v) == expected


@pytest.mark.parametrize("v,eq", [("null", True), ("NULL", True), ("null  ", True), (" null", False),
                                  ("2020-01-01 10:00:00", False), (None, None)])
def test_text_eq_is_padded_and_case_insensitive(spark, v, eq):
    assert one(spark, TF.text_eq("x", "null"), v) == eq
    assert one(spark, TF.text_ne("x", "null"), v) == (None if eq is None else not eq)


def test_text_not_in_treats_empty_as_blank(spark):
    assert one(spark, TF.text_not_in(F.trim("x"), "null", " "), "") is False
    assert one(spark, TF.text_not_in(F.trim("x"), "null", " "), "4") is True


# T2: NOT IN with NULLs --------------------------------------------------------
def test_not_in_semantics(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    r_plain = spark.createDataFrame([(2,)], "k int")
    r_null = spark.createDataFrame([(2,), (None,)], "k int")
    r_empty = spark.createDataFrame([], "k int")
    got = lambda r: sorted((x["k"] for x in O.not_in(left, "k", r, "k").collect()), key=lambda v: (v is None, v))
    assert got(r_plain) == [1]
    assert got(r_null) == []
    assert got(r_empty) == [1, 2, None]


def test_not_in_plan_needs_no_broadcast_nested_loop(spark):
    left = spark.range(100).withColumnRenamed("id", "k")
    right = spark.range(50).withColumnRenamed("id", "k")
    plan = O.not_in(left, "k", right, "k")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan


# T3: minute boundaries ----------------------------------------------------------
def test_minute_boundaries_vs_elapsed(spark):
    df = spark.createDataFrame([(TS("2020-01-04 13:23:46"), TS("2020-01-04 13:53:03")),
                                (TS("2020-01-01 10:59:59"), TS("2020-01-01 11:00:00"))], "a timestamp_ntz, b timestamp_ntz")
    got = df.select(TF.minute_boundaries("a", "b").alias("m"), TF.minutes_elapsed("a", "b").alias("e")).collect()
    assert [(r.m, r.e) for r in got] == [(30, 29), (1, 0)]


# T4: week buckets ---------------------------------------------------------------
@pytest.mark.parametrize("d,monday,anchored", [
    (D(2021, 1, 1), D(2020, 12, 28), D(2021, 1, 1)), (D(2021, 1, 2), D(2020, 12, 28), D(2021, 1, 1)),
    (D(2021, 1, 3), D(2021, 1, 4), D(2021, 1, 1)), (D(2021, 1, 4), D(2021, 1, 4), D(2021, 1, 1)),
    (D(2021, 1, 8), D(2021, 1, 4), D(2021, 1, 8)), (D(2020, 12, 31), D(2020, 12, 28), D(2020, 12, 25))])
def test_week_buckets(spark, d, monday, anchored):
    assert one(spark, TF.week_start_monday("x"), d, "date") == monday
    assert one(spark, TF.week_start_anchored("x", D(2021, 1, 1)), d, "date") == anchored


# T5: text measures ---------------------------------------------------------------
@pytest.mark.parametrize("v,km", [("20km", 20.0), ("13.4km", 13.4), ("23.4", 23.4), ("23.4 km", 23.4),
                                  ("20KM", 20.0), ("null", None), ("", None), (None, None), ("abc", None)])
def test_number_from_text(spark, v, km):
    assert one(spark, TF.number_from_text("x"), v) == km


@pytest.mark.parametrize("v,mins", [("32 minutes", 32), ("20 mins", 20), ("40", 40), ("25mins", 25),
                                    ("15 minute", 15), ("10minutes", 10), ("null", None), ("", None)])
def test_int_from_digits(spark, v, mins):
    assert one(spark, TF.int_from_digits("x"), v) == mins


def test_parse_timestamp_rejects_markers(spark):
    assert one(spark, TF.parse_timestamp("x"), "null") is None
    assert one(spark, TF.parse_timestamp("x"), "2020-01-03 00:12:37") == TS("2020-01-03 00:12:37")


# T7: weekday names -----------------------------------------------------------------
def test_weekday(spark):
    ts = TS("2020-01-05 12:00:00")  # a Sunday
    assert one(spark, TF.weekday_name("x"), ts, "timestamp_ntz") == "Sunday"
    assert one(spark, TF.weekday_number("x"), ts, "timestamp_ntz") == 1


# lists -------------------------------------------------------------------------------
def test_int_tokens_and_count(spark):
    assert one(spark, TF.int_tokens("x"), "1, 5, x, ") == [1, 5]
    assert one(spark, TF.int_tokens("x", distinct=True), "1, 1, 5") == [1, 5]
    assert one(spark, TF.token_count("x"), None) == 0
    assert one(spark, TF.token_count("x"), "1, 4") == 2


def test_recipe_entries_semi_join_and_text_match(spark):
    rec = spark.createDataFrame([(1, "1, 1, 01, 2")], "pizza_id int, toppings string")
    top = spark.createDataFrame([(1, "A"), (2, "B")], "topping_id int, topping_name string")
    got = sorted(tuple(r) for r in O.recipe_entries(rec, top).collect())
    assert got == [(1, 1, "A"), (1, 2, "B")]  # '1' repeated counts once; '01' is not '1' as text
    got_int = sorted(tuple(r) for r in O.recipe_entries(rec, top, match="int").collect())
    assert got_int == [(1, 1, "A"), (1, 2, "B")]


def test_token_frequency_counts_repeats(spark):
    df = spark.createDataFrame([("1, 1",), ("1, 5",), ("x",), (None,)], "l string")
    assert sorted(tuple(r) for r in O.token_frequency(df, "l").collect()) == [(1, 3), (5, 1)]


def test_labelled_tokens_keeps_unknown_ids(spark):
    texts = spark.createDataFrame([("2, 99",)], "t string")
    top = spark.createDataFrame([(2, "B")], "topping_id int, topping_name string")
    assert O.labelled_tokens(texts, "t", top).first()["label"] == "B, 99"


def test_variant_quantities(spark):
    v = spark.createDataFrame([(1, "4", "4, 1, 1")], "pizza_id int, exclusions string, extras string")
    rid = spark.createDataFrame([(1, 4), (1, 2)], "pizza_id int, topping_id int")
    got = sorted((r.topping_id, r.qty) for r in O.variant_quantities(v, rid, ["pizza_id", "exclusions", "extras"])
                 .collect())
    assert got == [(1, 2), (2, 1), (4, 1)]  # excluded then added back -> 1; extra twice -> 2


def test_ordered_concat_and_repeat_join(spark):
    df = spark.createDataFrame([("g", 2, "b"), ("g", 1, "a"), ("g", 3, "c")], "g string, k int, v string")
    assert df.groupBy("g").agg(TF.ordered_concat("v", "k").alias("s")).first()["s"] == "a, b, c"
    arr = F.array(F.struct(F.lit("x").alias("label"), F.lit(2).alias("n")),
                  F.struct(F.lit("y").alias("label"), F.lit(1).alias("n")))
    assert df.limit(1).select(TF.repeat_join(arr).alias("s")).first()["s"] == "x, x, y"


# ties, extremes, ranks -------------------------------------------------------------
def test_rows_at_extreme_keeps_ties_and_duplicates(spark):
    df = spark.createDataFrame([("A", 1, "x"), ("A", 1, "x"), ("A", 1, "y"), ("A", 2, "z"), (None, 0, "n")],
                               "k string, d int, v string")
    got = sorted(tuple(r) for r in O.rows_at_extreme(df, ["k"], "d", "min").select("k", "d", "v").collect())
    assert got == [("A", 1, "x"), ("A", 1, "x"), ("A", 1, "y")]


def test_top_n_with_ties(spark):
    df = spark.createDataFrame([(1, 5), (2, 5), (3, 4), (4, 3), (5, None)], "id int, v int")
    assert sorted(r.id for r in O.top_n_with_ties(df, "v", 1).collect()) == [1, 2]
    assert sorted(r.id for r in O.top_n_with_ties(df, "v", 3).collect()) == [1, 2, 3]
    assert sorted(r.id for r in O.top_n_with_ties(df, "v", 1, descending=False).collect()) == [5]  # NULL is the smallest value


def test_most_frequent_per_key(spark):
    df = spark.createDataFrame([("A", 1), ("A", 2), ("A", 2), ("B", 1), ("B", 2)], "k string, i int")
    got = sorted((r.k, r.i) for r in O.most_frequent_per_key(df, ["k"], "i").collect())
    assert got == [("A", 2), ("B", 1), ("B", 2)]


def test_masked_dense_rank_null_keys_and_mask(spark):
    df = spark.createDataFrame([(None, 1, True), (None, 2, True), (None, 2, True), ("A", 5, False), ("A", 6, True)],
                               "k string, d int, m boolean")
    got = sorted(((r.k or ""), r.d, r.ranks) for r in O.masked_dense_rank(df, ["k"], "d", F.col("m")).collect())
    assert got == [("", 1, 1), ("", 2, 2), ("", 2, 2), ("A", 5, None), ("A", 6, 1)]


def test_pivot_counts_zero_filled(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "c int, p string")
    got = sorted(tuple(r) for r in O.pivot_counts(df, ["c"], "p", {"a": "A", "b": "B"}).collect())
    assert got == [(1, 2, 0), (2, 0, 1)]


def test_null_safe_join(spark):
    a = spark.createDataFrame([(None, 1), ("x", 2)], "k string, v int")
    b = spark.createDataFrame([(None, 10), ("x", 20)], "k string, w int")
    assert sorted((r.v, r.w) for r in O.null_safe_join(a, b, ["k"]).collect()) == [(1, 10), (2, 20)]


def test_attach_membership_first_days(spark):
    f = spark.createDataFrame([("A", D(2021, 1, 7)), ("A", D(2021, 1, 13)), ("A", D(2021, 1, 14)), ("C", D(2021, 1, 1))],
                              "customer_id string, order_date date")
    m = spark.createDataFrame([("A", D(2021, 1, 7))], "customer_id string, join_date date")
    got = sorted((r.customer_id, r.order_date.day, r.is_member, r.in_first_days)
                 for r in O.attach_membership(f, m, first_days=7).collect())
    assert got == [("A", 7, True, True), ("A", 13, True, True), ("A", 14, True, False), ("C", 1, False, False)]


def test_price_map_and_points(spark):
    assert one(spark, TF.price_map("x", {"a": 12, "b": 10}), "b") == 10
    assert one(spark, TF.price_map("x", {"a": 12, "b": 10}), "z") == 0
    assert one(spark, TF.points(F.lit(10), F.col("x") == "s"), "s") == 200
