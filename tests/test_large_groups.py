"""Operators whose groups may be of any size: equal to the plain form, and spread over tasks."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tillroll import operators as O


def bag(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_string_agg_equals_listagg(spark, seed):
    r = random.Random(seed)
    rows = [(r.choice(["a", "b", None]), r.choice([1, 2, 2, 3, None]), r.choice(["x", "Y", "", None, "long value"])) for _ in range(80)]
    rows += [("none", 1, None)]
    df = spark.createDataFrame(rows, "k string, o int, v string")
    want = {}
    for k, o, v in rows:
        want.setdefault(k, []).append((o is not None, o or 0, v))
    want = sorted(((k, "; ".join(v for *_, v in sorted(x for x in vs if x[2] is not None))) for k, vs in want.items()), key=repr)
    assert bag(O.string_agg(df, ["k"], "v", ["o"], sep="; ")) == want
    assert O.string_agg(df.limit(0), ["k"], "v", ["o"]).count() == 0


def test_string_agg_of_a_million_entries(spark):
    n = 1_000_000
    df = spark.range(n).select(F.lit("hot").alias("k"), ((F.col("id") * 7919) % n).alias("o")).unionByName(
        spark.range(5).select(F.lit("cold").alias("k"), F.col("id").alias("o"))).withColumn("v", F.col("o").cast("string"))
    # No part of the group is more than a range of it.
    ranges = df.repartitionByRange(8, "k", "o", "v").groupBy(F.spark_partition_id()).count().collect()
    assert max(x["count"] for x in ranges) < n / 4
    got = {r.k: r.text for r in O.string_agg(df, ["k"], "v", ["o"], sep=",").collect()}
    assert got["cold"] == "0,1,2,3,4" and got["hot"] == ",".join(map(str, range(n)))


def test_ranged_dense_rank_spreads_a_hot_partition(spark):
    n = 400_000
    keys = spark.range(n).select(F.lit(1).alias("k"), ((F.col("id") * 7919) % n).alias("o")).unionByName(
        spark.createDataFrame([(2, 5), (2, None), (None, 7), (None, 9), (3, None)], "k int, o long"))
    keys.createOrReplaceTempView("ranged")
    want = spark.sql("select k, o, dense_rank() over (partition by k order by o nulls first) r from ranged")
    got = O.ranged_dense_rank(keys, ["k"], "o", "r")
    assert got.select("k", "o", F.col("r").cast("int")).exceptAll(want).count() == 0 and got.count() == n + 5
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(k#" in plan and ", __range#" in plan


@pytest.mark.parametrize("seed", range(3))
def test_masked_dense_rank_spread(spark, seed):
    r = random.Random(seed)
    rows = [(r.choice(["a", "b", None]), r.choice([None, *range(6)]), r.random() < 0.6) for _ in range(60)]
    df = spark.createDataFrame(rows, "k string, d int, m boolean")
    assert bag(O.masked_dense_rank(df, ["k"], "d", F.col("m"), spread=True)) == bag(O.masked_dense_rank(df, ["k"], "d", F.col("m")))


@pytest.mark.parametrize("seed", range(4))
def test_membership_as_of_repeated_joins(spark, seed):
    r = random.Random(seed)
    day = lambda: r.choice([None, *(dt.date(2021, 1, 1) + dt.timedelta(d) for d in range(20))])
    facts = [(r.choice([1, 2, 3, None]), day(), "x") for _ in range(80)]
    members = [(r.choice([1, 2, None]), day()) for _ in range(9)]
    f = spark.createDataFrame(facts, "customer_id int, order_date date, item string")
    m = spark.createDataFrame(members, "customer_id int, join_date date")
    want = []
    for c, d, item in facts:
        joined = max((j for k, j in members if None not in (c, d, j) and k == c and j <= d), default=None)
        want.append((c, d, item, joined, joined is not None, joined is not None and (d - joined).days < 7))
    got = O.attach_membership_as_of(f, m, first_days=7)
    assert got.columns == ["customer_id", "order_date", "item", "join_date", "is_member", "in_first_days"]
    assert bag(got) == sorted(want, key=repr)


def test_sketches_unite_over_days(spark):
    rows = spark.range(60_000).select((F.col("id") % 20_000).alias("v"), (F.col("id") % 30).alias("day"), (F.col("id") % 2).alias("k"))
    sketches = O.daily_sketches(rows, "day", "v")
    for first, last in ((None, None), (3, 11), (0, 0), (40, 50)):
        part = rows if first is None else rows.filter(F.col("day").between(first, last))
        exact = part.agg(F.countDistinct("v")).first()[0]
        estimate = O.distinct_estimate(sketches, "day", first=first, last=last).first().estimate
        assert abs(estimate - exact) <= 0.05 * exact
    per_key = O.distinct_estimate(O.daily_sketches(rows, "day", "v", ["k"]), "day", ["k"]).collect()
    assert len(per_key) == 2 and all(abs(x.estimate - 10_000) < 500 for x in per_key)


def test_top_with_ties_is_one_pass(spark):
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("g")).agg(F.count(F.lit(1)).alias("n"))
    top = O.top_n_with_ties(df, "n", 1)
    assert sorted(tuple(r) for r in top.collect()) == [(g, 143) for g in range(6)]
    logical = top._jdf.queryExecution().optimizedPlan().toString()
    assert logical.count("Aggregate [") == 1 and "WindowGroupLimit" in logical


def test_not_in_reads_the_subquery_once(spark):
    maybe = F.when(F.col("id") >= 0, F.col("id")).alias("k")  # may be NULL, as far as the optimizer knows
    left, right = spark.range(100).select(maybe), spark.range(50, 60).filter("id <> 55").select(maybe)
    out = O.not_in(left, "k", right, "k")
    assert len(out.collect()) == 91
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan, plan


@pytest.mark.parametrize("kind", ["string", "date", "timestamp", "boolean", "decimal(10,2)"])
def test_not_in_for_every_type(spark, kind):
    values = {"string": ["", "a", "b"], "boolean": ["true", "false", "true"]}.get(kind, ["1970-01-01", "2021-01-02", "2021-01-03"])
    values = ["0", "1", "2"] if kind.startswith("decimal") else values
    left = spark.createDataFrame([(v,) for v in [*values, None]], "k string").select(F.col("k").cast(kind).alias("k"))
    for inner in ([], values[:1], [None], [values[1], None]):
        right = spark.createDataFrame([(v,) for v in inner], "k string").select(F.col("k").cast(kind).alias("k"))
        left.createOrReplaceTempView("l_x")
        right.createOrReplaceTempView("r_x")
        assert bag(O.not_in(left, "k", right, "k")) == bag(spark.sql("SELECT k FROM l_x WHERE k NOT IN (SELECT k FROM r_x)"))
