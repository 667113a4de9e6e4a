"""Operators vs the plain SQL they replace, on random small inputs (brute-force oracle)."""

import random

import pytest
from pyspark.sql import functions as F

from tillroll import operators as O

SEEDS = range(6)


def rand_rows(rng, n, keys, values, null_rate=0.15):
    def v(domain):
        return None if rng.random() < null_rate else rng.choice(domain)
    return [(v(keys), v(values)) for _ in range(n)]


def bag(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed", SEEDS)
def test_not_in_equals_sql_not_in(spark, seed):
    rng = random.Random(seed)
    left = spark.createDataFrame([(r[0],) for r in rand_rows(rng, 30, range(8), [0])], "k int")
    right = spark.createDataFrame([(r[0],) for r in rand_rows(rng, rng.choice([0, 3, 10]), range(8), [0],
                                                             null_rate=rng.choice([0.0, 0.2]))], "k int")
    left.createOrReplaceTempView("l_t")
    right.createOrReplaceTempView("r_t")
    expected = spark.sql("SELECT k FROM l_t WHERE k NOT IN (SELECT k FROM r_t)")
    assert bag(O.not_in(left, "k", right, "k")) == bag(expected)


@pytest.mark.parametrize("seed", SEEDS)
def test_rows_at_extreme_equals_rank_filter(spark, seed):
    rng = random.Random(seed)
    df = spark.createDataFrame(rand_rows(rng, 40, ["a", "b", "c"], range(5)), "k string, d int")
    df.createOrReplaceTempView("x_t")
    for which, order in (("min", "ASC"), ("max", "DESC")):
        expected = spark.sql(f"""SELECT k, d FROM (SELECT k, d, RANK() OVER (PARTITION BY k ORDER BY d {order}) r
                                 FROM x_t WHERE k IS NOT NULL AND d IS NOT NULL) WHERE r = 1""")
        assert bag(O.rows_at_extreme(df, ["k"], "d", which).select("k", "d")) == bag(expected)


@pytest.mark.parametrize("seed", SEEDS)
def test_masked_dense_rank_equals_window(spark, seed):
    rng = random.Random(seed)
    rows = [(k, d, rng.random() < 0.6) for k, d in rand_rows(rng, 40, ["a", "b"], range(6))]
    df = spark.createDataFrame(rows, "k string, d int, m boolean")
    df.createOrReplaceTempView("y_t")
    expected = spark.sql("""SELECT k, d, m, CASE WHEN m THEN CAST(DENSE_RANK() OVER (PARTITION BY k, m ORDER BY d) AS BIGINT)
                            END AS ranks FROM y_t""")
    for few_rows in (False, True):
        got = O.masked_dense_rank(df, ["k", "m"], "d", F.col("m"), few_rows=few_rows).select("k", "d", "m", "ranks")
        assert bag(got) == bag(expected)


@pytest.mark.parametrize("seed", SEEDS)
def test_top_n_with_ties_brute_force(spark, seed):
    rng = random.Random(seed)
    vals = [rng.choice([None, *range(6)]) for _ in range(25)]
    df = spark.createDataFrame(list(enumerate(vals)), "id int, v int")
    size = [-1 if v is None else v for v in vals]  # NULL is the smallest
    for n in (1, 2, 5, 24, 30):
        for down in (True, False):
            nth = sorted(size, reverse=down)[min(n, len(size)) - 1]
            assert sorted(r.id for r in O.top_n_with_ties(df, "v", n, down).collect()) == \
                [i for i, v in enumerate(size) if (v >= nth if down else v <= nth)]
    nulls = spark.createDataFrame([(1, None), (2, None)], "id int, v int")
    assert O.top_n_with_ties(nulls, "v").count() == O.top_n_with_ties(nulls, "v", 1, False).count() == 2


@pytest.mark.parametrize("seed", SEEDS)
def test_most_frequent_equals_dense_rank(spark, seed):
    rng = random.Random(seed)
    df = spark.createDataFrame(rand_rows(rng, 50, ["a", "b", "c"], range(4), null_rate=0.2), "k string, i int")
    df.createOrReplaceTempView("z_t")
    expected = spark.sql("""SELECT k, i FROM (SELECT k, i, DENSE_RANK() OVER (PARTITION BY k ORDER BY c DESC) r
                            FROM (SELECT k, i, COUNT(*) c FROM z_t GROUP BY k, i)) WHERE r = 1""")
    assert bag(O.most_frequent_per_key(df, ["k"], "i").select("k", "i")) == bag(expected)
