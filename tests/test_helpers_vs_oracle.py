"""The Spark text helpers and the oracle's SQL fragments agree on messy spellings, not only on testdata."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from tillroll import functions as TF
from tillroll.plans import oracle as O

PIECES = ["", " ", "null", "NULL", "Null ", " null", "4", "12", "1, 5", "1,5", "2, 6, ", " 7 ", "x", "3.5", "20km",
          "13.4 KM", "23.4 km ", "10", "25mins", "15 minute", "32 minutes", "abc", "1, 1", ",", "0"]


def samples(seed, n=120):
    rng = random.Random(seed)
    out = [None] + PIECES
    for _ in range(n):
        out.append("".join(rng.choice(PIECES) for _ in range(rng.randint(1, 3))))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_helpers_match_oracle_fragments(spark, seed):
    values = samples(seed)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    got = {r.i: tuple(r)[1:] for r in df.select(
        "i",
        TF.has_value("x").alias("hv"),
        TF.number_from_text(F.trim(F.col("x"))).alias("km"),
        TF.int_from_digits("x").alias("mins"),
        TF.double_from_digits("x").alias("mins_d"),
        F.when(TF.has_value("x"), TF.token_count("x")).otherwise(0).alias("ntok"),
        TF.text_ne("x", "null").alias("ne_null"),
    ).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE t (i INTEGER, x VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(values)))
    sql = f"""SELECT i, {O.has_value('x')}, {O.KM.format(c='x')}, {O.MINUTES_INT.format(c='x')},
                     {O.MINUTES.format(c='x', t='DOUBLE')},
                     CASE WHEN {O.has_value('x')} THEN len({O.int_list('x')}) ELSE 0 END,
                     lower(rtrim(x)) <> 'null'
              FROM t"""
    want = {r[0]: tuple(r[1:]) for r in con.execute(sql).fetchall()}
    bad = {values[i]: (got[i], want[i]) for i in got if got[i] != want[i]}
    assert not bad, bad
