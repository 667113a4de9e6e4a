"""Calendar helpers agree with the oracle's DuckDB expressions over random dates and times."""

import datetime as dt
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from tillroll import functions as TF


@pytest.mark.parametrize("seed", range(2))
def test_calendar_helpers_match_duckdb(spark, seed):
    rng = random.Random(seed)
    base = dt.datetime(2019, 1, 1)
    rows = []
    for i in range(300):
        a = base + dt.timedelta(seconds=rng.randint(0, 4 * 365 * 86400))
        b = a + dt.timedelta(seconds=rng.randint(0, 5000))
        rows.append((i, a, b, a.date()))
    texts = ["2020-01-03 00:12:37", "null", "", "2020-01-03", "2020-01-03 00:12", "2020-02-30 10:00:00",
             "20200103", "2020-01-03T00:12:37", " 2020-01-03 00:12:37 "]
    df = spark.createDataFrame(rows, "i int, a timestamp_ntz, b timestamp_ntz, d date")
    got = {r.i: tuple(r)[1:] for r in df.select(
        "i", TF.week_start_monday("d"), TF.week_start_anchored("d", dt.date(2021, 1, 1)),
        TF.minute_boundaries("a", "b"), TF.weekday_name("a"), TF.weekday_number("a"), TF.hour_of_day("a")).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE t (i INTEGER, a TIMESTAMP, b TIMESTAMP, d DATE)")
    con.executemany("INSERT INTO t VALUES (?, ?, ?, ?)", rows)
    want = {r[0]: tuple(r[1:]) for r in con.execute("""
        SELECT i, CAST(date_trunc('week', d + 1) AS DATE),
               DATE '2021-01-01' + CAST(floor(date_diff('day', DATE '2021-01-01', d) / 7) * 7 AS INTEGER),
               date_diff('minute', a, b), dayname(a), dayofweek(a) + 1, hour(a)
        FROM t""").fetchall()}
    assert got == want

    tdf = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, x string")
    got_ts = {r.i: r.ts for r in tdf.select("i", TF.parse_timestamp("x").alias("ts")).collect()}
    con.execute("CREATE TABLE s (i INTEGER, x VARCHAR)")
    con.executemany("INSERT INTO s VALUES (?, ?)", list(enumerate(texts)))
    want_ts = {r[0]: r[1] for r in con.execute("SELECT i, TRY_CAST(x AS TIMESTAMP) FROM s").fetchall()}
    diff = {texts[i]: (got_ts[i], want_ts[i]) for i in got_ts if got_ts[i] != want_ts[i]}
    assert not diff, diff
