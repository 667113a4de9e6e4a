"""Tier 1: loyalty queries on the seed rows vs the FIXTURES goldens (order included)."""

import datetime as dt

import pytest

from tests import seed
from tillroll.plans import loyalty as L

D = dt.date


@pytest.fixture(scope="module")
def t(spark):
    return seed.loyalty(spark)


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_l01(t):
    assert rows(L.l01_total_spend(t)) == [("A", 76), ("B", 74), ("C", 36)]


def test_l02(t):
    assert rows(L.l02_visit_days(t)) == [("A", 4), ("B", 6), ("C", 2)]


def test_l03_ties_and_duplicates_kept(t):
    d = D(2021, 1, 1)
    assert rows(L.l03_first_day_items(t)) == [("A", "curry", d), ("A", "sushi", d), ("B", "curry", d),
                                              ("C", "ramen", d), ("C", "ramen", d)]


def test_l04(t):
    assert rows(L.l04_most_purchased(t)) == [("ramen", 8)]


def test_l05_ties(t):
    assert rows(L.l05_favourite_items(t)) == [("A", 3, "ramen"), ("B", 2, "curry"), ("B", 3, "ramen"),
                                              ("B", 1, "sushi"), ("C", 3, "ramen")]


def test_l06_same_day_counts_as_member(t):
    assert rows(L.l06_first_after_joining(t)) == [("A", 2, "curry", D(2021, 1, 7)), ("B", 1, "sushi", D(2021, 1, 11))]


def test_l07(t):
    assert rows(L.l07_last_before_joining(t)) == [("A", 2, "curry", D(2021, 1, 1)), ("A", 1, "sushi", D(2021, 1, 1)),
                                                  ("B", 1, "sushi", D(2021, 1, 4))]


def test_l08(t):
    assert rows(L.l08_before_joining_totals(t)) == [("A", 2, 25), ("B", 3, 40)]


def test_l09(t):
    assert rows(L.l09_points(t, seed.featured())) == [("A", 860), ("B", 940), ("C", 360)]


def test_l10(t):
    out = L.l10_points_first_week(t, seed.featured(), seed.CUTOFF, seed.CUSTOMERS)
    assert rows(out) == [("A", 1370), ("B", 820)]


def test_l10_all_customers_keeps_nonmembers(t):
    out = dict(rows(L.l10_points_first_week(t, seed.featured(), seed.CUTOFF)))
    assert out == {"A": 1370, "B": 820, "C": 360}


def test_l11(t):
    got = rows(L.l11_member_timeline(t))
    assert len(got) == 15
    assert got[:6] == [
        ("A", D(2021, 1, 1), "curry", 15, "NO"), ("A", D(2021, 1, 1), "sushi", 10, "NO"),
        ("A", D(2021, 1, 7), "curry", 15, "YES"), ("A", D(2021, 1, 10), "ramen", 12, "YES"),
        ("A", D(2021, 1, 11), "ramen", 12, "YES"), ("A", D(2021, 1, 11), "ramen", 12, "YES")]
    assert [r[4] for r in got if r[0] == "C"] == ["NO", "NO", "NO"]


def test_l12_ranks_only_member_rows(t):
    got = [(r[0], r[1], r[5]) for r in rows(L.l12_member_ranking(t))]
    assert got == [
        ("A", D(2021, 1, 1), None), ("A", D(2021, 1, 1), None), ("A", D(2021, 1, 7), 1), ("A", D(2021, 1, 10), 2),
        ("A", D(2021, 1, 11), 3), ("A", D(2021, 1, 11), 3),
        ("B", D(2021, 1, 1), None), ("B", D(2021, 1, 2), None), ("B", D(2021, 1, 4), None),
        ("B", D(2021, 1, 11), 1), ("B", D(2021, 1, 16), 2), ("B", D(2021, 2, 1), 3),
        ("C", D(2021, 1, 1), None), ("C", D(2021, 1, 1), None), ("C", D(2021, 1, 7), None)]


def test_null_keys_sort_last(spark):
    """The loyalty queries' dialect sorts NULLs last in ascending order."""
    from tillroll.sources import tables as TT
    from tillroll.sources.tables import LoyaltyTables
    rows = seed.SALES + [(None, D(2021, 1, 3), 1)]
    t = LoyaltyTables(spark.createDataFrame(rows, TT.SALES), spark.createDataFrame(seed.MENU, TT.MENU),
                      spark.createDataFrame(seed.MEMBERS, TT.MEMBERS))
    assert [r[0] for r in rows_of(L.l02_visit_days(t))] == ["A", "B", "C", None]


def rows_of(df):
    return [tuple(r) for r in df.collect()]
