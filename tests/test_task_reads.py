"""Retail queries merge shuffle partitions to at most what a task may read, whatever the session's own size."""

import re

import pytest

import __spark_entry__ as entry
from tillroll.session import PLAN_SETTINGS, _bytes, bound_task_reads

KEY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


@pytest.fixture
def advised(spark):
    old = spark.conf.get(KEY)
    yield lambda size: spark.conf.set(KEY, size)
    spark.conf.set(KEY, old)


@pytest.mark.parametrize("own, want", [("64m", "8m"), ("67108864b", "8m"), ("1g", "8m"), ("8m", "8m"), ("16k", "16k"), ("4096", "4k")])
def test_reads_are_only_lowered(spark, advised, own, want):
    advised(own)
    bound_task_reads(spark)
    assert PLAN_SETTINGS[KEY] == "8m" and _bytes(spark.conf.get(KEY)) == _bytes(want)


@pytest.mark.parametrize("key", ["C05", "D05_intended", "A07_intended", "A07"])
def test_queries_bound_their_reads(spark, advised, tmp_path, key):
    make = spark.createDataFrame
    tables = {
        "orders": make([(1, 5, "O", "2021-01-01")], "o_orderkey long, o_custkey long, o_orderstatus string, d string").selectExpr(
            "o_orderkey", "o_custkey", "o_orderstatus", "cast(d as timestamp_ntz) o_orderdate"),
        "lineitem": make([(1, 4, 1), (1, 4, 2)], "l_orderkey long, l_partkey long, l_linenumber int"),
        "part": make([(4, "ring", "LARGE")], "p_partkey long, p_name string, p_type string"),
        "nation": make([(n, f"T{n}") for n in range(25)], "n_nationkey long, n_name string")}
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    advised("64m")
    assert entry.queries()[key](spark, str(tmp_path)).count() == 1
    assert _bytes(spark.conf.get(KEY)) <= 8 << 20


@pytest.fixture(scope="module")
def one_customer(spark, tmp_path_factory):
    """Order 1 holds items of every kind, order 2 is pending, order 3 has no pizza of the menu."""
    make, at = spark.createDataFrame, tmp_path_factory.mktemp("rows")
    tables = {
        "orders": make([(1, 5, "O"), (2, 5, "P"), (3, 5, "O")], "o_orderkey long, o_custkey long, o_orderstatus string").selectExpr(
            "*", "timestamp_ntz'2021-01-01' as o_orderdate"),
        "lineitem": make([(1, 4, 4), (1, 4, 3), (1, 4, 2), (1, 5, 4), (1, 6, 4), (2, 4, 4), (2, 4, 2), (3, 6, 4)],
                         "l_orderkey long, l_partkey long, l_linenumber int"),
        "part": make([(4, "ring", "LARGE"), (5, "disc", "MEDIUM")], "p_partkey long, p_name string, p_type string")}
    for name, df in tables.items():
        df.write.parquet(f"{at}/{name}.parquet")
    return str(at)


def grouped_by(df) -> list[str]:
    """The keys of each aggregate, as the optimised plan names them."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return [re.sub(r"#\d+L?", "", keys) for keys in re.findall(r"Aggregate \[(.*?)\], \[", plan)]


def test_profit_holds_no_map_of_items(spark, one_customer):
    df = entry.queries()["D05_intended"](spark, one_customer)
    assert sorted(grouped_by(df)) == ["order_id", "pizza_id"]  # orders and the menu; (order, pizza) pairs would hold every item
    assert [tuple(r) for r in df.collect()] == [(44.08,)]  # 3 x 12 + 10 less 0.3 x 6.4 km


@pytest.mark.parametrize("key, want", [("A07", (5, 5, 3)), ("A07_intended", (5, 3, 3))])
def test_both_kinds_of_items_share_a_row(spark, one_customer, key, want):
    df = entry.queries()[key](spark, one_customer)
    assert sorted(grouped_by(df)) == ["customer_id", "order_id, customer_id"]  # no row per kind
    assert [tuple(r) for r in df.collect()] == [want]
