"""A hot join key (a third of the rows) is split across tasks in a chain of order-keyed joins."""

import pytest
from pyspark.sql import functions as F

LOCAL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
}


@pytest.fixture
def small_scale_confs(spark):
    old = {k: spark.conf.get(k, None) for k in LOCAL}
    for k, v in LOCAL.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_order_is_split(spark, small_scale_confs):
    n = 300_000
    items = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("order_id"),
                                  (F.col("id") % 1000).alias("pizza_id"))
    orders = spark.range(n).select(F.col("id").alias("order_id"), (F.col("id") % 50).alias("cust"))
    runs = spark.range(n).select(F.col("id").alias("order_id"), (F.col("id") % 20).alias("runner_id"))
    q = items.join(orders, "order_id").join(runs, "order_id").groupBy("pizza_id").count()
    assert sum(r["count"] for r in q.collect()) == n
    final = q._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "SortMergeJoin(skew=true)" in final
