"""Write tasks (D03 recreate, E02 append) and the driver entry points."""

import os
import uuid

from dataclasses import replace

import pytest

from tests import seed
from tillroll.plans.registry import QUERIES
from tillroll.sources import testdata
from tillroll.plans import delivery as P
from tillroll.session import ensure_checkpoint_dir
from tillroll.sources.sinks import append_rows, overwrite_table


def scratch(spark):
    """A fresh folder under the session's shared checkpoint folder."""
    return os.path.join(ensure_checkpoint_dir(spark), "sink-tests", uuid.uuid4().hex)


def test_d03_overwrite_is_idempotent(spark):
    t = seed.delivery(spark)
    path = os.path.join(scratch(spark), "customer_ratings")
    overwrite_table(P.d03_ratings(t), path)
    overwrite_table(P.d03_ratings(t), path)  # DROP IF EXISTS + CREATE: same content, not doubled
    back = spark.read.parquet(path)
    assert back.count() == 8
    assert back.columns == ["order_id", "customer_id", "runner_id", "rating"]


def test_e02_append_new_pizza(spark):
    t = seed.delivery(spark)
    root = scratch(spark)
    names, recipes = os.path.join(root, "pizza_names"), os.path.join(root, "pizza_recipes")
    overwrite_table(t.pizza_names, names)
    overwrite_table(t.pizza_recipes, recipes)
    new_names = P.e02_new_pizza_name(t, "Supreme", 3).filter("pizza_id = 3")
    new_recipe = P.e02_new_pizza_recipe(t, 3).filter("pizza_id = 3")
    append_rows(new_names, names)
    append_rows(new_recipe, recipes)
    assert sorted(tuple(r) for r in spark.read.parquet(names).collect())[-1] == (3, "Supreme")
    assert [tuple(r) for r in spark.read.parquet(recipes).filter("pizza_id = 3").collect()] == \
        [(3, "1,2,3,4,5,6,7,8,9,10,11,12")]


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns == ["customer_id", "order_date", "product_name", "price", "member", "ranks"]
    assert df.count() > 0


def test_every_query_has_oracle(spark):
    import __spark_entry__ as E
    assert set(QUERIES) <= set(E.queries()) and set(QUERIES) <= set(E.oracle_sql())


def test_one_id_for_both_inserts(spark):
    root, t = scratch(spark), seed.delivery(spark)
    names, recipes = os.path.join(root, "names"), os.path.join(root, "recipes")
    overwrite_table(t.pizza_names, names)
    overwrite_table(t.pizza_recipes, recipes)
    stored = replace(t, pizza_names=spark.read.parquet(names), pizza_recipes=spark.read.parquet(recipes))
    new_names, new_recipes = P.e02_new_pizza(stored, "Supreme")
    append_rows(new_names.filter("pizza_name = 'Supreme'"), names)
    append_rows(new_recipes.join(stored.pizza_recipes.select("pizza_id"), "pizza_id", "left_anti"), recipes)
    assert {r.pizza_id for r in spark.read.parquet(names).collect()} == {r.pizza_id for r in spark.read.parquet(recipes).collect()} == {1, 2, 3}


def test_overwrite_refuses_its_own_input(spark):
    path = os.path.join(scratch(spark), "names")
    overwrite_table(seed.delivery(spark).pizza_names, path)
    with pytest.raises(ValueError):
        overwrite_table(spark.read.parquet(path).filter("pizza_id > 1"), path)
    assert spark.read.parquet(path).count() == 2


def test_appended_files_are_seen(spark):
    root = scratch(spark)
    spark.range(3).write.parquet(f"{root}/region.parquet")
    assert testdata.read(spark, root, "region").count() == 3
    spark.range(2).write.mode("append").parquet(f"{root}/region.parquet")
    assert testdata.read(spark, root, "region").count() == 5
