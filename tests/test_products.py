"""Sales that meet once, by product and month: where the package is missing, and how often they move."""

import pytest
from pyspark.sql import functions as F

from skyledger.plans import gold, silver
from skyledger.plans.bindings import FIRST_YEAR, TODAY, Warehouse

DAY = "timestamp_ntz '1997-05-03'"


@pytest.fixture()
def tables(spark, tmp_path):
    part = spark.createDataFrame(
        [(1, "B1", "red", "T", 1), (2, "B1", "red", None, 1), (3, "B1", "red", None, 2), (4, "B1", "red x", None, 2)],
        "p_partkey long, p_brand string, p_name string, p_type string, p_size int",
    )
    lines = spark.range(80).select(
        "id", (F.col("id") % 5).alias("l_partkey"), F.expr(DAY).alias("l_shipdate"), F.lit(1).cast("long").alias("l_linenumber"),
        *[F.lit(v).alias(c) for c, v in {"l_quantity": 2.0, "l_extendedprice": 10.5, "l_discount": 0.1, "l_tax": 0.05}.items()],
    )
    part.write.parquet(f"{tmp_path}/part.parquet")
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    return Warehouse(spark, str(tmp_path))


def test_products_without_a_package_are_one(tables):
    plain = silver.medications_cleaned(tables.medications, FIRST_YEAR, TODAY)
    assert sorted(map(str, tables.medications_cleaned.collect())) == sorted(map(str, plain.collect()))
    found = sorted(map(str, tables.dim_medications.collect()))
    assert found == sorted(map(str, gold.dim_medications(plain).collect()))
    assert len(found) == 2


def test_named_sales_are_shuffled_once(tables):
    told, _ = tables._by_product
    products = gold.dim_medications(told, product=["l_partkey"])
    plan = products._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(l_partkey") == 1 and plan.count("Exchange hashpartitioning") == 1


def test_many_parts_meet_the_sales_in_one_shuffle_of_them(tables, monkeypatch):
    monkeypatch.setattr("skyledger.plans.bindings.FEW_PARTS", 0)
    plain = silver.medications_cleaned(tables.medications, FIRST_YEAR, TODAY)
    told, _ = tables._by_product
    plan = gold.dim_medications(told, product=["l_partkey"])._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("Exchange hashpartitioning(l_partkey") == 1
    assert plan.count("Exchange hashpartitioning") == 2  # sales and parts
    assert sorted(map(str, tables.medications_cleaned.collect())) == sorted(map(str, plain.collect()))
