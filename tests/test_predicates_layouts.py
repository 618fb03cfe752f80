"""Predicate set (composite, commuted, date-part, string range) and the
layouts that replace indexes: clustering, partial subsets, derived keys."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tessera.functions import scalar as fx
from tessera.operators import quality as V
from tessera.sources import sinks

from conftest import rows


@pytest.fixture(scope="module")
def wells(spark):
    return spark.createDataFrame([
        (11, "Upper Spring", 4, D("12.50"), dt.date(2014, 2, 28)), (12, "lower spring", 4, D("3.00"), dt.date(2015, 12, 31)),
        (13, "Mill", 6, D("12.50"), dt.date(2015, 1, 1)), (14, "mill", 6, None, None),
    ], "well int, name string, zone int, depth decimal(6,2), dug date")


def test_composite_and_commuted_predicates(wells):
    a = wells.where((F.col("zone") == 4) & (F.col("depth") > 5))
    b = wells.where((F.col("depth") > 5) & (F.col("zone") == 4))
    assert rows(a, "well") == rows(b, "well") == [(11,)]


def test_date_part_string_and_unique(wells):
    assert rows(wells.where(fx.year_equals("dug", 2015)), "well") == [(12,), (13,)]
    assert rows(wells.where(F.col("name") > "Mill"), "well") == [(11,), (12,), (14,)]  # upper case sorts first
    assert rows(wells.where(F.lower("name") == "mill"), "well") == [(13,), (14,)]
    assert rows(V.unique(wells, ["depth"], arrival="well"), "well") == [(13,)]


def test_year_range_pushdown_on_timestamps(spark):
    orders = spark.read.parquet("/root/testdata/sf0.01/orders.parquet")
    q = orders.where(fx.year_equals("o_orderdate", 1997))
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate,1997-01-01T00:00)" in plan
    assert q.count() == orders.where(F.year("o_orderdate") == 1997).count()


def test_partitioned_layout_prunes_directories(spark):
    orders = spark.read.parquet("/root/testdata/sf0.01/orders.parquet").withColumn("y", F.year("o_orderdate"))
    path = sinks.write_partitioned(orders, spark, "t_by_year", ["y"], ["o_orderkey"])
    q = spark.read.parquet(path).where(F.col("y") == 1997)
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(y" in plan and "(y#" in plan
    assert q.count() == orders.where(F.col("y") == 1997).count()


def test_schema_evolution_add_column_and_merge(spark):
    base = spark.createDataFrame([(1, "a")], "id int, name string")
    evolved = fx.add_column_if_absent(base, "created", F.lit("2024-01-01").cast("date"))
    assert fx.add_column_if_absent(evolved, "created", F.lit(None)).columns == ["id", "name", "created"]
    old_path = sinks.write_parquet(base, spark, "t_evolve")
    new_path = sinks.write_parquet(spark.createDataFrame([(2, "b", dt.date(2024, 2, 1))],
                                                         "id int, name string, created date"), spark, "t_evolve")
    merged = spark.read.option("mergeSchema", "true").parquet(old_path, new_path)
    assert rows(merged, "id", "created") == [(1, None), (2, dt.date(2024, 2, 1))]
