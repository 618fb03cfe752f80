"""Sources, sinks, view DDL and the Spark SQL function forms."""

from decimal import Decimal

from pyspark.sql import functions as F

from tessera.functions import scalar as fx
from tessera.functions import table_functions as tf
from tessera.operators import views as VW
from tessera.sources import literals, sinks

from conftest import rows


def test_view_create_replace_rename_drop(spark):
    df = spark.createDataFrame([(1, "IT"), (2, "HR")], "id int, dept string")
    VW.create_view(spark, "t_v", df.where("dept = 'IT'"))
    VW.create_view(spark, "t_v", df.where("dept = 'HR'"), replace=True)
    VW.rename_view(spark, "t_v", "t_v2")
    assert rows(spark.table("t_v2"), "id") == [(2,)]
    assert not spark.catalog.tableExists("t_v")
    assert VW.drop_view(spark, "t_v2") is True
    assert VW.drop_view(spark, "t_v2", if_exists=True) is False  # DROP VIEW IF EXISTS


def test_catalog_drop_if_exists(spark):
    catalog = sinks.Catalog.of(spark)
    catalog.publish("t_tbl", spark.range(3))
    assert catalog.exists("t_tbl")
    catalog.drop("t_tbl")
    catalog.drop("t_tbl", if_exists=True)
    assert not catalog.exists("t_tbl")


def test_constant_false_predicate_is_pruned(spark):
    df = spark.range(100).where(F.lit(1) == F.lit(0))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "LocalRelation" in plan and df.count() == 0
    empty = sinks.ctas(spark.range(5).withColumnRenamed("id", "k"), spark, "t_ctas", with_data=False)
    assert empty.count() == 0 and empty.columns == ["k"]


def test_filters_reach_the_scan(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/customer.parquet")
    q = df.where((F.col("c_nationkey") == 5) & (F.col("c_acctbal") > 5000)).select("c_custkey")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(c_nationkey), IsNotNull(c_acctbal), EqualTo(c_nationkey,5)" in plan
    assert "ReadSchema: struct<c_custkey:bigint,c_nationkey:int,c_acctbal:double>" in plan


def test_sql_functions(spark):
    for name in ("part", "orders", "lineitem", "customer"):
        spark.read.parquet(f"/root/testdata/sf0.01/{name}.parquet").createOrReplaceTempView(name)
    tf.register_sql_functions(spark)
    assert spark.sql("SELECT calculate_discount(100, 15) AS v").first()["v"] == Decimal("85.000000")
    assert spark.sql("SELECT calculate_discount(250.50, 20) AS v").first()["v"] == Decimal("200.400000")
    stats = spark.sql("SELECT * FROM part_stats('NO SUCH TYPE')").first()
    assert (stats["item_count"], stats["avg_price"]) == (0, None)
    one = spark.sql("SELECT * FROM search_parts('%ring%')")
    two = spark.sql("SELECT * FROM search_parts_of_type('%ring%', 'ECONOMY')")
    assert one.columns == ["p_partkey", "p_name"] and two.columns == ["p_partkey", "p_name", "p_type"]
    assert 0 < two.count() < one.count()
    lateral = spark.sql("SELECT c.c_custkey, r.* FROM customer c, LATERAL customer_rentals(c.c_custkey) r "
                        "WHERE c.c_nationkey = 7 AND c.c_mktsegment = 'MACHINERY'")
    orders = spark.table("orders")
    ids = spark.table("customer").where("c_nationkey = 7 AND c_mktsegment = 'MACHINERY'") \
        .select(F.col("c_custkey").alias("customer_id"))
    direct = tf.customer_rentals(orders, spark.table("lineitem"), spark.table("part"), ids)
    assert lateral.count() == direct.count() > 0
    col = spark.range(1).select(tf.calculate_discount(F.lit(Decimal("100.00")), F.lit(Decimal("15"))).alias("v"))
    assert col.first()["v"] == Decimal("85")


def test_schema_cast_rounds_into_integers(spark):
    from pyspark.sql import types as T

    df = spark.createDataFrame([(110.5,), (55555 * 1.1,)], "x double")
    out = literals.cast_to_schema(df, T.StructType([T.StructField("x", T.IntegerType())]))
    assert rows(out, "x") == [(111,), (61111,)]


def test_age_years_and_format(spark):
    df = spark.createDataFrame([("2024-03-01", "2020-02-29"), ("2024-02-28", "2020-02-29"), ("2024-01-01", None)],
                               "a string, b string")
    out = df.select(fx.age_years(F.to_date("a"), F.to_date("b")).alias("y"),
                    fx.format_text("%s / %s", F.col("a"), F.col("b")).alias("s"))
    got = [(r["y"], r["s"]) for r in out.collect()]
    assert got == [(4, "2024-03-01 / 2020-02-29"), (3, "2024-02-28 / 2020-02-29"), (None, "2024-01-01 / ")]


def test_layout_roundtrip_skips_row_groups(spark):
    orders = spark.read.parquet("/root/testdata/sf0.01/orders.parquet")
    path = sinks.write_clustered(orders, spark, "t_layout", ["o_custkey"], files=4)
    q = spark.read.parquet(path).where(F.col("o_custkey") == 7)
    assert "PushedFilters: [IsNotNull(o_custkey), EqualTo(o_custkey,7)]" in q._jdf.queryExecution().executedPlan().toString()
    assert q.count() == orders.where(F.col("o_custkey") == 7).count()


def test_year_filter_reaches_the_scan(spark):
    orders = spark.read.parquet("/root/testdata/sf0.01/orders.parquet")
    q = orders.where(fx.year_equals("o_orderdate", 1997))
    assert "GreaterThanOrEqual(o_orderdate,1997-01-01T00:00)" in q._jdf.queryExecution().executedPlan().toString()
    assert q.count() == orders.where(F.year("o_orderdate") == 1997).count()


def test_sizing_for_100_tb():
    from tessera.session import sizing

    conf = sizing(100 << 40)
    assert conf["spark.sql.shuffle.partitions"] == str(1 << 17)  # capped
    assert conf["spark.sql.files.maxPartitionBytes"] == str(512 << 20)
    assert sizing(1 << 30)["spark.sql.shuffle.partitions"] == "8"


def test_materialize_cuts_lineage(spark):
    from tessera.session import materialize

    src = spark.read.parquet("/root/testdata/sf0.01/orders.parquet")
    agg = src.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    stored = materialize(agg, "t_mat")
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" not in plan and "FileScan parquet" in plan
    assert rows(stored, "o_custkey", "n") == rows(agg, "o_custkey", "n")
