"""Parameterised scalar and table functions.

Each function exists in two forms: a Python function over Columns /
DataFrames (inlined into the caller's plan, so Catalyst optimises through
it), and a Spark SQL function (``CREATE TEMPORARY FUNCTION ... RETURN``) for
SQL users. Neither runs Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def calculate_discount(price: Column, percent: Column) -> Column:
    """price - price * percent / 100 (exact decimal arithmetic)."""
    return price - price * percent / 100


def film_stats(items: DataFrame, category_col: str, price_col: str, category: str | Column) -> DataFrame:
    """One row (item_count, avg_price) for a category; (0, NULL) when it has no rows."""
    cat = category if isinstance(category, Column) else F.lit(category)
    chosen = items.where(F.col(category_col) == cat)
    return chosen.agg(F.count(F.lit(1)).alias("item_count"),
                      (F.sum(F.col(price_col).cast("decimal(18,2)")).cast("double") / F.count(price_col))
                      .alias("avg_price"))


def search_items(items: DataFrame, name_col: str, pattern: str | Column, category_col: str | None = None,
                 category: str | None = None) -> DataFrame:
    """Rows whose name matches a LIKE pattern; with a category the result also
    carries it (the two-argument overload adds an output column)."""
    pat = pattern if isinstance(pattern, Column) else F.lit(pattern)
    hits = items.where(F.like(F.col(name_col), pat))
    if category is None:
        return hits
    return hits.where(F.col(category_col) == category)


def customer_rentals(orders: DataFrame, lineitem: DataFrame, part: DataFrame, customers: DataFrame) -> DataFrame:
    """Per requested customer: order date, item name and ship date of every line.

    ``customers`` is a DataFrame of ids (a LATERAL call for many ids is a semi
    join, so one plan serves any number of ids).
    """
    wanted = customers.select(F.col("customer_id").alias("__cid")).distinct()
    o = orders.join(wanted, orders["o_custkey"] == F.col("__cid"), "left_semi")
    j = (o.join(lineitem, o["o_orderkey"] == lineitem["l_orderkey"])
         .join(part, lineitem["l_partkey"] == part["p_partkey"]))
    return j.select(F.col("o_custkey").alias("customer_id"), F.to_date("o_orderdate").alias("rental_date"),
                    F.col("p_name").alias("title"), F.to_date("l_shipdate").alias("return_date"))


def register_sql_functions(spark: SparkSession) -> None:
    """The same functions for Spark SQL (temporary, per session).

    The table functions read the session's ``part`` / ``orders`` /
    ``lineitem`` views; ``customer_rentals`` can be called per row with
    ``LATERAL`` (one plan, decorrelated into a join by Spark).
    """
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION calculate_discount(price DECIMAL(18,2), percent DECIMAL(5,2))
        RETURNS DECIMAL(24,6)
        RETURN price - price * percent / 100""")
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION part_stats(kind STRING)
        RETURNS TABLE (item_count BIGINT, avg_price DOUBLE)
        RETURN SELECT COUNT(*), CAST(SUM(CAST(p_retailprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(p_retailprice)
               FROM part WHERE p_type = part_stats.kind""")
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION search_parts(pattern STRING)
        RETURNS TABLE (p_partkey BIGINT, p_name STRING)
        RETURN SELECT p_partkey, p_name FROM part WHERE p_name LIKE search_parts.pattern""")
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION search_parts_of_type(pattern STRING, kind STRING)
        RETURNS TABLE (p_partkey BIGINT, p_name STRING, p_type STRING)
        RETURN SELECT p_partkey, p_name, p_type FROM part
               WHERE p_name LIKE search_parts_of_type.pattern AND p_type = search_parts_of_type.kind""")
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION customer_rentals(id BIGINT)
        RETURNS TABLE (rental_date DATE, title STRING, return_date DATE)
        RETURN SELECT CAST(o.o_orderdate AS DATE), p.p_name, CAST(l.l_shipdate AS DATE)
               FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
               JOIN part p ON l.l_partkey = p.p_partkey
               WHERE o.o_custkey = customer_rentals.id""")
