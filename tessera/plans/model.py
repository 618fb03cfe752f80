"""Company-style relations derived from the driver tables.

The driver tables hold no NULLs, so nullable columns are derived by fixed
rules, identical in the Spark frames and the SQL text:

* emp  <- customer: emp_id = c_custkey, name, dept_id = NULLIF(c_nationkey, 0),
  segment, salary = c_acctbal as decimal(18,2), manager_id = c_custkey DIV 10,
  or NULL for customers with a negative balance.
* dept <- nation: dept_id = n_nationkey, dept_name = n_name, region = n_regionkey.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.sources.tables import Tables


def emp(t: Tables) -> DataFrame:
    c = t.customer
    return c.select(
        F.col("c_custkey").alias("emp_id"),
        F.col("c_name").alias("emp_name"),
        F.nullif(F.col("c_nationkey"), F.lit(0)).alias("dept_id"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").cast("decimal(18,2)").alias("salary"),
        F.when(F.col("c_acctbal") < 0, F.lit(None).cast("bigint"))
        .otherwise(F.expr("c_custkey div 10")).alias("manager_id"),
    )


def dept(t: Tables) -> DataFrame:
    n = t.nation
    return n.select(F.col("n_nationkey").alias("dept_id"), F.col("n_name").alias("dept_name"),
                    F.col("n_regionkey").alias("region"))


SQL = {
    "emp": """
  emp AS (
    SELECT c_custkey AS emp_id, c_name AS emp_name, NULLIF(c_nationkey, 0) AS dept_id,
           c_mktsegment AS segment, CAST(c_acctbal AS DECIMAL(18,2)) AS salary,
           CASE WHEN c_acctbal < 0 THEN NULL ELSE c_custkey // 10 END AS manager_id
    FROM customer)""",
    "dept": """
  dept AS (SELECT n_nationkey AS dept_id, n_name AS dept_name, n_regionkey AS region FROM nation)""",
}


def with_model(*names: str) -> str:
    return "WITH " + ",".join(SQL[n] for n in names)
