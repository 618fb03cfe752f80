"""Aggregations (2.5) and window functions (2.6)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators import joins as J
from tessera.operators.windows import global_rank, partition_total, prefix_sum
from tessera.plans import bank_model as bm
from tessera.plans import model
from tessera.plans.registry import register
from tessera.session import materialize

AGG, WIN = "aggregates", "windows"


def _money_sum(col: str):
    return F.sum(F.col(col).cast("decimal(18,2)"))


# ---------------------------------------------------------------- 2.5 aggregates

@register("agg_avg_round", area=AGG, oracle=model.with_model("emp") + """,
  s AS (SELECT segment, CAST(SUM(salary) * 100 AS BIGINT) AS cents, COUNT(salary) AS n FROM emp GROUP BY segment)
SELECT segment, sign(cents) * ((2 * abs(cents) + n) // (2 * n)) / 100.0 AS avg_salary FROM s""")
def agg_avg_round(t):
    """G1: GROUP BY + ROUND(AVG(x), 2) on a decimal column."""
    return model.emp(t).groupBy("segment").agg(
        F.round(F.avg("salary"), 2).cast("double").alias("avg_salary"))


@register("agg_join_sum", area=AGG, oracle="""
SELECT p.p_partkey, p.p_name, CAST(SUM(CAST(l.l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS total_qty
FROM part p JOIN lineitem l ON l.l_partkey = p.p_partkey
GROUP BY p.p_partkey, p.p_name""")
def agg_join_sum(t):
    """Join then SUM per key (grouped by id and name)."""
    p, li = t.part, t.lineitem
    per_part = li.groupBy("l_partkey").agg(_money_sum("l_quantity").alias("total_qty"))
    return (p.join(per_part, p["p_partkey"] == per_part["l_partkey"])
            .select("p_partkey", "p_name", F.col("total_qty").cast("double").alias("total_qty")))


@register("agg_having_count", area=AGG, oracle="""
SELECT c_nationkey, COUNT(*) AS customers FROM customer GROUP BY c_nationkey HAVING COUNT(*) > 60""")
def agg_having_count(t):
    """COUNT(*) with HAVING."""
    return (t.customer.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("customers"))
            .where(F.col("customers") > 60))


@register("agg_global", area=AGG, oracle="""
SELECT MIN(c_acctbal) AS min_balance, MAX(c_acctbal) AS max_balance,
       CAST(SUM(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS total_balance, COUNT(*) AS customers
FROM customer""")
def agg_global(t):
    """Global MIN / MAX / SUM (one row)."""
    return t.customer.agg(F.min("c_acctbal").alias("min_balance"), F.max("c_acctbal").alias("max_balance"),
                          _money_sum("c_acctbal").cast("double").alias("total_balance"),
                          F.count(F.lit(1)).alias("customers"))


@register("agg_count_distinct_having", area=AGG, oracle="""
SELECT l_partkey, CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS total_qty,
       COUNT(DISTINCT l_suppkey) AS suppliers
FROM lineitem GROUP BY l_partkey HAVING SUM(CAST(l_quantity AS DECIMAL(18,2))) > 1000""")
def agg_count_distinct_having(t):
    """COUNT(DISTINCT) beside SUM, HAVING on the SUM."""
    return (t.lineitem.groupBy("l_partkey")
            .agg(_money_sum("l_quantity").alias("q"), F.count_distinct("l_suppkey").alias("suppliers"))
            .where(F.col("q") > 1000)
            .select("l_partkey", F.col("q").cast("double").alias("total_qty"), "suppliers"))


@register("agg_outer_count", area=AGG, oracle=model.with_model("emp", "dept") + """
SELECT d.dept_id, d.dept_name, COUNT(e.emp_id) AS employees
FROM dept d LEFT JOIN emp e ON e.dept_id = d.dept_id GROUP BY d.dept_id, d.dept_name""")
def agg_outer_count(t):
    """COUNT(column) over an outer join: 0 for a parent without children."""
    d = model.dept(t)
    per_dept = model.emp(t).groupBy(F.col("dept_id").alias("e_dept")).agg(F.count("emp_id").alias("n"))
    return (d.join(per_dept, d["dept_id"] == per_dept["e_dept"], "left")
            .select("dept_id", "dept_name", F.coalesce("n", F.lit(0)).alias("employees")))


@register("agg_having_avg", area=AGG, oracle=model.with_model("emp") + """
SELECT dept_id, CAST(SUM(salary) AS DOUBLE) / COUNT(salary) AS avg_salary
FROM emp WHERE dept_id IS NOT NULL GROUP BY dept_id
HAVING CAST(SUM(salary) AS DOUBLE) / COUNT(salary) > 4500""")
def agg_having_avg(t):
    """HAVING on an average."""
    avg = F.sum("salary").cast("double") / F.count("salary")
    return (model.emp(t).where(F.col("dept_id").isNotNull()).groupBy("dept_id")
            .agg(avg.alias("avg_salary")).where(F.col("avg_salary") > 4500))


@register("agg_greatest_least", area=AGG, oracle="""
SELECT c_mktsegment, COUNT(*) AS size, LEAST(MAX(c_acctbal), 9990.0) AS capped_max,
       GREATEST(MIN(c_acctbal), -500.0) AS floored_min
FROM customer GROUP BY c_mktsegment""")
def agg_greatest_least(t):
    """GREATEST / LEAST applied to aggregates."""
    return t.customer.groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("size"),
        F.least(F.max("c_acctbal"), F.lit(9990.0)).alias("capped_max"),
        F.greatest(F.min("c_acctbal"), F.lit(-500.0)).alias("floored_min"))


FANOUT_RAW = model.with_model("emp", "dept") + """
SELECT d.dept_id, COUNT(e.emp_id) AS employees, CAST(COALESCE(SUM(e.salary), 0) AS DOUBLE) AS salaries,
       COUNT(s.s_suppkey) AS projects, CAST(COALESCE(SUM(CAST(s.s_acctbal AS DECIMAL(18,2))), 0) AS DOUBLE) AS budget
FROM dept d
LEFT JOIN emp e ON e.dept_id = d.dept_id
LEFT JOIN supplier s ON s.s_nationkey = d.dept_id
GROUP BY d.dept_id"""


@register("agg_fanout_raw", area=AGG, oracle=FANOUT_RAW)
def agg_fanout_raw(t):
    """G9 as written: COALESCE(SUM) over two LEFT JOINs, inflated by the fan-out.

    The inflated numbers are reproduced exactly from per-child aggregates
    (each child's total times the other child's row count), without building
    the fan-out itself.
    """
    out = J.fanout_totals(model.dept(t).select("dept_id"), "dept_id", {
        "e": (model.emp(t), "dept_id", {"employees": ("count", F.col("emp_id")),
                                         "salaries": ("sum", F.col("salary"))}),
        "s": (t.supplier, "s_nationkey", {"projects": ("count", F.col("s_suppkey")),
                                           "budget": ("sum", F.col("s_acctbal").cast("decimal(18,2)"))}),
    })
    return out.select("dept_id", "employees",
                      F.coalesce("salaries", F.lit(0)).cast("double").alias("salaries"),
                      "projects", F.coalesce("budget", F.lit(0)).cast("double").alias("budget"))


@register("agg_fanout_safe", area=AGG, oracle=model.with_model("emp", "dept") + """
SELECT d.dept_id, COALESCE(e.n, 0) AS employees, CAST(COALESCE(e.total, 0) AS DOUBLE) AS salaries,
       COALESCE(s.n, 0) AS projects, CAST(COALESCE(s.total, 0) AS DOUBLE) AS budget
FROM dept d
LEFT JOIN (SELECT dept_id, COUNT(*) AS n, SUM(salary) AS total FROM emp GROUP BY dept_id) e ON e.dept_id = d.dept_id
LEFT JOIN (SELECT s_nationkey, COUNT(*) AS n, SUM(CAST(s_acctbal AS DECIMAL(18,2))) AS total
           FROM supplier GROUP BY s_nationkey) s ON s.s_nationkey = d.dept_id""")
def agg_fanout_safe(t):
    """G9 corrected: each child aggregated on its own before joining."""
    d = model.dept(t).select("dept_id")
    e = model.emp(t).groupBy(F.col("dept_id").alias("e_dept")).agg(
        F.count(F.lit(1)).alias("en"), F.sum("salary").alias("et"))
    s = t.supplier.groupBy("s_nationkey").agg(
        F.count(F.lit(1)).alias("sn"), _money_sum("s_acctbal").alias("st"))
    j = d.join(e, d["dept_id"] == e["e_dept"], "left").join(s, d["dept_id"] == s["s_nationkey"], "left")
    return j.select("dept_id", F.coalesce("en", F.lit(0)).alias("employees"),
                    F.coalesce("et", F.lit(0)).cast("double").alias("salaries"),
                    F.coalesce("sn", F.lit(0)).alias("projects"),
                    F.coalesce("st", F.lit(0)).cast("double").alias("budget"))


@register("agg_dashboard", area=AGG, oracle="""
WITH nat AS (SELECT n_nationkey, n_regionkey FROM nation),
     sup AS (SELECT s_suppkey, s_nationkey FROM supplier),
     cus AS (SELECT c_custkey, c_nationkey FROM customer),
     per_region AS (
       SELECT n.n_regionkey,
              COUNT(DISTINCT n.n_nationkey) AS nations,
              (SELECT COUNT(DISTINCT s.s_suppkey) FROM sup s JOIN nat n2 ON s.s_nationkey = n2.n_nationkey
               WHERE n2.n_regionkey = n.n_regionkey) AS suppliers,
              (SELECT COUNT(DISTINCT c.c_custkey) FROM cus c JOIN nat n3 ON c.c_nationkey = n3.n_nationkey
               WHERE n3.n_regionkey = n.n_regionkey) AS customers
       FROM nat n GROUP BY n.n_regionkey)
SELECT n_regionkey, nations, suppliers, customers,
       ROUND(CAST(customers AS DOUBLE) / NULLIF(suppliers, 0), 4) AS customers_per_supplier
FROM per_region""")
def agg_dashboard(t):
    """Several COUNT(DISTINCT)s per group and a NULLIF-guarded ratio."""
    n = t.nation.select("n_nationkey", "n_regionkey")
    s = t.supplier.select("s_suppkey", F.col("s_nationkey").alias("nk"))
    c = t.customer.select("c_custkey", F.col("c_nationkey").alias("nk"))
    nations = n.groupBy("n_regionkey").agg(F.count_distinct("n_nationkey").alias("nations"))
    sup = (s.join(n, s["nk"] == n["n_nationkey"]).groupBy(F.col("n_regionkey").alias("r1"))
           .agg(F.count_distinct("s_suppkey").alias("suppliers")))
    cus = (c.join(n, c["nk"] == n["n_nationkey"]).groupBy(F.col("n_regionkey").alias("r2"))
           .agg(F.count_distinct("c_custkey").alias("customers")))
    j = (nations.join(sup, nations["n_regionkey"] == sup["r1"], "left")
         .join(cus, nations["n_regionkey"] == cus["r2"], "left"))
    suppliers = F.coalesce("suppliers", F.lit(0))
    customers = F.coalesce("customers", F.lit(0))
    return j.select("n_regionkey", "nations", suppliers.alias("suppliers"), customers.alias("customers"),
                    F.round(customers.cast("double") / F.nullif(suppliers, F.lit(0)), 4)
                    .alias("customers_per_supplier"))


@register("agg_by_day", area=AGG, oracle="""
SELECT CAST(ts AS DATE) AS event_date, event_type, COUNT(*) AS events,
       CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_value
FROM events GROUP BY 1, 2""")
def agg_by_day(t):
    """GROUP BY an expression (timestamp cast to date) and a column."""
    return t.events.groupBy(F.to_date("ts").alias("event_date"), "event_type").agg(
        F.count(F.lit(1)).alias("events"), _money_sum("value").cast("double").alias("total_value"))


@register("agg_project_overview", area=AGG, oracle="""
SELECT c.c_mktsegment, o.o_orderstatus, o.o_orderpriority, year(o.o_orderdate) AS order_year,
       COUNT(*) AS orders, CAST(SUM(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
GROUP BY c.c_mktsegment, o.o_orderstatus, o.o_orderpriority, year(o.o_orderdate)""")
def agg_project_overview(t):
    """GROUP BY four descriptive columns of a join."""
    o, c = t.orders, t.customer
    return (o.join(c, o["o_custkey"] == c["c_custkey"])
            .groupBy("c_mktsegment", "o_orderstatus", "o_orderpriority",
                     F.year("o_orderdate").cast("long").alias("order_year"))
            .agg(F.count(F.lit(1)).alias("orders"), _money_sum("o_totalprice").cast("double").alias("revenue")))


@register("agg_empty_input", area=AGG, oracle="""
SELECT COUNT(*) AS events, AVG(value) AS avg_value, MAX(value) AS max_value,
       CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_value
FROM events WHERE value < 0""")
def agg_empty_input(t):
    """A global aggregate over no rows still returns one row (0, NULL, ...)."""
    return t.events.where(F.col("value") < 0).agg(
        F.count(F.lit(1)).alias("events"), F.avg("value").alias("avg_value"),
        F.max("value").alias("max_value"), _money_sum("value").cast("double").alias("total_value"))


# ---------------------------------------------------------------- 2.6 windows

ACCOUNT_TOTALS = bm.with_bank("bank_accounts") + """,
  acc AS (SELECT account_id, customer_id, balance,
                 SUM(balance) OVER (PARTITION BY customer_id) AS customer_total FROM bank_accounts)"""


@register("win_partition_sum", area=WIN, oracle=ACCOUNT_TOTALS + """
SELECT account_id, customer_id, CAST(balance AS DOUBLE) AS balance,
       CAST(customer_total AS DOUBLE) AS customer_total FROM acc""")
def win_partition_sum(t):
    """SUM over a whole partition (no ORDER BY) next to each row."""
    a = bm.accounts(t).select("account_id", "customer_id", "balance")
    out = partition_total(a, "customer_id", "balance", "customer_total")
    return out.select("account_id", "customer_id", F.col("balance").cast("double").alias("balance"),
                      F.col("customer_total").cast("double").alias("customer_total"))


@register("win_rank_of_total", area=WIN, oracle=ACCOUNT_TOTALS + """
SELECT account_id, CAST(customer_total AS DOUBLE) AS customer_total,
       RANK() OVER (ORDER BY customer_total DESC NULLS FIRST) AS total_rank FROM acc""")
def win_rank_of_total(t):
    """RANK over the value of another window (rows, not customers, are ranked)."""
    a = bm.accounts(t).select("account_id", "customer_id", "balance")
    per_customer = materialize(a.groupBy(F.col("customer_id").alias("__c")).agg(
        F.sum("balance").alias("customer_total"), F.count(F.lit(1)).alias("__rows")), "rank_per_customer")
    ranked = global_rank(per_customer, "customer_total", "total_rank", descending=True, weight="__rows")
    return (a.join(ranked, a["customer_id"] == ranked["__c"])
            .select("account_id", F.col("customer_total").cast("double").alias("customer_total"), "total_rank"))


DAILY = """
WITH daily AS (
  SELECT CAST(ts AS DATE) AS event_date, event_type, SUM(CAST(value AS DECIMAL(18,2))) AS volume
  FROM events GROUP BY 1, 2)"""


def _daily(t):
    return t.events.groupBy(F.to_date("ts").alias("event_date"), "event_type").agg(
        _money_sum("value").alias("volume"))


@register("win_running_total", area=WIN, oracle=DAILY + """
SELECT event_date, event_type, CAST(volume AS DOUBLE) AS volume,
       CAST(SUM(volume) OVER (ORDER BY event_date) AS DOUBLE) AS running_volume
FROM daily""")
def win_running_total(t):
    """Running total with the default frame (RANGE ... CURRENT ROW: peers share it)."""
    d = materialize(_daily(t), "daily_volume")  # small; read by both halves of the running total
    out = prefix_sum(d, ["event_date"], "volume", "running_volume")
    return out.select("event_date", "event_type", F.col("volume").cast("double").alias("volume"),
                      F.col("running_volume").cast("double").alias("running_volume"))


@register("win_lag_default", area=WIN, oracle=DAILY + """
SELECT event_date, event_type,
       CAST(LAG(volume, 1, 0) OVER (PARTITION BY event_type ORDER BY event_date) AS DOUBLE) AS previous_volume
FROM daily""")
def win_lag_default(t):
    """LAG(x, 1, 0) per type by date (the previous row, not the previous day)."""
    w = Window.partitionBy("event_type").orderBy("event_date")
    return _daily(t).select("event_date", "event_type",
                            F.lag("volume", 1, 0).over(w).cast("double").alias("previous_volume"))


@register("win_growth_pct", area=WIN, oracle=DAILY + """
SELECT event_date, event_type,
       CAST(volume - LAG(volume, 1, 0) OVER (PARTITION BY event_type ORDER BY event_date) AS DOUBLE)
       / CAST(NULLIF(LAG(volume, 1, 0) OVER (PARTITION BY event_type ORDER BY event_date), 0) AS DOUBLE) * 100
         AS growth_percent
FROM daily""")
def win_growth_pct(t):
    """Growth percent from LAG with a NULLIF guard (first row NULL)."""
    w = Window.partitionBy("event_type").orderBy("event_date")
    prev = F.lag("volume", 1, 0).over(w)
    return _daily(t).select("event_date", "event_type",
                            ((F.col("volume") - prev).cast("double") / F.nullif(prev, F.lit(0)).cast("double") * 100)
                            .alias("growth_percent"))
