"""Views and materializations (2.11), scalar and table functions (2.12)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import table_functions as tf
from tessera.operators import views as VW
from tessera.plans import model
from tessera.plans.registry import register
from tessera.sources import sinks

VIEWS, UDF = "views", "functions_udf"
EMP = model.with_model("emp")
EMP_DEPT = model.with_model("emp", "dept")


def _dept_stats(emp):
    return emp.where(F.col("dept_id").isNotNull()).groupBy("dept_id").agg(
        F.count(F.lit(1)).alias("employees"), F.sum("salary").cast("double").alias("salaries"))


@register("view_replace_rename", area=VIEWS, oracle=EMP + """
SELECT emp_id, emp_name FROM emp WHERE dept_id = 6""")
def view_replace_rename(t):
    """M1: CREATE VIEW, CREATE OR REPLACE it, RENAME it, query it by the new name."""
    e = model.emp(t)
    VW.create_view(t.spark, "tessera_dept_staff", e.where(F.col("dept_id") == 5))
    VW.create_view(t.spark, "tessera_dept_staff", e.where(F.col("dept_id") == 6), replace=True)
    VW.rename_view(t.spark, "tessera_dept_staff", "tessera_staff_six")
    return t.spark.table("tessera_staff_six").select("emp_id", "emp_name")


@register("view_dept_statistics", area=VIEWS, oracle=EMP + """
SELECT dept_id, COUNT(*) AS employees, CAST(SUM(salary) AS DOUBLE) / COUNT(salary) AS avg_salary,
       CAST(MAX(salary) AS DOUBLE) AS max_salary
FROM emp WHERE dept_id IS NOT NULL GROUP BY dept_id ORDER BY employees DESC, dept_id""")
def view_dept_statistics(t):
    """M2: an aggregate view, queried with its own ORDER BY through Spark SQL."""
    stats = model.emp(t).where(F.col("dept_id").isNotNull()).groupBy("dept_id").agg(
        F.count(F.lit(1)).alias("employees"),
        (F.sum("salary").cast("double") / F.count("salary")).alias("avg_salary"),
        F.max("salary").cast("double").alias("max_salary"))
    VW.create_view(t.spark, "tessera_dept_statistics", stats)
    return t.spark.sql("SELECT * FROM tessera_dept_statistics ORDER BY employees DESC, dept_id")


@register("view_restricted", area=VIEWS, oracle=EMP + """
SELECT emp_id, emp_name, segment FROM emp WHERE segment = 'BUILDING'""")
def view_restricted(t):
    """M3: a row-restricted view and a column-restricted view on top of it."""
    rows = VW.create_view(t.spark, "tessera_building_staff", model.emp(t).where(F.col("segment") == "BUILDING"))
    return VW.create_view(t.spark, "tessera_building_public", rows.select("emp_id", "emp_name", "segment"))


@register("view_high_budget", area=VIEWS, oracle="""
SELECT s.s_suppkey, n.n_name,
       CASE WHEN s.s_acctbal > 9000 THEN 'top tier'
            WHEN s.s_acctbal > 5000 THEN 'middle tier'
            ELSE 'base tier' END AS review_label
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
WHERE s.s_acctbal > 2000""")
def view_high_budget(t):
    """M4: a labelled review view (join + CASE)."""
    s, n = t.supplier, t.nation
    label = (F.when(F.col("s_acctbal") > 9000, "top tier")
             .when(F.col("s_acctbal") > 5000, "middle tier").otherwise("base tier"))
    view = (s.where(F.col("s_acctbal") > 2000).join(n, s["s_nationkey"] == n["n_nationkey"])
            .select("s_suppkey", "n_name", label.alias("review_label")))
    return VW.create_view(t.spark, "tessera_high_budget", view)


def _new_hires(t):
    return t.supplier.select((F.col("s_suppkey") + 1000000000).alias("emp_id"), F.col("s_name").alias("emp_name"),
                             F.col("s_nationkey").alias("dept_id"), F.lit("HIRED").alias("segment"),
                             F.col("s_acctbal").cast("decimal(18,2)").alias("salary"),
                             F.lit(None).cast("bigint").alias("manager_id"))


@register("mv_with_data", area=VIEWS, oracle=EMP + """,
  hires AS (SELECT s_suppkey + 1000000000 AS emp_id, s_nationkey AS dept_id, CAST(s_acctbal AS DECIMAL(18,2)) AS salary
            FROM supplier),
  after AS (SELECT emp_id, dept_id, salary FROM emp UNION ALL SELECT * FROM hires)
SELECT dept_id, COUNT(*) AS employees, CAST(SUM(salary) AS DOUBLE) AS salaries, 'stale' AS state
FROM emp WHERE dept_id IS NOT NULL GROUP BY dept_id
UNION ALL
SELECT dept_id, COUNT(*), CAST(SUM(salary) AS DOUBLE), 'fresh' FROM after WHERE dept_id IS NOT NULL GROUP BY dept_id""")
def mv_with_data(t):
    """M5 + M7: a materialized view WITH DATA stays stale after its base changes
    until REFRESH; both versions are returned, labelled."""
    catalog = sinks.Catalog.of(t.spark)
    catalog.publish("tessera_mv_base", model.emp(t))
    mv = VW.MaterializedView.create(t.spark, "tessera_dept_mv",
                                    lambda: _dept_stats(catalog.read("tessera_mv_base")))
    catalog.publish("tessera_mv_base", catalog.read("tessera_mv_base").unionByName(_new_hires(t)))
    stale = mv.read().withColumn("state", F.lit("stale"))
    fresh = mv.refresh().withColumn("state", F.lit("fresh"))
    return stale.unionByName(fresh)


@register("mv_no_data", area=VIEWS, oracle="""
SELECT CAST(ts AS DATE) AS event_date, COUNT(*) AS events FROM events GROUP BY 1""")
def mv_no_data(t):
    """M6: WITH NO DATA: unreadable until the first REFRESH populates it."""
    mv = VW.MaterializedView.create(
        t.spark, "tessera_daily_events",
        lambda: t.events.groupBy(F.to_date("ts").alias("event_date")).agg(F.count(F.lit(1)).alias("events")),
        with_data=False)
    try:
        mv.read()
        raise AssertionError("reading an unpopulated materialized view must fail")
    except VW.NotPopulated:
        pass
    return mv.refresh()


@register("mv_refresh", area=VIEWS, oracle="""
SELECT CASE WHEN c_acctbal > 9000 THEN 'VIP' ELSE c_mktsegment END AS segment, COUNT(*) AS customers
FROM customer GROUP BY 1""")
def mv_refresh(t):
    """M7: the refresh job: after the base table is changed and published,
    REFRESH recomputes the stored result."""
    catalog = sinks.Catalog.of(t.spark)
    catalog.publish("tessera_segments_base", t.customer.select("c_custkey", "c_mktsegment", "c_acctbal"))
    mv = VW.MaterializedView.create(
        t.spark, "tessera_segment_counts",
        lambda: catalog.read("tessera_segments_base").groupBy(F.col("c_mktsegment").alias("segment"))
        .agg(F.count(F.lit(1)).alias("customers")))
    base = catalog.read("tessera_segments_base")
    catalog.publish("tessera_segments_base", base.withColumn(
        "c_mktsegment", F.when(F.col("c_acctbal") > 9000, "VIP").otherwise(F.col("c_mktsegment"))))
    return refresh_job(mv)


def refresh_job(mv: VW.MaterializedView):
    """The stored refresh procedure: REFRESH MATERIALIZED VIEW as a callable job."""
    return mv.refresh()


KEYED = EMP_DEPT + """,
  v1 AS (SELECT e.dept_id, COUNT(*) AS employees, CAST(SUM(e.salary) AS DOUBLE) AS salaries
         FROM emp e JOIN dept d ON e.dept_id = d.dept_id WHERE d.region <> 4 AND e.salary > 0 GROUP BY e.dept_id),
  v2 AS (SELECT e.dept_id, COUNT(*) AS employees, CAST(SUM(e.salary) AS DOUBLE) AS salaries
         FROM emp e JOIN dept d ON e.dept_id = d.dept_id WHERE d.region <> 0 GROUP BY e.dept_id)"""


@register("mv_refresh_keyed", area=VIEWS, oracle=KEYED + """
SELECT COALESCE(v2.dept_id, v1.dept_id) AS dept_id,
       CASE WHEN v1.dept_id IS NULL THEN 'insert' WHEN v2.dept_id IS NULL THEN 'delete' ELSE 'update' END AS change
FROM v1 FULL JOIN v2 ON v1.dept_id = v2.dept_id
WHERE v1.dept_id IS NULL OR v2.dept_id IS NULL
   OR v1.employees IS DISTINCT FROM v2.employees OR v1.salaries IS DISTINCT FROM v2.salaries""")
def mv_refresh_keyed(t):
    """M8: REFRESH CONCURRENTLY: keyed diff (insert / update / delete) between versions."""
    e, d = model.emp(t), model.dept(t)
    joined = e.join(d.select("dept_id", "region"), "dept_id")
    state = {"v": 1}

    def definition():
        if state["v"] == 1:
            rows = joined.where((F.col("region") != 4) & (F.col("salary") > 0))
        else:
            rows = joined.where(F.col("region") != 0)
        return _dept_stats(rows)

    mv = VW.MaterializedView.create(t.spark, "tessera_dept_keyed", definition, key=["dept_id"])
    state["v"] = 2
    return mv.refresh_keyed()


# ---------------------------------------------------------------- 2.12 functions

@register("udf_discount", area=UDF, oracle="""
SELECT l_orderkey, l_linenumber,
       CAST(CAST(l_extendedprice AS DECIMAL(18,2))
            - CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount * 100 AS DECIMAL(5,2)) * 0.01 AS DOUBLE)
         AS discounted
FROM lineitem""")
def udf_discount(t):
    """Scalar function calculate_discount(price, percent)."""
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    pct = (F.col("l_discount") * 100).cast("decimal(5,2)")
    return t.lineitem.select("l_orderkey", "l_linenumber",
                             tf.calculate_discount(price, pct).cast("double").alias("discounted"))


@register("udtf_film_stats", area=UDF, oracle="""
SELECT 'ECONOMY' AS category, COUNT(*) AS item_count,
       CAST(SUM(CAST(p_retailprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(p_retailprice) AS avg_price
FROM part WHERE p_type = 'ECONOMY'
UNION ALL
SELECT 'NO SUCH TYPE', COUNT(*), CAST(SUM(CAST(p_retailprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(p_retailprice)
FROM part WHERE p_type = 'NO SUCH TYPE'""")
def udtf_film_stats(t):
    """A one-row table function (count, average), safe for zero matches."""
    p = t.part
    a = tf.film_stats(p, "p_type", "p_retailprice", "ECONOMY").select(F.lit("ECONOMY").alias("category"), "*")
    b = tf.film_stats(p, "p_type", "p_retailprice", "NO SUCH TYPE").select(F.lit("NO SUCH TYPE").alias("category"), "*")
    return a.unionByName(b)


@register("udtf_search_1", area=UDF, oracle="SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%ring%'")
def udtf_search_1(t):
    """search(pattern) with a runtime LIKE pattern."""
    return tf.search_items(t.part, "p_name", "%ring%").select("p_partkey", "p_name")


@register("udtf_search_2", area=UDF, oracle="""
SELECT p_partkey, p_name, p_type FROM part WHERE p_name LIKE '%ring%' AND p_type = 'ECONOMY'""")
def udtf_search_2(t):
    """The two-argument overload search(pattern, category) with an extra column."""
    return tf.search_items(t.part, "p_name", "%ring%", "p_type", "ECONOMY").select("p_partkey", "p_name", "p_type")


@register("udtf_customer_rentals", area=UDF, oracle="""
SELECT o.o_custkey AS customer_id, CAST(o.o_orderdate AS DATE) AS rental_date, p.p_name AS title,
       CAST(l.l_shipdate AS DATE) AS return_date
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey JOIN part p ON l.l_partkey = p.p_partkey
WHERE o.o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey = 7 AND c_mktsegment = 'MACHINERY')""")
def udtf_customer_rentals(t):
    """U4: a table function over a 3-way join, called for a set of ids."""
    ids = t.customer.where((F.col("c_nationkey") == 7) & (F.col("c_mktsegment") == "MACHINERY")) \
        .select(F.col("c_custkey").alias("customer_id"))
    return tf.customer_rentals(t.orders, t.lineitem, t.part, ids)
