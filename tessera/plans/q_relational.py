"""Sources and sinks, projections, filters, sorts, set operations, scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import scalar as fx
from tessera.operators.subqueries import in_subquery_flag
from tessera.plans import bank_model as bm
from tessera.plans import model
from tessera.plans.registry import register
from tessera.sources import literals, sinks

SRC, PRED, SORT, SETS, FN = "sources", "predicates", "sorts", "sets", "functions"


# ---------------------------------------------------------------- 2.1 sources / sinks

@register("src_values", area=SRC, oracle=bm.with_bank("exchange_rates", "bank_accounts") + """
SELECT a.currency, COUNT(*) AS accounts,
       CAST(SUM(CAST(a.balance * COALESCE(r.rate, 1) AS DECIMAL(18,2))) AS DOUBLE) AS balance_kzt
FROM bank_accounts a
LEFT JOIN exchange_rates r
  ON r.from_currency = a.currency AND r.to_currency = 'KZT' AND r.valid_to IS NULL
GROUP BY a.currency""")
def src_values(t):
    """A1: a literal VALUES table (exchange rates) valuing every account in KZT."""
    rates = (bm.exchange_rates(t.spark).where(
        F.col("valid_to").isNull() & (F.col("to_currency") == "KZT")))
    acc = bm.accounts(t)
    joined = acc.join(rates, acc["currency"] == rates["from_currency"], "left")
    kzt = (F.col("balance") * F.coalesce(F.col("rate"), F.lit(1))).cast("decimal(18,2)")
    return joined.groupBy("currency").agg(
        F.count(F.lit(1)).alias("accounts"), F.sum(kzt).cast("double").alias("balance_kzt"))


@register("src_scan", area=SRC, oracle="SELECT * FROM supplier")
def src_scan(t):
    """A2: whole-table scan, all columns."""
    return t.supplier


CUSTOMER_DECL = T.StructType([
    T.StructField("c_custkey", T.IntegerType()),
    T.StructField("c_name", T.StringType()),
    T.StructField("c_nationkey", T.IntegerType()),
    T.StructField("c_acctbal", T.DecimalType(12, 2)),
    T.StructField("c_mktsegment", T.StringType()),
    T.StructField("c_phone", T.StringType()),
])


@register("src_schema_cast", area=SRC, oracle="""
SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, c_nationkey,
       CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS DOUBLE) AS c_acctbal, c_mktsegment,
       CAST(NULL AS VARCHAR) AS c_phone
FROM customer""")
def src_schema_cast(t):
    """A3: project a table onto a declared schema (missing column -> typed NULL)."""
    typed = literals.cast_to_schema(t.customer, CUSTOMER_DECL)
    return typed.withColumn("c_acctbal", F.col("c_acctbal").cast("double"))


@register("src_defaults", area=SRC, oracle="""
SELECT c_custkey, c_name, c_nationkey, c_mktsegment, 'Active' AS status FROM customer
UNION ALL
SELECT s_suppkey + 1000000000 AS c_custkey, s_name AS c_name, s_nationkey AS c_nationkey,
       'UNASSIGNED' AS c_mktsegment, 'Active' AS status
FROM supplier""")
def src_defaults(t):
    """A4: appended rows lacking columns get the column defaults."""
    schema = T.StructType([
        T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
        T.StructField("c_nationkey", T.IntegerType()), T.StructField("c_mktsegment", T.StringType()),
        T.StructField("status", T.StringType()),
    ])
    defaults = {"c_mktsegment": "UNASSIGNED", "status": "Active"}
    existing = literals.apply_defaults(t.customer, schema, defaults)
    incoming = t.supplier.select((F.col("s_suppkey") + 1000000000).alias("c_custkey"),
                                 F.col("s_name").alias("c_name"), F.col("s_nationkey").alias("c_nationkey"))
    return existing.unionByName(literals.apply_defaults(incoming, schema, defaults))


@register("src_serial", area=SRC, oracle="""
SELECT s_suppkey, s_name,
       (SELECT MAX(c_custkey) FROM customer) + ROW_NUMBER() OVER (ORDER BY s_name, s_suppkey) AS new_id
FROM supplier""")
def src_serial(t):
    """A5: surrogate keys continuing after the current maximum, in name order."""
    start = t.customer.agg(F.max("c_custkey")).scalar()
    return literals.assign_serial(t.supplier.select("s_suppkey", "s_name"),
                                  ["s_name", "s_suppkey"], "new_id", start=start)


@register("sink_ctas_empty", area=SRC, oracle="SELECT * FROM orders WHERE 1 = 0")
def sink_ctas_empty(t):
    """CREATE TABLE AS SELECT ... WHERE 1=0 -- structure only, no rows."""
    return sinks.ctas(t.orders, t.spark, "ctas_empty", with_data=False)


@register("sink_drop_if_exists", area=SRC, oracle="""
SELECT r_name, 'dropped' AS state FROM region""")
def sink_drop_if_exists(t):
    """DROP TABLE IF EXISTS: the table is gone for its readers, dropping it again is no error, without IF EXISTS it is."""
    catalog, name = sinks.Catalog.of(t.spark), "tessera_drop_probe"
    catalog.publish(name, t.region)
    catalog.drop(name)
    catalog.drop(name)
    try:
        catalog.drop(name, if_exists=False)
        refused = False
    except KeyError:
        refused = True
    state = "dropped" if refused and not catalog.exists(name) else "kept"
    return t.region.select("r_name", F.lit(state).alias("state"))


@register("sink_insert_select", area=SRC, oracle="SELECT * FROM orders WHERE o_orderstatus = 'F'")
def sink_insert_select(t):
    """Empty archive clone, then INSERT ... SELECT of finished orders."""
    archive = sinks.ctas(t.orders, t.spark, "orders_archive", with_data=False)
    appended = sinks.insert_select(archive, t.orders.where(F.col("o_orderstatus") == "F"))
    catalog = sinks.Catalog.of(t.spark)
    catalog.publish("orders_archive", appended)
    return catalog.read("orders_archive")


@register("schema_add_column", area=SRC, oracle="SELECT *, DATE '2024-01-01' AS created_date FROM part")
def schema_add_column(t):
    """ADD COLUMN IF NOT EXISTS ... DEFAULT: existing rows are backfilled."""
    return fx.add_column_if_absent(t.part, "created_date", F.lit("2024-01-01").cast("date"))


@register("layout_sorted_roundtrip", area=SRC, oracle="""
SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
WHERE o_orderdate BETWEEN TIMESTAMP '1998-01-01 00:00:00' AND TIMESTAMP '1998-03-31 00:00:00'
  AND o_totalprice > 150000""")
def layout_sorted_roundtrip(t):
    """A10: write orders range-clustered and sorted by date (the role of a
    B-tree index), read back with a date range that skips row groups."""
    path = sinks.write_clustered(t.orders, t.spark, "orders_by_date", ["o_orderdate", "o_orderkey"])
    stored = t.spark.read.parquet(path)
    lo, hi = (F.lit(v).cast("timestamp_ntz") for v in ("1998-01-01 00:00:00", "1998-03-31 00:00:00"))
    return (stored.where(F.col("o_orderdate").between(lo, hi) & (F.col("o_totalprice") > 150000))
            .select("o_orderkey", "o_orderdate", "o_totalprice"))


@register("layout_filtered_subset", area=SRC, oracle="""
SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 400000 AND o_orderstatus = 'O'""")
def layout_filtered_subset(t):
    """Materialise only the rows a frequent predicate needs (partial index)."""
    subset = t.orders.where(F.col("o_totalprice") > 300000)
    path = sinks.write_clustered(subset, t.spark, "orders_expensive", ["o_totalprice"])
    stored = t.spark.read.parquet(path)
    return (stored.where((F.col("o_totalprice") > 400000) & (F.col("o_orderstatus") == "O"))
            .select("o_orderkey", "o_totalprice"))


@register("layout_derived_key", area=SRC, oracle="""
SELECT o_orderkey, o_custkey, year(o_orderdate) AS order_year FROM orders
WHERE year(o_orderdate) = 1997""")
def layout_derived_key(t):
    """Derived key column (order year) as a directory partition, pruned on read."""
    keyed = t.orders.withColumn("order_year", F.year("o_orderdate"))
    path = sinks.write_partitioned(keyed, t.spark, "orders_by_year", ["order_year"], ["o_orderkey"])
    stored = t.spark.read.parquet(path)
    return (stored.where(F.col("order_year") == 1997)
            .select("o_orderkey", "o_custkey", F.col("order_year").cast("long").alias("order_year")))


@register("layout_hashed", area=SRC, oracle="""
SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (7, 70, 700)""")
def layout_hashed(t):
    """A10: hash layout on an equality key; a lookup touches one file per key."""
    path = sinks.write_hashed(t.orders.select("o_orderkey", "o_custkey"), t.spark, "orders_by_customer", ["o_custkey"])
    return t.spark.read.parquet(path).where(F.col("o_custkey").isin(7, 70, 700))


@register("layout_bucket_join", area=SRC, oracle="""
SELECT o.o_orderkey, o.o_custkey, l.l_linenumber, l.l_partkey
FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey WHERE o.o_custkey > 100""")
def layout_bucket_join(t):
    """A10: two tables bucketed and sorted on the join key are merged without a shuffle."""
    o = sinks.write_bucketed(t.orders.select("o_orderkey", "o_custkey"), t.spark, "orders", ["o_orderkey"], 8)
    li = sinks.write_bucketed(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"), t.spark, "lineitem", ["l_orderkey"], 8)
    o, li = t.spark.table(o).where(F.col("o_custkey") > 100), t.spark.table(li)
    return (o.hint("merge").join(li, F.col("l_orderkey") == F.col("o_orderkey"))
            .select("o_orderkey", "o_custkey", "l_linenumber", "l_partkey"))


@register("layout_derived_lower", area=SRC, oracle="""
SELECT p_partkey, lower(p_name) AS name_key FROM part WHERE lower(p_name) >= 'm'""")
def layout_derived_lower(t):
    """A lower-case key stored beside the rows and clustered on, for case-insensitive lookups."""
    keyed = t.part.select("p_partkey", F.lower("p_name").alias("name_key"))
    path = sinks.write_clustered(keyed, t.spark, "parts_by_name", ["name_key"])
    return t.spark.read.parquet(path).where(F.col("name_key") >= "m")


# ---------------------------------------------------------------- 2.2 projections / filters

@register("proj_computed", area=PRED, oracle="""
SELECT c_custkey, c_name || ' (' || c_mktsegment || ')' AS label,
       c_acctbal / 12 AS monthly_balance,
       CAST(ROUND(CAST(c_acctbal AS DECIMAL(18,2)) * 1.1, 2) AS DOUBLE) AS raised_balance
FROM customer""")
def proj_computed(t):
    """B1: projection with aliases and computed columns."""
    c = t.customer
    return c.select(
        "c_custkey",
        F.concat(F.col("c_name"), F.lit(" ("), F.col("c_mktsegment"), F.lit(")")).alias("label"),
        (F.col("c_acctbal") / 12).alias("monthly_balance"),
        F.round(F.col("c_acctbal").cast("decimal(18,2)") * F.lit(1.1).cast("decimal(2,1)"), 2)
        .cast("double").alias("raised_balance"),
    )


@register("proj_distinct", area=PRED, oracle=model.with_model("emp") + """
SELECT DISTINCT segment, dept_id FROM emp""")
def proj_distinct(t):
    """B2: DISTINCT projection; NULL is one group."""
    return model.emp(t).select("segment", "dept_id").distinct()


@register("proj_case", area=PRED, oracle="""
SELECT o_orderkey,
       CASE WHEN o_totalprice > 300000 THEN 'large'
            WHEN o_totalprice > 100000 THEN 'medium'
            ELSE 'small' END AS size_class
FROM orders""")
def proj_case(t):
    """Searched CASE, first matching branch wins."""
    price = F.col("o_totalprice")
    return t.orders.select(
        "o_orderkey",
        F.when(price > 300000, "large").when(price > 100000, "medium").otherwise("small").alias("size_class"))


@register("filter_cmp", area=PRED, oracle="""
SELECT o_orderkey, o_orderdate FROM orders
WHERE o_orderdate > TIMESTAMP '1998-06-30 00:00:00' AND o_orderstatus <> 'F'""")
def filter_cmp(t):
    """Comparison predicates on timestamp and text."""
    return (t.orders.where((F.col("o_orderdate") > F.lit("1998-06-30 00:00:00").cast("timestamp_ntz"))
                           & (F.col("o_orderstatus") != "F"))
            .select("o_orderkey", "o_orderdate"))


@register("filter_between", area=PRED, oracle="""
SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice BETWEEN 100000 AND 200000""")
def filter_between(t):
    """Inclusive BETWEEN."""
    return t.orders.where(F.col("o_totalprice").between(100000, 200000)).select("o_orderkey", "o_totalprice")


@register("filter_like", area=PRED, oracle="""
SELECT p_partkey, p_name FROM part WHERE p_name LIKE 'b%' OR p_name LIKE '%ring%'""")
def filter_like(t):
    """LIKE prefix OR contains."""
    return t.part.where(F.col("p_name").like("b%") | F.col("p_name").like("%ring%")).select("p_partkey", "p_name")


@register("filter_null", area=PRED, oracle=model.with_model("emp") + """
SELECT emp_id, manager_id, dept_id FROM emp
WHERE manager_id IS NOT NULL AND segment = 'BUILDING' AND dept_id IS NULL""")
def filter_null(t):
    """IS NULL / IS NOT NULL on derived nullable columns."""
    e = model.emp(t)
    return (e.where(F.col("manager_id").isNotNull() & (F.col("segment") == "BUILDING")
                    & F.col("dept_id").isNull())
            .select("emp_id", "manager_id", "dept_id"))


@register("filter_3vl", area=PRED, oracle="""
WITH o AS (
  SELECT o_orderkey, o_totalprice,
         CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_orderdate END AS closed_at
  FROM orders)
SELECT o_orderkey FROM o
WHERE (closed_at > TIMESTAMP '1998-01-01 00:00:00' OR o_totalprice > 400000)
  AND NOT (closed_at < TIMESTAMP '1996-01-01 00:00:00')""")
def filter_3vl(t):
    """AND / OR / NOT under three-valued logic (a NULL predicate filters the row)."""
    closed = F.when(F.col("o_orderstatus") == "O", F.lit(None)).otherwise(F.col("o_orderdate"))
    o = t.orders.select("o_orderkey", "o_totalprice", closed.alias("closed_at"))
    ts = lambda s: F.lit(s).cast("timestamp_ntz")
    return (o.where(((F.col("closed_at") > ts("1998-01-01 00:00:00")) | (F.col("o_totalprice") > 400000))
                    & ~(F.col("closed_at") < ts("1996-01-01 00:00:00")))
            .select("o_orderkey"))


@register("filter_in_list", area=PRED, oracle="""
SELECT o_orderkey, o_orderpriority, o_orderstatus FROM orders
WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus IN ('F', 'P')""")
def filter_in_list(t):
    """IN literal lists, two combined."""
    return (t.orders.where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
                           & F.col("o_orderstatus").isin("F", "P"))
            .select("o_orderkey", "o_orderpriority", "o_orderstatus"))


@register("filter_composite", area=PRED, oracle="""
SELECT c_custkey, c_nationkey, c_acctbal FROM customer WHERE c_nationkey = 5 AND c_acctbal > 5000""")
def filter_composite(t):
    """Equality plus range, both pushed into the Parquet scan."""
    return (t.customer.where((F.col("c_nationkey") == 5) & (F.col("c_acctbal") > 5000))
            .select("c_custkey", "c_nationkey", "c_acctbal"))


@register("filter_lower", area=PRED, oracle="""
SELECT c_custkey, c_mktsegment FROM customer WHERE lower(c_mktsegment) = 'building'""")
def filter_lower(t):
    """Case-insensitive equality."""
    return t.customer.where(F.lower("c_mktsegment") == "building").select("c_custkey", "c_mktsegment")


@register("filter_year", area=PRED, oracle="""
SELECT o_orderkey, o_orderdate FROM orders WHERE year(o_orderdate) = 1997""")
def filter_year(t):
    """Date-part equality, as a range the Parquet scan can use."""
    return t.orders.where(fx.year_equals("o_orderdate", 1997)).select("o_orderkey", "o_orderdate")


@register("filter_string_range", area=PRED, oracle="""
SELECT p_partkey, p_name FROM part WHERE p_name > 'm'""")
def filter_string_range(t):
    """Lexicographic (binary collation) string range."""
    return t.part.where(F.col("p_name") > "m").select("p_partkey", "p_name")


@register("filter_regex", area=PRED, oracle="""
SELECT c_custkey, c_name FROM customer WHERE regexp_matches(c_name, '#0+1[0-9][0-9]$')""")
def filter_regex(t):
    """Regular-expression predicate."""
    return t.customer.where(F.col("c_name").rlike("#0+1[0-9][0-9]$")).select("c_custkey", "c_name")


@register("filter_bool", area=PRED, oracle=bm.with_bank("bank_accounts") + """
SELECT account_id, currency FROM bank_accounts WHERE is_active AND currency <> 'KZT'""")
def filter_bool(t):
    """Boolean column as predicate."""
    a = bm.accounts(t)
    return a.where(F.col("is_active") & (F.col("currency") != "KZT")).select("account_id", "currency")


@register("proj_in_subquery_case", area=PRED, oracle=model.with_model("emp") + """
SELECT emp_id,
       CAST(CASE WHEN dept_id IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)
                 THEN salary * 1.15 ELSE salary * 1.05 END AS DOUBLE) AS new_salary
FROM emp""")
def proj_in_subquery_case(t):
    """IN (subquery) used as a value inside CASE (a mark join)."""
    e = model.emp(t)
    americas = t.nation.where(F.col("n_regionkey") == 1)
    flagged = in_subquery_flag(e, "dept_id", americas, "n_nationkey", "__in")
    raise_by = F.when(F.col("__in"), F.lit(1.15).cast("decimal(3,2)")).otherwise(F.lit(1.05).cast("decimal(3,2)"))
    return flagged.select("emp_id", (F.col("salary") * raise_by).cast("double").alias("new_salary"))


# ---------------------------------------------------------------- 2.7 sorts / top-k

@register("sort_multi", area=SORT, oracle="""
SELECT s_nationkey, s_acctbal, s_suppkey FROM supplier ORDER BY 1, 2 DESC, 3""")
def sort_multi(t):
    """L1: ORDER BY several columns, mixed directions."""
    return (t.supplier.select("s_nationkey", "s_acctbal", "s_suppkey")
            .orderBy(F.col("s_nationkey").asc_nulls_last(), F.col("s_acctbal").desc_nulls_first(),
                     F.col("s_suppkey").asc_nulls_last()))


@register("sort_desc", area=SORT, oracle="""
SELECT p_partkey, p_retailprice FROM part ORDER BY p_retailprice DESC NULLS FIRST, p_partkey""")
def sort_desc(t):
    """L2: ORDER BY DESC (NULLs first, as in PostgreSQL)."""
    return (t.part.select("p_partkey", "p_retailprice")
            .orderBy(F.col("p_retailprice").desc_nulls_first(), "p_partkey"))


@register("sort_nulls_first", area=SORT, oracle=model.with_model("emp") + """
SELECT emp_id, manager_id FROM emp ORDER BY manager_id ASC NULLS FIRST, emp_id""")
def sort_nulls_first(t):
    """L3: NULLS FIRST on an ascending key."""
    return model.emp(t).select("emp_id", "manager_id").orderBy(F.col("manager_id").asc_nulls_first(), "emp_id")


@register("topk_limit", area=SORT, oracle="""
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""")
def topk_limit(t):
    """L4: ORDER BY ... LIMIT n (a top-k; Spark plans TakeOrderedAndProject)."""
    return (t.orders.select("o_orderkey", "o_totalprice")
            .orderBy(F.col("o_totalprice").desc_nulls_first(), "o_orderkey").limit(10))


# ---------------------------------------------------------------- 2.8 set operations

@register("set_union", area=SETS, oracle="""
SELECT c_nationkey AS nationkey FROM customer WHERE c_acctbal > 9900
UNION
SELECT s_nationkey FROM supplier WHERE s_acctbal < 0""")
def set_union(t):
    """UNION (distinct)."""
    a = t.customer.where(F.col("c_acctbal") > 9900).select(F.col("c_nationkey").alias("nationkey"))
    b = t.supplier.where(F.col("s_acctbal") < 0).select("s_nationkey")
    return a.union(b).distinct()


@register("set_union_all", area=SETS, oracle="""
SELECT event_id, 'big' AS reason FROM events WHERE value > 200
UNION ALL
SELECT event_id, 'error' FROM events WHERE event_type = 'error' AND value > 150
UNION ALL
SELECT event_id, 'early' FROM events WHERE ts < TIMESTAMP '2024-01-02 00:00:00'""")
def set_union_all(t):
    """Three-way UNION ALL; a row may appear under several reasons."""
    e = t.events
    big = e.where(F.col("value") > 200).select("event_id", F.lit("big").alias("reason"))
    err = e.where((F.col("event_type") == "error") & (F.col("value") > 150)).select(
        "event_id", F.lit("error").alias("reason"))
    early = e.where(F.col("ts") < F.lit("2024-01-02 00:00:00").cast("timestamp_ntz")).select(
        "event_id", F.lit("early").alias("reason"))
    return big.unionByName(err).unionByName(early)


@register("set_intersect", area=SETS, oracle="""
SELECT o_custkey AS custkey FROM orders WHERE o_orderpriority = '1-URGENT'
INTERSECT
SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'""")
def set_intersect(t):
    """S3: INTERSECT (distinct)."""
    a = t.orders.where(F.col("o_orderpriority") == "1-URGENT").select(F.col("o_custkey").alias("custkey"))
    b = t.customer.where(F.col("c_mktsegment") == "BUILDING").select("c_custkey")
    return a.intersect(b)


@register("set_except", area=SETS, oracle="""
SELECT c_custkey AS custkey FROM customer WHERE c_mktsegment = 'BUILDING'
EXCEPT
SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'""")
def set_except(t):
    """EXCEPT (distinct)."""
    a = t.customer.where(F.col("c_mktsegment") == "BUILDING").select(F.col("c_custkey").alias("custkey"))
    b = t.orders.where(F.col("o_orderpriority") == "1-URGENT").select("o_custkey")
    return a.subtract(b)


# ---------------------------------------------------------------- 2.8 scalar functions

@register("fn_concat", area=FN, oracle=model.with_model("emp", "dept") + """
SELECT e.emp_id, e.emp_name || ' @ ' || d.dept_name AS placement
FROM emp e LEFT JOIN dept d ON e.dept_id = d.dept_id""")
def fn_concat(t):
    """|| yields NULL when either side is NULL."""
    e, d = model.emp(t), model.dept(t)
    j = e.join(d, "dept_id", "left")
    return j.select("emp_id", F.concat("emp_name", F.lit(" @ "), "dept_name").alias("placement"))


@register("fn_case_length", area=FN, oracle="""
SELECT c_custkey, upper(c_name) AS upper_name, lower(c_mktsegment) AS lower_segment,
       length(c_name) AS name_length
FROM customer""")
def fn_case_length(t):
    """UPPER / LOWER / LENGTH (in characters)."""
    c = t.customer
    return c.select("c_custkey", F.upper("c_name").alias("upper_name"),
                    F.lower("c_mktsegment").alias("lower_segment"),
                    F.length("c_name").cast("long").alias("name_length"))


@register("fn_substring", area=FN, oracle="""
SELECT p_partkey, substring(p_name, 1, 3) AS name_code FROM part""")
def fn_substring(t):
    """SUBSTRING(x FROM 1 FOR 3), 1-based."""
    return t.part.select("p_partkey", F.substring("p_name", 1, 3).alias("name_code"))


@register("fn_format", area=FN, oracle=model.with_model("emp", "dept") + """
SELECT e.emp_id,
       printf('%s works in %s', e.emp_name, COALESCE(d.dept_name, '')) AS sentence
FROM emp e LEFT JOIN dept d ON e.dept_id = d.dept_id""")
def fn_format(t):
    """FORMAT('%s ...'): a NULL argument prints as empty text."""
    e, d = model.emp(t), model.dept(t)
    j = e.join(d, "dept_id", "left")
    return j.select("emp_id", fx.format_text("%s works in %s", F.col("emp_name"), F.col("dept_name"))
                    .alias("sentence"))


@register("fn_round_arith", area=FN, oracle="""
SELECT l_orderkey, l_linenumber,
       CAST(ROUND(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
                  * (1 + CAST(l_tax AS DECIMAL(4,2))), 2) AS DOUBLE) AS charge
FROM lineitem""")
def fn_round_arith(t):
    """decimal arithmetic and ROUND(x, 2) (half away from zero)."""
    li = t.lineitem
    charge = (F.col("l_extendedprice").cast("decimal(18,2)")
              * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))
              * (F.lit(1) + F.col("l_tax").cast("decimal(4,2)")))
    return li.select("l_orderkey", "l_linenumber", F.round(charge, 2).cast("double").alias("charge"))


@register("fn_coalesce", area=FN, oracle=model.with_model("emp") + """
SELECT emp_id, COALESCE(manager_id, dept_id, -1) AS reports_to FROM emp""")
def fn_coalesce(t):
    """COALESCE, first non-NULL argument."""
    e = model.emp(t)
    return e.select("emp_id", F.coalesce("manager_id", F.col("dept_id").cast("bigint"), F.lit(-1).cast("bigint"))
                    .alias("reports_to"))


@register("fn_nullif", area=FN, oracle="""
SELECT c_custkey, NULLIF(c_nationkey, 0) AS nation_or_null,
       c_acctbal / NULLIF(c_nationkey, 0) AS per_nation
FROM customer""")
def fn_nullif(t):
    """NULLIF, also as a division-by-zero guard."""
    c = t.customer
    guarded = F.nullif(F.col("c_nationkey"), F.lit(0))
    return c.select("c_custkey", guarded.alias("nation_or_null"),
                    (F.col("c_acctbal") / guarded).alias("per_nation"))


@register("fn_extract_year", area=FN, oracle="""
SELECT o_orderkey, year(o_orderdate) AS order_year, month(o_orderdate) AS order_month FROM orders""")
def fn_extract_year(t):
    """F8: EXTRACT(YEAR / MONTH FROM date)."""
    return t.orders.select("o_orderkey", F.year("o_orderdate").cast("long").alias("order_year"),
                           F.month("o_orderdate").cast("long").alias("order_month"))


@register("fn_age_years", area=FN, oracle="""
SELECT o_orderkey, date_part('year', age(DATE '2002-01-01', CAST(o_orderdate AS DATE))) AS age_years
FROM orders""")
def fn_age_years(t):
    """EXTRACT(YEAR FROM AGE(as_of, d)): whole years between two dates."""
    return t.orders.select("o_orderkey", fx.age_years(F.lit("2002-01-01").cast("date"),
                                                      F.to_date("o_orderdate")).alias("age_years"))


@register("fn_current", area=FN, oracle="""
SELECT event_id, ts < CURRENT_TIMESTAMP AS is_past, CAST(ts AS DATE) < CURRENT_DATE AS is_before_today,
       CAST(CURRENT_TIMESTAMP AT TIME ZONE 'UTC' AS DATE) >= DATE '2024-01-01' AS clock_runs, length(CURRENT_USER) > 0 AS has_user
FROM events""")
def fn_current(t):
    """CURRENT_DATE, CURRENT_TIMESTAMP (one value per statement) and CURRENT_USER."""
    return t.events.select(
        "event_id", (F.col("ts") < F.current_timestamp()).alias("is_past"), (F.to_date("ts") < F.current_date()).alias("is_before_today"),
        (F.to_date(F.current_timestamp()) >= F.lit("2024-01-01").cast("date")).alias("clock_runs"), (F.length(F.current_user()) > 0).alias("has_user"))


@register("fn_date_plus_interval", area=FN, oracle="""
SELECT o_orderkey, CAST(o_orderdate AS DATE) + 30 AS due_date,
       CAST(o_orderdate AS DATE) + 30 < DATE '1996-01-01' AS overdue
FROM orders""")
def fn_date_plus_interval(t):
    """date + INTERVAL 'n days', compared with a fixed as-of date."""
    due = F.date_add(F.to_date("o_orderdate"), 30)
    return t.orders.select("o_orderkey", due.alias("due_date"),
                           (due < F.lit("1996-01-01").cast("date")).alias("overdue"))


@register("fn_ts_interval", area=FN, oracle="""
SELECT event_id, ts - INTERVAL 1 HOUR AS window_start, ts + INTERVAL 1 HOUR AS window_end,
       ts - INTERVAL 1 MINUTE < TIMESTAMP '2024-01-02 00:00:00' AS before_day_two
FROM events""")
def fn_ts_interval(t):
    """timestamp +/- INTERVAL and interval comparisons."""
    ts = F.col("ts")
    return t.events.select(
        "event_id",
        (ts - F.expr("INTERVAL 1 HOUR")).alias("window_start"),
        (ts + F.expr("INTERVAL 1 HOUR")).alias("window_end"),
        ((ts - F.expr("INTERVAL 1 MINUTE")) < F.lit("2024-01-02 00:00:00").cast("timestamp_ntz"))
        .alias("before_day_two"),
    )


@register("fn_casts", area=FN, oracle="""
SELECT event_id, CAST(ts AS DATE) AS event_date,
       CAST(CAST(value AS DECIMAL(10,2)) AS DOUBLE) AS amount,
       CAST(ROUND(CAST(value AS DECIMAL(10,2)) * 1.1) AS INTEGER) AS rounded_int,
       TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
FROM events""")
def fn_casts(t):
    """::DATE, ::NUMERIC, numeric -> integer assignment (rounds), safe casts."""
    amount = F.col("value").cast("decimal(10,2)")
    return t.events.select(
        "event_id", F.to_date("ts").alias("event_date"), amount.cast("double").alias("amount"),
        F.round(amount * F.lit(1.1).cast("decimal(2,1)")).cast("int").alias("rounded_int"),
        F.get_json_object("props", "$.k").try_cast("int").alias("k"),
    )


@register("json_get", area=FN, oracle="""
SELECT event_id, json_extract_string(props, '$.k') AS k_text FROM events""")
def json_get(t):
    """JSON field as text (->>)."""
    return t.events.select("event_id", F.get_json_object("props", "$.k").alias("k_text"))


@register("json_explode", area=FN, oracle="""
WITH p AS (
  SELECT o_orderkey,
         '[{"iin": "' || lpad(CAST(o_custkey AS VARCHAR), 12, '0') || '", "amount": ' || CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) || '},'
         || ' {"iin": "' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') || '", "amount": 1.50}]' AS payments
  FROM orders WHERE o_orderkey % 16 > 2)
SELECT o_orderkey, 'ok' AS document, i + 1 AS pos,
       json_extract_string(payments, '$[' || CAST(i AS VARCHAR) || '].iin') AS iin,
       CAST(CAST(json_extract_string(payments, '$[' || CAST(i AS VARCHAR) || '].amount') AS DECIMAL(18,2)) AS DOUBLE)
         AS amount
FROM p, range(CAST(json_array_length(payments) AS BIGINT)) r(i)
UNION ALL
SELECT o_orderkey, CASE o_orderkey % 16 WHEN 0 THEN 'empty' ELSE 'malformed' END, NULL, NULL, NULL
FROM orders WHERE o_orderkey % 16 <= 2""")
def json_explode(t):
    """unnest a JSON array of objects, with the 1-based element position; empty,
    missing and malformed documents keep a row."""
    o = t.orders
    payments = fx.payments_json(o)
    return fx.explode_payments(payments, ["o_orderkey"])


@register("json_build", area=FN, oracle="""
SELECT event_id, 'completed' AS status, event_type AS kind,
       CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
FROM events""")
def json_build(t):
    """F16: build a JSON object (jsonb_build_object) and read its fields back."""
    built = t.events.select("event_id", fx.json_object(
        status=F.lit("completed"), kind=F.col("event_type"),
        k=F.get_json_object("props", "$.k").cast("bigint")).alias("doc"))
    return built.select("event_id", F.get_json_object("doc", "$.status").alias("status"),
                        F.get_json_object("doc", "$.kind").alias("kind"),
                        F.get_json_object("doc", "$.k").cast("bigint").alias("k"))


@register("arr_append", area=FN, oracle="""
SELECT o_orderkey,
       array_to_string(list_append([o_custkey, CAST(o_orderkey AS BIGINT)], -1), ',') AS key_list,
       3 AS list_size
FROM orders""")
def arr_append(t):
    """array literal, then append an element (per row, never an unbounded collect)."""
    arr = F.array_append(F.array("o_custkey", "o_orderkey"), F.lit(-1).cast("bigint"))
    return t.orders.select("o_orderkey", F.array_join(arr.cast("array<string>"), ",").alias("key_list"),
                           F.size(arr).alias("list_size"))
