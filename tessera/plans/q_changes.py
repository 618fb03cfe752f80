"""Table changes (2.9) and data-quality validators (2.10) over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import changes as C
from tessera.operators import quality as V
from tessera.plans import bank_model as bm
from tessera.plans import model
from tessera.plans.registry import register
from tessera.sources import sinks

DML, DQ = "changes", "quality"
EMP = model.with_model("emp")


def _emp_out(df):
    return df.select("emp_id", "segment", F.col("salary").cast("double").alias("salary"))


# ---------------------------------------------------------------- 2.9 changes

@register("dml_update", area=DML, oracle=EMP + """
SELECT emp_id, segment,
       CAST(CASE WHEN dept_id = 5 THEN CAST(ROUND(salary * 1.1, 2) AS DECIMAL(18,2)) ELSE salary END AS DOUBLE)
         AS salary
FROM emp""")
def dml_update(t):
    """UPDATE ... SET expr WHERE p (rows where p is NULL stay as they are)."""
    e = model.emp(t)
    ch = C.update(e, {"salary": F.round(F.col("salary") * F.lit(1.1).cast("decimal(2,1)"), 2)},
                  where=F.col("dept_id") == 5)
    return _emp_out(ch.snapshot)


@register("dml_update_case", area=DML, oracle=EMP + """
SELECT emp_id, segment,
       CAST(CAST(CASE WHEN salary < 0 THEN 0
                      WHEN salary < 5000 THEN ROUND(salary * 1.05, 2)
                      ELSE salary END AS DECIMAL(18,2)) AS DOUBLE) AS salary
FROM emp""")
def dml_update_case(t):
    """UPDATE with a CASE expression."""
    s = F.col("salary")
    expr = (F.when(s < 0, F.lit(0)).when(s < 5000, F.round(s * F.lit(1.05).cast("decimal(3,2)"), 2))
            .otherwise(s))
    return _emp_out(C.update(model.emp(t), {"salary": expr}).snapshot)


@register("dml_update_default", area=DML, oracle=bm.with_bank("bank_customers") + """
SELECT customer_id, status,
       CAST(CASE WHEN status = 'blocked' THEN 500000.00 ELSE daily_limit_kzt END AS DOUBLE) AS daily_limit_kzt
FROM bank_customers""")
def dml_update_default(t):
    """D3: UPDATE ... SET col = DEFAULT (the column's registered default)."""
    cust = bm.customers(t)
    ch = C.update_to_default(cust, "daily_limit_kzt", {"daily_limit_kzt": 500000}, where=F.col("status") == "blocked")
    return ch.snapshot.select("customer_id", "status", F.col("daily_limit_kzt").cast("double"))


@register("dml_update_multi", area=DML, oracle=EMP + """
SELECT emp_id, CASE WHEN salary > 5000 THEN 'SENIOR' ELSE segment END AS segment,
       CAST(salary + 100 AS DOUBLE) AS salary
FROM emp""")
def dml_update_multi(t):
    """Several columns in one UPDATE: every expression sees the old row."""
    ch = C.update(model.emp(t), {
        "salary": F.col("salary") + 100,
        "segment": F.when(F.col("salary") > 5000, F.lit("SENIOR")).otherwise(F.col("segment")),
    })
    return _emp_out(ch.snapshot)


@register("dml_update_from_agg", area=DML, oracle=EMP + """,
  dept_avg AS (SELECT dept_id, CAST(SUM(salary) * 100 AS BIGINT) AS cents, COUNT(salary) AS n
               FROM emp GROUP BY dept_id)
SELECT e.emp_id, e.segment,
       CASE WHEN e.dept_id IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 3)
            THEN sign(a.cents) * ((2 * abs(a.cents) + a.n) // (2 * a.n)) / 100.0
            ELSE CAST(e.salary AS DOUBLE) END AS salary
FROM emp e LEFT JOIN dept_avg a ON e.dept_id = a.dept_id""")
def dml_update_from_agg(t):
    """SET col = (correlated AVG) WHERE key IN (subquery): pre-aggregate, join, assign."""
    e = model.emp(t)
    avgs = e.groupBy(F.col("dept_id").alias("__d")).agg(F.round(F.avg("salary"), 2).alias("__avg"))
    europe = t.nation.where(F.col("n_regionkey") == 3).select(F.col("n_nationkey").alias("__n"))
    joined = (e.join(avgs, e["dept_id"] == avgs["__d"], "left")
              .join(europe, e["dept_id"] == europe["__n"], "left"))
    ch = C.update(joined, {"salary": F.col("__avg")}, where=F.col("__n").isNotNull())
    return _emp_out(ch.snapshot)


@register("dml_update_in_subquery", area=DML, oracle=EMP + """
SELECT emp_id,
       CASE WHEN emp_id IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 400000)
            THEN 'PRIORITY' ELSE segment END AS segment,
       CAST(salary AS DOUBLE) AS salary
FROM emp""")
def dml_update_in_subquery(t):
    """The new value is chosen by IN (subquery) inside CASE."""
    from tessera.operators.subqueries import in_subquery_flag

    vip = t.orders.where((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_totalprice") > 400000))
    flagged = in_subquery_flag(model.emp(t), "emp_id", vip, "o_custkey", "__vip")
    ch = C.update(flagged, {"segment": F.when(F.col("__vip"), F.lit("PRIORITY")).otherwise(F.col("segment"))})
    return _emp_out(ch.snapshot)


@register("dml_update_returning", area=DML, oracle=EMP + """
SELECT emp_id, CAST(salary AS DOUBLE) AS old_salary, CAST(salary + 5000 AS DOUBLE) AS new_salary
FROM emp WHERE segment = 'AUTOMOBILE' AND dept_id = 7""")
def dml_update_returning(t):
    """UPDATE ... RETURNING old and new values of the changed rows."""
    ch = C.update(model.emp(t), {"salary": F.col("salary") + 5000},
                  where=(F.col("segment") == "AUTOMOBILE") & (F.col("dept_id") == 7),
                  returning=["emp_id", "old_salary", "salary"])
    return ch.returning.select("emp_id", F.col("old_salary").cast("double"),
                               F.col("salary").cast("double").alias("new_salary"))


@register("dml_delete", area=DML, oracle=EMP + """
SELECT emp_id, segment, CAST(salary AS DOUBLE) AS salary FROM emp WHERE NOT COALESCE(dept_id = 5, FALSE)""")
def dml_delete(t):
    """DELETE WHERE p: rows where p is NULL stay."""
    return _emp_out(C.delete(model.emp(t), F.col("dept_id") == 5).snapshot)


@register("dml_delete_not_in", area=DML, oracle="""
SELECT c_custkey FROM customer
WHERE NOT (c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderdate > TIMESTAMP '2000-06-01 00:00:00'))""")
def dml_delete_not_in(t):
    """DELETE ... WHERE key NOT IN (subquery): victims by null-aware anti join."""
    late = t.orders.where(F.col("o_orderdate") > F.lit("2000-06-01 00:00:00").cast("timestamp_ntz"))
    ch = C.delete_not_in(t.customer.select("c_custkey"), "c_custkey", late, "o_custkey")
    return ch.snapshot


@register("dml_delete_returning", area=DML, oracle="""
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_orderstatus = 'P' AND o_totalprice < 20000""")
def dml_delete_returning(t):
    """DELETE ... RETURNING the removed rows."""
    ch = C.delete(t.orders, (F.col("o_orderstatus") == "P") & (F.col("o_totalprice") < 20000),
                  returning=["o_orderkey", "o_custkey", "o_totalprice"])
    return ch.returning


@register("dml_insert_returning", area=DML, oracle=EMP + """
SELECT (SELECT MAX(emp_id) FROM emp) + ROW_NUMBER() OVER (ORDER BY s_name, s_suppkey) AS emp_id,
       s_name || ' <' || lower(replace(s_name, '#', '.')) || '@example.com>' AS contact
FROM supplier""")
def dml_insert_returning(t):
    """INSERT ... RETURNING generated ids and computed columns."""
    e = model.emp(t)
    rows = t.supplier.select(F.col("s_name").alias("emp_name"), "s_suppkey",
                             F.col("s_nationkey").alias("dept_id"),
                             F.col("s_acctbal").cast("decimal(18,2)").alias("salary"))
    contact = F.concat("emp_name", F.lit(" <"), F.lower(F.regexp_replace("emp_name", "#", ".")),
                       F.lit("@example.com>"))
    ch = C.insert(e, rows, id_col="emp_id", order=["emp_name", "s_suppkey"],
                  returning=["emp_id", contact.alias("contact")])
    return ch.returning


@register("dml_insert_if_absent", area=DML, oracle="""
SELECT n_nationkey AS dept_id, n_name AS dept_name FROM nation WHERE n_regionkey <= 2
UNION ALL
SELECT n_nationkey, n_name FROM nation n
WHERE n_regionkey >= 2
  AND NOT EXISTS (SELECT 1 FROM nation d WHERE d.n_regionkey <= 2 AND d.n_nationkey = n.n_nationkey)""")
def dml_insert_if_absent(t):
    """INSERT ... WHERE NOT EXISTS: a second run adds nothing."""
    d = model.dept(t).where(F.col("region") <= 2).select("dept_id", "dept_name")
    incoming = model.dept(t).where(F.col("region") >= 2).select("dept_id", "dept_name")
    once = C.insert_if_absent(d, incoming, ["dept_id"]).snapshot
    return C.insert_if_absent(once, incoming, ["dept_id"]).snapshot


@register("dml_archive_move", area=DML, oracle="""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' AND o_orderdate < TIMESTAMP '1996-01-01 00:00:00'
                        THEN 'archive' ELSE 'live' END AS location
FROM orders""")
def dml_archive_move(t):
    """Archive-then-delete: one predicate splits the table in two."""
    live, archived = C.archive_move(
        t.orders, (F.col("o_orderstatus") == "F") & (F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp_ntz")))
    return (live.select("o_orderkey", F.lit("live").alias("location"))
            .unionByName(archived.select("o_orderkey", F.lit("archive").alias("location"))))


@register("dml_view_write", area=DML, oracle=EMP + """
SELECT emp_id, segment,
       CAST(CASE WHEN dept_id = 5 AND salary > 5000 THEN salary + 1 ELSE salary END AS DOUBLE) AS salary
FROM emp""")
def dml_view_write(t):
    """UPDATE through an updatable view (dept 5): the base table changes,
    but only rows the view shows."""
    e = model.emp(t)
    view_pred = F.col("dept_id") == 5
    ch = C.update(e, {"salary": F.col("salary") + 1}, where=view_pred & (F.col("salary") > 5000))
    return _emp_out(ch.snapshot)


@register("dml_insert_assigns", area=DML, oracle="""
SELECT c_custkey AS id, CAST(c_nationkey AS INTEGER) AS score, c_name AS name, 'old' AS tier FROM customer
UNION ALL
SELECT 1000000000 + s_suppkey, CAST(ROUND(CAST(s_acctbal AS DECIMAL(18,2))) AS INTEGER), s_name, 'new' FROM supplier""")
def dml_insert_assigns(t):
    """Decimals round into an integer column; a column that the rows omit takes its default."""
    target = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_nationkey").cast("int").alias("score"),
                               F.col("c_name").alias("name"), F.lit("old").alias("tier"))
    rows = t.supplier.select((F.col("s_suppkey") + 1000000000).alias("id"),
                             F.col("s_acctbal").cast("decimal(18,2)").alias("score"), F.col("s_name").alias("name"))
    return C.insert(target, rows, defaults={"tier": "new"}).snapshot


@register("dml_serial_no_reuse", area=DML, oracle="""
WITH top AS (SELECT MAX(c_custkey) AS id FROM customer)
SELECT c_custkey AS id, c_name AS name FROM customer, top WHERE c_custkey < top.id
UNION ALL
SELECT top.id + ROW_NUMBER() OVER (ORDER BY s_suppkey), s_name FROM supplier, top""")
def dml_serial_no_reuse(t):
    """A5: the id of a deleted last row is not given out again (the catalog keeps the mark)."""
    catalog = sinks.Catalog.of(t.spark)
    people = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    top = people.agg(F.max("id")).first()[0]
    catalog.drop("tessera_people")  # a new table: its serial starts afresh
    catalog.publish("tessera_people", people, serial={"id": top})
    catalog.publish("tessera_people", C.delete(catalog.read("tessera_people"), F.col("id") == top).snapshot)
    rows = t.supplier.select("s_suppkey", F.col("s_name").alias("name"))
    change = C.insert(catalog.read("tessera_people"), rows, id_col="id", order=["s_suppkey"],
                      last_id=catalog.last_serial("tessera_people", "id"))
    return change.snapshot


@register("dml_view_insert", area=DML, oracle="""
SELECT s_suppkey AS id, s_nationkey AS nation, CAST(s_acctbal AS DOUBLE) AS balance, 'stored' AS outcome FROM supplier
UNION ALL
SELECT 1000000000 + c_custkey, c_nationkey, 0.0,
       CASE WHEN c_nationkey = 5 THEN 'stored' ELSE 'refused' END FROM customer""")
def dml_view_insert(t):
    """INSERT through a view with check option; the hidden column takes its default."""
    target = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("nation"),
                               F.col("s_acctbal").cast("double").alias("balance"))
    rows = t.customer.select((F.col("c_custkey") + 1000000000).alias("id"), F.col("c_nationkey").alias("nation"))
    change, refused = C.view_insert(target, rows, F.col("nation") == 5, defaults={"balance": 0.0})
    return change.snapshot.withColumn("outcome", F.lit("stored")).unionByName(
        refused.withColumn("outcome", F.lit("refused")))


@register("dml_view_update", area=DML, oracle="""
SELECT s_suppkey, CASE WHEN s_nationkey = 5 AND s_acctbal < 1000 THEN 1000.0 ELSE CAST(s_acctbal AS DOUBLE) END AS balance
FROM supplier""")
def dml_view_update(t):
    """UPDATE through a view reaches only the rows that the view shows."""
    target = t.supplier.select("s_suppkey", "s_nationkey", F.col("s_acctbal").cast("double").alias("balance"))
    return C.view_update(target, F.col("s_nationkey") == 5, {"balance": F.lit(1000.0)},
                         F.col("balance") < 1000).snapshot.select("s_suppkey", "balance")


MOVES = bm.with_bank("bank_accounts", "bank_transactions") + """,
  moves AS (SELECT from_account_id AS src, to_account_id AS dst, amount FROM bank_transactions
            WHERE status = 'completed' AND type = 'transfer'),
  deltas AS (SELECT src AS acct, -amount AS delta FROM moves UNION ALL SELECT dst, amount FROM moves),
  per_acct AS (SELECT acct, SUM(delta) AS d FROM deltas WHERE acct IS NOT NULL GROUP BY acct)"""


@register("txn_balance_move", area=DML, oracle=MOVES + """
SELECT a.account_id, CAST(a.balance + COALESCE(p.d, 0) AS DOUBLE) AS balance
FROM bank_accounts a LEFT JOIN per_acct p ON a.account_id = p.acct""")
def txn_balance_move(t):
    """A batch of paired debit/credit moves applied as one snapshot."""
    a = bm.accounts(t)
    tx = bm.transactions(t)
    moves = tx.where((F.col("status") == "completed") & (F.col("type") == "transfer"))
    out = C.apply_moves(a, "account_id", "balance", moves, "from_account_id", "to_account_id", "amount")
    return out.select("account_id", F.col("balance").cast("double"))


@register("txn_conditional_move", area=DML, oracle="WITH RECURSIVE" + bm.with_bank(
    "bank_accounts", "bank_transactions")[len("WITH"):] + """,
  queue AS (
    SELECT t.from_account_id AS src, t.to_account_id AS dst, t.amount * 1000 AS amount, a.balance,
           ROW_NUMBER() OVER (PARTITION BY t.from_account_id ORDER BY t.transaction_id) AS k
    FROM bank_transactions t JOIN bank_accounts a ON a.account_id = t.from_account_id
    WHERE t.status = 'completed' AND t.type = 'withdrawal'),
  walk AS (
    SELECT src, dst, k, amount, amount <= balance AS ok,
           CAST(balance - CASE WHEN amount <= balance THEN amount ELSE 0 END AS DECIMAL(38,2)) AS funds
    FROM queue WHERE k = 1
    UNION ALL
    SELECT q.src, q.dst, q.k, q.amount, q.amount <= w.funds,
           CAST(w.funds - CASE WHEN q.amount <= w.funds THEN q.amount ELSE 0 END AS DECIMAL(38,2))
    FROM walk w JOIN queue q ON q.src = w.src AND q.k = w.k + 1),
  change AS (SELECT acct, SUM(delta) AS d FROM (
      SELECT src AS acct, -amount AS delta FROM walk WHERE ok UNION ALL SELECT dst, amount FROM walk WHERE ok) m
    WHERE acct IS NOT NULL GROUP BY acct)
SELECT a.account_id, CAST(a.balance + COALESCE(c.d, 0) AS DOUBLE) AS balance
FROM bank_accounts a LEFT JOIN change c ON a.account_id = c.acct""")
def txn_conditional_move(t):
    """Moves served in order, each only if what is left on its source covers it (else skipped)."""
    a = bm.accounts(t)
    tx = bm.transactions(t)
    moves = (tx.where((F.col("status") == "completed") & (F.col("type") == "withdrawal"))
             .withColumn("amount", (F.col("amount") * 1000).cast("decimal(18,2)")))
    ok = C.eligible_moves(a, "account_id", "balance", moves, "from_account_id", "amount", "transaction_id")
    out = C.apply_moves(a, "account_id", "balance", ok, "from_account_id", "to_account_id", "amount")
    return out.select("account_id", F.col("balance").cast("double"))


@register("txn_versions", area=DML, oracle="""
SELECT p_partkey, CASE WHEN p_name LIKE '%ring%' THEN 1.50 ELSE p_retailprice END AS p_retailprice
FROM part""")
def txn_versions(t):
    """Savepoint s1 (price change), a later change rolled back, s1 published."""
    parts = t.part.select("p_partkey", "p_name", "p_size", "p_retailprice")
    v = C.Versions(parts)
    v.save("s1", C.update(parts, {"p_retailprice": F.lit(1.50)}, where=F.col("p_name").like("%ring%")).snapshot)
    v.save("s2", C.delete(v.current, F.col("p_size") > 40).snapshot)
    chosen = v.rollback_to("s1")
    catalog = sinks.Catalog.of(t.spark)
    catalog.publish("part_prices", chosen)
    return catalog.read("part_prices").select("p_partkey", "p_retailprice")


# ---------------------------------------------------------------- 2.10 validators

@register("dq_check_column", area=DQ, oracle="""
SELECT l_orderkey, l_linenumber, 'quantity_max' AS rule FROM lineitem WHERE NOT COALESCE(l_quantity <= 45, TRUE)""")
def dq_check_column(t):
    """V1: column CHECK (NULL passes)."""
    return V.check(t.lineitem, "quantity_max", F.col("l_quantity") <= 45).select("l_orderkey", "l_linenumber", "rule")


@register("dq_check_row", area=DQ, oracle="""
SELECT l_orderkey, l_linenumber, 'tax_not_above_discount' AS rule FROM lineitem
WHERE NOT COALESCE(l_tax <= l_discount, TRUE)""")
def dq_check_row(t):
    """V2: multi-column CHECK."""
    return V.check(t.lineitem, "tax_not_above_discount", F.col("l_tax") <= F.col("l_discount")) \
        .select("l_orderkey", "l_linenumber", "rule")


@register("dq_not_null", area=DQ, oracle=EMP + """
SELECT emp_id, 'not_null:dept_id' AS rule FROM emp WHERE dept_id IS NULL
UNION ALL
SELECT emp_id, 'not_null:manager_id' FROM emp WHERE manager_id IS NULL""")
def dq_not_null(t):
    """V3: NOT NULL on two columns."""
    return V.not_null(model.emp(t), ["dept_id", "manager_id"]).select("emp_id", "rule")


@register("dq_unique", area=DQ, oracle="""
SELECT p.p_partkey, 'unique:p_retailprice' AS rule FROM part p
WHERE p.p_retailprice IN (SELECT p_retailprice FROM part GROUP BY p_retailprice HAVING COUNT(*) > 1)""")
def dq_unique(t):
    """V4: UNIQUE on one column: every row of a duplicated value."""
    return V.unique(t.part, ["p_retailprice"]).select("p_partkey", "rule")


@register("dq_unique_composite", area=DQ, oracle="""
SELECT l_orderkey, l_partkey, l_linenumber, 'unique:l_orderkey,l_partkey' AS rule FROM lineitem l
WHERE (l_orderkey, l_partkey) IN (SELECT l_orderkey, l_partkey FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1)
  AND l_linenumber > (SELECT MIN(l2.l_linenumber) FROM lineitem l2
                      WHERE l2.l_orderkey = l.l_orderkey AND l2.l_partkey = l.l_partkey)""")
def dq_unique_composite(t):
    """V4: composite UNIQUE with first-arrival-wins (arrival = line number)."""
    return V.unique(t.lineitem, ["l_orderkey", "l_partkey"], arrival="l_linenumber") \
        .select("l_orderkey", "l_partkey", "l_linenumber", "rule")


@register("dq_primary_key", area=DQ, oracle="""
SELECT l_orderkey, l_linenumber, 'primary_key:l_orderkey,l_linenumber' AS rule, l_partkey FROM lineitem l
WHERE (l_orderkey, l_linenumber) IN (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1)
UNION ALL
SELECT l_orderkey, l_linenumber, 'not_null:' || c, l_partkey
FROM lineitem, (VALUES ('l_orderkey'), ('l_linenumber')) v(c)
WHERE (c = 'l_orderkey' AND l_orderkey IS NULL) OR (c = 'l_linenumber' AND l_linenumber IS NULL)""")
def dq_primary_key(t):
    """V5: PRIMARY KEY (orderkey, linenumber) = NOT NULL + UNIQUE."""
    return V.primary_key(t.lineitem, ["l_orderkey", "l_linenumber"]) \
        .select("l_orderkey", "l_linenumber", "rule", "l_partkey")


@register("dq_unique_where", area=DQ, oracle=bm.with_bank("bank_accounts") + """
SELECT account_id, customer_id, currency, 'unique_where:customer_id,currency' AS rule FROM bank_accounts a
WHERE is_active AND (customer_id, currency) IN (
  SELECT customer_id, currency FROM bank_accounts WHERE is_active GROUP BY 1, 2 HAVING COUNT(*) > 1)""")
def dq_unique_where(t):
    """V6: conditional UNIQUE: one active account per (customer, currency)."""
    a = bm.accounts(t)
    return V.unique_where(a, ["customer_id", "currency"], F.col("is_active")) \
        .select("account_id", "customer_id", "currency", "rule")


@register("dq_foreign_key", area=DQ, oracle=model.with_model("emp", "dept") + """
SELECT emp_id, dept_id, 'foreign_key:dept_id' AS rule FROM emp e
WHERE dept_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM dept d WHERE d.region <> 4 AND d.dept_id = e.dept_id)""")
def dq_foreign_key(t):
    """V7: FOREIGN KEY: a NULL reference passes, a dangling one fails."""
    parents = model.dept(t).where(F.col("region") != 4)
    return V.foreign_key(model.emp(t), ["dept_id"], parents, ["dept_id"]).select("emp_id", "dept_id", "rule")


@register("dq_enum", area=DQ, oracle=bm.with_bank("bank_accounts") + """
SELECT account_id, currency, 'domain:currency' AS rule FROM bank_accounts
WHERE NOT COALESCE(currency IN ('KZT', 'USD', 'EUR'), TRUE)""")
def dq_enum(t):
    """V8: domain CHECK (col IN (...))."""
    return V.in_domain(bm.accounts(t), "currency", ["KZT", "USD", "EUR"]).select("account_id", "currency", "rule")


@register("dq_pattern", area=DQ, oracle="""
SELECT event_id, 'pattern:props' AS rule FROM events WHERE NOT COALESCE(regexp_matches(props, '^[{]"k": [0-9][}]$'), TRUE)""")
def dq_pattern(t):
    """V9: pattern CHECK (col ~ regex)."""
    return V.matches(t.events, "props", '^[{]"k": [0-9][}]$').select("event_id", "rule")


@register("dq_delete_restrict", area=DQ, oracle="""
SELECT p_partkey, CASE WHEN EXISTS (SELECT 1 FROM lineitem l WHERE l.l_partkey = p.p_partkey)
                       THEN 'refused' ELSE 'deleted' END AS decision
FROM part p WHERE p_size > 45""")
def dq_delete_restrict(t):
    """ON DELETE RESTRICT: requested parents with children are refused."""
    requested = t.part.where(F.col("p_size") > 45).select("p_partkey")
    return V.delete_restrict(requested, "p_partkey", {"lineitem": (t.lineitem, "l_partkey")})


@register("dq_delete_cascade", area=DQ, oracle="""
SELECT l_orderkey, l_linenumber FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P' AND o_totalprice > 400000)""")
def dq_delete_cascade(t):
    """ON DELETE CASCADE: children of deleted parents go with them."""
    doomed = (F.col("o_orderstatus") == "P") & (F.col("o_totalprice") > 400000)
    out = V.delete_cascade(t.orders, "o_orderkey", doomed, {"lineitem": (t.lineitem, "l_orderkey")})
    return out["lineitem"].select("l_orderkey", "l_linenumber")


@register("dq_delete_graph", area=DQ, oracle="""
WITH asked AS (SELECT c_custkey FROM customer WHERE c_acctbal < 0),
hung AS (
  SELECT a.c_custkey, o.o_orderkey, l.l_linenumber, l.l_returnflag = 'R' AND l.l_quantity > 48 AS holds
  FROM asked a LEFT JOIN orders o ON o.o_custkey = a.c_custkey LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey),
told AS (SELECT c_custkey, bool_or(coalesce(holds, false)) AS refused FROM hung GROUP BY c_custkey)
SELECT c.c_custkey, CASE WHEN t.c_custkey IS NULL THEN 'untouched' WHEN t.refused THEN 'refused' ELSE 'deleted' END AS decision,
       CASE WHEN coalesce(t.refused, true) THEN (SELECT count(*) FROM orders o WHERE o.o_custkey = c.c_custkey) ELSE 0 END AS orders_left,
       CASE WHEN coalesce(t.refused, true) THEN (SELECT count(*) FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey
                                                 WHERE o.o_custkey = c.c_custkey) ELSE 0 END AS lines_left
FROM customer c LEFT JOIN told t ON t.c_custkey = c.c_custkey""")
def dq_delete_graph(t):
    """V10 and V11 over three tables: customers go with their orders and lines, unless a large returned line holds one of the orders."""
    lines = t.lineitem.withColumn("line_id", F.concat_ws("-", "l_orderkey", "l_linenumber")).select("line_id", "l_orderkey", "l_returnflag", "l_quantity")
    held = lines.where((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 48))
    orders = t.orders.select("o_orderkey", "o_custkey")
    tables = {"customer": (t.customer, "c_custkey"), "orders": (orders, "o_orderkey"), "lines": (lines, "line_id"), "held": (held, "line_id")}
    decisions, left = V.delete_graph(tables, [
        V.Reference("orders", "o_custkey", "customer"), V.Reference("lines", "l_orderkey", "orders"),
        V.Reference("held", "l_orderkey", "orders", restrict=True),
    ], "customer", t.customer.where(F.col("c_acctbal") < 0).select("c_custkey"))
    kept = left["orders"].groupBy(F.col("o_custkey").alias("__oc")).agg(F.count("*").alias("orders_left"))
    rest = (left["lines"].join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .groupBy(F.col("o_custkey").alias("__lc")).agg(F.count("*").alias("lines_left")))
    out = (t.customer.select("c_custkey").join(decisions, F.col("c_custkey").cast("string") == F.col("request"), "left")
           .join(kept, F.col("c_custkey") == F.col("__oc"), "left").join(rest, F.col("c_custkey") == F.col("__lc"), "left"))
    return out.select("c_custkey", F.coalesce("decision", F.lit("untouched")).alias("decision"),
                      *[F.coalesce(c, F.lit(0)).alias(c) for c in ("orders_left", "lines_left")])


@register("dq_enforce_ordered", area=DQ, oracle="""
WITH RECURSIVE batch AS (
  SELECT event_id, user_id % 50 AS who, CAST(ts AS DATE) AS day, event_type, value,
         value <= 150 AS fits, EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = e.user_id % 50 AND c.c_custkey <> 7) AS known
  FROM events e),
fine AS (SELECT *, row_number() OVER (ORDER BY event_id) AS k FROM batch WHERE fits AND known),
-- one row at a time: who has a day, which (kind, tenth of the value) is taken
walk AS (
  SELECT CAST(0 AS BIGINT) AS k, CAST(NULL AS BIGINT) AS event_id, CAST('' AS VARCHAR) AS reasons, MAP {'': true} AS days, MAP {'': true} AS kinds
  UNION ALL
  SELECT k, event_id, reasons, CASE WHEN reasons = '' THEN map_concat(days, MAP {d: true}) ELSE days END,
         CASE WHEN reasons = '' THEN map_concat(kinds, MAP {v: true}) ELSE kinds END
  FROM (
    SELECT k, event_id, days, kinds, d, v,
           concat_ws(',', CASE WHEN days[d] THEN 'unique:who,day' END, CASE WHEN kinds[v] THEN 'unique:event_type,tenth' END) AS reasons
    FROM (SELECT f.k, f.event_id, w.days, w.kinds, f.who || ' ' || f.day AS d, f.event_type || ' ' || floor(f.value * 10)::BIGINT AS v
          FROM walk w JOIN fine f ON f.k = w.k + 1)))
SELECT b.event_id, coalesce(w.reasons, concat_ws(',', CASE WHEN NOT b.fits THEN 'value_max' END,
                                                CASE WHEN NOT b.known THEN 'foreign_key:who' END)) AS reasons
FROM batch b LEFT JOIN walk w ON w.event_id = b.event_id""")
def dq_enforce_ordered(t):
    """V13 in arrival order over two unique keys: a rejected row occupies no key, the first valid one keeps it."""
    batch = t.events.select("event_id", (F.col("user_id") % 50).alias("who"), F.to_date("ts").alias("day"), "event_type", "value",
                            F.floor(F.col("value") * 10).alias("tenth"))
    parents = t.customer.where(F.col("c_custkey") != 7)
    out = V.enforce_in_order(batch, "event_id", {"value_max": F.col("value") <= 150}, [["who", "day"], ["event_type", "tenth"]],
                             [(["who"], parents, ["c_custkey"])])
    return out.select("event_id", "reasons")


@register("dq_view_check", area=DQ, oracle=EMP + """
SELECT emp_id, 'view_check' AS rule FROM emp WHERE NOT COALESCE(dept_id = 5, FALSE)""")
def dq_view_check(t):
    """WITH CHECK OPTION: rows written through the dept-5 view must stay visible."""
    return V.view_check(model.emp(t), F.col("dept_id") == 5).select("emp_id", "rule")


@register("dq_enforce", area=DQ, oracle="""
WITH batch AS (SELECT l_orderkey // 4 AS order_group, NULLIF(l_linenumber, 3) AS line, NULLIF(l_partkey, 7) AS part_id,
                      l_quantity, l_tax, l_discount FROM lineitem)
SELECT b.order_group, b.line, b.part_id,
       concat_ws(',',
         CASE WHEN b.l_quantity > 45 THEN 'quantity_max' END,
         CASE WHEN b.l_tax > b.l_discount THEN 'tax_not_above_discount' END,
         CASE WHEN b.part_id IS NOT NULL
                   AND NOT EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = b.part_id AND p.p_size <= 45)
              THEN 'foreign_key:part_id' END,
         CASE WHEN b.order_group IS NOT NULL AND b.line IS NOT NULL
                   AND COUNT(*) OVER (PARTITION BY b.order_group, b.line) > 1
              THEN 'unique:order_group,line' END) AS reasons
FROM batch b""")
def dq_enforce(t):
    """One pass splitting a batch (with NULL and repeated keys) into accepted / rejected with all reasons."""
    batch = t.lineitem.select(
        F.floor(F.col("l_orderkey") / 4).alias("order_group"),
        F.when(F.col("l_linenumber") != 3, F.col("l_linenumber")).alias("line"),
        F.when(F.col("l_partkey") != 7, F.col("l_partkey")).alias("part_id"), "l_quantity", "l_tax", "l_discount")
    out = V.enforce(
        batch,
        {"quantity_max": F.col("l_quantity") <= 45, "tax_not_above_discount": F.col("l_tax") <= F.col("l_discount")},
        unique_keys=[["order_group", "line"]],
        references=[(["part_id"], t.part.where(F.col("p_size") <= 45), ["p_partkey"])])
    return out.select("order_group", "line", "part_id", "reasons")
