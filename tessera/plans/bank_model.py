"""The banking schema derived from the driver tables.

The banking jobs take five relations (customers, accounts, exchange rates,
transactions, audit rows). Over the driver tables they are derived as:

* customers    <- ``customer``: id, 12-digit IIN from the key, name, status
  ``blocked`` for a negative balance, daily limit 1,000,000 for the BUILDING
  segment and 500,000 otherwise.
* accounts     <- ``orders``: one account per order, owned by the order's
  customer; currency from the order priority; balance = total price;
  inactive while the order is pending (``P``).
* exchange_rates <- a literal table (fixed reference values plus one closed
  historical row, so the ``valid_to IS NULL`` rule matters).
* transactions <- ``events``: id, sender account = ``user_id``, receiver =
  ``props.k``, amount in KZT = value, type from the event type, failed for
  ``error`` events and completed otherwise.

Each relation exists twice: as a Spark DataFrame and as SQL text for the
DuckDB oracle. Both are written by hand from the rules above.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.sources import literals
from tessera.sources.tables import Tables

# The open exchange rates of the reference seed data
# (from, to, rate): USD->KZT 460.00, EUR->KZT 500.00, RUB->KZT 5.00, KZT->USD 0.00217.
# The last row is our own closed historical rate.
RATE_ROWS = [
    (1, "USD", "KZT", Decimal("460.000000"), None),
    (2, "EUR", "KZT", Decimal("500.000000"), None),
    (3, "RUB", "KZT", Decimal("5.000000"), None),
    (4, "KZT", "USD", Decimal("0.002170"), None),
    (5, "USD", "KZT", Decimal("450.000000"), dt.datetime(2023, 12, 31, 0, 0)),
]

RATE_SCHEMA = T.StructType([
    T.StructField("rate_id", T.IntegerType(), False),
    T.StructField("from_currency", T.StringType(), False),
    T.StructField("to_currency", T.StringType(), False),
    T.StructField("rate", T.DecimalType(10, 6), False),
    T.StructField("valid_to", T.TimestampNTZType(), True),
])

# Reporting date for "today" in the jobs (the events span 2024-01-01..30).
AS_OF_DATE = "2024-01-15"


def customers(t: Tables) -> DataFrame:
    c = t.customer
    return c.select(
        F.col("c_custkey").alias("customer_id"),
        F.lpad(F.col("c_custkey").cast("string"), 12, "0").alias("iin"),
        F.col("c_name").alias("full_name"),
        F.when(F.col("c_acctbal") < 0, "blocked").otherwise("active").alias("status"),
        F.when(F.col("c_mktsegment") == "BUILDING", 1000000).otherwise(500000)
        .cast("decimal(18,2)").alias("daily_limit_kzt"),
    )


def accounts(t: Tables) -> DataFrame:
    o = t.orders
    return o.select(
        F.col("o_orderkey").alias("account_id"),
        F.col("o_custkey").alias("customer_id"),
        F.concat(F.lit("KZ"), F.lpad(F.col("o_orderkey").cast("string"), 18, "0")).alias("account_number"),
        F.when(F.col("o_orderpriority") == "2-HIGH", "USD")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "EUR")
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "RUB")
        .otherwise("KZT").alias("currency"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("balance"),
        (F.col("o_orderstatus") != "P").alias("is_active"),
    )


def exchange_rates(spark: SparkSession) -> DataFrame:
    return literals.values(spark, RATE_ROWS, RATE_SCHEMA)


def transactions(t: Tables) -> DataFrame:
    e = t.events
    amount = F.col("value").cast("decimal(18,2)")
    return e.select(
        F.col("event_id").alias("transaction_id"),
        F.col("user_id").alias("from_account_id"),
        F.get_json_object("props", "$.k").cast("bigint").alias("to_account_id"),
        amount.alias("amount"),
        F.lit("KZT").alias("currency"),
        amount.alias("amount_kzt"),
        F.when(F.col("event_type") == "purchase", "withdrawal")
        .when(F.col("event_type") == "signup", "deposit")
        .otherwise("transfer").alias("type"),
        F.when(F.col("event_type") == "error", "failed").otherwise("completed").alias("status"),
        F.col("ts").alias("created_at"),
    )


def _account_no(col):
    return F.concat(F.lit("KZ"), F.lpad(col.cast("string"), 18, "0"))


def transfer_requests(t: Tables) -> DataFrame:
    """Transfer requests <- events: sender = the user's
    account, receiver = the account numbered ``props.k`` (an unknown number for
    error events), amount = value x 2000, USD for clicks and KZT otherwise."""
    e = t.events
    to_no = _account_no(F.get_json_object("props", "$.k"))
    return e.select(
        F.col("event_id").alias("request_id"),
        _account_no(F.col("user_id")).alias("from_account_number"),
        F.when(F.col("event_type") == "error", F.concat(to_no, F.lit("X"))).otherwise(to_no).alias("to_account_number"),
        (F.col("value").cast("decimal(18,2)") * 2000).cast("decimal(18,2)").alias("amount"),
        F.when(F.col("event_type") == "click", "USD").otherwise("KZT").alias("currency"),
        F.col("ts").alias("requested_at"),
    )


def salary_payments(t: Tables) -> DataFrame:
    """Salary payments <- lineitem: one batch per order (paid from the order's
    account), one payment per line to the customer whose IIN is the part key;
    amount = quantity x 1000, or 0 for undiscounted lines; no description for
    returned lines."""
    li = t.lineitem
    return li.select(
        F.col("l_orderkey").alias("batch_id"),
        _account_no(F.col("l_orderkey")).alias("company_account_number"),
        F.col("l_linenumber").alias("pos"),
        F.lpad(F.col("l_partkey").cast("string"), 12, "0").alias("iin"),
        F.when(F.col("l_discount") == 0, F.lit(0)).otherwise(F.col("l_quantity") * 1000)
        .cast("decimal(18,2)").alias("amount"),
        F.when(F.col("l_returnflag") == "R", F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("Salary line "), F.col("l_linenumber").cast("string"))).alias("description"),
    )


def salary_payloads(t: Tables) -> DataFrame:
    """Salary batches as JSON documents, one per order (built from the order's
    own columns): a salary of floor(total / 100) to the ordering customer, and
    a zero payment (no description) to the IIN equal to the order key. Some
    orders carry an empty list, no document, a broken one or an amount that is
    no number."""
    o = t.orders
    iin = lambda c: F.lpad(F.col(c).cast("string"), 12, "0")
    amount = F.floor(F.col("o_totalprice") / 100).cast("decimal(18,2)").cast("string")
    payload = F.concat(
        F.lit('[{"iin": "'), iin("o_custkey"), F.lit('", "amount": '), amount,
        F.lit(', "description": "Salary '), F.col("o_orderkey").cast("string"), F.lit('"}, '),
        F.lit('{"iin": "'), iin("o_orderkey"), F.lit('", "amount": 0, "description": null}]'))
    kind = F.col("o_orderkey") % 16
    payload = (F.when(kind == 0, "[]").when(kind == 1, F.lit(None)).when(kind == 2, '[{"iin": ')
               .when(kind == 3, '[{"iin": "1", "amount": "12x", "description": "d"}]').otherwise(payload))
    return o.select(F.col("o_orderkey").alias("batch_id"),
                    _account_no(F.col("o_orderkey")).alias("company_account_number"),
                    payload.alias("payments"))


def shared_salary_payments(t: Tables) -> DataFrame:
    """Salary payments where up to four batches draw on one company account:
    that of the order whose key is the batch's rounded down to a multiple of 4."""
    return salary_payments(t).withColumn(
        "company_account_number", _account_no(F.col("batch_id") - F.col("batch_id") % 4))


SALARY_PAID_AT = "2024-01-31 12:00:00"

SQL = {
    "bank_customers": """
  bank_customers AS (
    SELECT c_custkey AS customer_id,
           lpad(CAST(c_custkey AS VARCHAR), 12, '0') AS iin,
           c_name AS full_name,
           CASE WHEN c_acctbal < 0 THEN 'blocked' ELSE 'active' END AS status,
           CAST(CASE WHEN c_mktsegment = 'BUILDING' THEN 1000000 ELSE 500000 END AS DECIMAL(18,2))
             AS daily_limit_kzt
    FROM customer)""",
    "bank_accounts": """
  bank_accounts AS (
    SELECT o_orderkey AS account_id,
           o_custkey AS customer_id,
           'KZ' || lpad(CAST(o_orderkey AS VARCHAR), 18, '0') AS account_number,
           CASE o_orderpriority WHEN '2-HIGH' THEN 'USD' WHEN '3-MEDIUM' THEN 'EUR'
                WHEN '4-NOT SPECIFIED' THEN 'RUB' ELSE 'KZT' END AS currency,
           CAST(o_totalprice AS DECIMAL(18,2)) AS balance,
           o_orderstatus <> 'P' AS is_active
    FROM orders)""",
    "exchange_rates": """
  exchange_rates AS (
    SELECT * FROM (VALUES
      (1, 'USD', 'KZT', CAST(460 AS DECIMAL(10,6)), CAST(NULL AS TIMESTAMP)),
      (2, 'EUR', 'KZT', CAST(500 AS DECIMAL(10,6)), CAST(NULL AS TIMESTAMP)),
      (3, 'RUB', 'KZT', CAST(5 AS DECIMAL(10,6)), CAST(NULL AS TIMESTAMP)),
      (4, 'KZT', 'USD', CAST(0.00217 AS DECIMAL(10,6)), CAST(NULL AS TIMESTAMP)),
      (5, 'USD', 'KZT', CAST(450 AS DECIMAL(10,6)), TIMESTAMP '2023-12-31 00:00:00')
    ) AS r(rate_id, from_currency, to_currency, rate, valid_to))""",
    "bank_transactions": """
  bank_transactions AS (
    SELECT event_id AS transaction_id,
           user_id AS from_account_id,
           CAST(json_extract_string(props, '$.k') AS BIGINT) AS to_account_id,
           CAST(value AS DECIMAL(18,2)) AS amount,
           'KZT' AS currency,
           CAST(value AS DECIMAL(18,2)) AS amount_kzt,
           CASE event_type WHEN 'purchase' THEN 'withdrawal' WHEN 'signup' THEN 'deposit'
                ELSE 'transfer' END AS type,
           CASE WHEN event_type = 'error' THEN 'failed' ELSE 'completed' END AS status,
           ts AS created_at
    FROM events)""",
    "transfer_requests": """
  transfer_requests AS (
    SELECT event_id AS request_id,
           'KZ' || lpad(CAST(user_id AS VARCHAR), 18, '0') AS from_account_number,
           'KZ' || lpad(json_extract_string(props, '$.k'), 18, '0')
             || CASE WHEN event_type = 'error' THEN 'X' ELSE '' END AS to_account_number,
           CAST(CAST(value AS DECIMAL(18,2)) * 2000 AS DECIMAL(18,2)) AS amount,
           CASE WHEN event_type = 'click' THEN 'USD' ELSE 'KZT' END AS currency,
           ts AS requested_at
    FROM events)""",
    "salary_payments": """
  salary_payments AS (
    SELECT l_orderkey AS batch_id,
           'KZ' || lpad(CAST(l_orderkey AS VARCHAR), 18, '0') AS company_account_number,
           l_linenumber AS pos,
           lpad(CAST(l_partkey AS VARCHAR), 12, '0') AS iin,
           CAST(CASE WHEN l_discount = 0 THEN 0 ELSE l_quantity * 1000 END AS DECIMAL(18,2)) AS amount,
           CASE WHEN l_returnflag = 'R' THEN NULL ELSE 'Salary line ' || CAST(l_linenumber AS VARCHAR) END
             AS description
    FROM lineitem)""",
    "salary_payloads": """
  salary_payloads AS (
    SELECT o_orderkey AS batch_id,
           'KZ' || lpad(CAST(o_orderkey AS VARCHAR), 18, '0') AS company_account_number,
           '[{"iin": "' || lpad(CAST(o_custkey AS VARCHAR), 12, '0') || '", "amount": '
             || CAST(CAST(floor(o_totalprice / 100) AS DECIMAL(18,2)) AS VARCHAR)
             || ', "description": "Salary ' || CAST(o_orderkey AS VARCHAR) || '"}, '
             || '{"iin": "' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0')
             || '", "amount": 0, "description": null}]' AS payments
    FROM orders WHERE o_orderkey % 16 > 3),
  salary_documents AS (
    SELECT o_orderkey AS batch_id,
           'KZ' || lpad(CAST(o_orderkey AS VARCHAR), 18, '0') AS company_account_number,
           CASE WHEN o_orderkey % 16 = 0 THEN 'empty' WHEN o_orderkey % 16 <= 3 THEN 'malformed' ELSE 'ok' END AS document
    FROM orders),
  salary_payments AS (
    SELECT batch_id, company_account_number, CAST(i + 1 AS INTEGER) AS pos,
           json_extract_string(payments, '$[' || CAST(i AS VARCHAR) || '].iin') AS iin,
           CAST(json_extract_string(payments, '$[' || CAST(i AS VARCHAR) || '].amount') AS DECIMAL(18,2)) AS amount,
           json_extract_string(payments, '$[' || CAST(i AS VARCHAR) || '].description') AS description
    FROM salary_payloads, range(CAST(json_array_length(payments) AS BIGINT)) r(i))""",
}


def with_bank(*names: str) -> str:
    """``WITH`` clause defining the named bank relations (append more CTEs with ', ...')."""
    return "WITH " + ",".join(SQL[n] for n in names)
