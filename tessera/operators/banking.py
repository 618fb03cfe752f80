"""Banking jobs over (customers, accounts, exchange rates, transactions).

Every job is a function of DataFrames returning a DataFrame; nothing is
collected to the driver and no per-row loop exists. Money is decimal(18,2)
throughout and only the reported columns are turned into doubles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import materialize
from tessera.operators.settlement import BALANCE, LIMIT, accept_in_order, settle_requests
from tessera.operators.windows import (
    MICROS_PER_HOUR, MICROS_PER_MINUTE, band_count, global_rank, prefix_sum, prefix_sums, previous_max,
)


def on_day(ts_col: str, day: str) -> Column:
    """``CAST(ts AS DATE) = day`` as a half-open range on the raw timestamp, so
    the predicate reaches the Parquet scan (row-group and file skipping)."""
    start = F.lit(day).cast("date")
    ts = F.col(ts_col)
    return (ts >= start.cast("timestamp_ntz")) & (ts < F.date_add(start, 1).cast("timestamp_ntz"))


def active_rates(rates: DataFrame, to_currency: str | None = None) -> DataFrame:
    """Open rates (``valid_to IS NULL``), one row per currency pair."""
    open_rates = rates.where(F.col("valid_to").isNull())
    if to_currency is not None:
        open_rates = open_rates.where(F.col("to_currency") == to_currency)
    return open_rates.select("from_currency", "to_currency", "rate")


def with_kzt_rate(df: DataFrame, rates: DataFrame, currency_col: str, out: str,
                  to_currency: str = "KZT") -> DataFrame:
    """Attach the open rate from ``currency_col`` to ``to_currency`` (1 when none).

    The open rates hold one row per currency pair, so Spark broadcasts them by
    their size; the lookup is a left join that never drops or
    duplicates rows as long as the open rows are unique per pair (see
    ``quality.unique_where``).
    """
    open_rates = (active_rates(rates, to_currency)
                             .select(F.col("from_currency").alias("__from"), F.col("rate").alias("__rate")))
    joined = df.join(open_rates, F.col(currency_col) == F.col("__from"), "left")
    return joined.withColumn(out, F.coalesce(F.col("__rate"), F.lit(1).cast("decimal(10,6)"))) \
        .drop("__from", "__rate")


def daily_transaction_report(transactions: DataFrame) -> DataFrame:
    """Per (date, type): count, volume, average, running total, previous volume, growth.

    Completed rows with a KZT amount only. The running total is ordered by
    (date, type) over the whole report; it is computed as a range-partitioned
    prefix sum over the (small) daily aggregate, never as a one-task window.
    The previous volume is the previous *row* of the same type (LAG, default 0).
    """
    # Days x types rows, read by both halves of the running total: written
    # once, so the transaction history is scanned once.
    daily = materialize(
        transactions
        .where((F.col("status") == "completed") & F.col("amount_kzt").isNotNull())
        .groupBy(F.to_date("created_at").alias("transaction_date"), F.col("type"))
        .agg(F.count(F.lit(1)).alias("transaction_count"),
             F.sum("amount_kzt").alias("total_volume")), "daily_report")
    # (date, type) is unique after the aggregation: running sums on the rows.
    with_running = prefix_sum(daily, ["transaction_date", "type"], "total_volume", "running_total",
                              rows_unique=True)
    prev = F.lag("total_volume", 1, 0).over(Window.partitionBy("type").orderBy("transaction_date"))
    return (
        with_running.withColumn("previous_volume", prev)
        .select(
            "transaction_date", "type", "transaction_count",
            F.col("total_volume").cast("double").alias("total_volume_kzt"),
            (F.col("total_volume").cast("double") / F.col("transaction_count")).alias("average_amount_kzt"),
            F.col("running_total").cast("double").alias("running_total_kzt"),
            F.col("previous_volume").cast("double").alias("previous_day_volume"),
            ((F.col("total_volume") - F.col("previous_volume")).cast("double")
             / F.nullif(F.col("previous_volume"), F.lit(0)).cast("double") * 100)
            .alias("day_over_day_growth_percent"),
        )
    )


def balance_summary(customers: DataFrame, accounts: DataFrame, rates: DataFrame,
                    transactions: DataFrame, as_of: str) -> DataFrame:
    """Per account: balance in KZT, the customer's total, today's spend,
    limit utilisation and the rank of the customer's total.

    Customers without accounts are excluded (inner join), and so are accounts
    without a customer. The per-customer total is a grouped sum joined back
    (a hot customer stays one aggregate row); the rank is over all rows,
    computed on the per-customer table as a weighted prefix count over
    distinct totals instead of a single-partition window.
    """
    acc = (with_kzt_rate(accounts.select("account_id", "customer_id", "account_number", "currency", "balance"),
                         rates, "currency", "rate_to_kzt")
           .withColumn("balance_kzt", F.col("balance") * F.col("rate_to_kzt")).drop("rate_to_kzt"))
    # Today's completed spend per customer, through the sending account.
    spent = (transactions
             .where((F.col("status") == "completed") & on_day("created_at", as_of))
             .join(accounts.select(F.col("account_id").alias("__acct"), F.col("customer_id").alias("__cust")),
                   F.col("from_account_id") == F.col("__acct"))
             .groupBy("__cust").agg(F.sum("amount_kzt").alias("__spent")))
    # One row per existing customer: total over its accounts, number of
    # account rows, name, limit and spend. The rank of an account row is
    # 1 + the number of rows of customers with a larger total, so it is
    # computed on this table (weighted by row count) and joined back once;
    # nothing account-sized is written or gathered.
    # Customer-sized and read twice by the rank (counts, then join back):
    # written once instead of re-aggregating the accounts.
    per_customer = materialize(
        acc.groupBy("customer_id").agg(F.sum("balance_kzt").alias("total_kzt"), F.count(F.lit(1)).alias("__rows"))
        .join(customers.select("customer_id", "full_name", "daily_limit_kzt"), "customer_id")
        .join(spent, F.col("customer_id") == F.col("__cust"), "left")
        .withColumn("total_spent_today", F.coalesce(F.col("__spent"), F.lit(0).cast("decimal(18,2)")))
        .drop("__cust", "__spent"), "balance_per_customer")
    ranked_customers = global_rank(per_customer, "total_kzt", "total_balance_rank", descending=True,
                                   weight="__rows").drop("__rows")
    ranked = acc.join(ranked_customers, "customer_id")
    return ranked.select(
        "full_name", "account_number", "currency",
        F.col("balance").cast("double").alias("balance"),
        F.col("balance_kzt").cast("double").alias("balance_kzt"),
        F.col("total_kzt").cast("double").alias("total_balance_kzt"),
        F.col("total_spent_today").cast("double").alias("total_spent_today"),
        (F.col("total_spent_today").cast("double") / F.col("daily_limit_kzt").cast("double") * 100)
        .alias("limit_utilization_percent"),
        F.col("total_balance_rank"),
    )


SUSPICIOUS_COLUMNS = ["transaction_id", "flag_reason", "created_at", "from_account_id", "to_account_id"]


def suspicious_activity(transactions: DataFrame, accounts: DataFrame, high_value_kzt: float,
                        max_per_window: int, window_us: int = MICROS_PER_HOUR,
                        rapid_gap_us: int = MICROS_PER_MINUTE) -> DataFrame:
    """High value UNION ALL high frequency UNION ALL rapid sequence.

    * high value: completed transfers strictly above ``high_value_kzt``;
    * high frequency: completed rows whose customer has more than
      ``max_per_window`` completed rows within +-window (self included) -- a
      bucketed RANGE count per customer;
    * rapid sequence: completed rows with an earlier id on the same account (of
      any status) whose time is later than t - gap -- a running max of time
      over earlier ids, per account and id block.
    A row may be flagged for several reasons.
    """
    def flagged(df: DataFrame, reason: str) -> DataFrame:
        return df.select("transaction_id", F.lit(reason).alias("flag_reason"), "created_at",
                         "from_account_id", "to_account_id")

    completed = F.col("status") == "completed"
    high_value = transactions.where((F.col("amount_kzt") > high_value_kzt) & completed
                                    & (F.col("type") == "transfer"))

    owners = accounts.select(F.col("account_id").alias("__acct"), F.col("customer_id").alias("__cust"))
    owned = (transactions.where(completed)
             .join(owners, F.col("from_account_id") == F.col("__acct")).drop("__acct"))
    counted = band_count(owned, "__cust", "created_at", window_us, window_us, "__n")
    high_freq = counted.where(F.col("__n") > max_per_window)

    base = transactions.select(*SUSPICIOUS_COLUMNS[:1], *SUSPICIOUS_COLUMNS[2:], "status")
    prev = previous_max(base, "from_account_id", "transaction_id", "created_at", "__prev_max")
    gap = F.expr(f"INTERVAL {rapid_gap_us} MICROSECONDS")
    rapid = prev.where(completed & (F.col("__prev_max") > F.col("created_at") - gap))

    return (flagged(high_value, "High_Value_Transfer")
            .unionByName(flagged(high_freq, "High_Frequency_Hourly"))
            .unionByName(flagged(rapid, "Rapid_Sequential_Transfer")))


# Transfer error codes and messages of the reference procedure
# (the amount message is ours; the reference fails there on a table CHECK).
ERR_AMOUNT = ("23514", "Amount must be positive.")
ERR_SOURCE = ("A0001", "Source account not found or inactive.")
ERR_DEST = ("A0002", "Destination account not found or inactive.")
ERR_SENDER = ("C0001", "Sender customer is not active (blocked or frozen).")
ERR_CURRENCY = ("V0001", "Transfer currency must match sender account currency.")
ERR_RATE = ("V0002", "Exchange rate not found for ")
ERR_RATE_KZT = ("V0003", "Exchange rate to KZT not found for daily limit check.")
ERR_LIMIT = ("L0001", "Daily transaction limit exceeded for customer.")
ERR_BALANCE = ("B0001", "Insufficient balance in source account.")

def validate_transfers(requests: DataFrame, customers: DataFrame, accounts: DataFrame,
                       rates: DataFrame) -> DataFrame:
    """J4 rules 0-5 (stateless), first failure wins.

    ``requests``: request_id, from_account_number, to_account_number, amount,
    currency, requested_at. Adds: source / destination account ids, sender
    customer, ``credit_rate`` (source -> destination, 1 for equal currencies),
    ``amount_kzt`` (rounded to cents), ``error_code`` and ``message`` (NULL
    when the request passes rules 0-5). Lookups are equi joins; the rate
    table is small and left to Spark's own size check.
    """
    src = accounts.where(F.col("is_active")).select(
        F.col("account_number").alias("__src_no"), F.col("account_id").alias("src_account_id"),
        F.col("customer_id").alias("sender_id"), F.col("currency").alias("src_currency"),
        F.col("balance").alias("src_balance"))
    dst = accounts.where(F.col("is_active")).select(
        F.col("account_number").alias("__dst_no"), F.col("account_id").alias("dst_account_id"),
        F.col("currency").alias("dst_currency"))
    cust = customers.select(F.col("customer_id").alias("__cid"), F.col("status").alias("sender_status"),
                            F.col("daily_limit_kzt"))
    open_rates = active_rates(rates)
    pair = (open_rates.select(F.col("from_currency").alias("__pf"), F.col("to_currency").alias("__pt"),
                                         F.col("rate").alias("pair_rate")))
    to_kzt = (open_rates.where(F.col("to_currency") == "KZT").select(
        F.col("from_currency").alias("__kf"), F.col("rate").alias("kzt_rate")))

    j = (requests
         .join(src, F.col("from_account_number") == F.col("__src_no"), "left")
         .join(dst, F.col("to_account_number") == F.col("__dst_no"), "left")
         .join(cust, F.col("sender_id") == F.col("__cid"), "left")
         .join(pair, (F.col("src_currency") == F.col("__pf")) & (F.col("dst_currency") == F.col("__pt")), "left")
         .join(to_kzt, F.col("src_currency") == F.col("__kf"), "left"))

    amount = F.col("amount")
    differs = F.col("src_currency") != F.col("dst_currency")
    code = (F.when(amount.isNull() | (amount <= 0), F.lit(ERR_AMOUNT[0]))
            .when(F.col("src_account_id").isNull(), F.lit(ERR_SOURCE[0]))
            .when(F.col("dst_account_id").isNull(), F.lit(ERR_DEST[0]))
            .when(F.coalesce(F.col("sender_status") != "active", F.lit(True)), F.lit(ERR_SENDER[0]))
            .when(F.col("currency") != F.col("src_currency"), F.lit(ERR_CURRENCY[0]))
            .when(differs & F.col("pair_rate").isNull(), F.lit(ERR_RATE[0]))
            .when((F.col("src_currency") != "KZT") & F.col("kzt_rate").isNull(), F.lit(ERR_RATE_KZT[0])))
    message = (F.when(code == ERR_AMOUNT[0], F.lit(ERR_AMOUNT[1]))
               .when(code == ERR_SOURCE[0], F.lit(ERR_SOURCE[1]))
               .when(code == ERR_DEST[0], F.lit(ERR_DEST[1]))
               .when(code == ERR_SENDER[0], F.lit(ERR_SENDER[1]))
               .when(code == ERR_CURRENCY[0], F.lit(ERR_CURRENCY[1]))
               .when(code == ERR_RATE[0], F.concat(F.lit(ERR_RATE[1]), F.col("src_currency"), F.lit(" to "),
                                                   F.col("dst_currency")))
               .when(code == ERR_RATE_KZT[0], F.lit(ERR_RATE_KZT[1])))
    amount_kzt = F.when(F.col("src_currency") == "KZT", amount).otherwise(
        F.round(amount * F.col("kzt_rate"), 2)).cast("decimal(18,2)")
    credit_rate = F.when(differs, F.col("pair_rate")).otherwise(F.lit(1).cast("decimal(10,6)"))
    return (j.withColumn("error_code", code).withColumn("message", message)
            .withColumn("amount_kzt", amount_kzt).withColumn("credit_rate", credit_rate)
            .drop("__src_no", "__dst_no", "__cid", "__pf", "__pt", "__kf", "pair_rate", "kzt_rate"))


def settle_transfers(validated: DataFrame, transactions: DataFrame, accounts: DataFrame, live: bool = False) -> DataFrame:
    """J4 rules 6-7 over the requests that passed rules 0-5, then the outcome.

    Rule 6: completed spend of the sender today (existing transactions plus
    earlier accepted requests of the same day) + amount_kzt <= daily limit.
    Rule 7: source balance (minus earlier accepted debits) >= amount.
    Requests are processed in (requested_at, request_id) order. With ``live``
    each one is posted before the next is looked at, so money received within
    the batch is spendable; else credits are posted at batch end.

    Both rules are settled in rounds over all senders (``settlement``): no row
    loop, no Python, and a busy sender is spread over tasks.
    """
    owners = accounts.select(F.col("account_id").alias("__a"), F.col("customer_id").alias("__c"))
    validated = materialize(
        validated.withColumn("day", F.to_date("requested_at"))
        .withColumn("credited", F.round(F.col("amount") * F.col("credit_rate"), 2).cast("decimal(18,2)")), "transfer_validated")
    fine = validated.where(F.col("error_code").isNull())
    # Only (sender, day) pairs that occur in the batch need their earlier
    # spend: a semi join prunes the transaction history before aggregating.
    wanted = fine.select(F.col("sender_id").alias("__wc"), F.col("day").alias("__wd")).distinct()
    existing = (transactions.where(F.col("status") == "completed")
                .join(owners, F.col("from_account_id") == F.col("__a"))
                .withColumn("__d", F.to_date("created_at"))
                .join(wanted, (F.col("__c") == F.col("__wc")) & (F.col("__d") == F.col("__wd")), "left_semi")
                .groupBy(F.col("__c").alias("__sc"), F.col("__d").alias("__sd"))
                .agg(F.sum("amount_kzt").alias("spent_before")))
    staged = (fine.join(existing, (F.col("sender_id") == F.col("__sc")) & (F.col("day") == F.col("__sd")), "left")
              .withColumn("spent_before", F.coalesce("spent_before", F.lit(0).cast("decimal(18,2)"))).drop("__sc", "__sd"))
    settled = settle_requests(staged, live).select(F.col("request_id").alias("__rid"), "outcome")

    out = validated.join(settled, F.col("request_id") == F.col("__rid"), "left")
    code = F.coalesce("error_code", F.when(F.col("outcome") == LIMIT, F.lit(ERR_LIMIT[0]))
                      .when(F.col("outcome") == BALANCE, F.lit(ERR_BALANCE[0])))
    message = F.coalesce(F.col("message"),
                         F.when(code == ERR_LIMIT[0], F.lit(ERR_LIMIT[1]))
                         .when(code == ERR_BALANCE[0], F.lit(ERR_BALANCE[1])))
    ok = code.isNull()
    return out.select(
        "request_id", "src_account_id", "dst_account_id", "sender_id", "amount", "amount_kzt", "credit_rate",
        F.when(ok, "completed").otherwise("failed").alias("status"),
        code.alias("error_code"), message.alias("message"), F.when(ok, F.col("credited")).alias("credited"))


def post_transfers(accounts: DataFrame, settled: DataFrame) -> DataFrame:
    """New account balances: debit each completed amount, credit amount x rate."""
    done = settled.where(F.col("status") == "completed")
    deltas = (done.select(F.col("src_account_id").alias("__acct"), (-F.col("amount")).alias("__delta"))
              .unionByName(done.select(F.col("dst_account_id").alias("__acct"), F.col("credited").alias("__delta"))))
    per_acct = deltas.groupBy("__acct").agg(F.sum("__delta").alias("__sum"))
    return (accounts.join(per_acct, F.col("account_id") == F.col("__acct"), "left")
            .withColumn("balance", (F.col("balance") + F.coalesce("__sum", F.lit(0))).cast("decimal(18,2)"))
            .drop("__acct", "__sum"))


def _actor(actor: str | None) -> Column:
    """The acting user: given explicitly, else the session user (CURRENT_USER)."""
    return F.current_user() if actor is None else F.lit(actor)


def _when(at: str | None) -> Column:
    """The change time: given explicitly (reproducible), else CURRENT_TIMESTAMP."""
    return F.current_timestamp().cast("timestamp_ntz") if at is None else F.lit(at).cast("timestamp_ntz")


def transfer_rows(requests: DataFrame, settled: DataFrame, at: str | None = None) -> DataFrame:
    """The transaction row of each request, as it stands after the batch.

    A completed one carries accounts, rate and amount in KZT; a failed one none
    of them, and its description (NULL stays NULL) tells the message.
    """
    r = requests.select(F.col("request_id").alias("__rid"), "currency", F.col("requested_at").alias("created_at"),
                        (F.col("description") if "description" in requests.columns
                         else F.lit(None).cast("string")).alias("__text"))
    ok = F.col("status") == "completed"
    kept = [F.when(ok, F.col(c)).alias(new) for c, new in (
        ("src_account_id", "from_account_id"), ("dst_account_id", "to_account_id"),
        ("credit_rate", "exchange_rate"), ("amount_kzt", "amount_kzt"))]
    text = F.when(ok, F.col("__text")).otherwise(F.concat("__text", F.lit(" (FAILED: "), "message", F.lit(")")))
    return settled.join(r, F.col("request_id") == F.col("__rid")).select(
        F.col("request_id").alias("transaction_id"), *kept, "amount", "currency", F.lit("transfer").alias("type"),
        "status", "created_at", _when(at).alias("completed_at"), text.alias("description"))


def transfer_audit(settled: DataFrame, actor: str | None = None, at: str | None = None,
                   ip_address: str | None = None) -> DataFrame:
    """Audit rows: INSERT with the new status, or TRANSFER_FAIL with code and message."""
    from tessera.functions.scalar import json_object

    ok = F.col("status") == "completed"
    return settled.select(
        F.lit("transactions").alias("table_name"), F.col("request_id").alias("record_id"),
        F.when(ok, "INSERT").otherwise("TRANSFER_FAIL").alias("action"),
        F.when(~ok, json_object(error_code=F.col("error_code"), message=F.col("message"))).alias("old_values"),
        F.when(ok, json_object(status=F.lit("completed"))).alias("new_values"),
        _actor(actor).alias("changed_by"), _when(at).alias("changed_at"), F.lit(ip_address).cast("string").alias("ip_address"))


# Salary batch messages of the reference procedure; the NULL and
# non-positive amount cases fail on the table's NOT NULL / CHECK constraints.
BATCH_ACCOUNT_MSG = "Company account not found, inactive, or not KZT."
BATCH_BALANCE_MSG = "Insufficient balance in company account. Total needed: "
ERR_RECEIVER = ("P0001", "Receiver IIN {iin} account not found or inactive (must be KZT).")
ERR_AMOUNT_NULL = ("23502", "Amount must not be NULL.")
ERR_AMOUNT_POSITIVE = ("23514", "Amount must be positive.")
SALARY_SUFFIX = " (Salary Batch)"


BATCH_DOCUMENT_MSG = "Malformed payment list."


def salary_batches(payments: DataFrame, customers: DataFrame, accounts: DataFrame, paid_at: str,
                   documents: DataFrame | None = None) -> dict[str, DataFrame]:
    """Salary batches, fully set-based.

    ``payments``: batch_id, company_account_number, pos, iin, amount,
    description (one row per payment; see ``functions.scalar.explode_payment_rows``
    for JSON input). ``documents`` (batch_id, company_account_number, document)
    lists batches that may have no payment row: an empty one is processed with
    zero counts, a malformed one rejected.

    Per batch the company account must be an active KZT account. A company's
    batches are served in order of their id: each needs what the earlier ones
    have left to cover the sum of its amounts (else the whole batch is
    rejected) and takes what it really pays out. Each payment needs a receiver
    (the lowest active KZT account of the customer with that IIN) and a
    positive amount; failures are per payment. Returns ``summary`` (one row
    per batch), ``failures`` (one row per failed payment), ``postings`` (the new
    transactions), ``balances`` (accounts after credits and debits) and
    ``payments`` (every payment of a processed batch with its outcome).
    """
    from tessera.operators.changes import apply_moves

    company = accounts.where(F.col("is_active") & (F.col("currency") == "KZT")).select(
        F.col("account_number").alias("__co_no"), F.col("account_id").alias("company_account_id"),
        F.col("balance").alias("company_balance"))
    receivers = (accounts.where(F.col("is_active") & (F.col("currency") == "KZT"))
                 .join(customers.select("customer_id", "iin"), "customer_id")
                 .groupBy(F.col("iin").alias("__iin")).agg(F.min("account_id").alias("receiver_account_id")))
    matched = payments.join(receivers, F.col("iin") == F.col("__iin"), "left").drop("__iin")
    code = (F.when(F.col("receiver_account_id").isNull(), F.lit(ERR_RECEIVER[0]))
            .when(F.col("amount").isNull(), F.lit(ERR_AMOUNT_NULL[0]))
            .when(F.col("amount") <= 0, F.lit(ERR_AMOUNT_POSITIVE[0])))
    head, tail = ERR_RECEIVER[1].split("{iin}")
    # RAISE prints a NULL argument as <NULL>.
    message = (F.when(code == ERR_RECEIVER[0], F.concat(F.lit(head), F.coalesce("iin", F.lit("<NULL>")), F.lit(tail)))
               .when(code == ERR_AMOUNT_NULL[0], F.lit(ERR_AMOUNT_NULL[1]))
               .when(code == ERR_AMOUNT_POSITIVE[0], F.lit(ERR_AMOUNT_POSITIVE[1])))
    matched = matched.withColumn("error_code", code).withColumn("message", message)

    per_batch = matched.groupBy("batch_id", "company_account_number").agg(
        F.coalesce(F.sum("amount"), F.lit(0)).cast("decimal(28,2)").alias("__total"),
        F.coalesce(F.sum(F.when(F.col("amount") > 0, F.col("amount"))), F.lit(0)).cast("decimal(28,2)").alias("__positive"),
        F.coalesce(F.sum(F.when(F.col("error_code").isNull(), F.col("amount"))), F.lit(0)).cast("decimal(28,2)").alias("__paid"),
        F.count(F.when(F.col("error_code").isNull(), 1)).alias("__ok"),
        F.count(F.when(F.col("error_code").isNotNull(), 1)).alias("__bad"))
    if documents is not None:
        listed = documents.select("batch_id", "company_account_number", "document")
        per_batch = listed.join(per_batch.drop("company_account_number"), "batch_id", "left").fillna(
            0, ["__total", "__positive", "__paid", "__ok", "__bad"])
    else:
        per_batch = per_batch.withColumn("document", F.lit("ok"))
    batches = per_batch.join(company, F.col("company_account_number") == F.col("__co_no"), "left").drop("__co_no")
    fine = F.col("company_account_id").isNotNull() & (F.col("document") != "malformed")
    # A batch that is refused before its sum is looked at needs nothing and takes nothing.
    queued = batches.withColumns({
        "__need": F.when(fine, F.greatest("__total", "__positive")), "__take": F.when(fine, F.col("__paid")).otherwise(F.lit(0).cast("decimal(28,2)"))})
    served = accept_in_order(queued, "company_account_id", "batch_id", "__need", "__take", "company_balance")
    reject = (F.when(F.col("document") == "malformed", F.lit(BATCH_DOCUMENT_MSG))
              .when(F.col("company_account_id").isNull(), F.lit(BATCH_ACCOUNT_MSG))
              .when(~F.col("accepted"), F.concat(F.lit(BATCH_BALANCE_MSG), F.col("__total").cast("string"))))
    batches = served.withColumn("batch_message", reject).drop("accepted", "__need", "__take")
    live = batches.where(F.col("batch_message").isNull()).select(F.col("batch_id").alias("__b"), "company_account_id")
    classified = matched.join(live, F.col("batch_id") == F.col("__b")).drop("__b")

    ok = classified.where(F.col("error_code").isNull())
    postings = ok.select(
        "batch_id", "pos", F.col("company_account_id").alias("from_account_id"),
        F.col("receiver_account_id").alias("to_account_id"), "amount", F.lit("KZT").alias("currency"),
        F.col("amount").alias("amount_kzt"), F.lit("transfer").alias("type"), F.lit("completed").alias("status"),
        F.concat(F.col("description"), F.lit(SALARY_SUFFIX)).alias("description"),
        F.lit(paid_at).cast("timestamp_ntz").alias("created_at"), "iin")
    failures = classified.where(F.col("error_code").isNotNull()).select(
        "batch_id", "pos", "iin", "amount", "error_code", "message")

    done = F.col("batch_message").isNull()
    summary = batches.select(
        "batch_id", F.when(done, "processed").otherwise("rejected").alias("batch_status"),
        F.when(done, F.col("__ok")).otherwise(F.lit(0)).cast("long").alias("successful_count"),
        F.when(done, F.col("__bad")).otherwise(F.lit(0)).cast("long").alias("failed_count"),
        "batch_message", "company_account_number")

    moves = postings.select("from_account_id", "to_account_id", "amount")
    balances = apply_moves(accounts, "account_id", "balance", moves, "from_account_id", "to_account_id", "amount")
    return {"summary": summary, "failures": failures, "postings": postings, "balances": balances, "payments": classified}


PAGE_ROWS = 1000


def failure_pages(out: dict[str, DataFrame], page_rows: int = PAGE_ROWS) -> DataFrame:
    """The result of every processed batch, its failure details as numbered JSON arrays of ``page_rows`` each.

    One row per page (page 0 with an empty array where nothing failed): batch_id,
    successful_count, failed_count, page, pages, details. A page is built from a
    bounded group: a payment's page follows from how many failures stand ahead
    of it (a split running count), so a batch of any size is never one value
    or one task. The pages in order hold the rows of ``failures``.
    """
    # (pos, iin, code) may repeat in a batch; equal rows are interchangeable.
    placed = prefix_sums(out["failures"], ["pos", "iin", "error_code", "message"], {"__place": F.lit(1).cast("long")}, ["batch_id"])
    item = F.struct("pos", F.coalesce("iin", F.lit("")).alias("iin"), F.col("error_code").alias("code"), F.col("message").alias("error"))
    pages = (placed.groupBy(F.col("batch_id").alias("__b"), F.floor(F.col("__place") / page_rows).alias("page"))
             .agg(F.to_json(F.array_sort(F.collect_list(item))).alias("details")))
    done = out["summary"].where(F.col("batch_status") == "processed").select("batch_id", "successful_count", "failed_count")
    return (done.join(pages, F.col("batch_id") == F.col("__b"), "left")
            .select("batch_id", "successful_count", "failed_count", F.coalesce("page", F.lit(0)).cast("long").alias("page"),
                    F.greatest(F.ceil(F.col("failed_count") / page_rows), F.lit(1)).cast("long").alias("pages"),
                    F.coalesce("details", F.lit("[]")).alias("details")))


def salary_audit(out: dict[str, DataFrame], actor: str | None = None, at: str | None = None,
                 ip_address: str | None = None) -> DataFrame:
    """J7 for J5: a row per paid payment, per failed payment, and one closing row per processed batch."""
    from tessera.functions.scalar import json_object

    p = out["payments"]
    ok = F.col("error_code").isNull()
    rows = p.select(
        F.when(ok, "transactions").otherwise("salary_batch").alias("table_name"), "batch_id",
        F.col("pos").cast("long").alias("record_id"), F.when(ok, "INSERT").otherwise("TRANSFER_FAIL").alias("action"),
        F.when(~ok, json_object(iin=F.col("iin"), error=F.col("message"))).alias("old_values"),
        F.when(ok, json_object(status=F.lit("completed"), iin=F.col("iin"))).alias("new_values"))
    closing = out["summary"].where(F.col("batch_status") == "processed").select(
        F.lit("salary_batch").alias("table_name"), "batch_id", F.lit(None).cast("long").alias("record_id"),
        F.lit("UPDATE").alias("action"), F.lit(None).cast("string").alias("old_values"),
        json_object(company_account=F.col("company_account_number"), success=F.col("successful_count"),
                    failed=F.col("failed_count")).alias("new_values"))
    return rows.unionByName(closing).withColumns({
        "changed_by": _actor(actor), "changed_at": _when(at), "ip_address": F.lit(ip_address).cast("string")})


def salary_batch_summary(postings: DataFrame, accounts: DataFrame, customers: DataFrame) -> DataFrame:
    """Per (batch date, company) count and total of salary postings.

    Only descriptions containing '(Salary Batch)' count; a NULL description
    made the stored text NULL, so such postings are skipped.
    """
    owner = accounts.select(F.col("account_id").alias("__a"), F.col("customer_id").alias("__c"))
    names = customers.select(F.col("customer_id").alias("__cid"), F.col("full_name").alias("company_name"))
    rows = (postings.where(F.col("description").like("%(Salary Batch)%"))
            .join(owner, F.col("from_account_id") == F.col("__a"))
            .join(names, F.col("__c") == F.col("__cid")))
    return rows.groupBy(F.to_date("created_at").alias("batch_date"), "company_name").agg(
        F.count("batch_id").alias("total_payments"), F.sum("amount").alias("total_amount_kzt"))


def audit_diff(before: DataFrame, after: DataFrame, key: str, columns: list[str], table_name: str,
               actor: str | None = None, at: str | None = None) -> DataFrame:
    """Audit rows from two snapshots of a table (full outer join on the key).

    INSERT / DELETE for one-sided keys, UPDATE when any listed column differs;
    ``old_values`` / ``new_values`` are JSON objects of the listed columns.
    """
    from tessera.functions.scalar import json_object

    b = before.select(F.col(key).alias("__k_old"), *[F.col(c).alias(f"__old_{c}") for c in columns])
    a = after.select(F.col(key).alias("__k_new"), *[F.col(c).alias(f"__new_{c}") for c in columns])
    j = b.join(a, F.col("__k_old") == F.col("__k_new"), "full")
    same = F.lit(True)
    for c in columns:
        same = same & F.col(f"__old_{c}").eqNullSafe(F.col(f"__new_{c}"))
    action = (F.when(F.col("__k_old").isNull(), "INSERT").when(F.col("__k_new").isNull(), "DELETE")
              .when(~same, "UPDATE"))
    old_json = json_object(**{c: F.col(f"__old_{c}") for c in columns})
    new_json = json_object(**{c: F.col(f"__new_{c}") for c in columns})
    return (j.withColumn("action", action).where(F.col("action").isNotNull())
            .select(F.lit(table_name).alias("table_name"),
                    F.coalesce("__k_new", "__k_old").alias("record_id"), "action",
                    F.when(F.col("action") != "INSERT", old_json).alias("old_values"),
                    F.when(F.col("action") != "DELETE", new_json).alias("new_values"),
                    _actor(actor).alias("changed_by"), _when(at).alias("changed_at")))
