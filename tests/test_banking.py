"""Banking jobs on rows of our own, with the sequential rules checked against a
plain loop, on these rows and on the relations derived from the driver tables."""

import datetime as dt
import random
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tessera.operators import banking, settlement
from tessera.plans import bank_model as bm
from tessera.sources.tables import Tables

from conftest import rows

DAY = "2030-03-03"
NOON = dt.datetime(2030, 3, 3, 12, 0)
REQUEST = ("request_id long, from_account_number string, to_account_number string, amount decimal(18,2), "
           "currency string, requested_at timestamp_ntz")
PAYMENT = "batch_id long, company_account_number string, pos int, iin string, amount decimal(18,2), description string"


def customers(spark):
    """Three active customers with limits of 800, 90 and 4,000, and a frozen one."""
    return spark.createDataFrame([
        (21, "tin-21", "Brewer", "active", D(800)), (22, "tin-22", "Tanner", "active", D(90)),
        (23, "tin-23", "Cooper", "frozen", D(90)), (24, "tin-24", "Weaver", "active", D(4000)),
    ], "customer_id long, iin string, full_name string, status string, daily_limit_kzt decimal(18,2)")


def accounts(spark, extra=()):
    own = [(201, 21, "B-KZT", "KZT", D(900), True), (202, 21, "B-USD", "USD", D(6), True),
           (203, 22, "T-KZT", "KZT", D(70), True), (204, 23, "C-KZT", "KZT", D(70), True),
           (205, 24, "W-KZT", "KZT", D(9000), True), (206, 24, "W-CHF", "CHF", D(50), True),
           (207, 24, "W-OLD", "KZT", D(50), False)]
    return spark.createDataFrame(own + list(extra), "account_id long, customer_id long, account_number string, "
                                                    "currency string, balance decimal(18,2), is_active boolean")


def rates(spark):
    """Dollars at 100 (80 before), tenge back at 0.01; none for francs."""
    return spark.createDataFrame([(1, "USD", "KZT", D(100), None), (2, "USD", "KZT", D(80), NOON),
                                  (3, "KZT", "USD", D("0.01"), None)], bm.RATE_SCHEMA)


def transactions(spark, extra=()):
    return spark.createDataFrame(
        [(1, 201, 203, D(30), D(30), "transfer", "completed", NOON - dt.timedelta(hours=1)),
         (2, 201, 203, D(500), D(500), "transfer", "failed", NOON),
         (3, 202, 203, D(1), D(100), "transfer", "completed", NOON - dt.timedelta(days=1)), *extra],
        "transaction_id long, from_account_id long, to_account_id long, amount decimal(18,2), "
        "amount_kzt decimal(18,2), type string, status string, created_at timestamp_ntz")


def requests(spark, data):
    return spark.createDataFrame([(i + 1, a, b, D(x), c, NOON + dt.timedelta(minutes=i))
                                  for i, (a, b, x, c) in enumerate(data)], REQUEST)


def test_balance_summary(spark):
    out = banking.balance_summary(customers(spark), accounts(spark), rates(spark), transactions(spark), DAY)
    got = {r["account_number"]: r for r in out.collect()}
    total = {"B-KZT": 1500.0, "B-USD": 1500.0, "T-KZT": 70.0, "C-KZT": 70.0, "W-KZT": 9100.0, "W-CHF": 9100.0, "W-OLD": 9100.0}
    assert {k: r["total_balance_kzt"] for k, r in got.items()} == total
    assert {k: r["total_balance_rank"] for k, r in got.items()} == {
        k: 1 + sum(x > v for x in total.values()) for k, v in total.items()}
    assert (got["B-USD"]["balance_kzt"], got["W-CHF"]["balance_kzt"]) == (600.0, 50.0)  # no rate counts as one
    assert (got["B-KZT"]["total_spent_today"], got["B-KZT"]["limit_utilization_percent"]) == (30.0, 3.75)


CASES = [
    (("none", "B-KZT", "1", "KZT"), "A0001"), (("W-OLD", "B-KZT", "1", "KZT"), "A0001"),
    (("B-KZT", "none", "1", "KZT"), "A0002"), (("C-KZT", "B-KZT", "1", "KZT"), "C0001"),
    (("B-KZT", "T-KZT", "1", "USD"), "V0001"), (("B-USD", "W-CHF", "1", "USD"), "V0002"),
    (("W-CHF", "W-CHF", "1", "CHF"), "V0003"), (("T-KZT", "B-KZT", "91", "KZT"), "L0001"),
    (("B-USD", "T-KZT", "7", "USD"), "B0001"), (("B-KZT", "T-KZT", "-1", "KZT"), "23514"),
    (("B-KZT", "B-USD", "200", "KZT"), None), (("W-KZT", "T-KZT", "44.44", "KZT"), None),
]


def test_transfer_rules_one_case_each(spark):
    acc, reqs = accounts(spark), requests(spark, [c for c, _ in CASES])
    validated = banking.validate_transfers(reqs, customers(spark), acc, rates(spark))
    settled = banking.settle_transfers(validated, transactions(spark), acc)
    got = {r["request_id"]: r for r in settled.collect()}
    assert [got[i + 1]["error_code"] for i in range(len(CASES))] == [code for _, code in CASES]
    assert got[11]["credited"] == D(2) and got[6]["message"].endswith("USD to CHF")
    balances = dict(rows(banking.post_transfers(acc, settled), "account_id", "balance"))
    assert (balances[201], balances[202], balances[203], balances[205]) == (D(700), D(8), D("114.44"), D("8955.56"))
    audit = banking.transfer_audit(settled, "clerk", "2030-03-03 13:00:00", "192.0.2.9")
    assert audit.where("action = 'TRANSFER_FAIL'").count() == 10 and {r["ip_address"] for r in audit.collect()} == {"192.0.2.9"}
    named = reqs.withColumn("description", F.when(F.col("request_id") != 9, "rent"))
    kept = {r["transaction_id"]: r for r in banking.transfer_rows(named, settled, "2030-03-03 13:00:00").collect()}
    assert kept[11]["description"] == "rent" and kept[11]["exchange_rate"] == D("0.01") and kept[11]["to_account_id"] == 202
    assert kept[8]["description"].startswith("rent (FAILED: ") and kept[8]["from_account_id"] is None
    assert kept[9]["description"] is None  # NULL text stays NULL


def brute_force(validated_rows, spent_before):
    """One request at a time, in (time, id) order per sender."""
    spent, left, out = dict(spent_before), {}, {}
    for r in sorted(validated_rows, key=lambda r: (r["requested_at"], r["request_id"])):
        day, source = (r["sender_id"], r["requested_at"].date()), r["src_account_id"]
        code = r["error_code"]
        if not code:
            left.setdefault(source, r["src_balance"])
            if spent.get(day, 0) + r["amount_kzt"] > r["daily_limit_kzt"]:
                code = "L0001"
            elif left[source] < r["amount"]:
                code = "B0001"
            else:
                spent[day] = spent.get(day, 0) + r["amount_kzt"]
                left[source] -= r["amount"]
        out[r["request_id"]] = code
    return out


def spent_by_day(acc, tx):
    owner = {r["account_id"]: r["customer_id"] for r in acc.collect()}
    spent = {}
    for r in tx.where("status = 'completed'").collect():
        if r["from_account_id"] in owner:
            day = (owner[r["from_account_id"]], r["created_at"].date())
            spent[day] = spent.get(day, D(0)) + r["amount_kzt"]
    return spent


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_transfers_match_brute_force(spark, sf):
    t = Tables(spark, f"/root/testdata/sf{sf}")
    acc, tx = bm.accounts(t), bm.transactions(t)
    validated = banking.validate_transfers(bm.transfer_requests(t), bm.customers(t), acc, bm.exchange_rates(spark))
    expected = brute_force(validated.collect(), spent_by_day(acc, tx))
    got = {r["request_id"]: r["error_code"] for r in banking.settle_transfers(validated, tx, acc).collect()}
    assert got == expected and {None, "L0001"} <= set(expected.values())


def test_one_sender_with_a_third_of_the_rows(spark):
    rnd = random.Random(8)
    acc = accounts(spark, [(300 + i, 22 if i < 2 else 24, f"X{i}", "KZT", D(rnd.choice([40, 150, 600])), True) for i in range(5)])
    data = [(n, f"X{0 if rnd.random() < 0.33 else rnd.randrange(5)}", "B-KZT", D(rnd.choice([1, 3, 8, 20])), "KZT",
             NOON + dt.timedelta(days=rnd.randrange(3), minutes=rnd.randrange(600))) for n in range(500)]
    validated = banking.validate_transfers(spark.createDataFrame(data, REQUEST), customers(spark), acc, rates(spark))
    expected = brute_force(validated.collect(), spent_by_day(acc, transactions(spark)))
    assert {"L0001", "B0001", None} <= set(expected.values())
    got = banking.settle_transfers(validated, transactions(spark), acc).collect()
    assert {r["request_id"]: r["error_code"] for r in got} == expected


def live_force(validated_rows, spent_before, balances):
    """The whole batch one request at a time, every transfer posted at once."""
    spent, left, out = dict(spent_before), dict(balances), {}
    for r in sorted(validated_rows, key=lambda r: (r["requested_at"], r["request_id"])):
        day, code = (r["sender_id"], r["requested_at"].date()), r["error_code"]
        if not code:
            if spent.get(day, 0) + r["amount_kzt"] > r["daily_limit_kzt"]:
                code = "L0001"
            elif left[r["src_account_id"]] < r["amount"]:
                code = "B0001"
            else:
                spent[day] = spent.get(day, 0) + r["amount_kzt"]
                left[r["src_account_id"]] -= r["amount"]
                left[r["dst_account_id"]] += (r["amount"] * r["credit_rate"]).quantize(D("0.01"), "ROUND_HALF_UP")
        out[r["request_id"]] = code
    return out


def test_money_received_is_spendable_along_a_chain(spark):
    """Each of three accounts can pay only with what the one before has just sent; a refusal breaks the chain behind it."""
    acc = accounts(spark, [(301, 24, "A", "KZT", D(100), True), (302, 21, "B", "KZT", D(0), True), (303, 22, "C", "KZT", D(0), True)])
    steps = [("A", "B", 80), ("B", "C", 70), ("C", "A", 60), ("A", "B", 85), ("A", "B", 80), ("B", "C", 91), ("B", "C", 90), ("C", "C", 30), ("C", "A", 30)]
    reqs = requests(spark, [(a, b, x, "KZT") for a, b, x in steps])
    validated = banking.validate_transfers(reqs, customers(spark), acc, rates(spark))
    expected = live_force(validated.collect(), {}, {r["account_id"]: r["balance"] for r in acc.collect()})
    settled = banking.settle_transfers(validated, transactions(spark).limit(0), acc, live=True)
    assert {r["request_id"]: r["error_code"] for r in settled.collect()} == expected
    assert [expected[i] for i in range(1, 10)] == [None, None, None, "B0001", None, "B0001", None, None, "L0001"]
    balances = dict(rows(banking.post_transfers(acc, settled), "account_id", "balance"))
    assert (balances[301], balances[302], balances[303]) == (D(0), D(0), D(100))


@pytest.mark.parametrize("live, fold", [(True, 512), (True, 7), (False, 7)])
def test_rounds_match_brute_force(spark, monkeypatch, live, fold):
    """Tight budgets, several accounts a sender, a sender with a third of the rows, folds long and short."""
    monkeypatch.setattr(settlement, "FOLD_ROWS", fold)
    rnd = random.Random(fold)
    extra = [(300 + i, (21, 22, 24)[i % 3], f"X{i}", "KZT", D(rnd.choice([0, 40, 150])), True) for i in range(9)]
    acc = accounts(spark, extra)
    data = [(n, f"X{0 if rnd.random() < 0.33 else rnd.randrange(9)}", f"X{rnd.randrange(9)}", D(rnd.choice([1, 3, 8, 20, 60])), "KZT",
             NOON + dt.timedelta(days=rnd.randrange(3), minutes=rnd.randrange(600))) for n in range(150 if live else 400)]
    validated = banking.validate_transfers(spark.createDataFrame(data, REQUEST), customers(spark), acc, rates(spark))
    spent = spent_by_day(acc, transactions(spark))
    expected = (live_force(validated.collect(), spent, {r["account_id"]: r["balance"] for r in acc.collect()}) if live
                else brute_force(validated.collect(), spent))
    assert {"L0001", "B0001", None} <= set(expected.values())
    plans = []
    kept = settlement.materialize
    monkeypatch.setattr(settlement, "materialize", lambda df, area: (plans.append(df._jdf.queryExecution().executedPlan().toString()), kept(df, area))[1])
    got = banking.settle_transfers(validated, transactions(spark), acc, live=live)
    assert {r["request_id"]: r["error_code"] for r in got.collect()} == expected
    assert not any("Python" in p or "Pandas" in p or "Arrow" in p for p in plans)


def test_alternating_refusals_take_few_rounds(spark, monkeypatch):
    areas, kept = [], settlement.materialize
    monkeypatch.setattr(settlement, "materialize", lambda df, area: (areas.append(area), kept(df, area))[1])
    data = [("a", n, D(1) if n % 2 else D(1001 - n // 2), D(1001)) for n in range(2002)]  # every even one just misses
    data += [("b", 1, D(5), D(3)), ("c", 1, D(2), D(3)), ("c", 2, None, D(3)), (None, 1, D(1), None), ("d", 1, D(1), D(5)), ("d", 2, D(4), D(5))]
    frame = spark.createDataFrame(data, "k string, n long, need decimal(18,2), funds decimal(18,2)")
    got = {(r["k"], r["n"]): r["accepted"] for r in settlement.accept_in_order(frame, "k", "n", "need", "need", "funds").collect()}
    want, left = {}, {}
    for k, n, need, funds in data:
        free = left.setdefault(k, funds)
        want[k, n] = need is not None and free is not None and need <= free
        left[k] = free - need if want[k, n] else free
    assert got == want and sum(not v for (k, _), v in want.items() if k == "a") >= 1000
    assert areas.count("accept_round") <= 20


def test_salary_batches_in_order_without_overdraft(spark):
    acc = accounts(spark)
    paid = [(1, "W-KZT", 1, "tin-21", D(10), "May"), (1, "W-KZT", 2, "tin-99", D(10), "May"),
            (1, "W-KZT", 3, "tin-22", D(0), None), (1, "W-KZT", 4, "tin-22", None, None),
            (2, "T-KZT", 1, "tin-21", D(60), "a"), (3, "T-KZT", 1, "tin-21", D(60), "b"), (4, "T-KZT", 1, "tin-21", D(10), None),
            (5, "B-USD", 1, "tin-22", D(1), "usd"), (6, "T-KZT", 1, "tin-21", D(1), "c")]
    documents = [(n, a, "ok") for n, a in ((1, "W-KZT"), (2, "T-KZT"), (3, "T-KZT"), (4, "T-KZT"), (5, "B-USD"), (6, "T-KZT"))]
    documents += [(7, "W-KZT", "empty"), (8, "W-KZT", "malformed"), (9, "none", "empty")]
    out = banking.salary_batches(spark.createDataFrame(paid, PAYMENT), customers(spark), acc, "2030-03-31 08:00:00",
                                 spark.createDataFrame(documents, "batch_id long, company_account_number string, document string"))
    assert rows(out["summary"], "batch_id", "batch_status", "successful_count", "failed_count") == [
        (1, "processed", 1, 3), (2, "processed", 1, 0), (3, "rejected", 0, 0), (4, "processed", 1, 0), (5, "rejected", 0, 0),
        (6, "rejected", 0, 0), (7, "processed", 0, 0), (8, "rejected", 0, 0), (9, "rejected", 0, 0)]
    assert rows(out["failures"], "pos", "error_code") == [(2, "P0001"), (3, "23514"), (4, "23502")]
    balances = dict(rows(out["balances"], "account_id", "balance"))
    assert min(balances.values()) >= 0
    assert (balances[205], balances[203], balances[201]) == (D(8990), D(0), D(980))
    audit = banking.salary_audit(out, "clerk", "2030-03-31 08:00:00", "192.0.2.9")
    assert rows(audit.groupBy("action").count(), "action", "count") == [("INSERT", 3), ("TRANSFER_FAIL", 3), ("UPDATE", 4)]
    view = banking.salary_batch_summary(out["postings"], acc, customers(spark))
    assert rows(view, "company_name", "total_payments", "total_amount_kzt") == [("Tanner", 1, D(60)), ("Weaver", 1, D(10))]


def test_suspicious_activity(spark):
    start = NOON + dt.timedelta(days=40)
    moves = [(203, 7000, "transfer", "completed", 0), (201, 1, "transfer", "completed", 7200),
             (202, 1, "deposit", "failed", 7205), (202, 1, "withdrawal", "completed", 7230), (201, 9, "deposit", "completed", 9000)]
    tx = spark.createDataFrame([(n, a, 205, D(x), k, s, start + dt.timedelta(seconds=at)) for n, (a, x, k, s, at) in enumerate(moves)],
                               "transaction_id long, from_account_id long, to_account_id long, amount_kzt decimal(18,2), "
                               "type string, status string, created_at timestamp_ntz")
    got = rows(banking.suspicious_activity(tx, accounts(spark), 5000.0, max_per_window=2), "transaction_id", "flag_reason")
    assert got == [(0, "High_Value_Transfer"), (1, "High_Frequency_Hourly"), (3, "High_Frequency_Hourly"),
                   (3, "Rapid_Sequential_Transfer"), (4, "High_Frequency_Hourly")]


def test_pages_hold_the_failures(spark):
    """Pages joined again are the failure rows; a batch without failures has one empty page."""
    import json

    paid = [(1, "W-KZT", n, f"tin-{90 + n % 7}" if n % 3 else "tin-21", D(n % 5), "May") for n in range(57)] + [(2, "B-KZT", 1, "tin-22", D(1), None)]
    out = banking.salary_batches(spark.createDataFrame(paid, PAYMENT), customers(spark), accounts(spark), "2030-03-31 08:00:00")
    pages = banking.failure_pages(out, page_rows=10).orderBy("batch_id", "page").collect()
    first = [r for r in pages if r["batch_id"] == 1]
    held = [json.loads(r["details"]) for r in first]
    assert [r["page"] for r in first] == list(range(first[0]["pages"])) and [len(p) for p in held[:-1]] == [10] * (len(held) - 1)
    failures = out["failures"].where("batch_id = 1").orderBy("pos").collect()
    assert [(x["pos"], x["iin"], x["code"], x["error"]) for p in held for x in p] == [
        (r["pos"], r["iin"], r["error_code"], r["message"]) for r in failures]
    assert first[0]["failed_count"] == len(failures) and len(failures) > 20
    assert [(r["page"], r["pages"], r["details"], r["failed_count"]) for r in pages if r["batch_id"] == 2] == [(0, 1, "[]", 0)]
