"""Requests served in order against budgets that the earlier ones draw down, without a loop over rows.

Whether a request is served depends on the fate of all before it. Each round
brackets what a budget can hold when a request's turn comes: at worst every open
request before it was served and no open credit came in, at best the other way
round. Where both ends agree the request is settled. What is left open is folded
in order, by SQL, over the first ``FOLD_ROWS`` requests of each key, whose
budgets are known exactly; so a round settles many refusals, not one. Rounds
carry open requests only, with the budget as it stands for each of them.

Running sums are split by (key, time bucket), so a key with any share of the rows
is spread over tasks, and the folded groups are bounded.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.windows import prefix_sums
from tessera.session import materialize

FOLD_ROWS = 512


def accept_in_order(requests: DataFrame, key: str, order: str, need: str, take: str, funds: str) -> DataFrame:
    """``requests`` with ``accepted``: served per ``key`` in ``order`` while the funds last.

    A request is accepted when what is left covers its ``need``; it then takes
    ``take`` (at most its need). A refused one takes nothing, and later ones
    may still fit. (key, order) must be unique, ``order`` numeric or temporal; a
    null need or funds is refused.

    Keys whose funds cover everything, or with a single request, need no order at
    all. The others go through the rounds of this module: at most one more than
    their longest run of requests that the bracket leaves open, over ``FOLD_ROWS``.
    """
    requests = materialize(requests, "accept_requests")
    money, names = requests.schema[funds].dataType, requests.columns
    taken = F.coalesce(F.col(take), F.lit(0)).cast(money)
    fits = F.coalesce(F.col(need) <= F.col(funds), F.lit(False))
    served = F.col(need).isNotNull() & F.col(funds).isNotNull()
    tight = (requests.where(served).groupBy(F.col(key).alias("__fk"))
             .agg(F.count("*").alias("n"), F.sum(taken).alias("all"), F.max(F.col(need) - taken).alias("spare"), F.min(funds).alias("funds"))
             .where("n > 1 AND all + spare > funds").select("__fk"))
    if not tight.head(1):
        return requests.withColumn("accepted", fits)
    tight = materialize(tight, "accept_keys")
    of = F.col(key).eqNullSafe(F.col("__fk"))
    open_ = requests.where(served).join(tight, of, "left_semi").withColumn("__taken", F.lit(None).cast(money))
    done = [requests.where(served).join(tight, of, "left_anti").withColumn("accepted", fits), requests.where(~served).withColumn("accepted", F.lit(False))]
    while open_.head(1):
        free = F.col("__taken").isNull()
        sums = prefix_sums(open_, [order], {
            "__fixed": F.coalesce("__taken", F.lit(0).cast(money)), "__maybe": F.when(free, taken).otherwise(F.lit(0).cast(money)),
            "__place": free.cast("long")}, partition_by=[key])
        sums = sums.where(free).withColumn(funds, (F.col(funds) - F.col("__fixed")).cast(money)).drop("__fixed", "__taken")
        sure = F.when(~fits, False).when(F.col(need) <= F.col(funds) - F.col("__maybe"), True)
        judged = sums.withColumn("__sure", sure)
        first = judged.where(F.col("__place") < FOLD_ROWS).groupBy(F.col(key).alias("__fk")).agg(F.array_sort(F.collect_list(
            F.struct(F.col(order).alias("at"), F.col(need).alias("need"), taken.alias("take"), F.col(funds).alias("funds")))).alias("r"))
        held = F.struct(F.lit(0).cast(money).alias("used"), F.array().cast("array<boolean>").alias("yes"))
        yes = lambda s, x: F.coalesce(x["need"] <= x["funds"] - s["used"], F.lit(False))
        fold = F.aggregate("r", held, lambda s, x: F.struct(
            (s["used"] + F.when(yes(s, x), x["take"]).otherwise(F.lit(0))).cast(money).alias("used"), F.array_append(s["yes"], yes(s, x)).alias("yes")))
        folded = first.select("__fk", F.explode(F.arrays_zip(F.transform("r", lambda x: x["at"]).alias("at"), fold["yes"].alias("yes"))).alias("f"))
        folded = folded.select("__fk", F.col("f.at").alias("__at"), F.col("f.yes").alias("__yes"))
        judged = judged.join(folded, F.col(key).eqNullSafe(F.col("__fk")) & F.col(order).eqNullSafe(F.col("__at")), "left")
        judged = materialize(judged.withColumn("accepted", F.coalesce("__yes", "__sure")).select(*names, "accepted"), "accept_round")
        done.append(judged.where("accepted IS NOT NULL"))
        later = judged.where("accepted IS NULL").select(F.col(key).alias("__fk")).distinct()
        open_ = (judged.where("accepted IS NOT FALSE")
                 .withColumn("__taken", F.when(F.col("accepted"), taken)).drop("accepted")
                 .join(later, F.col(key).eqNullSafe(F.col("__fk")), "left_semi"))
    # The funds as they were given, not as they stand for each request.
    settled = reduce(DataFrame.unionByName, [d.select(F.col(key).alias("__ak"), F.col(order).alias("__ao"), "accepted") for d in done])
    return requests.join(settled, F.col(key).eqNullSafe(F.col("__ak")) & F.col(order).eqNullSafe(F.col("__ao"))).drop("__ak", "__ao")


OK, LIMIT, BALANCE, REFUSED = "ok", "limit", "balance", "refused"


def settle_requests(requests: DataFrame, live: bool = False) -> DataFrame:
    """(request_id, outcome): ``ok``, ``limit`` or ``balance`` for every transfer request, in (requested_at, request_id) order.

    A request draws on two coupled budgets: what its sender may spend that day
    (``spent_before`` + ``amount_kzt`` <= ``daily_limit_kzt``, tested first) and
    the balance of ``src_account_id`` (``src_balance`` >= ``amount``). A refused
    request draws on neither. With ``live`` the money that an earlier request
    has brought to an account can be spent by the next one (``credited`` to
    ``dst_account_id``); else credits count after the batch.

    Days and accounts that can pay for everything bind nobody and take no part.
    Without ``live`` a sender with up to ``FOLD_ROWS`` requests that are bound is
    folded at once; all others go through the rounds. With ``live`` a fold stops
    ahead of an account that waits for an open credit; the earliest open request
    never waits, so every round settles some, and the rounds follow the longest
    chain of transfers that wait for each other. A refusal whose reason isn't
    certain yet stays as an observer.
    """
    cents = lambda c: (F.col(c) * 100).cast("long")
    rows = materialize(requests.select(
        "request_id", "sender_id", "day", F.col("src_account_id").alias("src"), F.col("dst_account_id").alias("dst"), "requested_at",
        cents("amount").alias("amount"), cents("amount_kzt").alias("kzt"), cents("credited").alias("credited"),
        cents("spent_before").alias("spent"), cents("daily_limit_kzt").alias("most"), cents("src_balance").alias("balance")), "settle_requests")
    days = (rows.groupBy(F.col("sender_id").alias("__s"), F.col("day").alias("__d")).agg(F.sum("kzt").alias("n"), F.max("spent").alias("spent"), F.max("most").alias("most"))
            .where("spent + n > most").select("__s", "__d", F.lit(True).alias("day_hard")))
    accounts = (rows.groupBy(F.col("src").alias("__a")).agg(F.sum("amount").alias("n"), F.max("balance").alias("balance"))
                .where("n > balance").select("__a", F.lit(True).alias("src_hard")))
    rows = rows.join(days, (F.col("sender_id") == F.col("__s")) & F.col("day").eqNullSafe(F.col("__d")), "left").drop("__s", "__d")
    rows = rows.join(accounts, F.col("src") == F.col("__a"), "left").drop("__a")
    if live:
        rows = rows.join(accounts.withColumnRenamed("src_hard", "dst_hard"), F.col("dst") == F.col("__a"), "left").drop("__a")
    else:
        rows = rows.withColumn("dst_hard", F.lit(False))
    rows = rows.fillna(False, ["src_hard", "day_hard", "dst_hard"])
    # state 0: open, 1: just accepted, 2: refused for a reason to come
    rows = materialize(rows.withColumn("state", F.when(F.col("src_hard") | F.col("day_hard"), 0).otherwise(1)), "settle_rows")
    done = [rows.where("state = 1").select("request_id", F.lit(OK).alias("outcome"))]
    if live:
        rows = rows.where("state = 0 OR dst_hard")
    else:
        rows = rows.where("state = 0")
        large = rows.groupBy(F.col("sender_id").alias("__s")).count().where(F.col("count") > FOLD_ROWS).select("__s")
        if not large.head(1):
            return done[0].unionByName(_folded(rows.withColumn("blocked", F.lit(False))))
        large = materialize(large, "settle_large")
        small = rows.join(large, F.col("sender_id") == F.col("__s"), "left_anti")
        done.append(_folded(small.withColumn("blocked", F.lit(False))))
        rows = rows.join(large, F.col("sender_id") == F.col("__s"), "left_semi")
    while True:
        most = rows.where("state <> 1").groupBy("sender_id").agg(F.count(F.when(F.col("state") == 0, 1)).alias("n")).agg(F.max("n")).head()[0]
        if most is None:
            return reduce(DataFrame.unionByName, done)
        judged = materialize(_round(rows, live, most > FOLD_ROWS), "settle_round")
        done.append(judged.where(F.col("outcome").isin(OK, LIMIT, BALANCE)).select("request_id", "outcome"))
        state = F.when(F.col("outcome") == OK, 1).when(F.col("outcome") == REFUSED, 2).otherwise(0)
        # Only what later open requests have to know of is carried on.
        rows = judged.where(F.col("outcome").isNull() | F.col("outcome").isin(OK, REFUSED)).withColumn("state", state).drop("outcome")


def _round(rows: DataFrame, live: bool, long: bool) -> DataFrame:
    """The rows of state 0 and 2 with their budgets as far as they are known, and the ``outcome`` where it is certain.

    ``long``: some sender has more open rows than one fold takes.
    """
    order, names = ["requested_at", "request_id"], [c for c in rows.columns if c != "state"]
    zero, open_, accepted = F.lit(0).cast("long"), F.col("state") == 0, F.col("state") == 1
    net = F.col("credited") - F.col("amount") if live else -F.col("amount")
    own = F.col("src").eqNullSafe(F.col("dst")) if live else F.lit(False)
    delta = F.when(own, net).otherwise(-F.col("amount"))
    event = lambda account, paid, fixed, low, high, waits: F.struct(
        account.alias("account"), F.lit(paid).alias("paid"), fixed.alias("fixed"), low.alias("low"), high.alias("high"), waits.alias("waits"))
    events = [event(F.col("src"), True, F.when(accepted, delta).otherwise(zero), F.when(open_, F.least(delta, zero)).otherwise(zero),
                    F.when(open_, F.greatest(delta, zero)).otherwise(zero), (open_ & own).cast("long"))]
    if live:
        credit = event(F.col("dst"), False, F.when(accepted, F.col("credited")).otherwise(zero), zero,
                       F.when(open_, F.col("credited")).otherwise(zero), open_.cast("long"))
        events.append(F.when(F.col("dst_hard") & ~own & (F.col("state") != 2), credit))
    moved = rows.select("*", F.explode(F.filter(F.array(*events), lambda e: e.isNotNull())).alias("e")).select(*names, "state", "e.*")
    moved = prefix_sums(moved, order, {c: F.col(c) for c in ("fixed", "low", "high", "waits")}, partition_by=["account"], replace=True)
    mine = prefix_sums(moved.where("paid"), order, {
        "fixed_kzt": F.when(accepted, F.col("kzt")).otherwise(zero), "open_kzt": F.when(open_, F.col("kzt")).otherwise(zero)},
        partition_by=["sender_id", "day"]).where(~accepted)
    mine = (mine.withColumn("balance", F.col("balance") + F.col("fixed")).withColumn("spent", F.col("spent") + F.col("fixed_kzt"))
            .withColumn("blocked", F.col("src_hard") & (F.col("waits") > 0)))
    if long:
        mine = prefix_sums(mine, order, {"place": open_.cast("long")}, partition_by=["sender_id"])
    below, above = F.col("spent") + F.col("open_kzt") + F.col("kzt") <= F.col("most"), F.col("spent") + F.col("kzt") > F.col("most")
    covered = ~F.col("src_hard") | (F.col("balance") + F.col("low") >= F.col("amount"))
    short = F.col("src_hard") & (F.col("balance") + F.col("high") < F.col("amount"))
    sure = (F.when(above, LIMIT).when(below & ((F.col("state") == 2) | short), BALANCE)
            .when(open_ & below & covered, OK).when(open_ & short, REFUSED).when(F.col("state") == 2, REFUSED))
    turn = open_ & (F.col("place") < FOLD_ROWS) if long else open_
    folded = _folded(mine.where(turn)).select(F.col("request_id").alias("__fid"), F.col("outcome").alias("__out"))
    judged = mine.withColumn("sure", sure).join(folded, F.col("request_id") == F.col("__fid"), "left")
    return judged.select(*names, F.coalesce("__out", "sure").alias("outcome"))


def _folded(rows: DataFrame) -> DataFrame:
    """(request_id, outcome) of rows whose budgets but for each other are known: each sender's in order, up to the first blocked one."""
    rows = rows.withColumn("day", F.coalesce("day", F.lit("0001-01-01").cast("date")))
    each = F.struct(F.col("requested_at").isNull().alias("late"), "requested_at", "request_id", "src", "day", "amount", "kzt",
                    "balance", "spent", "most", "src_hard", "blocked")
    first = rows.groupBy("sender_id").agg(F.array_sort(F.collect_list(each)).alias("r"), F.collect_set("src").alias("accounts"),
                                          F.collect_set("day").alias("days"))
    out = F.arrays_zip(F.transform("r", lambda x: x["request_id"]).alias("id"), _fold().alias("out"))
    return first.select(F.explode(out).alias("f")).select(F.col("f.id").alias("request_id"), F.col("f.out").alias("outcome"))


def _fold() -> Column:
    """Outcomes of the sorted requests ``r`` of one sender with its ``accounts`` and ``days``; null from the first blocked one on."""
    zeros = lambda a: F.transform(a, lambda _: F.lit(0).cast("long"))
    turns = F.transform("r", lambda x: F.struct(x.alias("x"), (F.array_position("accounts", x["src"]).cast("int") - 1).alias("a"),
                                                (F.array_position("days", x["day"]).cast("int") - 1).alias("d")))

    def told(s, t):
        """Appends the outcome of a request."""
        x, over = t["x"], s["over"] | t["x"]["blocked"]
        out = (F.when(over, F.lit(None).cast("string"))
               .when(x["spent"] + F.get(s["spent"], t["d"]) + x["kzt"] > x["most"], LIMIT)
               .when(x["src_hard"] & (x["balance"] - F.get(s["used"], t["a"]) < x["amount"]), BALANCE).otherwise(OK))
        return F.struct(s["used"].alias("used"), s["spent"].alias("spent"), F.array_append(s["out"], out).alias("out"), over.alias("over"))

    def paid(s, t):
        """Charges the request whose outcome was appended last."""
        served = F.element_at(s["out"], -1).eqNullSafe(F.lit(OK))
        plus = lambda array, at, value: F.when(served, F.transform(array, lambda v, i: v + F.when(i == at, value).otherwise(0))).otherwise(array)
        return F.struct(plus(s["used"], t["a"], t["x"]["amount"]).alias("used"), plus(s["spent"], t["d"], t["x"]["kzt"]).alias("spent"),
                        s["out"].alias("out"), s["over"].alias("over"))

    start = F.struct(zeros("accounts").alias("used"), zeros("days").alias("spent"), F.array().cast("array<string>").alias("out"), F.lit(False).alias("over"))
    twice = F.flatten(F.transform(turns, lambda t: F.array(F.struct(t.alias("t"), F.lit(False).alias("pay")), F.struct(t.alias("t"), F.lit(True).alias("pay")))))
    return F.aggregate(twice, start, lambda s, y: F.when(y["pay"], paid(s, y["t"])).otherwise(told(s, y["t"])))["out"]
