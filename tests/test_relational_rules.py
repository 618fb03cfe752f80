"""Filters, joins, aggregates, set operations and subqueries on generated rows,
each against the same rule in plain Python."""

import datetime as dt
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tessera.operators import joins as J
from tessera.operators import subqueries as Q
from tessera.operators.joins import not_in

from conftest import rows

rng = random.Random(11)
# Boats of a fictional harbour: (boat, berth, tons, registered, tow); berths and tows may be missing or unknown.
BOATS = [(i, rng.choice([1, 2, 3, 7, None]), rng.choice([None, 5, 8, 8, 13, 21, 34]),
          dt.date(2001, 1, 1) + dt.timedelta(days=rng.randrange(6000)), rng.choice([None, *range(1, 25)]))
         for i in range(1, 25)]
BERTHS = [(1, "north mole"), (2, "fish quay"), (3, "old dock"), (4, "slipway")]
CARGO = [(k, rng.choice([1, 2, 3, 9, None]), rng.randrange(1, 90)) for k in range(40)]


@pytest.fixture(scope="module")
def harbour(spark):
    boats = spark.createDataFrame(BOATS, "boat int, berth int, tons int, registered date, tow int")
    berths = spark.createDataFrame(BERTHS, "berth int, name string")
    cargo = spark.createDataFrame(CARGO, "crate int, berth int, weight int")
    return boats, berths, cargo


def ids(df):
    return sorted(r[0] for r in df.select("boat").collect())


def test_filters_treat_null_as_unknown(harbour):
    boats, _, _ = harbour
    cut = dt.date(2008, 1, 1)
    assert ids(boats.where(F.col("registered") > F.lit(cut))) == [b[0] for b in BOATS if b[3] > cut]
    assert ids(boats.where(F.col("tons").between(8, 21))) == [b[0] for b in BOATS if b[2] and 8 <= b[2] <= 21]
    both = (F.col("berth") == 2) & (F.col("tons") > 5)
    assert ids(boats.where(both)) == ids(boats.where((F.col("tons") > 5) & (F.col("berth") == 2)))
    assert ids(boats.where(~(F.col("berth") == 2))) == [b[0] for b in BOATS if b[1] not in (2, None)]


def test_join_kinds(harbour):
    boats, berths, _ = harbour
    names = dict(BERTHS)
    inner = [(b[0], names[b[1]]) for b in BOATS if b[1] in names]
    assert rows(boats.join(berths, "berth"), "boat", "name") == inner
    assert rows(J.natural_join(boats, berths), "boat", "name") == inner
    left = boats.join(berths, "berth", "left")
    assert left.count() == len(BOATS) and left.where("name IS NULL").count() == len(BOATS) - len(inner)
    used = {b[1] for b in BOATS}
    empty = [x for x in names if x not in used]
    assert boats.join(berths, boats["berth"] == berths["berth"], "full").count() == len(BOATS) + len(empty)
    b, n = boats.withColumnRenamed("berth", "bb"), berths.withColumnRenamed("berth", "nb")
    lonely = J.full_unmatched(b, n, "bb", "nb")
    assert lonely.count() == len(BOATS) - len(inner) + len(empty)
    with pytest.raises(ValueError):
        J.natural_join(boats.select("boat"), berths)


def test_predicate_in_on_keeps_rows_that_where_drops(harbour):
    boats, berths, _ = harbour
    on = boats.join(berths, (boats["berth"] == berths["berth"]) & (berths["name"] == "no such berth"), "left")
    assert on.count() == len(BOATS) and on.where("name IS NOT NULL").count() == 0
    where = boats.join(berths, "berth", "left").where(F.col("name") == "no such berth")
    assert where.count() == 0


def test_fanout_totals_equal_the_chained_join(harbour):
    boats, berths, cargo = harbour
    chained = (berths.join(boats, berths["berth"] == boats["berth"], "left")
               .join(cargo, berths["berth"] == cargo["berth"], "left").groupBy(berths["berth"])
               .agg(F.count(boats["boat"]).alias("boats"), F.sum(cargo["weight"]).alias("weight"),
                    F.count(F.lit(1)).alias("joined_rows")))
    derived = J.fanout_totals(berths.select("berth"), "berth", {
        "b": (boats, "berth", {"boats": ("count", F.col("boat"))}),
        "c": (cargo, "berth", {"weight": ("sum", F.col("weight"))}),
    })
    cols = ("berth", "boats", "weight", "joined_rows")
    key = lambda r: tuple(-1 if x is None else x for x in r)
    plain = lambda df: sorted((tuple(r[c] for c in cols) for r in df.collect()), key=key)
    assert plain(derived) == plain(chained)


def test_pairs_and_tows(harbour):
    boats, _, _ = harbour
    n = Counter(b[1] for b in BOATS if b[1] is not None)
    got = {r["berth"]: r["pair_count"] for r in J.pair_counts(boats, "berth").collect()}
    assert {k: v for k, v in got.items() if v} == {k: v * (v - 1) // 2 for k, v in n.items() if v > 1}
    other = boats.select(F.col("boat").alias("tug"), F.col("tow").alias("tug_tow"))
    towed = boats.join(other, boats["tow"] == other["tug"], "left")
    tows = {b[0]: b[4] for b in BOATS}
    assert rows(towed.where("tug_tow IS NOT NULL"), "boat", "tug_tow") == sorted(
        (b, tows[t]) for b, t in tows.items() if t and tows[t])


def test_aggregates_and_sets(harbour):
    boats, _, cargo = harbour
    weights = defaultdict(list)
    for _, berth, w in CARGO:
        weights[berth].append(w)
    having = cargo.groupBy("berth").agg(F.sum("weight").alias("w"), F.count_distinct("crate").alias("n")).where("w > 200")
    want = {(k, sum(v), len(v)) for k, v in weights.items() if sum(v) > 200}
    assert {tuple(r) for r in having.collect()} == want
    heavy, early = boats.where("tons > 8").select("boat"), boats.where(F.year("registered") < 2008).select("boat")
    a, b = {x[0] for x in BOATS if x[2] and x[2] > 8}, {x[0] for x in BOATS if x[3].year < 2008}
    assert ids(heavy.union(early).distinct()) == sorted(a | b)
    assert ids(heavy.intersect(early)) == sorted(a & b) and ids(heavy.subtract(early)) == sorted(a - b)


def test_any_rank_and_top1(harbour):
    boats, _, _ = harbour
    seven = boats.where("berth = 7")
    least = min(b[2] for b in BOATS if b[1] == 7 and b[2])
    assert ids(Q.greater_than_any(boats, "tons", seven, "tons")) == [b[0] for b in BOATS if b[2] and b[2] > least]
    assert ids(Q.greater_than_any(boats, "tons", seven.where(F.lit(False)), "tons")) == []
    got = {r["boat"]: r["rank"] for r in Q.rank_within(boats, "berth", "tons", "rank").collect()}
    for boat, berth, tons, *_ in BOATS:
        more = sum(1 for b in BOATS if None not in (berth, tons, b[2]) and b[1] == berth and b[2] > tons)
        assert got[boat] == 1 + more


def test_top1_null_sorts_first_and_ties(spark):
    df = spark.createDataFrame([("p", 1, 2.5), ("p", 2, None), ("q", 9, 4.0), ("q", 12, 4.0)], "g string, id int, v double")
    assert rows(Q.top1_per_group(df, "g", "v", "id", ["id"]), "g", "id") == [("p", 2), ("q", 9)]


def test_not_in_and_in_flag_follow_three_valued_logic(spark):
    left = spark.createDataFrame([(4,), (6,), (None,)], "k int")
    for listed, kept in (([4, None], []), ([4, 4], [6]), ([], [4, 6, None])):
        right = spark.createDataFrame([(x,) for x in listed], "r int")
        assert sorted((r[0] for r in not_in(left, "k", right, "r").collect()), key=str) == sorted(kept, key=str)
    flag = lambda listed: {r["k"]: r["f"] for r in Q.in_subquery_flag(
        left, "k", spark.createDataFrame([(x,) for x in listed], "s int"), "s", "f").collect()}
    assert flag([4, None]) == {4: True, 6: None, None: None}
    assert flag([4]) == {4: True, 6: False, None: None}


def test_full_join_without_a_full_outer_join(spark):
    """Equal to Spark's own, with hot, missing and NULL keys on both sides; no side of a hot key is one task's."""
    import random

    from tessera.operators.joins import full_join

    rnd = random.Random(6)
    for size in (0, 7, 300):
        a = spark.createDataFrame([(n, rnd.choice([None, 1, 1, 1, *range(2, 40)]), rnd.choice([None, "x", "y"])) for n in range(size)], "a int, k int, s string")
        b = spark.createDataFrame([(n, rnd.choice([None, 1, *range(20, 60)]), rnd.choice([None, "x", "y"])) for n in range(size // 2)], "b int, k2 int, s2 string")
        for left, right in ((["k"], ["k2"]), (["k", "s"], ["k2", "s2"])):
            got = full_join(a, b, left, right)
            want = a.join(b, [F.col(x) == F.col(y) for x, y in zip(left, right)], "full")
            key = lambda r: tuple((x is None, str(x)) for x in r)
            assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, want.collect()), key=key)
            assert "FullOuter" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_bucketed_tables_join_without_a_shuffle(spark):
    from tessera.sources import sinks

    a = spark.range(2000).selectExpr("id AS k", "id * 2 AS v")
    b = spark.range(500).selectExpr("id * 3 AS k2", "id AS w")
    ta, tb = sinks.write_bucketed(a, spark, "left", ["k"], 4), sinks.write_bucketed(b, spark, "right", ["k2"], 4)
    joined = spark.table(ta).hint("merge").join(spark.table(tb), F.col("k") == F.col("k2"))
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert joined.count() == a.join(b, F.col("k") == F.col("k2")).count() == 500
    for name in (ta, tb):
        spark.sql(f"DROP TABLE {name}")
