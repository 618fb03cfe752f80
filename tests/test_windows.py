"""Pair tests: the distributed window operators against plain Spark windows
(which move a whole key, or everything, into one task) on data with NULLs,
ties and a key holding a third of the rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators.windows import band_count, global_rank, partition_total, prefix_sum, previous_max

from conftest import rows


@pytest.fixture(scope="module")
def events(spark):
    rnd = random.Random(7)
    base = dt.datetime(2024, 1, 1)
    data = []
    for i in range(3000):
        key = 0 if i % 3 == 0 else rnd.randint(1, 40)  # key 0 holds a third of the rows
        if i % 97 == 0:
            key = None
        ts = base + dt.timedelta(seconds=rnd.randint(0, 3 * 24 * 3600))
        if i % 113 == 0:
            ts = None
        data.append((i, key, ts, rnd.randint(-50, 500)))
    return spark.createDataFrame(data, "id long, k long, ts timestamp_ntz, v long")


def test_band_count_matches_range_window(events):
    hour = 3_600_000_000
    got = band_count(events, "k", "ts", hour, hour, "n", bucket_us=hour)  # narrow buckets: many edges
    t = F.unix_micros(F.col("ts").cast("timestamp"))
    w = Window.partitionBy("k").orderBy("__t").rangeBetween(-hour, hour)
    want = (events.withColumn("__t", t)
            .withColumn("n", F.when(F.col("k").isNotNull() & F.col("ts").isNotNull(), F.count(F.lit(1)).over(w))))
    assert rows(got, "id", "n") == rows(want, "id", "n")


def test_band_count_counts_only_marked_rows(events):
    minute = 60_000_000
    got = band_count(events, "k", "ts", 30 * minute, 5 * minute, "n", counted=F.col("v") > 100)
    t = F.unix_micros(F.col("ts").cast("timestamp"))
    w = Window.partitionBy("k").orderBy("__t").rangeBetween(-30 * minute, 5 * minute)
    want = (events.withColumn("__t", t)
            .withColumn("n", F.when(F.col("k").isNotNull() & F.col("ts").isNotNull(),
                                    F.count(F.when(F.col("v") > 100, 1)).over(w))))
    assert rows(got, "id", "n") == rows(want, "id", "n")


def test_previous_max_matches_rows_window(events):
    got = previous_max(events, "k", "id", "v", "m", block=7)
    w = Window.partitionBy("k").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    want = events.withColumn("m", F.when(F.col("k").isNotNull(), F.max("v").over(w)))
    assert rows(got, "id", "m") == rows(want, "id", "m")


@pytest.mark.parametrize("descending,inclusive", [(False, True), (True, True), (False, False), (True, False)])
def test_prefix_sum_matches_global_window(events, descending, inclusive):
    df = events.withColumn("d", F.to_date("ts"))
    got = prefix_sum(df, ["v"], "id", "s", descending=descending, inclusive=inclusive)
    order = F.col("v").desc_nulls_first() if descending else F.col("v").asc_nulls_last()
    w = Window.orderBy(order)  # default frame: RANGE UNBOUNDED PRECEDING .. CURRENT ROW (peers included)
    want = df.withColumn("s", F.sum("id").over(w))
    if not inclusive:
        peers = Window.partitionBy("v")
        want = want.withColumn("s", F.col("s") - F.sum("id").over(peers))
    assert rows(got, "id", "s") == rows(want, "id", "s")


def test_prefix_sum_on_dates_and_composite_key(events):
    df = events.withColumn("d", F.to_date("ts")).withColumn("g", (F.col("v") % 3).cast("int"))
    got = prefix_sum(df, ["d", "g"], "v", "s")
    want = df.withColumn("s", F.sum("v").over(Window.orderBy(F.col("d").asc_nulls_last(), F.col("g").asc_nulls_last())))
    assert rows(got, "id", "s") == rows(want, "id", "s")


def test_global_rank_matches_rank_and_weights(events, spark):
    got = global_rank(events, "v", "r", descending=True)
    want = events.withColumn("r", F.rank().over(Window.orderBy(F.col("v").desc_nulls_first())))
    assert rows(got, "id", "r") == rows(want, "id", "r")
    per_key = events.groupBy("k").agg(F.sum("v").alias("total"), F.count(F.lit(1)).alias("n"))
    weighted = global_rank(per_key, "total", "r", descending=True, weight="n")
    expanded = events.join(per_key, events["k"].eqNullSafe(per_key["k"])).select(events["id"], "total")
    want2 = expanded.withColumn("r", F.rank().over(Window.orderBy(F.col("total").desc_nulls_first())))
    got2 = expanded.join(weighted.select("total", "r"), "total")
    assert rows(got2, "id", "r") == rows(want2, "id", "r")


def test_partition_total(events):
    got = partition_total(events, "k", "v", "t")
    want = events.withColumn("t", F.sum("v").over(Window.partitionBy("k")))
    assert rows(got, "id", "t") == rows(want, "id", "t")


def test_partitioned_prefix_sum_and_rank_within(events):
    from tessera.operators.subqueries import rank_within

    got = prefix_sum(events, ["v"], "id", "s", partition_by=["k"])
    want = events.withColumn("s", F.sum("id").over(Window.partitionBy("k").orderBy(F.col("v").asc_nulls_last())))
    assert rows(got, "id", "s") == rows(want, "id", "s")
    ranked = rank_within(events, "k", "v", "r")
    w = Window.partitionBy("k").orderBy(F.col("v").desc())
    want_r = events.withColumn("r", F.when(F.col("k").isNull() | F.col("v").isNull(), 1)
                               .otherwise(F.rank().over(w)))
    assert rows(ranked, "id", "r") == rows(want_r, "id", "r")


def test_prefix_sum_rows_unique_mode(events):
    got = prefix_sum(events, ["ts", "id"], "v", "s", partition_by=["k"], rows_unique=True)
    w = Window.partitionBy("k").orderBy(F.col("ts").asc_nulls_last(), F.col("id").asc_nulls_last())
    want = events.withColumn("s", F.sum("v").over(w))
    assert rows(got, "id", "s") == rows(want, "id", "s")
    got2 = prefix_sum(events, ["id"], "v", "s", descending=True, inclusive=False, rows_unique=True)
    want2 = events.withColumn("s", F.sum("v").over(Window.orderBy(F.col("id").desc())) - F.col("v"))
    assert rows(got2, "id", "s") == rows(want2, "id", "s")


def test_band_count_of_a_crowded_key(spark, monkeypatch):
    """A key with a third of all rows within an hour is counted in two levels, with the same result as its window."""
    import random

    from tessera.operators import windows

    rnd = random.Random(2)
    start = 1_700_000_000_000_000
    data = [(n, 1, start + rnd.choice([rnd.randrange(3600), rnd.randrange(30)]) * 1_000_000 + rnd.choice([0, 0, rnd.randrange(10**6)])) for n in range(400)]
    data += [(n, 2 + n % 9, start + rnd.randrange(30 * 3600) * 1_000_000) for n in range(400, 1200)] + [(1200, None, start), (1201, 1, None)]
    frame = spark.createDataFrame(data, "n long, k int, us long").withColumn("ts", F.timestamp_micros("us").cast("timestamp_ntz"))
    spans = [(3_600_000_000, 3_600_000_000), (30_000_000, 0), (0, 500_000)]
    areas, kept = [], windows.materialize
    for before, after in spans:
        want = {n: None if k is None or us is None else sum(k == j and us - before <= v <= us + after and m % 3 > 0 for m, j, v in data if v is not None)
                for n, k, us in data}
        for crowd in (1 << 17, 20):
            monkeypatch.setattr(windows, "CROWD_ROWS", crowd)
            monkeypatch.setattr(windows, "materialize", lambda df, area: (areas.append(area), kept(df, area))[1])
            got = windows.band_count(frame, "k", "ts", before, after, "c", counted=F.col("n") % 3 > 0)
            assert {r["n"]: r["c"] for r in got.collect()} == want
    assert areas.count("band_times") == len(spans)


def test_no_task_holds_a_crowded_key(spark):
    """The window of the two-level count is split by second; a key's rows of one time are one row in it."""
    from tessera.operators.windows import _band_count_by_levels

    rows = spark.range(200_000).select(F.col("id").alias("n"), F.lit(1).alias("k"), (F.col("id") % 3600 * 1_000_000).alias("__t"), F.lit(True).alias("__counted"))
    out = _band_count_by_levels(rows, ["k"], 3_600_000_000, 3_600_000_000, "c")
    assert out.agg(F.min("c"), F.max("c"), F.count("c")).first() == (200_000, 200_000, 200_000)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" in plan and all("__s" in w or "_ob" in w or "__o0" in w or "bucket" in w for w in plan.split("\n") if "Window [" in w)
