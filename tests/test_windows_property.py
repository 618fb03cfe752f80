"""Property tests: random small inputs (NULL keys and times, ties, tight
buckets) give the same answers as plain Spark windows."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators.windows import band_count, prefix_sum, previous_max

from conftest import rows

BASE = dt.datetime(2024, 1, 1)
ROW = st.tuples(st.one_of(st.none(), st.integers(0, 3)),
                st.one_of(st.none(), st.integers(0, 6 * 3600)),
                st.integers(-5, 20))
FRAMES = st.lists(ROW, min_size=1, max_size=40)
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def _frame(spark, data):
    rows_ = [(i, k, None if s is None else BASE + dt.timedelta(seconds=s), v) for i, (k, s, v) in enumerate(data)]
    return spark.createDataFrame(rows_, "id long, k long, ts timestamp_ntz, v long")


@SETTINGS
@given(data=FRAMES, band_min=st.integers(1, 90))
def test_band_count_property(spark, data, band_min):
    df = _frame(spark, data)
    band = band_min * 60_000_000
    got = band_count(df, "k", "ts", band, band // 2, "n", bucket_us=band)
    w = Window.partitionBy("k").orderBy("__t").rangeBetween(-band, band // 2)
    want = (df.withColumn("__t", F.unix_micros(F.col("ts").cast("timestamp")))
            .withColumn("n", F.when(F.col("k").isNotNull() & F.col("ts").isNotNull(), F.count(F.lit(1)).over(w))))
    assert rows(got, "id", "n") == rows(want, "id", "n")


@SETTINGS
@given(data=FRAMES)
def test_previous_max_and_prefix_sum_property(spark, data):
    df = _frame(spark, data)
    got = previous_max(df, "k", "id", "v", "m", block=3)
    w = Window.partitionBy("k").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    want = df.withColumn("m", F.when(F.col("k").isNotNull(), F.max("v").over(w)))
    assert rows(got, "id", "m") == rows(want, "id", "m")
    got_s = prefix_sum(df, ["v"], "id", "s", partition_by=["k"], descending=True)
    want_s = df.withColumn("s", F.sum("id").over(Window.partitionBy("k").orderBy(F.col("v").desc())))
    assert rows(got_s, "id", "s") == rows(want_s, "id", "s")
