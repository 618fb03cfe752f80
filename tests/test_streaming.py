"""Streams equal their batch counterparts, fed in several micro-batches."""

import os
import tempfile

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators.windows import MICROS_PER_MINUTE, previous_max
from tessera.streaming.daily_report import run_daily_report
from tessera.streaming.rapid import run_rapid_alerts, run_rapid_alerts_by_table

from conftest import rows

SF = "/root/testdata/sf0.01"


def _split_by_time(spark, files=6):
    """Write the events as several files in time order (arrivals in id order)."""
    events = spark.read.parquet(f"{SF}/events.parquet")
    folder = tempfile.mkdtemp(prefix="tessera-stream-")
    bounds = events.select(F.ntile(files).over(Window.orderBy("event_id")).alias("part"), "*")
    for i in range(1, files + 1):
        bounds.where(F.col("part") == i).drop("part").coalesce(1).write.parquet(os.path.join(folder, f"part={i:02d}"))
    return folder, events


def test_daily_report_stream_equals_batch(spark):
    folder, events = _split_by_time(spark)
    out = run_daily_report(spark, folder + "/*", events.schema, files_per_trigger=1)
    batch = events.groupBy(F.to_date("ts").alias("event_date"), "event_type").agg(
        F.count(F.lit(1)).alias("events"), F.sum(F.col("value").cast("decimal(18,2)")).alias("total_value"))
    cols = ("event_date", "event_type", "events", "total_value")
    assert rows(out, *cols) == rows(batch, *cols)


def test_rapid_stream_equals_batch(spark):
    folder, events = _split_by_time(spark)
    out = run_rapid_alerts(spark, folder + "/*", events.schema, MICROS_PER_MINUTE, files_per_trigger=1)
    prev = previous_max(events, "user_id", "event_id", "ts", "m")
    batch = prev.where(F.col("m") > F.col("ts") - F.expr("INTERVAL 1 MINUTE"))
    assert rows(out, "event_id", "user_id") == rows(batch, "event_id", "user_id")
    assert out.count() > 0


def test_rapid_by_state_table_equals_batch(spark):
    folder, events = _split_by_time(spark)
    out = run_rapid_alerts_by_table(spark, folder + "/*", events.schema, MICROS_PER_MINUTE, files_per_trigger=2)
    prev = previous_max(events, "user_id", "event_id", "ts", "m")
    batch = prev.where(F.col("m") > F.col("ts") - F.expr("INTERVAL 1 MINUTE"))
    assert rows(out, "event_id", "user_id") == rows(batch, "event_id", "user_id")


def test_daily_report_resumes_from_its_folder(spark):
    events = spark.read.parquet(f"{SF}/events.parquet")
    parts = events.select(F.ntile(4).over(Window.orderBy("event_id")).alias("part"), "*")
    source = tempfile.mkdtemp(prefix="tessera-resume-src-")
    root = tempfile.mkdtemp(prefix="tessera-resume-out-")
    for i in (1, 2):
        parts.where(F.col("part") == i).drop("part").coalesce(1).write.parquet(os.path.join(source, f"part={i}"))
    run_daily_report(spark, source + "/*", events.schema, root=root, files_per_trigger=1)
    for i in (3, 4):  # new files arrive; a new run resumes from the same checkpoint and versions
        parts.where(F.col("part") == i).drop("part").coalesce(1).write.parquet(os.path.join(source, f"part={i}"))
    out = run_daily_report(spark, source + "/*", events.schema, root=root, files_per_trigger=1)
    again = run_daily_report(spark, source + "/*", events.schema, root=root)  # nothing new: same report
    batch = events.groupBy(F.to_date("ts").alias("event_date"), "event_type").agg(
        F.count(F.lit(1)).alias("events"), F.sum(F.col("value").cast("decimal(18,2)")).alias("total_value"))
    cols = ("event_date", "event_type", "events", "total_value")
    assert rows(out, *cols) == rows(batch, *cols)
    assert rows(again, *cols) == rows(batch, *cols)


def _shuffled(spark, files=6):
    """The events dealt to files in an order that has nothing to do with time or id, newest file first."""
    events = spark.read.parquet(f"{SF}/events.parquet")
    folder = tempfile.mkdtemp(prefix="tessera-stream-")
    for i in range(files):
        part = events.where(F.pmod(F.xxhash64("event_id"), F.lit(files)) == i)
        part.orderBy(F.desc("ts")).coalesce(1).write.parquet(os.path.join(folder, f"part={i:02d}"))
    return folder, events


def test_late_files_count(spark):
    folder, events = _shuffled(spark)
    batch = events.groupBy(F.to_date("ts").alias("event_date"), "event_type").agg(
        F.count(F.lit(1)).alias("events"), F.sum(F.col("value").cast("decimal(18,2)")).alias("total_value"))
    cols = ("event_date", "event_type", "events", "total_value")
    assert rows(run_daily_report(spark, folder + "/*", events.schema, files_per_trigger=1), *cols) == rows(batch, *cols)
    prev = previous_max(events, "user_id", "event_id", "ts", "m")
    alerts = prev.where(F.col("m") > F.col("ts") - F.expr("INTERVAL 1 MINUTE"))
    out = run_rapid_alerts_by_table(spark, folder + "/*", events.schema, MICROS_PER_MINUTE, files_per_trigger=1)
    assert rows(out, "event_id", "user_id") == rows(alerts, "event_id", "user_id")


def test_a_missing_previous_version_raises(spark):
    import pytest

    from tessera.streaming.daily_report import upsert_batch

    root = tempfile.mkdtemp(prefix="tessera-stream-")
    batch = spark.createDataFrame([(1, 2)], "k int, v int")
    done = []
    handle = upsert_batch(root, ["k"], done)
    with pytest.raises(Exception):
        handle(batch, 3)
    assert done == []
    handle(batch, 0)
    handle(spark.createDataFrame([(1, 5), (2, 6)], "k int, v int"), 1)
    assert rows(spark.read.parquet(f"{root}/batch=1"), "k", "v") == [(1, 5), (2, 6)]


def _fifty_files(spark, folder, rows_each=40):
    rows_ = [(f, n) for f in range(50) for n in range(f * rows_each, (f + 1) * rows_each)]
    frame = spark.createDataFrame(rows_, "f int, event_id long").select(
        "f", "event_id", (F.col("event_id") % 3).alias("user_id"), F.timestamp_seconds(1_700_000_000 + F.col("event_id") * 25).cast("timestamp_ntz").alias("ts"),
        F.lit("click").alias("event_type"), F.lit(1.0).alias("value"))
    for f in range(50):
        frame.where(F.col("f") == f).drop("f").coalesce(1).write.parquet(os.path.join(folder, f"part={f:02d}"))
    return frame.drop("f")


def test_rapid_reads_stay_flat_over_fifty_batches(spark):
    folder, read = tempfile.mkdtemp(prefix="tessera-stream-"), []
    events = _fifty_files(spark, folder)
    out = run_rapid_alerts_by_table(spark, folder + "/*", events.schema, 2 * MICROS_PER_MINUTE, files_per_trigger=1, block=64, read=read)
    prev = previous_max(events, "user_id", "event_id", "ts", "m")
    batch = prev.where(F.col("m") > F.col("ts") - F.expr("INTERVAL 2 MINUTES"))
    assert rows(out, "event_id", "user_id") == rows(batch, "event_id", "user_id") and out.count() > 0
    assert len(read) == 50 and max(read[25:]) <= max(read[5:25]) <= 3 * 64


def test_daily_report_writes_only_changed_days(spark):
    from tessera.streaming.daily_report import read_days, replace_days

    root = tempfile.mkdtemp(prefix="tessera-days-") + "/report"
    schema = "d date, k string, n long"
    batches = [[("2024-01-01", "a", 1), ("2024-01-01", "b", 2)], [("2024-01-02", "a", 3)], [("2024-01-01", "a", 5)],
               [("2024-01-03", "a", 1)], [("2024-01-01", "c", 9), ("2024-01-03", "a", 2)]]
    frames = [spark.createDataFrame(b, "d string, k string, n long").withColumn("d", F.col("d").cast("date")) for b in batches]
    handle, want = replace_days(root, "d", ["d", "k"]), {}

    def state():
        return {(str(r["d"]), r["k"]): r["n"] for r in read_days(spark, root, "d", frames[0].schema).collect()}

    def files():
        return {os.path.join(top, f): os.stat(os.path.join(top, f)).st_mtime_ns for top, _, names in os.walk(root) for f in names if f.endswith(".parquet")}

    for i, frame in enumerate(frames):
        before = files() if i else {}
        handle(frame, i)
        want |= {(d, k): n for d, k, n in batches[i]}
        assert state() == want
        touched = {d for d, _, _ in batches[i]}
        new = {f for f, at in files().items() if before.get(f) != at}
        assert new and all(any(f"d={d}/batch={i}/" in f for d in touched) for f in new)
        handle(frame, i)  # a re-run changes nothing
        assert state() == want
    assert len({f.split("batch=")[1].split("/")[0] for f in files() if "d=2024-01-01" in f}) == 2  # the newest and the one before
