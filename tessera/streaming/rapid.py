"""Rapid-sequence alerts with per-account state (Structured Streaming).

For every event the rule asks whether an earlier id of the same account has a
time later than ``t - gap``. The state per account is a single value: the
latest time seen so far. Within a micro-batch the rows of an account are
taken in id order, so for id-ordered arrivals the alerts equal the batch
result; an id that arrives after a higher id is compared with a maximum that
already includes the higher one (documented divergence for late arrivals).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tessera.session import file_system, storage_root
from tessera.streaming.daily_report import FILES_PER_TRIGGER, event_stream

ALERT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("user_id", T.LongType()),
])
STATE_SCHEMA = T.StructType([T.StructField("latest_us", T.LongType())])


def _alerts(gap_us: int):
    def update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        latest = state.get[0] if state.exists else None
        rows = pd.concat(list(batches), ignore_index=True).sort_values("event_id", kind="stable")
        flagged_ids = []
        for event_id, t_us in zip(rows["event_id"].tolist(), rows["t_us"].tolist()):
            if t_us is None or pd.isna(t_us):
                continue
            if latest is not None and latest > t_us - gap_us:
                flagged_ids.append(event_id)
            latest = t_us if latest is None else max(latest, t_us)
        if latest is not None:
            state.update((int(latest),))
        yield pd.DataFrame({"event_id": pd.Series(flagged_ids, dtype="int64"),
                            "user_id": pd.Series([key[0]] * len(flagged_ids), dtype="int64")})

    return update


def rapid_alerts(events: DataFrame, gap_us: int) -> DataFrame:
    """Streaming alerts keyed by account, state = latest event time (microseconds)."""
    staged = events.select("event_id", "user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("t_us"))
    return staged.groupBy("user_id").applyInPandasWithState(
        _alerts(gap_us), ALERT_SCHEMA, STATE_SCHEMA, "append", GroupStateTimeout.NoTimeout)


def run_rapid_alerts(spark: SparkSession, path: str, schema: T.StructType, gap_us: int,
                     files_per_trigger: int | None = FILES_PER_TRIGGER) -> DataFrame:
    """Run over every file available now into a Parquet sink; return the alerts."""
    out = storage_root(spark, "stream_rapid")
    query = (rapid_alerts(event_stream(spark, path, schema, files_per_trigger), gap_us)
             .writeStream.outputMode("append").format("parquet")
             .option("path", out)
             .option("checkpointLocation", storage_root(spark, "stream_checkpoints"))
             .trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return spark.read.schema(ALERT_SCHEMA).parquet(out)


#: Ids of a block of the history; a batch reads the blocks that it touches whole.
BLOCK_IDS = 1 << 17


def affected_blocks(known: DataFrame, new: DataFrame, gap_us: int) -> DataFrame:
    """(user_id, blk, carry) of the blocks whose alerts the new rows can change, with the latest time of the blocks before.

    ``known``: (user_id, blk, low_us, high_us) of every block including the new
    rows, ``new``: the same of the new rows alone. A block is affected if it has
    new rows, or if it stands behind a late row that is later than the gap before one of its rows.
    """
    mine = known.join(new.select(F.col("user_id").alias("__u")).distinct(), F.col("user_id") == F.col("__u"), "left_semi")
    late = new.select(F.col("user_id").alias("__u"), F.col("blk").alias("__b"), F.col("high_us").alias("new_us"))
    mine = mine.join(late, (F.col("user_id") == F.col("__u")) & (F.col("blk") == F.col("__b")), "left")
    ahead = Window.partitionBy("user_id").orderBy("blk").rowsBetween(Window.unboundedPreceding, -1)
    mine = mine.withColumns({"carry": F.max("high_us").over(ahead), "late_us": F.max("new_us").over(ahead)})
    return mine.where(F.col("new_us").isNotNull() | (F.col("late_us") > F.col("low_us") - gap_us)).select("user_id", "blk", "carry")


def rapid_batch(root: str, gap_us: int, block: int = BLOCK_IDS, read: list[int] | None = None):
    """foreachBatch handler of ``run_rapid_alerts_by_table``; ``read`` gets how many stored rows each batch has read."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        staged = batch.select("event_id", "user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("t_us"))
        staged = staged.where(F.col("user_id").isNotNull() & F.col("t_us").isNotNull() & F.col("event_id").isNotNull())
        staged = staged.withColumn("blk", F.floor(F.col("event_id") / block)).withColumn("batch", F.lit(batch_id).cast("long"))
        staged.write.partitionBy("blk", "batch").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(f"{root}/history")
        schema = "event_id long, user_id long, t_us long, blk long, batch long"
        history = spark.read.schema(schema).parquet(f"{root}/history").where(F.col("batch") <= batch_id)
        new = (history.where(F.col("batch") == batch_id).groupBy("user_id", "blk").agg(F.min("t_us").alias("low_us"), F.max("t_us").alias("high_us")))
        known = new
        if batch_id > 0:
            known = spark.read.schema("user_id long, blk long, low_us long, high_us long").parquet(f"{root}/blocks/batch={batch_id - 1}")
            known = known.unionByName(new).groupBy("user_id", "blk").agg(F.min("low_us").alias("low_us"), F.max("high_us").alias("high_us"))
        known.write.mode("overwrite").parquet(f"{root}/blocks/batch={batch_id}")
        known = spark.read.schema("user_id long, blk long, low_us long, high_us long").parquet(f"{root}/blocks/batch={batch_id}")
        affected_blocks(known, new, gap_us).write.mode("overwrite").parquet(f"{root}/affected/batch={batch_id}")
        affected = spark.read.schema("user_id long, blk long, carry long").parquet(f"{root}/affected/batch={batch_id}")
        blocks = [r[0] for r in affected.select("blk").distinct().collect()]  # ids of a batch's blocks: the partitions to read
        at = affected.select(F.col("user_id").alias("__u"), F.col("blk").alias("__b"), "carry")
        stored = history.where(F.col("blk").isin(blocks))
        if read is not None:
            read.append(stored.count())
        rows = stored.join(at, (F.col("user_id") == F.col("__u")) & (F.col("blk") == F.col("__b")))
        local = Window.partitionBy("user_id", "blk").orderBy("event_id").rowsBetween(Window.unboundedPreceding, -1)
        before = F.greatest(F.max("t_us").over(local), F.col("carry"))
        alerts = rows.withColumn("__before", before).where(F.col("__before") > F.col("t_us") - gap_us)
        alerts.select("event_id", "user_id").write.mode("overwrite").parquet(f"{root}/alerts/batch={batch_id}")
        fs, old = file_system(spark, f"{root}/blocks/batch={batch_id - 2}")
        if batch_id >= 2 and fs.exists(old):
            fs.delete(old, True)

    return handle


def run_rapid_alerts_by_table(spark: SparkSession, path: str, schema: T.StructType, gap_us: int,
                              files_per_trigger: int | None = FILES_PER_TRIGGER, block: int = BLOCK_IDS,
                              read: list[int] | None = None) -> DataFrame:
    """The same alerts whatever the order of arrival, without per-key Python.

    The history is a table partitioned by block of ids. Beside it stands one row
    per account and block with its first and last time. A micro-batch
    (``foreachBatch``) reads the blocks that its rows can change
    (``affected_blocks``), each with the latest time of all blocks before, so what it
    reads doesn't grow with the history. More rows can only add
    alerts, so the union of all batches' alerts is the batch result, also when
    an id comes after a higher one. Everything is written per batch id at fixed
    paths, so a re-run batch overwrites its own output.
    """
    root = storage_root(spark, "stream_rapid_table")
    query = (event_stream(spark, path, schema, files_per_trigger).writeStream
             .option("checkpointLocation", storage_root(spark, "stream_checkpoints"))
             .foreachBatch(rapid_batch(root, gap_us, block, read)).trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    fs, alerts = file_system(spark, f"{root}/alerts")
    if not fs.exists(alerts):
        return spark.createDataFrame([], ALERT_SCHEMA)
    return spark.read.parquet(f"{root}/alerts").select("event_id", "user_id").distinct()
