"""Continuously refreshed daily transaction report (Structured Streaming).

Events arrive as Parquet files. Per (day, type) the stream keeps count and
total; each micro-batch emits the groups it changed (update mode) and
``foreachBatch`` writes the days that they belong to, no other: the report is
partitioned by day and, within a day, by the batch that wrote it; the newest
batch of a day is that day's report. Re-running a batch after a failure or a
restart rewrites the same partitions (idempotent). Late files count: there is no watermark by default,
as the state is one row per (day, type) and so stays small by itself. A job
that must bound it passes one and accepts that older rows are dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import file_system, storage_root


# Default micro-batch size in files: bounds the rows one trigger (and one key's
# state update) handles, whatever the backlog.
FILES_PER_TRIGGER = 64


def event_stream(spark: SparkSession, path: str, schema: T.StructType,
                 files_per_trigger: int | None = FILES_PER_TRIGGER) -> DataFrame:
    """Stream the Parquet files of a table.

    A table stored as a folder is streamed as is; a table stored as one file is streamed from its folder with a file-name filter (the file source
    only accepts folders).
    """
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    fs, hadoop = file_system(spark, path)
    if not set("*?[{") & set(path) and fs.exists(hadoop) and fs.getFileStatus(hadoop).isFile():
        folder, _, name = path.rpartition("/")
        return reader.option("pathGlobFilter", name).parquet(folder)
    return reader.parquet(path)


def daily_aggregates(events: DataFrame, watermark: str | None = None) -> DataFrame:
    """Per (UTC day, event type): count and decimal total."""
    ts = F.col("ts").cast("timestamp")  # watermarks need TIMESTAMP, not TIMESTAMP_NTZ
    timed = events.withColumn("event_time", ts)
    if watermark:
        timed = timed.withWatermark("event_time", watermark)
    return (timed
            .groupBy(F.window("event_time", "1 day").alias("day"), "event_type")
            .agg(F.count(F.lit(1)).alias("events"),
                 F.sum(F.col("value").cast("decimal(18,2)")).alias("total_value"))
            .select(F.to_date(F.col("day.start")).alias("event_date"), "event_type", "events", "total_value"))


def upsert_batch(root: str, keys: list[str], last: list[int]):
    """foreachBatch handler: the report after batch N is the report after
    batch N-1 with the keys present in batch N replaced.

    Each version is written to a fixed path per batch id, so a re-run batch
    (after a failure or a driver restart) reads the same previous version and
    overwrites the same output: idempotent, and nothing lives only in the
    driver. Only batch 0 has no predecessor; a missing or unreadable version
    raises. Versions before the previous one are deleted: a re-run never needs them.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()  # read twice below
        try:
            merged = batch
            if batch_id > 0:
                previous = spark.read.schema(batch.schema).parquet(f"{root}/batch={batch_id - 1}")
                merged = previous.join(batch.select(*keys), keys, "left_anti").unionByName(batch)
            merged.write.mode("overwrite").parquet(f"{root}/batch={batch_id}")
        finally:
            batch.unpersist()
        fs, old = file_system(spark, f"{root}/batch={batch_id - 2}")
        if batch_id >= 2 and fs.exists(old):
            fs.delete(old, True)
        last.append(batch_id)

    return handle


def replace_days(root: str, day: str, keys: list[str]):
    """foreachBatch handler: a new version of each day that batch N changed, at ``root/day=D/batch=N``.

    The groups of the batch replace those of the same keys; the day's other
    groups are read from its newest earlier version, of these days alone. So
    what a batch reads and writes follows the days that it changed, however long
    the report is. A day's older versions are deleted once two newer ones
    exist (a re-run reads the one before).
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()  # read twice below
        try:
            days = [r[0] for r in batch.select(day).distinct().collect()]  # bounded by the files of a trigger
            fs, top = file_system(spark, root)
            merged, versions = batch, {}
            for d in days:
                _, folder = file_system(spark, f"{root}/{day}={d}")
                found = [s.getPath() for s in fs.listStatus(folder)] if fs.exists(folder) else []
                versions[d] = sorted((int(p.getName().partition("=")[2]), str(p.toString())) for p in found if p.getName().startswith("batch="))
            older = [max(v for v in versions[d] if v[0] < batch_id)[1] for d in days if any(v[0] < batch_id for v in versions[d])]
            if older:
                previous = spark.read.option("basePath", root).schema(batch.schema).parquet(*older).select(*batch.columns)
                merged = previous.join(batch.select(*keys), keys, "left_anti").unionByName(batch)
            (merged.withColumn("batch", F.lit(batch_id).cast("long")).repartition(day).write.partitionBy(day, "batch")
             .option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(root))
        finally:
            batch.unpersist()
        for d in days:
            for _, path in sorted(v for v in versions[d] if v[0] < batch_id)[:-1]:
                fs.delete(file_system(spark, path)[1], True)

    return handle


def read_days(spark: SparkSession, root: str, day: str, schema: T.StructType) -> DataFrame:
    """The newest version of every day."""
    stored = spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.LongType())])).parquet(root)
    newest = stored.groupBy(F.col(day).alias("__day")).agg(F.max("batch").alias("__batch"))
    return (stored.join(newest, F.col(day).eqNullSafe(F.col("__day")) & (F.col("batch") == F.col("__batch")))
            .select(*schema.names))


def run_daily_report(spark: SparkSession, path: str, schema: T.StructType, root: str | None = None,
                     files_per_trigger: int | None = FILES_PER_TRIGGER) -> DataFrame:
    """Run the stream over every file available now, then return the report.

    ``root`` is where report versions and the stream checkpoint live (pass
    the same folder to resume a stream); by default a fresh folder under the
    shared checkpoint folder.
    """
    root = root or storage_root(spark, "stream_daily_report")
    report = daily_aggregates(event_stream(spark, path, schema, files_per_trigger))
    query = (report.writeStream.outputMode("update")
             .option("checkpointLocation", f"{root}/_checkpoint")
             .foreachBatch(replace_days(f"{root}/report", "event_date", ["event_date", "event_type"]))
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    fs, stored = file_system(spark, f"{root}/report")
    if not fs.exists(stored):  # nothing has ever arrived
        return spark.createDataFrame([], report.schema)
    return read_days(spark, f"{root}/report", "event_date", report.schema)
