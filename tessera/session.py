"""Spark session construction and shared storage locations.

On a cluster the session is created by the platform; ``configure`` only adds
SQL settings that are safe to set at runtime. Lineage cuts and materialized
outputs go under the cluster's ``spark.checkpoint.dir``; a private scratch
directory is used only when that setting is absent (local runs and tests).
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings: AQE re-plans joins (broadcast when a side turns out
# small, skew splitting when a partition is hot) and coalesces small shuffle
# partitions; timestamps are compared in UTC like the DuckDB oracle.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def configure(spark: SparkSession, extra: dict[str, str] | None = None) -> SparkSession:
    """Apply the runtime settings (and optional ``sizing`` ones) to a session."""
    for key, value in {**RUNTIME_CONF, **(extra or {})}.items():
        spark.conf.set(key, value)
    return spark


def build_session(master: str | None = None, app: str = "tessera",
                  shuffle_partitions: int | None = None) -> SparkSession:
    """Local/test session. On a cluster use the provided session + ``configure``."""
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    parts = shuffle_partitions or int(os.environ.get("TESSERA_SHUFFLE_PARTITIONS", "8"))
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", str(parts))
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster, else a scratch one.

    Only when ``spark.checkpoint.dir`` is unset and the master is local (tests,
    local runs) is a directory of our own chosen, registered with the context
    and removed at exit; a cluster without a shared folder raises.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if sc.master != "local" and not sc.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="tessera-ckpt-")
    atexit.register(shutil.rmtree, local, ignore_errors=True)
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def shared_root(spark: SparkSession) -> str:
    """The folder that outlives this application: the configured checkpoint folder, else the scratch one."""
    return spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or checkpoint_root(spark)


def file_system(spark: SparkSession, path: str):
    """(Hadoop file system, Hadoop path) of a path, whatever store it is in."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def release(spark: SparkSession) -> None:
    """Delete what this application has written with ``storage_root``; for the end of a job."""
    fs, path = file_system(spark, checkpoint_root(spark).rstrip("/") + "/tessera")
    fs.delete(path, True)


def storage_root(spark: SparkSession, area: str) -> str:
    """A fresh directory under the shared checkpoint folder for written tables."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/tessera/{area}/{uuid.uuid4().hex}"


def materialize(df, area: str = "materialized"):
    """Compute ``df`` once and cut its lineage: a written table in the shared folder.

    For an intermediate result that several branches of a plan read: without
    it every branch recomputes the joins below it. One job writes Parquet
    under the cluster's checkpoint folder (a plain ``checkpoint()`` would run
    the plan twice, once to count and once to write); the returned frame scans
    that table, so a lost executor costs a re-read, not a recomputation, and
    later filters still reach the scan.
    """
    spark = df.sparkSession
    path = storage_root(spark, area)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sizing(input_bytes: int, target_partition_bytes: int = 1 << 30,
           max_split_bytes: int = 512 << 20, max_partitions: int | None = 1 << 17) -> dict[str, str]:
    """Runtime SQL settings for a job reading ``input_bytes`` of Parquet.

    Scan splits of up to ``max_split_bytes`` keep the task count manageable
    (100 TB -> ~200k scan tasks). The initial shuffle partition count gives
    about ``target_partition_bytes`` per reducer, capped so map x reduce
    blocks stay tractable (100 TB -> 131,072). AQE then coalesces small
    partitions towards 256 MB and splits skewed ones above 1 GB, so reducers
    fit in executor memory and spill only under heavy skew. Apply with
    ``configure(spark, sizing(...))``.
    """
    wanted = max(1, input_bytes // target_partition_bytes)
    partitions = max(8, 1 << wanted.bit_length())
    if max_partitions:
        partitions = min(max_partitions, partitions)
    return {
        "spark.sql.files.maxPartitionBytes": str(max_split_bytes),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 << 20),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1 << 30),
    }
