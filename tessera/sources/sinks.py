"""Sinks: written tables, snapshots and query-shaped data layouts.

Every write goes to a fresh directory under the shared checkpoint folder
(``tessera.session``); a table "name" is a pointer file to its current
directory, so publishing a new version is one new pointer and readers never
see a half-written table.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import file_system, shared_root, storage_root
from tessera.sources.literals import cast_to_schema


class Catalog:
    """Name -> current Parquet directory, kept as files in the shared folder.

    Each publish writes the data to a fresh directory and then creates the
    next pointer file of the name (numbered; creating a file that exists
    fails, so two writers cannot both win). Readers follow the newest pointer:
    they see the old version or the new one, and a restarted driver or
    another job with the same shared folder sees the same names. A pointer
    also keeps the high-water marks of serial columns.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = shared_root(spark).rstrip("/") + "/tessera-catalog"

    @classmethod
    def of(cls, spark: SparkSession) -> Catalog:
        return cls(spark)

    def _folder(self, name: str):
        return file_system(self.spark, f"{self.root}/{quote(name, safe='')}")

    def _newest(self, name: str) -> tuple[int, dict]:
        fs, folder = self._folder(name)
        if not fs.exists(folder):
            return 0, {}
        versions = [int(x.getPath().getName()) for x in fs.listStatus(folder)]
        if not versions:
            return 0, {}
        stream = fs.open(self.spark._jvm.org.apache.hadoop.fs.Path(folder, f"{max(versions):09d}"))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return max(versions), json.loads(text)

    def _point(self, name: str, version: int, entry: dict) -> None:
        fs, folder = self._folder(name)
        stream = fs.create(self.spark._jvm.org.apache.hadoop.fs.Path(folder, f"{version:09d}"), False)
        try:
            stream.write(bytearray(json.dumps(entry).encode()))
        finally:
            stream.close()

    def publish(self, name: str, df: DataFrame, partition_by: Sequence[str] = (),
                serial: dict[str, int] | None = None) -> str:
        """Write ``df`` to a fresh directory, then point ``name`` at it."""
        return self.point_at(name, write_parquet(df, self.spark, name, partition_by, durable=True), serial)

    def point_at(self, name: str, path: str, serial: dict[str, int] | None = None) -> str:
        """Make a written directory the current version of ``name``."""
        version, old = self._newest(name)
        marks = dict(old.get("serial", {}))
        for column, value in (serial or {}).items():
            marks[column] = max(value, marks.get(column, 0))
        self._point(name, version + 1, {"path": path, "serial": marks})
        return path

    def read(self, name: str) -> DataFrame:
        entry = self._newest(name)[1]
        if not entry.get("path"):
            raise KeyError(f"table {name!r} has no data")
        return self.spark.read.parquet(entry["path"])

    def last_serial(self, name: str, column: str) -> int:
        """The highest id ever given out in a serial column, deleted rows included."""
        return self._newest(name)[1].get("serial", {}).get(column, 0)

    def drop(self, name: str, if_exists: bool = True) -> None:
        version, entry = self._newest(name)
        if not entry.get("path"):
            if not if_exists:
                raise KeyError(name)
            return
        self._point(name, version + 1, {"path": None, "serial": {}})

    def exists(self, name: str) -> bool:
        return bool(self._newest(name)[1].get("path"))


def write_parquet(df: DataFrame, spark: SparkSession, area: str,
                  partition_by: Sequence[str] = (), durable: bool = False) -> str:
    """Write to a fresh directory; a ``durable`` one outlives this application's scratch area."""
    path = f"{shared_root(spark).rstrip('/')}/tessera-tables/{quote(area, safe='')}/{uuid.uuid4().hex}" if durable \
        else storage_root(spark, area)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def ctas(df: DataFrame, spark: SparkSession, area: str, with_data: bool = True) -> DataFrame:
    """CREATE TABLE AS SELECT; ``with_data=False`` clones the structure only."""
    source = df if with_data else df.where(F.lit(False))
    path = write_parquet(source, spark, area)
    return spark.read.schema(df.schema).parquet(path)


def insert_select(target: DataFrame, rows: DataFrame) -> DataFrame:
    """INSERT INTO target SELECT ...: columns matched by name, assignment casts to the target types."""
    return target.unionByName(cast_to_schema(rows.select(*target.columns), target.schema))


def write_clustered(df: DataFrame, spark: SparkSession, area: str, cluster_by: Sequence[str],
                    files: int | None = None) -> str:
    """Range-cluster rows by ``cluster_by`` and sort inside each file.

    Parquet keeps min/max statistics per row group, so a later filter on the
    clustering columns skips most row groups and files (the role an index
    plays in a row store).
    """
    n = files or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    path = storage_root(spark, area)
    (df.repartitionByRange(n, *cluster_by)
       .sortWithinPartitions(*cluster_by)
       .write.parquet(path))
    return path


def write_hashed(df: DataFrame, spark: SparkSession, area: str, key: Sequence[str], files: int | None = None) -> str:
    """Hash layout for equality lookups: each key value is in one sorted file (for joins see ``write_bucketed``).

    Files hold the rows of one hash bucket sorted by the key, so an equality
    filter skips all row groups but one or two of a single file.
    """
    n = files or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    path = storage_root(spark, area)
    df.repartition(n, *key).sortWithinPartitions(*key).write.parquet(path)
    return path


def write_bucketed(df: DataFrame, spark: SparkSession, area: str, key: Sequence[str], buckets: int) -> str:
    """Bucketed and sorted table of the session's catalog, its files in the shared folder; gives the table's name.

    Spark knows the buckets, so two tables with the same number of buckets on
    the join key are merged bucket by bucket, without a shuffle. The rows are
    dealt by bucket before they are written: one file per bucket.
    """
    name = f"tessera_{area}_{uuid.uuid4().hex}"
    (df.repartition(buckets, *key).write.bucketBy(buckets, *key).sortBy(*key)
       .option("path", storage_root(spark, area)).format("parquet").saveAsTable(name))
    return name


def write_partitioned(df: DataFrame, spark: SparkSession, area: str,
                      partition_by: Sequence[str], spread_by: Sequence[str] = ()) -> str:
    """Directory-partition by derived key columns; filters on them prune directories.

    Rows are range-partitioned on the partition columns followed by
    ``spread_by``, so a hot partition value is written by several tasks
    instead of one, while each task still writes few directories.
    """
    n = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    path = storage_root(spark, area)
    (df.repartitionByRange(n, *partition_by, *spread_by)
       .write.partitionBy(*partition_by).parquet(path))
    return path
