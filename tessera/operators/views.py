"""Views and materialized views.

A view is a named, lazily evaluated DataFrame (a session temp view, so Spark
SQL can use it too). A materialized view stores its result as a Parquet
snapshot through ``sinks.Catalog``: reads return the stored version until a
refresh recomputes it into a fresh directory and swaps the pointer.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.quality import unique
from tessera.sources.sinks import Catalog, write_parquet


def create_view(spark: SparkSession, name: str, df: DataFrame, replace: bool = True) -> DataFrame:
    """CREATE [OR REPLACE] VIEW name AS <df>."""
    if not replace and spark.catalog.tableExists(name):
        raise ValueError(f"view {name!r} already exists")
    df.createOrReplaceTempView(name)
    return spark.table(name)


def drop_view(spark: SparkSession, name: str, if_exists: bool = True) -> bool:
    """DROP VIEW [IF EXISTS] name."""
    dropped = spark.catalog.dropTempView(name)
    if not dropped and not if_exists:
        raise ValueError(f"view {name!r} does not exist")
    return dropped


def rename_view(spark: SparkSession, old: str, new: str) -> DataFrame:
    """ALTER VIEW old RENAME TO new (re-register the same plan, drop the old name)."""
    plan = spark.table(old)
    plan.createOrReplaceTempView(new)
    spark.catalog.dropTempView(old)
    return spark.table(new)


class NotPopulated(RuntimeError):
    """Reading a materialized view created WITH NO DATA before its first refresh."""


@dataclass
class MaterializedView:
    spark: SparkSession
    name: str
    definition: Callable[[], DataFrame]
    key: Sequence[str] = ()

    @classmethod
    def create(cls, spark: SparkSession, name: str, definition: Callable[[], DataFrame],
               with_data: bool = True, key: Sequence[str] = ()) -> MaterializedView:
        mv = cls(spark, name, definition, tuple(key))
        if with_data:
            mv.refresh()
        else:
            Catalog.of(spark).drop(name)
        return mv

    @property
    def populated(self) -> bool:
        return Catalog.of(self.spark).exists(self.name)

    def read(self) -> DataFrame:
        if not self.populated:
            raise NotPopulated(f"materialized view {self.name!r} has not been populated")
        return Catalog.of(self.spark).read(self.name)

    def refresh(self) -> DataFrame:
        """REFRESH MATERIALIZED VIEW: recompute fully into a new snapshot."""
        Catalog.of(self.spark).publish(self.name, self.definition())
        return self.read()

    def refresh_keyed(self) -> DataFrame:
        """REFRESH ... CONCURRENTLY: diff the new result against the stored one by key.

        Needs a unique key (checked on the written copy before the swap: duplicate keys raise). Publishes the
        new snapshot, then returns the change set ``(key..., change)`` with
        change in insert / update / delete, computed between the two stored
        snapshots (both immutable directories, so the diff is reproducible).
        Readers keep seeing the old snapshot until the pointer swap.
        """
        if not self.key:
            raise ValueError("keyed refresh needs a unique key")
        catalog, old = Catalog.of(self.spark), self.read()
        path = write_parquet(self.definition(), self.spark, self.name, durable=True)  # computed once
        if unique(self.spark.read.parquet(path), self.key).limit(1).count():
            raise ValueError(f"materialized view {self.name!r}: key {list(self.key)} is not unique")
        catalog.point_at(self.name, path)
        return diff_by_key(old, self.read(), self.key)


def diff_by_key(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows that differ between two keyed snapshots: insert, update or delete.

    One full outer join on the key; a row is an update when any non-key column
    differs (NULL-safe comparison).
    """
    key = list(key)
    values = [c for c in new.columns if c not in key]
    o = old.select(*[F.col(k).alias(f"__o_{k}") for k in key], *[F.col(c).alias(f"__o_{c}") for c in values],
                   F.lit(True).alias("__in_old"))
    n = new.select(*[F.col(k).alias(f"__n_{k}") for k in key], *[F.col(c).alias(f"__n_{c}") for c in values],
                   F.lit(True).alias("__in_new"))
    j = o.join(n, [F.col(f"__o_{k}") == F.col(f"__n_{k}") for k in key], "full")
    same = F.lit(True)
    for c in values:
        same = same & F.col(f"__o_{c}").eqNullSafe(F.col(f"__n_{c}"))
    change = (F.when(F.col("__in_old").isNull(), F.lit("insert"))
              .when(F.col("__in_new").isNull(), F.lit("delete"))
              .when(~same, F.lit("update")))
    return (j.withColumn("change", change).where(F.col("change").isNotNull())
            .select(*[F.coalesce(F.col(f"__n_{k}"), F.col(f"__o_{k}")).alias(k) for k in key], "change"))
