"""Driver tables: one Parquet file (or directory) per relation.

Reads are lazy; Catalyst prunes columns and pushes filters into each scan,
so callers select only what they need and never pre-filter by hand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLE_NAMES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLE_NAMES:
        raise KeyError(f"unknown table {name!r}")
    return spark.read.parquet(table_path(sf_dir, name))


class Tables:
    """Attribute access to the driver tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._frames: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in TABLE_NAMES:
            raise AttributeError(name)
        # One DataFrame per table: files are listed and footers read once per
        # query, however often the plan refers to the table.
        if name not in self._frames:
            self._frames[name] = load(self.spark, self.sf_dir, name)
        return self._frames[name]

    def register_views(self, names=TABLE_NAMES) -> None:
        """Expose the tables to ``spark.sql`` under their own names."""
        for name in names:
            load(self.spark, self.sf_dir, name).createOrReplaceTempView(name)
