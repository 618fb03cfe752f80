"""Query registry: key -> (Spark plan builder, DuckDB oracle SQL).

Every operator of the library is registered here applied to the driver
tables. The oracle SQL is written independently in plain SQL over the same
Parquet tables; ``None`` marks a query whose semantics SQL cannot express
(stateful streaming), for which only row counts are compared.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tessera.session import configure
from tessera.sources.tables import Tables

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    key: str
    build: Builder
    oracle: str | None
    area: str
    tags: tuple[str, ...] = field(default_factory=tuple)


_REGISTRY: dict[str, Query] = {}


def register(key: str, oracle: str | None, area: str, tags: tuple[str, ...] = ()):
    """Decorator for ``fn(t: Tables) -> DataFrame``."""

    def wrap(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if key in _REGISTRY:
            raise ValueError(f"duplicate query key {key!r}")

        def build(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return fn(Tables(spark, sf_dir))

        build.__name__ = f"build_{key}"
        build.__doc__ = fn.__doc__
        _REGISTRY[key] = Query(key, build, oracle, area, tuple(tags))
        return fn

    return wrap


def all_queries() -> dict[str, Query]:
    from tessera import plans  # noqa: F401  (imports register every module)

    return dict(_REGISTRY)
