"""Literal sources, declared schemas, column defaults and surrogate keys."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def values(spark: SparkSession, rows: Iterable[Sequence], schema: T.StructType) -> DataFrame:
    """A multi-row literal relation (``VALUES``) with an explicit schema.

    Built as literals inside the plan (an inline array of structs), so no data
    travels from Python and Catalyst folds it into a local relation.
    """
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, schema.fields)])
               for row in rows]
    if not structs:
        return spark.createDataFrame([], schema)
    return spark.range(1).select(F.inline(F.array(*structs)))


def _assign(col: Column, source: T.DataType, target: T.DataType) -> Column:
    """Assignment cast: numeric -> integer rounds half away from zero, like
    an INSERT into an integer column, instead of truncating like CAST."""
    integral = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    if isinstance(target, integral) and isinstance(source, (T.DecimalType, T.FloatType, T.DoubleType)):
        return F.round(col).cast(target)
    return col.cast(target)


def assign(col: Column, target: T.DataType) -> Column:
    """Assignment cast of an expression of any type (see ``_assign``)."""
    if isinstance(target, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return F.round(col).cast(target)
    return col.cast(target)


def cast_to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` onto a declared schema: named columns, declared types.

    Missing columns become NULL of the declared type; extra columns are dropped.
    """
    cols = []
    for field in schema.fields:
        if field.name in df.columns:
            cols.append(_assign(F.col(field.name), df.schema[field.name].dataType, field.dataType)
                        .alias(field.name))
        else:
            cols.append(F.lit(None).cast(field.dataType).alias(field.name))
    return df.select(*cols)


def apply_defaults(df: DataFrame, schema: T.StructType,
                   defaults: Mapping[str, Column | object]) -> DataFrame:
    """Fill columns that the incoming rows do not carry at all with defaults.

    A column that is present keeps its values, NULLs included (an explicit NULL
    is not replaced by the default). Columns absent and without a default are NULL.
    """
    cols = []
    for field in schema.fields:
        if field.name in df.columns:
            cols.append(_assign(F.col(field.name), df.schema[field.name].dataType, field.dataType)
                        .alias(field.name))
        else:
            default = defaults.get(field.name)
            value = default if isinstance(default, Column) else F.lit(default)
            cols.append(assign(value, field.dataType).alias(field.name))
    return df.select(*cols)


def assign_serial(df: DataFrame, order: Sequence[str], out: str, start: Column | int = 0,
                  partitions: int | None = None) -> DataFrame:
    """Surrogate keys ``start + 1, start + 2, ...`` in the order of ``order``.

    The order columns must make rows unique. Rows are range-partitioned, then
    each row gets its position inside its range plus the row count of all
    earlier ranges. The range number is written out with the rows (a table in
    the shared checkpoint folder) so it is fixed before ranges are counted;
    the per-range counts are one row per range.
    """
    from tessera.session import materialize

    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    ordering = [F.col(c).asc_nulls_last() for c in order]
    ranged = materialize(df.repartitionByRange(n, *ordering)
                         .withColumn("__pid", F.spark_partition_id()), "serial")
    local = ranged.withColumn(
        "__pos", F.row_number().over(Window.partitionBy("__pid").orderBy(*ordering)))
    counts = ranged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    offsets = counts.select(
        "__pid",
        F.coalesce(F.sum("__n").over(Window.orderBy("__pid")
                                      .rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("__offset"))
    base = start if isinstance(start, Column) else F.lit(start)
    return (local.join(offsets, "__pid")
            .withColumn(out, (base + F.col("__offset") + F.col("__pos")).cast("long"))
            .drop("__pid", "__pos", "__offset"))
