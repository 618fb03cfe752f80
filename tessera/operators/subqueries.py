"""Subquery shapes rewritten into joins, aggregates and windows.

Spark decorrelates EXISTS / IN / correlated scalar aggregates itself; the
forms here are the ones it rejects or plans poorly: a quantified comparison,
an IN used as a value, a correlated top-1 inside GROUP BY, and a correlated
COUNT used as a rank.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.windows import prefix_sum


def in_subquery_flag(df: DataFrame, col: str, sub: DataFrame, sub_col: str, out: str) -> DataFrame:
    """Add ``out`` = ``col IN (SELECT sub_col FROM sub)`` as a three-valued boolean.

    TRUE on a match; otherwise NULL when ``col`` is NULL (and ``sub`` is not
    empty) or ``sub`` holds a NULL; otherwise FALSE. The match is a left join
    against the distinct non-NULL keys, so it shuffles (or broadcasts, when
    small) once.
    """
    keys = (sub.select(F.col(sub_col).alias("__ik")).where(F.col("__ik").isNotNull())
            .distinct().withColumn("__hit", F.lit(True)))
    # 0: empty subquery; 1: no NULL in it; 2: it holds a NULL. One scalar subquery.
    n, non_null = F.count(F.lit(1)), F.count(F.col(sub_col))
    mode = sub.agg(F.when(n == 0, 0).when(n == non_null, 1).otherwise(2)).scalar()
    joined = df.join(keys, F.col(col) == F.col("__ik"), "left")
    # One reference to the subquery: s = mode, plus 10 when the key is NULL.
    # FALSE for (key, empty), (key, no NULL), (NULL key, empty); else NULL.
    s = F.when(F.col(col).isNull(), 10).otherwise(0) + mode
    flag = (F.when(F.col("__hit"), F.lit(True))
            .when(s.isin(0, 1, 10), F.lit(False))
            .otherwise(F.lit(None).cast("boolean")))
    return joined.withColumn(out, flag).drop("__ik", "__hit")


def greater_than_any(df: DataFrame, col: str, sub: DataFrame, sub_col: str) -> DataFrame:
    """Rows with ``col > ANY (SELECT sub_col FROM sub)``.

    True exactly when ``col`` exceeds the smallest non-NULL value; an empty or
    all-NULL subquery selects nothing. The minimum is a scalar subquery,
    computed once with partial aggregation.
    """
    smallest = sub.agg(F.min(sub_col)).scalar()
    return df.where(F.col(col) > smallest)


def rank_within(df: DataFrame, group: str, value: str, out: str) -> DataFrame:
    """``1 + (SELECT COUNT(*) FROM same group WHERE value > this.value)``.

    That is RANK() by ``value`` descending inside ``group``; when the group or
    the value is NULL the correlated count finds nothing, so the rank is 1.
    Computed as a per-group prefix count over distinct values, split by value
    bucket, so a group holding a large share of the rows is not ranked in one
    task.
    """
    valid = F.col(group).isNotNull() & F.col(value).isNotNull()
    counts = (df.where(valid).groupBy(group, value).agg(F.count(F.lit(1)).alias("__n")))
    larger = prefix_sum(counts, [value], "__n", "__larger", descending=True, inclusive=False,
                        partition_by=[group], rows_unique=True)
    ranks = larger.select(F.col(group).alias("__g"), F.col(value).alias("__v"),
                          (F.col("__larger") + 1).alias("__rank"))
    joined = df.join(ranks, (F.col(group) == F.col("__g")) & (F.col(value) == F.col("__v")), "left")
    return joined.withColumn(out, F.coalesce(F.col("__rank"), F.lit(1)).cast("long")) \
        .drop("__g", "__v", "__rank")


def top1_per_group(df: DataFrame, group: str, value: str, tie_break: str,
                   keep: Sequence[str]) -> DataFrame:
    """Per group, the row of the largest ``value`` (ORDER BY value DESC LIMIT 1).

    NULL values sort first in a descending PostgreSQL order, so a group with a
    NULL value picks that row. Ties go to the smallest ``tie_break``. Done with
    ``max_by`` over a struct ordering key: one aggregation, partial on the map
    side, so a hot group never gathers its rows in one place.
    """
    order_key = F.struct(
        F.col(value).isNull().alias("__is_null"),
        F.col(value).alias("__v"),
        (-F.col(tie_break)).alias("__tb"),
    )
    picked = F.max_by(F.struct(*[F.col(c) for c in keep]), order_key)
    return df.groupBy(group).agg(picked.alias("__top")).select(group, "__top.*")


def correlated_avg(df: DataFrame, key: str, sub: DataFrame, sub_key: str, sub_value: str,
                   out: str) -> DataFrame:
    """Attach ``(SELECT AVG(sub_value) FROM sub WHERE sub_key = key)`` as ``out``.

    The subquery is aggregated once per key and left-joined; keys without rows
    get NULL, exactly like the correlated scalar subquery. The average is
    returned as a double (exact decimal sum divided by the count).
    """
    avg = F.sum(sub_value).cast("double") / F.count(sub_value)
    per_key = sub.groupBy(F.col(sub_key).alias("__ck")).agg(avg.alias(out))
    return df.join(per_key, F.col(key) == F.col("__ck"), "left").drop("__ck")


def above_scalar(df: DataFrame, col: str | Column, scalar_df: DataFrame) -> DataFrame:
    """Rows where ``col`` exceeds an uncorrelated one-value subquery."""
    c = F.col(col) if isinstance(col, str) else col
    return df.where(c > scalar_df.scalar())
