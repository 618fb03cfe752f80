"""Join forms beyond ``DataFrame.join``'s defaults.

Physical strategy (broadcast hash, shuffle hash, sort-merge) is left to
Catalyst and AQE: a side is broadcast only when its measured size is below
``spark.sql.autoBroadcastJoinThreshold``, otherwise the join shuffles on its
keys, and AQE splits skewed partitions. ``F.broadcast`` is used only for
literal tables of fixed size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import materialize


def natural_join(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """NATURAL JOIN: equality on every column name the two sides share."""
    common = [c for c in left.columns if c in set(right.columns)]
    if not common:
        raise ValueError("NATURAL JOIN without a shared column would be a cross join; write crossJoin if it is meant")
    return left.join(right, common, how)


def full_unmatched(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                   status: str = "status", left_label: str = "left only",
                   right_label: str = "right only") -> DataFrame:
    """FULL JOIN keeping only rows without a partner, labelled by side."""
    joined = left.join(right, left[left_key] == right[right_key], "full")
    return (joined.where(left[left_key].isNull() | right[right_key].isNull())
            .withColumn(status, F.when(right[right_key].isNull(), F.lit(left_label))
                        .otherwise(F.lit(right_label))))


def pair_counts(df: DataFrame, key: str, out: str = "pair_count") -> DataFrame:
    """Number of unordered pairs ``(a, b)`` with ``a.key = b.key`` and ``a.id < b.id``.

    A self join on equality plus ``a.id < b.id`` lists n(n-1)/2 pairs for a
    group of n rows. The pairs themselves are never materialised: the count
    per key is n(n-1)/2 of a grouped count, so a hot key costs nothing extra.
    NULL keys form no pairs.
    """
    n = F.count(F.lit(1))
    return (df.where(F.col(key).isNotNull()).groupBy(key)
            .agg((n * (n - 1) / 2).cast("long").alias(out))
            .where(F.col(out) > 0))


def fanout_totals(parent: DataFrame, parent_key: str, children: dict[str, tuple[DataFrame, str, dict]]
                  ) -> DataFrame:
    """Aggregates of ``parent LEFT JOIN child1 LEFT JOIN child2 ...`` (all on the
    parent key) as the chained join would report them, without building it.

    For each parent the chained join has prod(max(n_i, 1)) rows. A COUNT or
    SUM over child i therefore equals child i's own aggregate times the row
    multiplicity of all other children. ``children`` maps a name to
    ``(child_df, child_key, {out_col: ("count"|"sum", column)})``. Each child is
    aggregated on its key first (partial aggregation before the shuffle), then
    joined one row per parent.
    """
    result = parent
    names = []
    for name, (child, child_key, aggs) in children.items():
        exprs = [F.count(F.lit(1)).alias(f"__n_{name}")]
        for out, (fn, column) in aggs.items():
            exprs.append((F.count(column) if fn == "count" else F.sum(column)).alias(f"__{out}"))
        per_key = child.groupBy(F.col(child_key).alias(f"__k_{name}")).agg(*exprs)
        result = result.join(per_key, F.col(parent_key) == F.col(f"__k_{name}"), "left") \
            .drop(f"__k_{name}")
        names.append((name, aggs))

    def multiplicity(skip: str | None) -> Column:
        m = F.lit(1).cast("long")
        for other, _ in names:
            if other != skip:
                m = m * F.greatest(F.coalesce(F.col(f"__n_{other}"), F.lit(0)), F.lit(1))
        return m

    outs = []
    for name, aggs in names:
        for out, (fn, _) in aggs.items():
            value = F.col(f"__{out}")
            if fn == "count":  # COUNT over no rows is 0, SUM over no rows stays NULL
                value = F.coalesce(value, F.lit(0))
            outs.append((value * multiplicity(name)).alias(out))
    return result.select(*parent.columns, *outs, multiplicity(None).alias("joined_rows"))


def not_in(left: DataFrame, left_key: str, right: DataFrame, right_key: str) -> DataFrame:
    """``left_key NOT IN (SELECT right_key FROM right)`` with SQL NULL rules.

    Any NULL on the right empties the result; a NULL left key qualifies only
    when the right side is empty. Both facts come from one scalar subquery
    (a global aggregate, evaluated once); the rest is an equi anti join that
    Spark runs as a hash or sort-merge join, never a nested loop.
    """
    # 0: the list is empty (keep every row); 1: no NULL in it (keep non-NULL
    # keys); 2: it holds a NULL (keep nothing). One scalar subquery.
    # The list is read by the scalar subquery and by the anti join (and Spark
    # copies filters into each): written once as one column, so a list that
    # is itself a join is computed once.
    listed = materialize(right.select(F.col(right_key).alias("__nk")).distinct(), "not_in_list")
    n, non_null = F.count(F.lit(1)), F.count(F.col("__nk"))
    mode = listed.agg(F.when(n == 0, 0).when(n == non_null, 1).otherwise(2)).scalar()
    keys = listed.where(F.col("__nk").isNotNull())
    # Non-NULL keys: anti join, dropped entirely when the list holds a NULL.
    # NULL keys: kept only when the list is empty. The subquery conditions do
    # not mention the join key, so Spark does not copy them into the list side.
    matched = (left.where(F.col(left_key).isNotNull())
               .join(keys, F.col(left_key) == F.col("__nk"), "left_anti")
               .where(mode <= 1))
    null_keys = left.where(F.col(left_key).isNull()).where(mode == 0)
    return matched.unionByName(null_keys)


def union_full(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
               select_cols: Sequence[Column]) -> DataFrame:
    """The result of LEFT JOIN UNION RIGHT JOIN (distinct rows), joined once."""
    # One full outer join has exactly the rows of both halves; UNION makes them distinct.
    return left.join(right, left[left_key] == right[right_key], "full").select(*select_cols).distinct()


def full_join(left: DataFrame, right: DataFrame, left_keys: Sequence[str], right_keys: Sequence[str]) -> DataFrame:
    """FULL OUTER JOIN on equal keys, all columns of both sides, whatever share of the rows a key has.

    Spark can't split a hot key of a full outer join. Here the matches are an
    inner join, which it splits on both sides, and each side's remainder is a
    semi join with the keys that the other side lacks: one row per key, added up
    before the shuffle and written once. Rows with a NULL key match nothing and
    belong to the remainder.
    """
    sides = [(left, list(left_keys), "__in_left"), (right, list(right_keys), "__in_right")]
    names = [f"__k{i}" for i in range(len(left_keys))]
    digest = None
    for frame, keys, flag in sides:
        own = frame.select(*[F.col(k).alias(n) for k, n in zip(keys, names)]).where(_all_given(names))
        own = own.select(*names, *[F.lit(f == flag).alias(f) for _, _, f in sides])
        digest = own if digest is None else digest.unionByName(own)
    digest = materialize(digest.groupBy(*names).agg(*[F.max(f).alias(f) for _, _, f in sides])
                         .where("NOT (__in_left AND __in_right)"), "full_join_keys")
    out = left.join(right, [F.col(a) == F.col(b) for a, b in zip(left_keys, right_keys)])
    for frame, keys, flag in sides:
        alone = frame.join(digest.where(flag), [F.col(k) == F.col(n) for k, n in zip(keys, names)], "left_semi")
        out = out.unionByName(alone.unionByName(frame.where(~_all_given(keys))), allowMissingColumns=True)
    return out


def _all_given(columns: Sequence[str]) -> Column:
    given = F.lit(True)
    for c in columns:
        given = given & F.col(c).isNotNull()
    return given
