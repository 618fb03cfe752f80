"""Window operators that stay distributed at any scale.

Spark's ``Window`` without ``partitionBy`` moves every row into one task, and a
keyed window puts a whole key into one task. The helpers here give the same
results while splitting the work:

* ``prefix_sum``: ``SUM(..) OVER ([PARTITION BY p] ORDER BY ..)`` with the
  default RANGE frame. Rows (or, by default, one row per distinct key) are put
  into order-preserving buckets computed from the value alone (no statistics
  pass), summed locally per (partition, bucket), and shifted by the totals of
  the earlier buckets of their partition. Without a partition the offset table
  has one row per bucket, so its broadcast is bounded by the bucket count.
* ``global_rank``: ``RANK() OVER (ORDER BY ..)`` as 1 + a prefix count of
  larger (or smaller) keys, optionally weighted so a per-customer table can
  rank account rows.
* ``band_count``: per key, the number of rows whose time lies within
  ``[t - before, t + after]`` (a RANGE frame). Rows are split into time buckets
  per key in one pass, and rows near a bucket edge are also emitted (narrow)
  into the neighbouring bucket, so a key holding a third of all rows is still
  spread over many tasks.
* ``previous_max``: per key, the maximum of a value over rows with a smaller id
  (a ROWS frame ending one row before the current one), computed per id block
  and combined with the running maximum of earlier blocks.
* ``partition_total``: ``SUM(..) OVER (PARTITION BY key)`` as a grouped
  aggregate joined back, so a hot key is one aggregate row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import materialize

_PID = "__bucket"

MICROS_PER_MINUTE = 60 * 1_000_000
MICROS_PER_HOUR = 60 * MICROS_PER_MINUTE


def _ordering(cols: Sequence[str], descending: bool) -> list[Column]:
    if descending:
        return [F.col(c).desc_nulls_first() for c in cols]
    return [F.col(c).asc_nulls_last() for c in cols]


# Buckets per e-fold of |value| for numeric ordering keys: values within ~0.1%
# of each other share a bucket, so even a narrow value range is split finely,
# while the bucket table stays bounded (|v| < 1e18 gives at most ~85k buckets).
LOG_BUCKETS_PER_EFOLD = 1024
_NULL_BUCKET = 1 << 62


def ordered_bucket(col: str, dtype: T.DataType) -> Column:
    """A bucket number that never decreases as ``col`` grows; NULL -> last bucket.

    Computed from the value alone (no statistics pass over the data, and the
    same bucket on every recomputation): one bucket per day for dates, per
    hour for timestamps, and a fine logarithmic scale for numbers.
    """
    c = F.col(col)
    if isinstance(dtype, T.DateType):
        b = F.unix_date(c).cast("long")
    elif isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        b = F.floor(F.unix_micros(c.cast("timestamp")) / 3_600_000_000).cast("long")
    elif isinstance(dtype, T.NumericType):
        v = c.cast("double")
        b = (F.signum(v) * F.floor(F.log1p(F.abs(v)) * LOG_BUCKETS_PER_EFOLD)).cast("long")
    else:
        raise TypeError(f"ordering column must be numeric or temporal, got {dtype}")
    return F.coalesce(b, F.lit(_NULL_BUCKET))


def prefix_sum(df: DataFrame, order_cols: Sequence[str], value: str | Column, out: str,
               descending: bool = False, inclusive: bool = True,
               partition_by: Sequence[str] = (), rows_unique: bool = False) -> DataFrame:
    """Add ``out`` = SUM(value) OVER ([PARTITION BY p] ORDER BY order_cols RANGE UNBOUNDED PRECEDING).

    Peers (equal ordering keys) share one total, as in the SQL default frame.
    With ``inclusive=False`` the current peer group is left out (sum of strictly
    earlier keys). NULL keys sort last ascending and first descending
    (PostgreSQL order). The first ordering column must be numeric or temporal.
    Exact for integer and decimal values.

    Work is split by (partition, value bucket), so neither the whole table nor
    a hot partition lands in one task. Without ``partition_by`` the per-bucket
    offsets are one row per bucket (bounded, broadcast); with it they are one
    row per (partition, bucket) and joined normally.

    ``rows_unique=True`` promises that (partition, order) identifies a row;
    the running sums are then computed on the rows themselves, without the
    per-key aggregation and the join back.
    """
    order_cols = list(order_cols)
    parts = list(partition_by)
    value_col = F.col(value) if isinstance(value, str) else value
    if rows_unique:
        return _prefix_sum_rows(df, order_cols, value_col, out, descending, inclusive, parts)
    per_key = df.groupBy(*parts, *order_cols).agg(F.sum(value_col).alias("__key_sum"))
    bucketed = per_key.withColumn(_PID, ordered_bucket(order_cols[0], per_key.schema[order_cols[0]].dataType))

    ordering = _ordering(order_cols, descending)
    bucket_order = F.col(_PID).desc() if descending else F.col(_PID).asc()
    local = bucketed.select(
        *parts, *order_cols, _PID, "__key_sum",
        F.sum("__key_sum").over(Window.partitionBy(*parts, _PID).orderBy(*ordering)
                                .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        .alias("__local_cum"),
    )
    # One row per (partition, bucket): its total, then the running total of
    # the earlier buckets of the same partition.
    totals = bucketed.groupBy(*parts, _PID).agg(F.sum("__key_sum").alias("__range_total"))
    earlier = Window.partitionBy(*parts).orderBy(bucket_order).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *parts, _PID,
        F.coalesce(F.sum("__range_total").over(earlier),
                   F.lit(0).cast(totals.schema["__range_total"].dataType)).alias("__offset"),
    )
    cum = F.col("__local_cum") + F.col("__offset")
    if not inclusive:
        cum = cum - F.col("__key_sum")
    if parts:  # NULL is a partition of its own, as in a window
        offsets = offsets.select(*[F.col(p).alias(f"__o{i}") for i, p in enumerate(parts)], _PID, "__offset")
        cond = [F.col(p).eqNullSafe(F.col(f"__o{i}")) for i, p in enumerate(parts)]
        keyed = local.join(offsets, [*cond, local[_PID] == offsets[_PID]]).drop(offsets[_PID]) \
            .drop(*[f"__o{i}" for i in range(len(parts))])
    else:
        keyed = local.join(offsets, _PID)
    names = [*parts, *order_cols]
    renamed = [f"__k{i}" for i in range(len(names))]
    keyed = keyed.select(*[F.col(c).alias(r) for c, r in zip(names, renamed)], cum.alias(out))
    cond = [F.col(c).eqNullSafe(F.col(r)) for c, r in zip(names, renamed)]
    return df.join(keyed, cond, "left").drop(*renamed)


def _offsets(totals: DataFrame, parts: list[str], descending: bool) -> DataFrame:
    bucket_order = F.col(_PID).desc() if descending else F.col(_PID).asc()
    earlier = Window.partitionBy(*parts).orderBy(bucket_order).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(
        *parts, _PID,
        F.coalesce(F.sum("__range_total").over(earlier),
                   F.lit(0).cast(totals.schema["__range_total"].dataType)).alias("__offset"))


def _prefix_sum_rows(df: DataFrame, order_cols: list[str], value_col: Column, out: str, descending: bool,
                     inclusive: bool, parts: list[str]) -> DataFrame:
    """prefix_sum when (parts, order) is unique per row: windows run on the rows."""
    bucketed = (df.withColumn("__val", value_col)
                .withColumn(_PID, ordered_bucket(order_cols[0], df.schema[order_cols[0]].dataType)))
    ordering = _ordering(order_cols, descending)
    local = bucketed.withColumn(
        "__local_cum", F.sum("__val").over(Window.partitionBy(*parts, _PID).orderBy(*ordering)
                                           .rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    totals = bucketed.groupBy(*parts, _PID).agg(F.sum("__val").alias("__range_total"))
    offsets = _offsets(totals, parts, descending)
    if parts:  # NULL is a partition of its own, as in a window
        offsets = offsets.select(*[F.col(p).alias(f"__o{i}") for i, p in enumerate(parts)], _PID, "__offset")
        cond = [F.col(p).eqNullSafe(F.col(f"__o{i}")) for i, p in enumerate(parts)]
        joined = local.join(offsets, [*cond, local[_PID] == offsets[_PID]]).drop(offsets[_PID]) \
            .drop(*[f"__o{i}" for i in range(len(parts))])
    else:
        joined = local.join(offsets, _PID)
    cum = F.col("__local_cum") + F.col("__offset")
    if not inclusive:
        cum = cum - F.col("__val")
    return joined.withColumn(out, cum).drop("__val", _PID, "__local_cum", "__offset")


def prefix_sums(df: DataFrame, order_cols: Sequence[str], values: dict[str, Column], partition_by: Sequence[str],
                replace: bool = False) -> DataFrame:
    """Add each ``out`` of ``values`` = the sum of its expression over the strictly earlier rows of the partition.

    Like ``prefix_sum(inclusive=False, rows_unique=True)`` for several values in
    one pass: (partition, order) identifies a row. With ``replace`` an ``out``
    may carry the name of a column, which it replaces.
    """
    parts, order = list(partition_by), _ordering(order_cols, False)
    kept = [c for c in df.columns if not (replace and c in values)]
    val = {out: f"__v{i}" for i, out in enumerate(values)}
    bucketed = df.select(*kept, *[values[o].alias(v) for o, v in val.items()],
                         ordered_bucket(order_cols[0], df.schema[order_cols[0]].dataType).alias(_PID))
    before = Window.partitionBy(*parts, _PID).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = bucketed.select(*kept, _PID, *[F.sum(v).over(before).alias(v) for v in val.values()])
    totals = bucketed.groupBy(*[F.col(p).alias(f"__o{i}") for i, p in enumerate(parts)], F.col(_PID).alias("__ob")).agg(
        *[F.sum(v).alias(f"__t{v}") for v in val.values()])
    earlier = Window.partitionBy(*[f"__o{i}" for i in range(len(parts))]).orderBy("__ob").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*[f"__o{i}" for i in range(len(parts))], "__ob",
                            *[F.sum(f"__t{v}").over(earlier).alias(f"__t{v}") for v in val.values()])
    on = [F.col(p).eqNullSafe(F.col(f"__o{i}")) for i, p in enumerate(parts)] + [F.col(_PID) == F.col("__ob")]
    none = {o: F.lit(0).cast(bucketed.schema[v].dataType) for o, v in val.items()}
    return local.join(offsets, on).select(*kept, *[
        (F.coalesce(v, none[o]) + F.coalesce(f"__t{v}", none[o])).alias(o) for o, v in val.items()])


def global_rank(df: DataFrame, order_col: str, out: str, descending: bool = True,
                weight: str | None = None) -> DataFrame:
    """Add ``out`` = RANK() OVER (ORDER BY order_col [DESC]) without a one-task window.

    rank = 1 + number of rows whose key sorts strictly before this row's key.
    With ``weight``, each row of ``df`` stands for ``weight`` rows (e.g. a
    per-customer table ranking the customer's account rows), so a rank over
    many rows can be computed on a pre-aggregated table.
    """
    w = F.col(weight).cast("long") if weight else F.lit(1).cast("long")
    counts = df.groupBy(order_col).agg(F.sum(w).alias("__n"))
    before = prefix_sum(counts, [order_col], "__n", "__before", descending=descending, inclusive=False,
                        rows_unique=True)
    ranks = before.select(F.col(order_col).alias("__rk"), (F.col("__before") + 1).alias(out))
    return df.join(ranks, F.col(order_col).eqNullSafe(F.col("__rk")), "left").drop("__rk")


def _micros(ts: str) -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp"))


#: Rows of one key in one bucket of ``band_count`` above which the key is counted in two levels.
CROWD_ROWS = 1 << 17


def band_count(df: DataFrame, key: str | Sequence[str], ts: str, before_us: int, after_us: int,
               out: str, bucket_us: int | None = None, counted: Column | None = None) -> DataFrame:
    """Per key, count rows with time in ``[t - before_us, t + after_us]`` (inclusive).

    Equivalent to ``COUNT(*) OVER (PARTITION BY key ORDER BY ts RANGE BETWEEN
    before PRECEDING AND after FOLLOWING)`` restricted to rows where
    ``counted`` is true (all rows by default). Rows with a NULL key or time get
    NULL, since an equality or BETWEEN on NULL matches nothing. The window runs
    per (key, time bucket); rows within ``before_us``/``after_us`` of a bucket
    edge are also copied (key and time only) into the neighbouring bucket, so
    each row sees its whole band and no row id or join-back is needed.

    A key that crowds a bucket (``CROWD_ROWS``; found by one count per key and
    bucket) doesn't go through that window at all, see ``_band_count_by_levels``.
    """
    keys = [key] if isinstance(key, str) else list(key)
    # Default bucket: 8 band widths. About (before + after) / width = 25% of
    # the rows are copied once, and a key busy all day is split into 3 buckets
    # a day for a one-hour band.
    width = bucket_us or max(before_us, after_us, 1) * 8
    if width < max(before_us, after_us):
        raise ValueError("bucket must be at least as wide as the band")
    counted = F.lit(True) if counted is None else counted

    base = df.withColumn("__t", _micros(ts)).withColumn("__counted", F.coalesce(counted, F.lit(False)))
    valid = F.col("__t").isNotNull()
    for k in keys:
        valid = valid & F.col(k).isNotNull()
    skipped = base.where(~valid).select(*df.columns, F.lit(None).cast("long").alias(out))
    crowded = (base.where(valid).groupBy(*[F.col(k).alias(f"__c{i}") for i, k in enumerate(keys)], F.floor(F.col("__t") / width).alias("__b"))
               .count().where(F.col("count") > CROWD_ROWS).select(*[f"__c{i}" for i in range(len(keys))]).distinct())
    if crowded.head(1):
        crowded = materialize(crowded, "crowded_keys")
        on = [F.col(k) == F.col(f"__c{i}") for i, k in enumerate(keys)]
        skipped = skipped.unionByName(_band_count_by_levels(
            base.where(valid).join(crowded, on, "left_semi"), keys, before_us, after_us, out).select(*df.columns, out))
        base = base.join(crowded, on, "left_anti")

    # One pass: each row yields itself (home) plus, when it lies within the
    # band of a bucket edge, a copy for the neighbouring bucket. A row late in
    # bucket b lies in the band of early rows of b+1 (they look back by
    # before_us); a row early in b lies in the band of late rows of b-1.
    b = F.floor(F.col("__t") / width)
    target = lambda bucket, home: F.struct(bucket.alias("b"), F.lit(home).alias("home"))
    to_next = F.when(F.col("__counted") & (F.col("__t") >= (b + 1) * width - before_us), target(b + 1, False))
    to_prev = F.when(F.col("__counted") & (F.col("__t") < b * width + after_us), target(b - 1, False))
    targets = F.filter(F.array(target(b, True), to_next, to_prev), lambda x: x.isNotNull())
    spread = base.where(valid).withColumn("__tgt", F.explode(targets))
    # Copies only need key, time and flag: other columns are nulled so the
    # extra rows stay narrow in the shuffle.
    payload = [c for c in df.columns if c not in keys]
    spread = spread.select(
        *keys, *[F.when(F.col("__tgt.home"), F.col(c)).alias(c) for c in payload],
        "__t", "__counted", F.col("__tgt.b").alias("__b"), F.col("__tgt.home").alias("__home"))

    w = Window.partitionBy(*keys, "__b").orderBy("__t").rangeBetween(-before_us, after_us)
    counted_rows = (spread.withColumn(out, F.count(F.when(F.col("__counted"), 1)).over(w))
                    .where("__home").select(*df.columns, out))
    return counted_rows.unionByName(skipped)


def _band_count_by_levels(base: DataFrame, keys: list[str], before_us: int, after_us: int, out: str) -> DataFrame:
    """The band's rows as a difference of two running counts, for keys with any number of rows at a time.

    Equal times of a key are one row with their number, added up before the
    shuffle. Each time asks for the running count at both ends of its band. The
    questions stand among the counts of the two short buckets (a second) that hold the
    ends, where they are compared row by row; all buckets before give their totals as a
    prefix sum over seconds and hours. A task sees the distinct microseconds
    of a second or the seconds of an hour, never a key's rows.
    """
    second = 1_000_000
    times = materialize(base.groupBy(*keys, "__t").agg(F.count(F.when(F.col("__counted"), 1)).alias("__n")), "band_times")
    point = lambda at, n, of, sign: F.struct(at.alias("x"), n.alias("n"), of.alias("of"), F.lit(sign).alias("sign"))
    zero, none, t = F.lit(0).cast("long"), F.lit(None).cast("long"), F.col("__t")
    points = times.select(*keys, F.explode(F.array(
        point(t, F.col("__n"), none, 0), point(t + after_us, zero, t, 1), point(t - before_us - 1, zero, t, -1))).alias("p"))
    points = points.select(*keys, "p.*", F.floor(F.col("p.x") / second).alias("__s"))
    running = F.sum("n").over(Window.partitionBy(*keys, "__s").orderBy("x").rangeBetween(Window.unboundedPreceding, Window.currentRow))
    local = points.withColumn("__local", running).where("sign <> 0")
    totals = (points.groupBy(*keys, "__s").agg(F.sum("n").alias("__total"))
              .withColumn("__at", F.timestamp_micros(F.col("__s") * second)))
    before = prefix_sums(totals, ["__at"], {"__before": F.col("__total")}, keys)
    before = before.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col("__s").alias("__os"), "__before")
    on = [F.col(k) == F.col(f"__k{i}") for i, k in enumerate(keys)]
    ends = local.join(before, [*on, F.col("__s") == F.col("__os")])
    bands = (ends.groupBy(*[F.col(k).alias(f"__g{i}") for i, k in enumerate(keys)], F.col("of").alias("__of"))
             .agg(F.sum(F.col("sign") * (F.col("__local") + F.col("__before"))).alias(out)))
    return base.join(bands, [F.col(k) == F.col(f"__g{i}") for i, k in enumerate(keys)] + [F.col("__t") == F.col("__of")])


def previous_max(df: DataFrame, key: str, order_col: str, value: str, out: str,
                 block: int = 1 << 20) -> DataFrame:
    """Per key, max(value) over rows with a strictly smaller ``order_col``.

    Equivalent to ``MAX(value) OVER (PARTITION BY key ORDER BY order_col ROWS
    BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)`` for a unique ``order_col``.
    Rows are processed per (key, order_col block); the maxima of earlier blocks
    of the same key come from a per-block table (one row per key and block).
    Rows with NULL key or order value get NULL.
    """
    rows = df.withColumn("__blk", F.floor(F.col(order_col) / block))
    local_w = (Window.partitionBy(key, "__blk").orderBy(order_col)
               .rowsBetween(Window.unboundedPreceding, -1))
    local = rows.withColumn("__local_max", F.max(value).over(local_w))

    per_block = (rows.where(F.col(key).isNotNull() & F.col("__blk").isNotNull())
                 .groupBy(key, "__blk").agg(F.max(value).alias("__blk_max")))
    earlier = per_block.select(
        key, "__blk",
        F.max("__blk_max").over(Window.partitionBy(key).orderBy("__blk")
                                .rowsBetween(Window.unboundedPreceding, -1)).alias("__earlier_max"),
    )
    joined = local.join(earlier, [key, "__blk"], "left")
    return joined.withColumn(
        out,
        F.when(F.col(key).isNull() | F.col(order_col).isNull(), F.lit(None))
        .otherwise(F.greatest("__local_max", "__earlier_max")),
    ).drop("__blk", "__local_max", "__earlier_max")


def partition_total(df: DataFrame, key: str | Sequence[str], value: str | Column, out: str) -> DataFrame:
    """Add ``out`` = SUM(value) OVER (PARTITION BY key) without a keyed window.

    A whole-partition frame needs no order, so the sum is a grouped aggregate
    (partial sums before the shuffle) joined back on the key. A hot key is then
    one row on the aggregate side, and AQE can split its rows on the other
    side; a window would instead sort all of that key's rows in one task.
    NULL keys form one partition, as in a window.
    """
    keys = [key] if isinstance(key, str) else list(key)
    value_col = F.col(value) if isinstance(value, str) else value
    renamed = [f"__pk{i}" for i in range(len(keys))]
    totals = df.groupBy(*[F.col(k).alias(r) for k, r in zip(keys, renamed)]).agg(F.sum(value_col).alias(out))
    cond = [F.col(k).eqNullSafe(F.col(r)) for k, r in zip(keys, renamed)]
    return df.join(totals, cond, "left").drop(*renamed)
