"""Mixing sources to target weights by Pfair scheduling, with DataFrame functions only.

Each source's rows are put in a fixed hashed order and cut into blocks of
equal size. In the ideal (fluid) mix source i advances at a rate in proportion
to its target weight; when a source runs out, the others share its rate. Block
k of a source may run from the slot where the fluid mix begins it (release,
rounded down) to the slot where it completes it (deadline, rounded up). In
each slot the released block with the earliest deadline runs (ties: the lower
source). By slot T every source has run its fluid share rounded down or up,
so it is off by less than one block.

Only counts reach the schedule: ``BLOCKS`` and the number of rows set the
block size, so the schedule has at most ``BLOCKS`` + number of sources
entries, whatever the size of the table; it is folded in one row by SQL's
``aggregate`` and joined back. Rows are numbered within (source, hash bucket)
plus the bucket's offset, so a source that holds a third of all rows is spread
over all buckets.

Defined cases: a null source is a source of its own; sources without a weight,
or with one that is null or not positive, get the smallest positive weight (no
row is dropped); ties and repeated rows are numbered one after another in any
order among equal ids; empty tables give empty tables; extra columns pass, but
those named like the new ones are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import fresh, null_safe
from tessera.session import materialize

BLOCKS = 1000
BUCKET_HEX = 3  # hash buckets per source: 16 to this power
ALPHA = 0.5
_EPS = 1e-6
MIX_COLUMNS = ("mix_block", "mix_slot", "mix_position")


def temperature_weights(docs: DataFrame, source: str = "source", alpha: float = ALPHA) -> DataFrame:
    """(source, weight): size to the power ``alpha``, the usual levelling of large sources."""
    return docs.groupBy(F.col(source).alias("source")).agg(F.pow(F.count("*"), F.lit(alpha)).alias("weight"))


def _fluid(v: Column, sources: Column) -> Column:
    """Blocks that the fluid mix has run at virtual time ``v``: each source v * weight, its size at most."""
    return F.aggregate(sources, F.lit(0.0), lambda a, s: a + F.least(v * s["w"], s["n"].cast("double")))


def block_schedule(counts: DataFrame, weights: DataFrame, block_rows: Column) -> DataFrame:
    """(sid, block, slot) from (sid, key, rows) and (key, weight); one entry per block."""
    known = counts.join(weights.select("key", F.col("weight").cast("double").alias("weight")), "key", "left")
    known = known.groupBy("sid", "rows").agg(F.max("weight").alias("weight"))
    good = F.when((F.col("weight") > 0) & ~F.isnan("weight") & (F.col("weight") < float("inf")), F.col("weight"))
    n = F.ceil(F.col("rows") / block_rows).cast("long")
    listed = known.groupBy().agg(F.sort_array(F.collect_list(F.struct("sid", n.alias("n"), good.alias("w")))).alias("s"))
    floor = F.coalesce(F.array_min(F.transform("s", lambda x: x["w"])), F.lit(1.0))
    listed = listed.select(F.transform("s", lambda x: F.struct(
        x["sid"].alias("sid"), x["n"].alias("n"), F.coalesce(x["w"], floor).alias("w"))).alias("s"))
    total = F.aggregate("s", F.lit(0.0), lambda a, x: a + x["w"])
    listed = listed.select(F.transform("s", lambda x: F.struct(
        x["sid"].alias("sid"), x["n"].alias("n"), (x["w"] / total).alias("w"))).alias("s"))
    slots = F.aggregate("s", F.lit(0).cast("long"), lambda a, x: a + x["n"])
    windows = listed.select("s", slots.alias("slots")).select("slots", F.transform("s", lambda x: F.transform(
        F.sequence(F.lit(0).cast("long"), x["n"] - 1), lambda k: F.struct(
            F.floor(_fluid(k / x["w"], F.col("s")) + _EPS).alias("r"),
            F.ceil(_fluid((k + 1) / x["w"], F.col("s")) - _EPS).alias("d")))).alias("win"),
        F.transform("s", lambda x: x["sid"]).alias("sids"))
    windows = windows.filter("slots > 0")
    # Of a slot: the source whose next block is released and due first.
    pick = """array_min(transform(acc.next, (k, i) -> IF(k < size(win[i]) AND win[i][k].r <= t,
        struct(win[i][k].d AS d, i AS i), NULL)))"""
    fold = f"""aggregate(sequence(0L, slots - 1L),
        struct(transform(win, x -> 0) AS next, cast(array() AS array<int>) AS picks),
        (acc, t) -> transform(array({pick}), p -> struct(
            transform(acc.next, (k, i) -> k + IF(i = p.i, 1, 0)) AS next,
            concat(acc.picks, array(p.i)) AS picks))[0],
        acc -> acc.picks)"""
    plan = windows.select("sids", F.posexplode(F.expr(fold)).alias("slot", "i"))
    nth = F.row_number().over(Window.partitionBy("i").orderBy("slot")) - 1
    return plan.select(F.element_at("sids", F.col("i") + 1).alias("sid"), nth.cast("long").alias("block"),
                       F.col("slot").cast("long").alias("slot"))


def mix(docs: DataFrame, weights: DataFrame, doc_id: str = "doc_id", source: str = "source",
        blocks: int = BLOCKS) -> DataFrame:
    """``docs`` with ``mix_block``, ``mix_slot`` and ``mix_position`` (0, 1, ... over the whole table).

    Order by ``mix_position`` to write the mixed corpus. ``weights`` has
    (source, weight); weights are relative.
    """
    key, bucket, nth, order = (fresh(docs, c) for c in ("__key", "__bucket", "__nth", "__order"))
    digest = F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))
    # Hash order; the first hex digits are the bucket, so buckets follow the order.
    dealt = (docs.withColumn(key, null_safe(F.col(source))).withColumn(order, digest)
             .withColumn(bucket, F.conv(F.substring(order, 1, BUCKET_HEX), 16, 10).cast("int")))
    sized = materialize(dealt.groupBy(F.col(key).alias("key"), F.col(bucket).alias("bucket"))
                        .agg(F.count("*").alias("rows")), "mix_sizes")
    # Sources by name (null first); one row per source, so the list is as short as the weights.
    totals = sized.groupBy("key").agg(F.sum("rows").alias("rows"))
    ids = totals.groupBy().agg(F.sort_array(F.collect_list(F.struct("key", "rows"))).alias("s"))
    counts = materialize(ids.select(F.posexplode("s").alias("sid", "x")).select("sid", "x.key", "x.rows"), "mix_sources")
    rows = counts.agg(F.sum("rows")).first()[0] or 0
    block_rows = max(1, -(-rows // blocks))
    plan = block_schedule(counts, weights.select(null_safe(F.col("source")).alias("key"), "weight"), F.lit(block_rows))
    before = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sized.withColumn("offset", F.coalesce(F.sum("rows").over(before), F.lit(0)))
    offsets = offsets.join(counts.select("key", "sid"), "key").select("key", "bucket", "offset", "sid")
    # Rows ahead of a slot: every earlier block is full but for the last of its source.
    plan = plan.join(counts.select("sid", "rows"), "sid")
    height = F.least(F.lit(block_rows), F.col("rows") - F.col("block") * block_rows)
    ahead = Window.orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    plan = materialize(plan.select("sid", "block", "slot", F.coalesce(F.sum(height).over(ahead), F.lit(0)).alias("ahead")), "mix_plan")
    o = {c: fresh(docs, f"__o_{c}") for c in offsets.columns}
    p = {c: fresh(docs, f"__p_{c}") for c in plan.columns}
    offsets, plan = offsets.withColumnsRenamed(o), plan.withColumnsRenamed(p)
    # The window and the join with the offsets share one dealing of the rows.
    within = Window.partitionBy(key, bucket).orderBy(order, F.xxhash64(doc_id))
    out = dealt.withColumn(nth, F.row_number().over(within) - 1)
    out = out.join(offsets, (out[key] == offsets[o["key"]]) & (out[bucket] == offsets[o["bucket"]]))
    out = out.withColumn(nth, F.col(o["offset"]) + F.col(nth)).withColumn(order, F.floor(F.col(nth) / block_rows))
    out = out.join(plan, (F.col(o["sid"]) == F.col(p["sid"])) & (F.col(order) == F.col(p["block"])))
    return out.select(
        *[out[c] for c in docs.columns if c not in MIX_COLUMNS], F.col(p["block"]).alias("mix_block"), F.col(p["slot"]).alias("mix_slot"),
        (F.col(p["ahead"]) + F.col(nth) - F.col(p["block"]) * block_rows).alias("mix_position"))
