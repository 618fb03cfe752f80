"""SimHash near-duplicates by a self-join of a binary trie of fingerprints.

A text's words (lower-cased A-Z, cut at ASCII white space) give shingles of
three; a fingerprint bit is set if over half of the shingles' XXH64 (seed 42)
have it. Texts link when their fingerprints differ in three bits or fewer.

The join runs on distinct fingerprints. Three errors leave one of four 16-bit
blocks untouched, so each fingerprint enters four tries, one per block put in
front with an error budget of zero; a 16-bit front is a trie node. Nodes are
dealt to tasks by Spark. A node of more than ``NODE_ROWS`` fingerprints is
opened into the pairs of its children (eight bits deeper) that the budget
still allows, again and again, so no task holds an unbounded node. Inside a
task the two sides of a node pair are walked together bit by bit; differing
bits add up and a pair over the budget is cut off. A task gives the links as
stars, at most one row per fingerprint and trie; components then close in
Spark by alternating star joins, each written to the shared folder.

Defined cases: a null or wordless text has fingerprint zero and links like any
other; repeated rows and null ids are kept, the smallest non-null id of a
component names it (null if it has none); an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import add_text_columns, fresh, null_safe
from tessera.session import materialize

SHINGLE = 3
SEED = 42
MAX_BITS = 3
BLOCKS, BLOCK = 4, 16
NODE_ROWS = 50_000
STEP_BITS = 8
_RUN_ROWS = 200_000
_FRONT = 1 << 16
_HASHES_AT_ONCE = 1 << 16
_BITS_OF_BYTE = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def fingerprint(text: bytes) -> int:
    """The text's 64-bit fingerprint."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= SHINGLE:
        return xxhash.xxh64_intdigest(joined, SEED)
    stops = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = [0, *stops[:-SHINGLE].tolist()]
    ends = (stops[SHINGLE - 1:] - 1).tolist()
    counts = np.zeros(64, np.int64)
    for at in range(0, len(starts), _HASHES_AT_ONCE):
        part = [joined[a:b] for a, b in zip(starts[at:at + _HASHES_AT_ONCE], ends[at:at + _HASHES_AT_ONCE])]
        h = np.fromiter(map(xxhash.xxh64_intdigest, part, repeat(SEED)), np.uint64, len(part))
        columns = h.astype("<u8").view(np.uint8).reshape(-1, 8) + (np.arange(8) << 8)
        counts += (np.bincount(columns.ravel(), minlength=2048).reshape(8, 256) @ _BITS_OF_BYTE).ravel()
    return int(np.packbits(2 * counts > len(starts), bitorder="little").view("<u8")[0])


def add_fingerprints(docs: DataFrame, text: str = "text", name: str = "fp") -> DataFrame:
    """``docs`` with its fingerprints as (signed) longs, without the text."""

    def prints(texts: list[bytes]) -> list:
        return [np.fromiter(map(fingerprint, texts), np.uint64, len(texts)).view(np.int64)]

    return add_text_columns(docs, text, [T.StructField(name, T.LongType())], lambda: prints, drop=(text,))


def walk(keys: np.ndarray, alo, ahi, blo, bhi, depth: int, used, budget: int = MAX_BITS):
    """Links below the given node pairs: yields index pairs of ``keys`` (sorted within each node).

    Nodes are ranges of ``keys`` that agree in the first ``depth`` bits; a
    pair with equal ranges joins a node with itself. ``used`` is the number of
    bits that the prefixes of the two sides already differ by.
    """
    ones: dict[int, np.ndarray] = {}

    def split(lo, hi, bit):
        if bit not in ones:
            ones[bit] = np.concatenate([[0], np.cumsum((keys >> np.uint64(63 - bit)) & np.uint64(1), dtype=np.int32)])
        return hi - (ones[bit][hi] - ones[bit][lo])

    stack = [(depth, *(np.asarray(x, np.int64) for x in (alo, ahi, blo, bhi, used)))]
    while stack:
        depth, alo, ahi, blo, bhi, used = stack.pop()
        if len(alo) > _FRONT:
            stack.append((depth, *(x[_FRONT:] for x in (alo, ahi, blo, bhi, used))))
            alo, ahi, blo, bhi, used = (x[:_FRONT] for x in (alo, ahi, blo, bhi, used))
        single = (ahi - alo == 1) & (bhi - blo == 1)
        if single.any():
            i, j = alo[single], blo[single]
            near = np.bitwise_count(keys[i] ^ keys[j]) <= budget
            yield i[near & (i != j)], j[near & (i != j)]
            alo, ahi, blo, bhi, used = (x[~single] for x in (alo, ahi, blo, bhi, used))
        if not len(alo):
            continue
        if depth == 64:  # equal keys on either side of the pair
            raise AssertionError("fingerprints of a node must be distinct")
        am, bm, same = split(alo, ahi, depth), split(blo, bhi, depth), alo == blo
        other = ~same
        parts = [(alo, am, blo, bm, used), (am, ahi, bm, bhi, used), (alo, am, bm, bhi, used + 1),
                 tuple(x[other] for x in (am, ahi, blo, bm, used + 1))]
        alo, ahi, blo, bhi, used = (np.concatenate(x) for x in zip(*parts))
        live = (ahi > alo) & (bhi > blo) & (used <= budget) & ~((alo == blo) & (ahi - alo == 1))
        if live.any():
            stack.append((depth + 1, *(x[live] for x in (alo, ahi, blo, bhi, used))))


def merge(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """``labels`` (each the smallest index of its set) after the sets of i and j are joined."""
    while len(i):
        a, b = labels[i], labels[j]
        apart = a != b
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        low = np.minimum(a, b)
        np.minimum.at(labels, np.maximum(a, b), low)
        while True:
            short = labels[labels]
            if np.array_equal(short, labels):
                break
            labels = short
    return labels


def _rotate(keys: np.ndarray, by: np.ndarray) -> np.ndarray:
    """Bits rotated to the left; ``by`` in 1..63 or 0."""
    by = by.astype(np.uint64)
    back = (np.uint64(64) - by) & np.uint64(63)
    return np.where(by == 0, keys, (keys << by) | (keys >> back))


def _links_in_tasks(nodes: DataFrame, depth: int) -> DataFrame:
    """Star links (a, b) of each node or node pair; rows (turn, pa, pb, used, side, key)."""

    def solve(cols: list[np.ndarray]) -> pa.RecordBatch:
        turn, pa_, pb, used, side, key = cols
        keys = key.view(np.uint64)
        new = np.flatnonzero(np.concatenate([[True], (turn[1:] != turn[:-1]) | (pa_[1:] != pa_[:-1]) | (pb[1:] != pb[:-1])]))
        stop = np.append(new[1:], len(keys))
        ones = np.concatenate([[0], np.cumsum(side == 1)])
        middle = stop - (ones[stop] - ones[new])
        own = pa_[new] == pb[new]
        alo, ahi = new, np.where(own, stop, middle)
        blo, bhi = np.where(own, new, middle), stop
        full = (ahi > alo) & (bhi > blo) & ~(own & (stop - new == 1))
        labels = np.arange(len(keys))
        for i, j in walk(keys, *(x[full] for x in (alo, ahi, blo, bhi)), depth, used[new][full]):
            labels = merge(labels, i, j)
        tail = np.flatnonzero(labels != np.arange(len(keys)))
        fps = _rotate(keys, np.where(turn == 0, 0, 64 - BLOCK * turn)).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(fps[tail]), pa.array(fps[labels[tail]])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        rows = 0
        for batch in batches:
            held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            rows += batch.num_rows
            if rows < _RUN_ROWS:
                continue
            cols = [np.concatenate(x) for x in zip(*held)]
            last = (cols[0] == cols[0][-1]) & (cols[1] == cols[1][-1]) & (cols[2] == cols[2][-1])
            cut = len(last) - int(last.sum())  # the last node may go on in the next batch
            if cut:
                yield solve([c[:cut] for c in cols])
            held = [[c[cut:] for c in cols]]
            rows = len(last) - cut
        if rows:
            yield solve([np.concatenate(x) for x in zip(*held)])

    return (nodes.select("turn", "pa", "pb", "used", "side", "key")
            .repartition("turn", "pa", "pb").sortWithinPartitions("turn", "pa", "pb", "side", F.col("key").bitwiseXOR(F.lit(-1 << 63)))
            .mapInArrow(run, "a bigint, b bigint"))


def _open(nodes: DataFrame, depth: int) -> DataFrame:
    """Rows of the pairs of children, ``STEP_BITS`` deeper, that the budget allows."""
    masks = [sum(1 << b for b in bits) for n in range(MAX_BITS + 1) for bits in combinations(range(STEP_BITS), n)]
    child = F.shiftrightunsigned("key", 64 - depth - STEP_BITS).bitwiseAND((1 << STEP_BITS) - 1)
    out = nodes.withColumn("mask", F.explode(F.lit(masks))).withColumn("child", child)
    out = out.withColumn("used2", F.col("used") + F.bit_count("mask").cast("long")).filter(F.col("used2") <= MAX_BITS)
    own = F.col("pa") == F.col("pb")
    c, d = F.col("child"), F.col("child").bitwiseXOR(F.col("mask"))
    # In a node with itself a child takes the lower place; in a pair the side settles it.
    first = F.when(own, F.least(c, d)).when(F.col("side") == 0, c).otherwise(d)
    second = F.when(own, F.greatest(c, d)).when(F.col("side") == 0, d).otherwise(c)
    side = F.when(own, (c > d).cast("long")).otherwise(F.col("side"))
    return out.select("turn", (F.shiftleft("pa", STEP_BITS) + first).alias("pa"),
                      (F.shiftleft("pb", STEP_BITS) + second).alias("pb"),
                      F.col("used2").alias("used"), side.alias("side"), "key")


def fingerprint_links(fps: DataFrame, node_rows: int = NODE_ROWS) -> DataFrame:
    """Links (a, b) whose closure is that of all pairs of ``fps.fp`` within the bit budget.

    ``fps`` holds each fingerprint once. Every pair within the budget is met in
    a task; only a spanning star of each task's sets is returned.
    """
    turns = [F.struct(F.lit(r).cast("long").alias("turn"), (F.expr(f"shiftleft(fp, {BLOCK * r}) | shiftrightunsigned(fp, {64 - BLOCK * r})") if r else F.col("fp")).alias("key")) for r in range(BLOCKS)]
    nodes = fps.select(F.explode(F.array(*turns)).alias("t")).select("t.*")
    front = F.shiftrightunsigned("key", 64 - BLOCK)
    nodes = nodes.select("turn", front.alias("pa"), front.alias("pb"), F.lit(0).cast("long").alias("used"),
                         F.lit(0).cast("long").alias("side"), "key")
    depth, links = BLOCK, None
    while True:
        sizes = nodes.groupBy("turn", "pa", "pb").count().filter(F.col("count") > node_rows).drop("count")
        large = depth + STEP_BITS <= 64 and sizes.limit(1).count() > 0
        small = nodes.join(sizes, ["turn", "pa", "pb"], "left_anti") if large else nodes
        found = _links_in_tasks(small, depth)
        links = found if links is None else links.unionByName(found)
        if not large:
            return links
        nodes = materialize(_open(nodes.join(sizes, ["turn", "pa", "pb"], "left_semi"), depth), "simhash_nodes")
        depth += STEP_BITS


def components(links: DataFrame) -> DataFrame:
    """(a, b): each linked node and the smallest node reachable, by alternating star joins."""
    stars = materialize(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                        .filter("a <> b").distinct(), "components")
    seen = None
    while True:
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        large = materialize(large, "components")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").select(F.col("b").alias("x"), "m").filter("x <> m")
                 .select(F.col("x").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b"))).distinct())
        stars = materialize(small, "components")
        state = stars.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            return stars
        seen = state


def classes(prints: DataFrame, node_rows: int = NODE_ROWS) -> DataFrame:
    """(fp, root): every fingerprint of ``prints`` and the smallest one of its component."""
    fps = materialize(prints.select("fp").distinct(), "simhash_fps")
    roots = components(fingerprint_links(fps, node_rows)).select(F.col("a").alias("fp"), F.col("b").alias("root"))
    return fps.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    node_rows: int = NODE_ROWS) -> DataFrame:
    """One row per document: id, ``fingerprint`` (16 hex digits), ``component_id``."""
    prints = materialize(add_fingerprints(docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))), "simhash_docs")
    lowest = prints.groupBy("fp").agg(F.min("id").alias("low"))
    root = classes(prints, node_rows)
    named = root.join(lowest, "fp").groupBy("root").agg(F.min("low").alias("component_id"))
    by_fp = materialize(root.join(named, "root").select("fp", "component_id"), "simhash_classes")
    return prints.join(by_fp, "fp").select(
        F.col("id").alias(doc_id), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", node_rows: int = NODE_ROWS) -> DataFrame:
    """One document of each component: the smallest id (nulls last), ties by text hash; one of equal rows."""
    key, hash_, nth = fresh(docs, "__key"), fresh(docs, "__hash"), fresh(docs, "__nth")
    keyed = docs.withColumn(key, null_safe(F.col(doc_id))).withColumn(hash_, F.xxhash64(text))
    slim = keyed.select(F.col(doc_id).alias("id"), F.col(key).alias("key"), F.col(hash_).alias("h"), F.col(text).alias("text"))
    prints = materialize(add_fingerprints(slim), "simhash_docs")
    rank = F.struct(F.col("id").isNull().alias("none"), "id", "h", "key")
    lowest = prints.groupBy("fp").agg(F.min(rank).alias("low"))
    stay = classes(prints, node_rows).join(lowest, "fp").groupBy("root").agg(F.min("low").alias("low"))
    stay = materialize(stay.select(F.col("low.key").alias("skey"), F.col("low.h").alias("sh")).distinct(), "simhash_kept")
    # The join and the window share one dealing of the texts.
    kept = keyed.join(stay.hint("merge"), (keyed[key] == stay["skey"]) & (keyed[hash_] == stay["sh"]), "left_semi")
    order = Window.partitionBy(key, hash_).orderBy(*[F.xxhash64(c) for c in docs.columns])
    return kept.withColumn(nth, F.row_number().over(order)).filter(F.col(nth) == 1).select(*docs.columns)
