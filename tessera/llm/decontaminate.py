"""Benchmark decontamination: rare n-gram seeds propose, Smith-Waterman alignment decides.

A pair is contaminated when the best local alignment of the item with the
document (match 2, mismatch -1, gap -1) reaches ``MIN_SCORE`` of a perfect
copy's. Every such pair is found, wherever its edits stand:

An alignment with m matched words and e edits scores 2 m - e at most and has
e + 1 runs of matched words at most. If it reaches R of the 2 L that a perfect
copy of L words has, it has 2 L (1 - R) edits at most, spans (3 - 2 R) L words
at most, and keeps a number of the item's n-grams whole that L, n and R give
(``needed``). If m of an item's p n-grams must be whole, one of its p - m + 1
rarest is. Those are its seeds; of the sizes n with m > 0 an item takes the one
whose seeds are rarest in the corpus.

1. One scan counts the benchmark's n-grams in all documents.
2. A second scan cuts texts into blocks of twice the span, one span apart, so
   every alignment lies whole in one of them. Blocks that hold a seed become
   rows and are joined with the seeds and then with the items.
3. A block and an item meet once, at the least of the seeds they share. Pairs
   with enough whole words and n-grams in common are aligned.

Items have size classes by powers of two, each with a span of its own. The
tasks hold two bit tables of fixed size, which only let through more blocks as
they fill; the benchmark itself is a table that Spark joins.

Defined cases: null or wordless texts and items match nothing; short items
follow the same threshold (an item of one word matches that word, of three
words two neighbours are enough); repeated items and rows each give their own
pairs; empty tables give an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import bit_table, fresh, in_bit_table, pieces, ship, shipped, text_bytes
from tessera.session import materialize

NGRAM = 4  # longest seeds tried; the threshold decides which sizes can be used
MIN_SCORE = 0.6
MATCH, MISMATCH, GAP = 2, -1, -1
TABLE_LOG2 = 25
_ALIGN_CELLS = 1 << 20
_EPS = 1e-6


def _word_hashes(text: bytes) -> np.ndarray:
    words = text.decode("utf-8", "replace").lower().encode().translate(None, b".,;:!?\"'()[]").split()
    return np.fromiter(map(zlib.crc32, words), np.uint64, len(words))


def _ngrams(h: np.ndarray, n: int, level: int = 0) -> np.ndarray:
    """Hashes of the n-grams, as Spark longs; ``level`` keeps size classes apart."""
    out = np.zeros(max(0, len(h) - n + 1), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            out = out * np.uint64(0x9E3779B97F4A7C15) + h[k:k + len(out)]
        out ^= out >> np.uint64(31)
        out = out * np.uint64(0xD6E8FEB86659FD93) + np.uint64(n)
        out ^= np.uint64(level * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    return out.view(np.int64)


@lru_cache(maxsize=4096)
def needed(size: int, n: int, min_score: float) -> int:
    """How many of an item's n-grams any alignment over the threshold keeps whole."""
    most = int(2 * size * (1 - min_score) + _EPS)
    return min(ceil(min_score * size + e / 2 - _EPS) - (n - 1) * (e + 1) for e in (0, most))


def _level(size: int) -> int:
    return (size - 1).bit_length()


def _span(level: int, min_score: float) -> int:
    return int((3 - 2 * min_score) * (1 << level) + _EPS)


def align(item: np.ndarray, passages: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best local score of ``item`` in each row of ``passages`` (0: padding), and the column where it ends.

    ``item`` is one item for all rows, or one of the same length per row.
    """
    n, m = passages.shape
    steps = (GAP * np.arange(m + 1)).astype(np.int32)
    above = np.zeros((n, m + 1), np.int32)
    best, end = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for word in item.reshape(-1, item.shape[-1], 1).swapaxes(0, 1):
        row = np.zeros((n, m + 1), np.int32)
        row[:, 1:] = np.maximum(above[:, :-1] + np.where(passages == word, np.int32(MATCH), np.int32(MISMATCH)), above[:, 1:] + GAP)
        np.maximum(row, 0, out=row)
        row = np.maximum.accumulate(row - steps, axis=1) + steps  # gaps along the passage
        column = row.argmax(axis=1)
        top = row[np.arange(n), column]
        end = np.where(top > best, column, end)
        best = np.maximum(best, top)
        above = row
    return best, end


def _item_table(benchmark: DataFrame, item_id: str, text: str) -> DataFrame:
    """(iid, item_id, words): every item that has a word, under an id of its own row."""
    raw = benchmark.select(F.monotonically_increasing_id().alias("iid"), F.col(item_id).alias("item_id"), F.col(text).alias("text"))
    schema = T.StructType([raw.schema["iid"], raw.schema["item_id"], T.StructField("words", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [_word_hashes(t).astype(np.uint32).tobytes() for t in text_bytes(batch.column(2))]
            full = pa.array([len(w) > 0 for w in words], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(words, pa.binary())],
                                             names=schema.names).filter(full)

    return materialize(raw.mapInArrow(run, schema), "bench_items")


def _item_grams(items: DataFrame, min_score: float) -> DataFrame:
    """(iid, level, n, keep, plain, gram) per place of an n-gram; the ``keep`` rarest of size n suffice."""
    schema = "iid long, level int, n int, keep int, plain long, gram long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for iid, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                h = np.frombuffer(raw, np.uint32).astype(np.uint64)
                level = _level(len(h))
                for n in range(1, NGRAM + 1):
                    least = needed(len(h), n, min_score)
                    if least > 0:
                        plain, gram = _ngrams(h, n), _ngrams(h, n, level + 1)
                        same = [np.full(len(plain), x) for x in (iid, level, n, len(plain) - least + 1)]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(x, t) for x, t in zip([*same, plain, gram], [pa.int64()] + [pa.int32()] * 3 + [pa.int64()] * 2)],
                            names=["iid", "level", "n", "keep", "plain", "gram"])

    return items.select("iid", "words").mapInArrow(run, schema)


def _joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All words of the texts, the text of each, and where each text begins."""
    words = [_word_hashes(t) for t in texts]
    ends = np.cumsum([0, *map(len, words)])
    return np.concatenate(words), np.repeat(np.arange(len(texts)), np.diff(ends)), ends


def _found(h: np.ndarray, owner: np.ndarray, n: int, level: int, table: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Places of n-grams that the bit table may know, and their hashes; none reaches into the next text."""
    g = _ngrams(h, n, level)
    at = np.flatnonzero(in_bit_table(table, g, TABLE_LOG2))
    at = at[owner[at] == owner[at + n - 1]]
    return at, g[at]


def _corpus_counts(docs: DataFrame, grams: DataFrame, sizes: list[int]) -> DataFrame:
    """(plain, count) of the benchmark's n-grams over all documents."""
    sent = ship(docs.sparkSession, bit_table(grams.select("plain").distinct(), TABLE_LOG2))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shipped(sent)
        for batch in batches:
            texts = text_bytes(batch.column(0))
            for lo, hi in pieces(texts):
                h, owner, _ = _joined(texts[lo:hi])
                for n in sizes:
                    value, count = np.unique(_found(h, owner, n, 0, table)[1], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(value), pa.array(count)], names=["plain", "count"])

    seen = docs.select("text").mapInArrow(run, "plain long, count long")
    return seen.groupBy("plain").agg(F.sum("count").alias("count"))


def _seeds(grams: DataFrame, counts: DataFrame) -> DataFrame:
    """(iid, level, n, seeds): the seeds of each item, of the size whose seeds are rarest."""
    known = grams.join(counts, "plain", "left").withColumn("count", F.coalesce("count", F.lit(0)))
    rarest = Window.partitionBy("iid", "n").orderBy("count", "gram")
    kept = known.withColumn("nth", F.row_number().over(rarest)).filter("nth <= keep")
    sets = kept.groupBy("iid", "level", "n").agg(F.sum("count").alias("cost"), F.collect_set("gram").alias("seeds"))
    best = sets.groupBy("iid").agg(F.min_by(F.struct("level", "n", "seeds"), F.struct("cost", -F.col("n"))).alias("b"))
    return best.select("iid", "b.*")


def _blocks(h: np.ndarray, owner: np.ndarray, ends: np.ndarray, kinds: list[tuple[int, int]], table: bytes,
            min_score: float) -> Iterator[tuple[int, int, int, np.ndarray]]:
    """(text, start, stop, seeds) of the blocks that may hold a seed, for each size class."""
    for level in sorted({k for k, _ in kinds}):
        span = _span(level, min_score)
        rows, blocks, seeds = [], [], []
        for n in sorted(n for k, n in kinds if k == level):
            at, g = _found(h, owner, n, level + 1, table)
            row = owner[at]
            place, size = at - ends[row], ends[row + 1] - ends[row]
            block = place // span
            own = (block == 0) | (size > (block + 1) * span)  # else the block before holds all of it
            before = (block > 0) & (place + n <= (block + 1) * span)
            rows += [row[own], row[before]]
            blocks += [block[own], block[before] - 1]
            seeds += [g[own], g[before]]
        row, block, seed = np.concatenate(rows), np.concatenate(blocks), np.concatenate(seeds)
        order = np.lexsort((seed, block, row))
        row, block, seed = row[order], block[order], seed[order]
        first = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (block[1:] != block[:-1])][:len(row)])
        for a, b in zip(first.tolist(), [*first[1:].tolist(), len(row)]):
            r, start = int(row[a]), int(block[a]) * span
            yield r, start, min(start + 2 * span, int(ends[r + 1] - ends[r])), np.unique(seed[a:b])


def _passages(docs: DataFrame, seeds: DataFrame, min_score: float) -> DataFrame:
    """(id, h, start, words, grams): blocks of the documents and the seeds they may hold."""
    kinds = [(r["level"], r["n"]) for r in seeds.select("level", "n").distinct().collect()]  # powers of two x NGRAM
    sent = ship(docs.sparkSession, bit_table(seeds.select(F.explode("seeds")).distinct(), TABLE_LOG2))
    schema = T.StructType([docs.schema["id"], docs.schema["h"], T.StructField("start", T.LongType()),
                           T.StructField("words", T.BinaryType()), T.StructField("grams", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shipped(sent)
        for batch in batches:
            texts = text_bytes(batch.column(2))
            for lo, hi in pieces(texts):
                h, owner, ends = _joined(texts[lo:hi])
                rows, starts, words, grams = [], [], [], []
                for r, a, b, seed in _blocks(h, owner, ends, kinds, table, min_score):
                    rows.append(lo + r)
                    starts.append(a)
                    words.append(h[ends[r] + a:ends[r] + b].astype(np.uint32).tobytes())
                    grams.append(seed)
                for at in range(0, len(rows), 4096):
                    pick, part = pa.array(rows[at:at + 4096], pa.int64()), slice(at, at + 4096)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pick), batch.column(1).take(pick), pa.array(starts[part], pa.int64()),
                         pa.array(words[part], pa.binary()), pa.array(grams[part], pa.list_(pa.int64()))], names=schema.names)

    return docs.select("id", "h", "text").mapInArrow(run, schema)


def plausible(passages: list[np.ndarray], items: list[np.ndarray], min_score: float) -> np.ndarray:
    """Per pair: may an alignment reach the threshold, by the item's words and n-grams that the passage has?"""
    lengths = np.fromiter(map(len, items), np.int64, len(items))
    sizes, size_of = np.unique(lengths, return_inverse=True)
    sides = [(np.concatenate(side), np.repeat(np.arange(len(side)), list(map(len, side)))) for side in (items, passages)]
    ok = np.ones(len(items), bool)
    for n in range(1, NGRAM + 1):
        least = np.array([needed(s, n, min_score) for s in sizes.tolist()])[size_of]
        mine, theirs = (_owned(h, owner, n, ok & (least > 0)) for h, owner in sides)
        have = np.bincount(mine[1][np.isin(mine[0], theirs[0])], minlength=len(items))
        ok &= have >= least
    return ok


def _owned(h: np.ndarray, owner: np.ndarray, n: int, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of each row that is asked for, made different from row to row, and their rows."""
    own = asked[owner]
    h, owner = h[own], owner[own]
    g = _ngrams(h, n).view(np.uint64)
    whole = owner[:len(g)] == owner[len(owner) - len(g):]
    row = owner[:len(g)][whole]
    with np.errstate(over="ignore"):
        return g[whole] ^ row.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F), row


def score_pairs(passages: list[np.ndarray], items: list[np.ndarray], min_score: float) -> list[tuple[int, float, int]]:
    """(pair, score, end) of the pairs over the threshold; items of one length are aligned together."""
    if not items:
        return []
    out = []
    by_size: dict[int, list[int]] = {}
    for r in np.flatnonzero(plausible(passages, items, min_score)).tolist():
        by_size.setdefault(len(items[r]), []).append(r)
    for size, group in by_size.items():
        group.sort(key=lambda r: len(passages[r]))
        at = 0
        while at < len(group):
            part = group[at:at + max(1, _ALIGN_CELLS // (4 * len(passages[group[at]]) + 1))]
            table = np.zeros((len(part), max(len(passages[r]) for r in part)), np.uint64)
            for k, r in enumerate(part):
                table[k, :len(passages[r])] = passages[r] + np.uint64(1)
            best, end = align(np.stack([items[r] for r in part]) + np.uint64(1), table)
            scores = best / (MATCH * size)
            out += [(r, s, e) for r, s, e in zip(part, scores.tolist(), end.tolist()) if s >= min_score]
            at += len(part)
    return out


def _aligned(pairs: DataFrame, min_score: float) -> DataFrame:
    """``pairs`` over the threshold: their words give way to ``score`` and ``end_word``."""
    names = ["id", "h", "iid", "item_id", "start"]
    schema = T.StructType([pairs.schema[c] for c in names]
                          + [T.StructField("score", T.DoubleType()), T.StructField("end_word", T.LongType())])

    def words(column: pa.Array) -> list[np.ndarray]:
        return [np.frombuffer(x, np.uint32).astype(np.uint64) for x in column.to_pylist()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = sorted(score_pairs(words(batch.column(5)), words(batch.column(6)), min_score))
            pick = pa.array([r for r, _, _ in got], pa.int64())
            starts = batch.column(4).take(pick).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(k).take(pick) for k in range(5)]
                + [pa.array([s for _, s, _ in got], pa.float64()), pa.array([a + e for a, (_, _, e) in zip(starts, got)], pa.int64())],
                names=schema.names)

    return pairs.select(*names, "words", "item_words").mapInArrow(run, schema)


def candidate_pairs(docs: DataFrame, benchmark: DataFrame, item_id: str = "item_id", item_text: str = "text",
                    min_score: float = MIN_SCORE) -> DataFrame | None:
    """(id, h, start, words, iid, item_id, item_words) of (id, h, text) ``docs``: blocks and items that share a seed.

    None if no item has a word.
    """
    items = _item_table(benchmark, item_id, item_text)
    grams = materialize(_item_grams(items, min_score), "bench_grams")
    sizes = [r["n"] for r in grams.select("n").distinct().collect()]
    if not sizes:
        return None
    seeds = materialize(_seeds(grams, _corpus_counts(docs, grams, sizes)), "bench_seeds")
    # Written, so that both joins go by measured sizes and passages move only for a large benchmark.
    known = materialize(items.withColumnRenamed("words", "item_words").join(seeds.select("iid", "seeds"), "iid"), "bench_known")
    owners = materialize(seeds.select(F.explode("seeds").alias("gram"), "iid"), "bench_owners")
    found = _passages(docs, seeds, min_score).withColumn("gram", F.explode("grams"))
    found = found.join(owners, "gram").join(known, "iid")
    # Of the seeds that a block and an item share, the least one speaks for all.
    found = found.filter(F.array_min(F.array_intersect("grams", "seeds")) == F.col("gram"))
    return found.drop("gram", "grams", "seeds")


def contaminated_pairs(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
                       item_id: str = "item_id", item_text: str = "text", min_score: float = MIN_SCORE) -> DataFrame:
    """(doc_id, item_id, score, end_word) of each document that holds (a copy of) a test item."""
    slim = docs.select(F.col(doc_id).alias("id"), F.xxhash64(text).alias("h"), F.col(text).alias("text"))
    found = candidate_pairs(slim, benchmark, item_id, item_text, min_score)
    if found is None:
        empty = T.StructType([T.StructField(doc_id, docs.schema[doc_id].dataType),
                              T.StructField("item_id", benchmark.schema[item_id].dataType),
                              T.StructField("score", T.DoubleType()), T.StructField("end_word", T.LongType())])
        return docs.sparkSession.createDataFrame([], empty)
    # Repeated rows give the same blocks each, so the rows of the best block are the copies.
    pair = ["id", "h", "iid", "item_id"]
    tops = _aligned(found, min_score).groupBy(*pair, "start", "score", "end_word").agg(F.count("*").alias("copies"))
    best = tops.groupBy(*pair).agg(F.max(F.struct("score", (-F.col("end_word")).alias("back"), "start", "copies")).alias("b"))
    best = best.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("b.copies"))))
    return best.select(F.col("id").alias(doc_id), "item_id", "b.score", (-F.col("b.back")).alias("end_word"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
                      item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``docs`` without contaminated documents; rows equal in id and text go together."""
    key = fresh(docs, "__key")
    keyed = docs.withColumn(key, F.struct(F.col(doc_id).alias("id"), F.xxhash64(text).alias("h")))
    pairs = contaminated_pairs(keyed.select(key, text), benchmark, key, text, item_id, item_text)
    bad = materialize(pairs.select(F.col(f"{key}.id").alias("bid"), F.col(f"{key}.h").alias("bh")).distinct(), "contaminated")
    keyed = docs.withColumn(key, F.xxhash64(text))
    return keyed.join(bad, keyed[doc_id].eqNullSafe(bad["bid"]) & (keyed[key] == bad["bh"]), "left_anti").drop(key)
