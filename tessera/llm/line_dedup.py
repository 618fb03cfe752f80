"""Line dedup by repeated runs of lines, or by content-defined chunks of lines.

The query and the pipeline look up the content-defined chunks and, so that no
shared passage hangs on where a boundary falls, the runs around them
(``runs=True``): every ``MIN_LINES`` neighbouring lines, overlapping, and every
line of ``LONG_WORDS`` words or ``LONG_BYTES`` bytes alone. What has less than
``RUN_WORDS`` words with a letter or digit is no passage: doubled blank lines,
braces and rules stay. Without ``runs`` only chunks are looked up, which is less
to move but misses passages that no chunk boundary happens to enclose.

For chunks a text is cut at newlines. A rolling hash over the hashes of the last
``SPAN`` lines closes a chunk where it falls on zero modulo ``DIVISOR`` (and
at ``MAX_LINES`` at the latest), so a boundary depends on the lines just ahead
of it only and shared passages are cut alike wherever they stand. A chunk that
stands in several places of the corpus is kept at its first place, the
smallest (doc_id, text hash, position), and removed from all others. Where a
shared passage begins or ends between two boundaries, the lines next to the
chunk go too, as far as they equal those next to the first place, byte for
byte; the search covers the chunk and ``SPAN`` - 1 lines before and the chunk
after, which hold all the lines that the surroundings can have shifted. Only
chunks of ``MIN_LINES`` lines or more go. Either way a short line that repeats
alone stays, and every line that goes has an equal one at a smaller place.

Hashes only propose. A first scan counts the hashes of all chunks or runs; those that
occur twice set bits in a table of fixed size. A second scan gives out the
bytes of the chunks whose bit is set, with the lines beside them, and these
are grouped by hash and bytes, so neither a collision nor a crowded table ever
removes a line. Grouping pre-aggregates in the map tasks, so a chunk that a
third of the corpus holds reaches its reducer as one row a task. Whole texts
move once, to meet the list of their lines to cut.

Defined cases: null texts have no line and stay null; without ``runs``
blank-only chunks count like any other; a null id sorts last; rows equal in id and text are one
document and get the same verdict; empty tables give empty tables; extra
columns of ``documents`` pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import bit_table, fresh, in_bit_table, null_safe, pieces, text_bytes
from tessera.session import materialize

SPAN = 2
DIVISOR = 2
MIN_LINES = 2
MAX_LINES = 64
RUN_WORDS = 4
LONG_WORDS = 50
LONG_BYTES = 300
FILTER_LOG2 = 24
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15


def chunk_ends(lines: list[bytes]) -> list[int]:
    """Stops (exclusive line indexes) of the chunks of a text's lines."""
    ends, start, roll = [], 0, 0
    hashes = [xxhash.xxh64_intdigest(x, 0) for x in lines]
    drop = pow(_BASE, SPAN, 1 << 64)
    for i, h in enumerate(hashes):
        roll = (roll * _BASE + h) & _MASK
        if i >= SPAN:
            roll = (roll - drop * hashes[i - SPAN]) & _MASK
        if (roll >> 33) % DIVISOR == 0 or i + 1 - start >= MAX_LINES:
            ends.append(i + 1)
            start = i + 1
    if start < len(lines):
        ends.append(len(lines))
    return ends


def _chunks(text: bytes) -> Iterator[tuple[int, int, bytes, list[bytes], list[bytes]]]:
    """(first line, lines, bytes, lines before, lines after) of each chunk, the lines beside it nearest first."""
    lines = text.split(b"\n")
    cuts = [0, *chunk_ends(lines)]
    for k, (start, end) in enumerate(zip(cuts, cuts[1:])):
        before = lines[max(0, cuts[max(k - 1, 0)] - SPAN + 1):start][::-1]
        yield start, end - start, b"\n".join(lines[start:end]), before, lines[end:cuts[min(k + 2, len(cuts) - 1)]]


#: Everything but ASCII letters, digits, newlines and bytes of other scripts becomes a space.
_TO_WORDS = bytes(c if c >= 128 or chr(c).isalnum() or c == 10 else 32 for c in range(256))


def _passages(text: bytes) -> Iterator[tuple[int, int, bytes, list[bytes], list[bytes]]]:
    """Like ``_chunks``, and of the runs around them; runs overlap, so nothing beside a passage is needed."""
    lines = text.split(b"\n")
    words = [len(x.split()) for x in text.translate(_TO_WORDS).split(b"\n")]
    start = 0
    for end in chunk_ends(lines):
        if end - start > MIN_LINES and sum(words[start:end]) >= RUN_WORDS:  # shorter ones are runs
            yield start, end - start, b"\n".join(lines[start:end]), [], []
        start = end
    for k in range(len(lines) - MIN_LINES + 1):
        if sum(words[k:k + MIN_LINES]) >= RUN_WORDS:
            yield k, MIN_LINES, b"\n".join(lines[k:k + MIN_LINES]), [], []
    for k, line in enumerate(lines):
        if len(line) >= LONG_BYTES or len(line) >= 2 * LONG_WORDS - 1 and len(line.split()) >= LONG_WORDS:
            yield k, 1, line, [], []


def _chunk_hashes(texts: DataFrame, cut=_chunks) -> DataFrame:
    """(chunk): the hash of each chunk of the texts in the only column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [xxhash.xxh64_intdigest(c[2], 1) for t in text_bytes(batch.column(0)) for c in cut(t)]
            yield pa.RecordBatch.from_arrays([pa.array(np.array(found, np.uint64).view(np.int64))], names=["chunk"])

    return texts.mapInArrow(run, "chunk bigint")


def _chunk_rows(keyed: DataFrame, table, log2: int, cut=_chunks) -> DataFrame:
    """(id, h, chunk, at, n, body, before, after) of the chunks whose hash may be in the bit table."""
    line = T.StringType()
    fields = [keyed.schema["id"], keyed.schema["h"], T.StructField("chunk", T.LongType()),
              T.StructField("at", T.IntegerType()), T.StructField("n", T.IntegerType()), T.StructField("body", line),
              T.StructField("before", T.ArrayType(line)), T.StructField("after", T.ArrayType(line))]
    strings, lists = (pa.binary(), pa.string()), (pa.list_(pa.binary()), pa.list_(pa.string()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_bytes(batch.column(2))
            for lo, hi in pieces(texts):
                found = [(i, *c) for i in range(lo, hi) for c in cut(texts[i])]
                chunk = np.array([xxhash.xxh64_intdigest(c[3], 1) for c in found], np.uint64).view(np.int64)
                kept = np.flatnonzero(in_bit_table(table.value, chunk, log2))
                found, chunk = [found[k] for k in kept.tolist()], chunk[kept]
                row = pa.array([c[0] for c in found], pa.int64())
                made = [batch.column(0).take(row), batch.column(1).take(row), pa.array(chunk),
                        pa.array([c[1] for c in found], pa.int32()), pa.array([c[2] for c in found], pa.int32())]
                for k, (raw, kind) in ((3, strings), (4, lists), (5, lists)):
                    made.append(pa.array([c[k] for c in found], raw).cast(kind))
                yield pa.RecordBatch.from_arrays(made, names=[f.name for f in fields])

    return keyed.mapInArrow(run, T.StructType(fields))


def _alike(a: Column, b: Column) -> Column:
    """How many lines two lists begin with in common."""
    differ = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), F.lit(False)).cast("int")
    return F.when(differ > 0, differ - 1).otherwise(F.size(a))


def repeated_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", runs: bool = False) -> DataFrame:
    """(key, h, gone): for each document (id key, text hash) that loses lines the spans (at, n) to cut; they may overlap."""
    keyed = docs.select(F.struct(null_safe(F.col(doc_id)).alias("key"), F.col(doc_id).alias("id")).alias("id"),
                        F.xxhash64(text).alias("h"), F.col(text).alias("text"))
    cut, least = (_passages, 1) if runs else (_chunks, MIN_LINES)
    twice = _chunk_hashes(keyed.select("text"), cut).groupBy("chunk").count().filter("count > 1").select("chunk")
    table = docs.sparkSession.sparkContext.broadcast(bit_table(twice, FILTER_LOG2))
    # Rows equal in id and text share their places: they propose chunks, but remove none.
    bodies = materialize(_chunk_rows(keyed, table, FILTER_LOG2, cut), "line_bodies")
    place = F.struct(F.col("id.id").isNull().alias("none"), F.col("id.id").alias("id"), "h", "at")
    bodies = bodies.withColumn("place", place)
    first = (bodies.groupBy("chunk", "body").agg(F.min(F.struct("place", "before", "after")).alias("first"), F.count("*").alias("places"))
             .filter("places > 1").drop("places"))
    # Written, so that both sides of the join are plain exchanges: Spark splits a chunk of many places.
    first = materialize(first, "line_first").hint("merge")
    later = bodies.join(first, ["chunk", "body"]).filter("place <> first.place")
    back, on = _alike(F.col("before"), F.col("first.before")), _alike(F.col("after"), F.col("first.after"))
    spans = later.select(F.col("id.key").alias("key"), "h", "at", "n", back.alias("back"), on.alias("on"))
    span = F.struct((F.col("at") - F.col("back")).alias("at"), (F.col("n") + F.col("back") + F.col("on")).alias("n"))
    return spans.select("key", "h", span.alias("span")).filter(F.col("span.n") >= least).groupBy("key", "h").agg(F.collect_set("span").alias("gone"))


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                removed: str = "n_removed_lines", runs: bool = False) -> DataFrame:
    """``docs`` with repeated chunks (``runs``: runs) cut from the text, and the number of lines cut."""
    gone = materialize(repeated_lines(docs, doc_id, text, runs), "line_gone")
    key, hash_, list_, key2, hash2 = (fresh(docs, c) for c in ("__key", "__h", "__gone", "__key2", "__h2"))
    gone = gone.toDF(key2, hash2, list_)
    out = docs.withColumn(key, null_safe(F.col(doc_id))).withColumn(hash_, F.xxhash64(text))
    # A sorted merge at every size: the texts move once.
    out = out.join(gone.hint("merge"), (F.col(key) == F.col(key2)) & (F.col(hash_) == F.col(hash2)), "left")
    lines = F.split(text, "\n", -1)
    # Line numbers that stay, by a hash set: linear in the lines, however many spans there are.
    cut = F.flatten(F.transform(list_, lambda s: F.sequence(s["at"], s["at"] + s["n"] - 1)))
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), cut)
    out = out.withColumn(list_, F.when(F.col(list_).isNotNull(), F.transform(stay, lambda i: F.get(lines, i))))
    return out.select(
        *[F.when(F.col(list_).isNull(), F.col(c)).otherwise(F.array_join(list_, "\n")).alias(c) if c == text else F.col(f"`{c}`")
          for c in docs.columns if c != removed],
        F.when(F.col(list_).isNull(), 0).otherwise(F.size(lines) - F.size(list_)).cast("long").alias(removed))


def drop_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """Pipeline form: texts without repeated runs; a document left without any word goes."""
    removed = fresh(docs, "__removed")
    out = dedup_lines(docs, doc_id, text, removed, runs=True)
    out = out.filter((F.col(removed) == 0) | F.col(text).rlike(r"[^\x20\x09-\x0D]"))
    if n_chars in docs.columns:
        out = out.withColumn(n_chars, F.when(F.col(removed) == 0, F.col(n_chars)).otherwise(F.length(text)))
    return out.select(*docs.columns)
