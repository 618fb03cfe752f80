"""Shared pieces of the text operators: Arrow batches of bounded size, words, unique names.

Text work runs in ``mapInArrow``: Spark deals the rows, each task sees Arrow
batches of at most ``BATCH_ROWS`` rows, and every batch is worked on in
pieces of about ``PIECE_BYTES`` of text, so a task's memory depends on the
longest single text, never on the table.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import configure

BATCH_ROWS = 1000
BATCH_BYTES = 16 << 20
PIECE_BYTES = 2 << 20


def tuned(spark: SparkSession) -> SparkSession:
    """Session settings of the text operators: small Arrow batches, bounded in rows and bytes."""
    return configure(spark, {
        "spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_ROWS),
        "spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH_BYTES),
    })


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tuned(spark).read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a variant of it that is no column of ``df`` (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null counts as empty."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def pieces(texts: list[bytes], limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive index ranges of about ``limit`` bytes, one text at least."""
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield start, i
            start, size = i, 0
        size += len(t) + 16
    if start < len(texts):
        yield start, len(texts)


def add_text_columns(df: DataFrame, text: str, fields: list[T.StructField],
                     make: Callable[[], Callable[[list[bytes]], list]],
                     drop: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with columns computed from its texts, one task-local function per task.

    ``make()`` runs once per task and returns ``fn(texts) -> columns`` (one
    sequence per field). A field that carries a name of ``df`` replaces that column.
    """
    names = [f.name for f in fields]
    kept = [c for c in df.columns if c not in names and c not in drop]
    schema = T.StructType([df.schema[c] for c in kept] + fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn, arrow = make(), None
        for batch in batches:
            texts = text_bytes(batch.column(batch.schema.get_field_index(text)))
            for lo, hi in pieces(texts):
                made = fn(texts[lo:hi])
                old = [batch.column(batch.schema.get_field_index(c)).slice(lo, hi - lo) for c in kept]
                arrow = arrow or [_arrow_type(f.dataType) for f in fields]
                new = [pa.array(v, type=t) for v, t in zip(made, arrow)]
                yield pa.RecordBatch.from_arrays(old + new, names=kept + names)

    return df.mapInArrow(run, schema)


def _arrow_type(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def word_ids(words: list[bytes]) -> tuple[np.ndarray, int]:
    """Exact ids of the words (equal words, equal ids) and how many ids there are."""
    vocabulary = dict.fromkeys(words)
    for i, w in enumerate(vocabulary):
        vocabulary[w] = i
    return np.fromiter(map(vocabulary.__getitem__, words), np.int64, len(words)), len(vocabulary)


def split_words(texts: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """Words between ASCII white space (space, 09-0D) and the offset of each text's first word."""
    each = [t.split() for t in texts]
    ends = np.zeros(len(each) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, each), np.int64, len(each)), out=ends[1:])
    return list(chain.from_iterable(each)), ends


def null_safe(value: Column) -> Column:
    """A string key that is never null: equal for equal values, and for null only by null."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit(""))


def crc_mod(doc_id: Column, by: int) -> Column:
    """crc32 of the id's decimal text, modulo ``by``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % by


def ship(spark: SparkSession, value):
    """A broadcast of any value of this package, with its code; read it with ``shipped`` in a task."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def shipped(broadcast):
    return pickle.loads(broadcast.value)


def bit_table(hashes: DataFrame, log2: int) -> bytes:
    """A table of 2 ** ``log2`` bits, set at the low bits of the hashes in the only column.

    Spark joins the bits, 64 to a row; the size doesn't depend on the data.
    """
    hashes = hashes.toDF("h")
    place = F.col("h").bitwiseAND((1 << log2) - 1)
    bit = F.expr("shiftleft(1L, cast(h & 63 as int))")
    rows = hashes.select(F.shiftright(place, 6).alias("w"), bit.alias("b")).groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    table = np.zeros(1 << (log2 - 6), np.int64)
    table[rows["w"].to_numpy()] = rows["b"].to_numpy()
    return table.tobytes()


def in_bit_table(table: bytes, hashes: np.ndarray, log2: int) -> np.ndarray:
    """Which hashes have their bit set; every hash that was put in does."""
    at = hashes & ((1 << log2) - 1)
    return ((np.frombuffer(table, np.int64)[at >> 6] >> (at & 63)) & 1).astype(bool)
