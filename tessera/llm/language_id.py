"""Language identification: averaged hashed subword embeddings and a linear softmax.

A text's letters (other characters become spaces) give all byte n-grams of
length 1 to 3, hashed into ``BUCKETS`` rows of an embedding table; their mean goes
through a linear softmax. Both are trained by stochastic gradient descent in
numpy on a bounded, documented sample: about ``SAMPLE`` different texts per
language, chosen by a hash of the text, of every language. The driver holds their
subword counts as sparse rows and fills one small batch of them at a time. A
fifth of the sample sets the softmax temperature and the score below which a
prediction is rejected (column ``rejected``).

Defined cases: a text that is null or has no letter is ``und`` with score 0;
without any labelled row every text is ``und``; repeated rows are judged alike;
very long texts are read whole, a slice at a time; extra columns are dropped.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import add_text_columns, crc_mod, ship, shipped
from tessera.session import materialize

BUCKETS = 4096
WIDTH = 16
SAMPLE = 500
EPOCHS = 12
RATE = 0.5
PRECISION = 0.99
UNKNOWN = "und"
_SLICE = 1 << 20
_LETTER = re.compile(r"[^\W\d_]")
_TO_LETTERS = bytes(c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def features(text: bytes) -> np.ndarray | None:
    """Counts of the text's hashed subwords; None if it has no letter."""
    decoded = text.decode("utf-8", "replace")
    if not _LETTER.search(decoded):
        return None
    clean = b" " + b" ".join(decoded.lower().encode().translate(_TO_LETTERS).split()) + b" "
    counts = np.zeros(BUCKETS, np.int64)
    for at in range(0, len(clean), _SLICE):
        x = np.frombuffer(clean, np.uint8, min(_SLICE + 2, len(clean) - at), at).astype(np.uint32)
        here = x[:_SLICE]
        two = (here[:len(x) - 1] << 8) | x[1:1 + min(len(x) - 1, len(here))]
        three = (two[:max(0, len(x) - 2)] << 8) | x[2:2 + min(max(0, len(x) - 2), len(two))]
        for n, grams in ((1, here), (2, two), (3, three)):
            h = (grams + np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)
            h ^= h >> np.uint32(15)
            counts += np.bincount((h * np.uint32(0xC2B2AE35)) >> np.uint32(20), minlength=BUCKETS)
    return counts


class Model:
    def __init__(self, languages: list[str], table: np.ndarray, bias: np.ndarray, temperature: float, reject: float):
        self.languages, self.table, self.bias = languages, table, bias
        self.temperature, self.reject = temperature, reject

    def predict(self, text: bytes) -> tuple[str, float, bool]:
        counts = features(text) if self.languages else None
        if counts is None:
            return UNKNOWN, 0.0, True
        p = softmax((counts @ self.table / counts.sum() + self.bias)[None, :] / self.temperature)[0]
        k = int(p.argmax())
        return self.languages[k], float(min(1.0, p[k])), bool(p[k] < self.reject)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(rows: list[tuple[str, bytes, bool]], seed: int = 7) -> Model:
    """A model from (language, ``sparse`` counts, used for calibration) rows."""
    languages = sorted({r[0] for r in rows})
    if not languages:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros(0), 1.0, 0.0)
    place = {lang: k for k, lang in enumerate(languages)}
    y = np.array([place[r[0]] for r in rows])
    aside = np.array([r[2] for r in rows])
    if aside.all() or set(y[~aside]) != set(y):
        aside[:] = False
    rng = np.random.default_rng(seed)
    emb = rng.uniform(-1, 1, (BUCKETS, WIDTH)) / WIDTH
    out, bias = np.zeros((WIDTH, len(languages))), np.zeros(len(languages))
    counts = [r[1] for r in rows]
    learn = np.flatnonzero(~aside)
    yt = y[learn]
    weight = len(yt) / (len(languages) * np.bincount(yt, minlength=len(languages)))  # languages count alike
    scale = 1 / np.mean([(dense([counts[k]]) ** 2).sum() for k in learn])  # features are frequencies, so steps on the table are larger
    out = rng.uniform(-1, 1, out.shape) / WIDTH
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        order = rng.permutation(len(yt))
        for at in range(0, len(order), 16):
            pick = order[at:at + 16]
            x = dense([counts[k] for k in learn[pick]])
            h = x @ emb
            g = softmax(h @ out + bias)
            g[np.arange(len(pick)), yt[pick]] -= 1
            g *= (weight[yt[pick]] / len(pick))[:, None]
            back = g @ out.T
            out -= rate * (WIDTH * h.T @ g)
            bias -= rate * g.sum(axis=0) * 0.1
            emb -= rate * scale * (x.T @ back)
    table = emb @ out
    held = np.flatnonzero(aside if aside.any() else ~aside)
    logits = np.concatenate([dense([counts[k] for k in held[at:at + 256]]) @ table for at in range(0, len(held), 256)]) + bias
    temperature, reject = calibrate(logits, y[held])
    return Model(languages, table.astype(np.float64), bias, temperature, reject)


def sparse(counts: np.ndarray) -> bytes:
    """The subwords of a text and their counts, as pairs of 32-bit numbers: bucket, float."""
    at = np.flatnonzero(counts)
    return at.astype(np.uint32).tobytes() + counts[at].astype(np.float32).tobytes()


def dense(rows: list[bytes]) -> np.ndarray:
    """Subword frequencies of sparse rows."""
    x = np.zeros((len(rows), BUCKETS), np.float32)
    for k, raw in enumerate(rows):
        half = len(raw) // 2
        x[k, np.frombuffer(raw[:half], np.uint32)] = np.frombuffer(raw[half:], np.float32)
    return x / np.maximum(x.sum(axis=1, keepdims=True), 1)


def calibrate(logits: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """The temperature of least log loss, and the lowest score that keeps ``PRECISION``."""
    grid = np.geomspace(0.05, 20, 60)
    loss = [-np.log(np.maximum(softmax(logits / t)[np.arange(len(y)), y], 1e-12)).mean() for t in grid]
    t = float(grid[int(np.argmin(loss))])
    p = softmax(logits / t)
    score, right = p.max(axis=1), p.argmax(axis=1) == y
    order = np.argsort(-score)
    good = np.cumsum(right[order]) >= PRECISION * np.arange(1, len(y) + 1)
    return t, float(score[order][np.flatnonzero(good)[-1]]) if good.any() else 1.0


def fit(docs: DataFrame, train_rows: Column, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """The model learned from the rows that ``train_rows`` allows and that carry a language."""
    # Texts by hash: copies count once, so that no group of them outgrows the sample.
    labelled = docs.filter(train_rows & F.col(lang).isNotNull() & F.col(text).isNotNull())
    labelled = labelled.select(F.col(lang).alias("lang"), F.xxhash64(text).alias("place"), F.col(text).alias("text"))
    sizes = materialize(labelled.groupBy("lang").agg(F.approx_count_distinct("place").alias("n")), "lang_sizes")
    near = F.pmod("place", F.lit(1_000_000)) / 1e6 < F.lit(SAMPLE) / F.greatest("n", F.lit(1))
    picked = labelled.join(sizes, "lang").filter(near).groupBy("lang", "place").agg(F.min("text").alias("text"))
    picked = picked.select("lang", "text", (F.pmod(F.xxhash64("place", F.lit("calibration")), F.lit(5)) == 0).alias("aside"))

    def count(texts: list[bytes]) -> list:
        got = [features(t) for t in texts]
        return [[None if c is None else sparse(c) for c in got]]

    counted = add_text_columns(picked, "text", [T.StructField("counts", T.BinaryType())], lambda: count, drop=("text",))
    rows = [(r["lang"], bytes(r["counts"]), r["aside"]) for r in counted.filter("counts is not null").collect()]
    return train(sorted(rows))


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` without the text, with ``lang_pred``, ``score`` and ``rejected``."""
    sent = ship(docs.sparkSession, model)

    def make():
        known = shipped(sent)
        return lambda texts: list(zip(*(known.predict(t) for t in texts)))

    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
              T.StructField("rejected", T.BooleanType())]
    return add_text_columns(docs, text, fields, make, drop=(text,))


def identify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected; learned outside the held-out quarter."""
    held = crc_mod(F.col(doc_id), 4) == 2
    model = fit(docs, ~held, doc_id, text, lang)
    out = predict(docs.select(F.col(doc_id), held.alias("held_out"), F.col(text)), model, text)
    return out.select(doc_id, "held_out", "lang_pred", "score", "rejected")
