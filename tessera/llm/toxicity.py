"""Toxicity by class-conditional Kneser-Ney models.

Words are spelled letter by letter from their start to their end, which is a
letter of its own; a context is the ``ORDER`` - 1 letters before, or the whole beginning of the word
where that is shorter. For the toxic and for the ordinary class

    P(letter | context) = max(C - D, 0) / C(context) + D * N(context) / C(context) * S(letter | last two)

with N the number of different letters seen after the context. S is shared by
the classes: a Kneser-Ney continuation model, the number of different contexts
that the letter follows, given the last two letters, itself smoothed by
shorter ones. Rare expressions so lean on what both classes share. A letter unseen after a seen context
has the ratio of the two backoff weights D * N / C, as S cancels; after an unseen
context both classes say S, and the ratio is 0. A text's
two log-likelihoods are compared per word; their difference and the strongest
single words go through a logistic calibration.

A node is a context and a letter, ``ORDER`` letters of ``BITS`` bits in one number: a to z and
the end have their own numbers, digits share one, other letters go by their code point
modulo 994, which keeps the letters of an alphabet apart (S has 64 symbols, and folds them further). Counts are
added up in Spark by node, over every counted row, and the log-ratios are computed there. Two
kinds of rows are written: a context's backoff ratio, and by how much a node's ratio
differs from it. A word's score is so the sum of all rows that its letters meet. The
rows are a written table that grows with the input. Scoring is exact over all of it, in two steps. The tasks get the most
frequent rows, ``NODES`` at most, and a table of 2 ** ``REST_LOG2`` bits set by
all others. A word whose rows are all in hand or surely unseen is scored at
once. The others are given out with the codes that are open, meet the
written table in a join and come back to their text. Frequent words so never
move, and neither bound changes a score. Copies of a text share one answer, which
is dealt over ``SALTS`` parts so that no group of copies meets in one task.

Of the rows that may be learned from (residues 1 to 4 of the id), residues 1 to 3 are
counted; the calibration is fitted on residue 4, a sample of about
``CALIBRATION`` different texts of it.

Labels meet texts in a join on the id. A table of 2 ** ``FILTER_LOG2`` bits,
whose size doesn't depend on the data, first drops most unlabelled texts; it has
no false negatives, so it changes no result.

Defined cases: null texts count as empty; an empty text has the score of a text
without evidence; without labelled rows every score is 0; several labels of an
id count as toxic if one says so; repeated rows count each; very long texts and
words are read whole; extra columns are dropped.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import (
    add_text_columns, bit_table, crc_mod, in_bit_table, pieces, ship, shipped, split_words, text_bytes,
)
from tessera.session import materialize

DISCOUNT = 0.75
NODES = 1 << 20
REST_LOG2 = 24
FILTER_LOG2 = 23
CALIBRATION = 20_000
CLEAR = 3.0
SALTS = 16
ORDER, BITS = 6, 10
SPELL_BYTES = 1 << 18
FEATURES = ("mean", "top", "second", "clear")

_LETTERS = bytes(c if 97 <= c <= 122 or 48 <= c <= 57 or c >= 128 else 32 for c in range(256))
#: Letters as numbers: 0 ends a word, 1..26 a to z, 27 digits, 28..1021 other letters; any unseen letter; what stands before a word.
_END, _OTHERS, _UNSEEN, _START = 0, 994, (1 << BITS) - 2, (1 << BITS) - 1
#: S folds the other letters and the start to 28..63.
SYMBOLS = 64


def normal_words(texts: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    return split_words([t.decode("utf-8", "replace").lower().encode().translate(_LETTERS) for t in texts])


def spell(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(node, number of the word) of every letter of every word, its end included."""
    points = np.frombuffer((b"\n".join(words) + b"\n").decode().encode("utf-32-le"), np.uint32).astype(np.int64)
    ends = points == 10
    letters = np.where(points < 128, points - 96, 28 + points % _OTHERS)
    letters[(points >= 48) & (points <= 57)] = 27
    letters[ends] = _END
    word = np.cumsum(ends) - ends
    place = np.arange(len(points)) - np.concatenate([[0], np.flatnonzero(ends)[:-1] + 1])[word]
    past = np.concatenate([np.full(ORDER, _START), letters])
    codes = np.zeros(len(points), np.int64)
    for back in range(ORDER - 1, -1, -1):
        codes = (codes << BITS) | np.where(place >= back, past[ORDER - back:len(past) - back], _START)
    return codes, word


def backoff_code(codes: np.ndarray) -> np.ndarray:
    """The codes of the backoff ratios of nodes' contexts."""
    return codes >> BITS << BITS | _UNSEEN


def mixed(codes):
    """Spreads codes over their low bits; ``>>`` of numpy numbers or of a column's name."""
    if isinstance(codes, str):
        return F.col(codes).bitwiseXOR(F.shiftright(codes, 25)).bitwiseXOR(F.shiftright(codes, 48))
    return codes ^ (codes >> 25) ^ (codes >> 48)


def spelled(words: list[bytes]) -> Iterator[tuple[int, int]]:
    """Index ranges of words of about ``SPELL_BYTES`` bytes, for ``spell``; one word at least."""
    return pieces(words, SPELL_BYTES)


def shared_model(grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """S for every last three symbols, from how many nodes end in each of them.

    Each node is one context of its last letters, so these are continuation counts.
    """
    three = np.bincount(grams, counts, minlength=SYMBOLS ** 3)
    codes = np.arange(SYMBOLS ** 3)
    shared = np.full(len(codes), 1 / SYMBOLS)
    for letters in (1, 2, 3):
        gram = codes % SYMBOLS ** letters
        count = np.bincount(gram, three, minlength=SYMBOLS ** letters).reshape(-1, SYMBOLS)
        total, kinds = count.sum(axis=1), (count > 0).sum(axis=1)
        before = gram // SYMBOLS
        c, t, n = count.ravel()[gram], np.maximum(total, 1)[before], kinds[before]
        shared = np.where(total[before] > 0, np.maximum(c - DISCOUNT, 0) / t + DISCOUNT * n / t * shared, shared)
    return shared


def node_ratios(counts: DataFrame) -> DataFrame:
    """(code, n, ratio) of (code, toxic, ordinary): per context the log-ratio of toxic to ordinary backoff, per node what its own adds."""
    spark = counts.sparkSession

    def symbol(back: int) -> Column:
        letter = F.shiftright("code", BITS * back).bitwiseAND((1 << BITS) - 1)
        return F.when(letter < 28, letter).otherwise(28 + (letter - 28) % (SYMBOLS - 28))

    gram = ((symbol(2) * SYMBOLS + symbol(1)) * SYMBOLS + symbol(0)).cast("int")
    grams = counts.groupBy(gram.alias("gram")).count().toArrow()  # SYMBOLS ** 3 rows at most
    shared = shared_model(grams["gram"].to_numpy(), grams["count"].to_numpy().astype(float))
    smooth = spark.createDataFrame(pd.DataFrame({"gram": np.arange(SYMBOLS ** 3, dtype=np.int32), "s": shared}))
    context = Window.partitionBy(F.shiftright("code", BITS))  # 2 ** BITS letters at most

    def total(c: str) -> Column:
        return F.sum(c).over(context)

    def weight(c: str) -> Column:  # of S; all of it after a context that the class doesn't know
        kinds = F.sum((F.col(c) > 0).cast("long")).over(context)
        return F.when(total(c) > 0, DISCOUNT * kinds / total(c)).otherwise(F.lit(1.0))

    def log_p(c: str) -> Column:
        plain = F.when(total(c) > 0, F.greatest(F.col(c) - DISCOUNT, F.lit(0.0)) / total(c)).otherwise(F.lit(0.0))
        return F.log(plain + weight(c) * F.col("s"))

    back = F.log(weight("toxic")) - F.log(weight("ordinary"))
    one = counts.withColumn("gram", gram).join(smooth, "gram").select(
        "code", (F.col("toxic") + F.col("ordinary")).alias("n"), (total("toxic") + total("ordinary")).alias("all"), back.alias("back"),
        (log_p("toxic") - log_p("ordinary")).alias("own"), (F.min("code").over(context) == F.col("code")).alias("first"))
    node = F.struct("code", "n", (F.col("own") - F.col("back")).alias("ratio"))
    behind = F.struct(F.shiftleft(F.shiftright("code", BITS), BITS).bitwiseOR(F.lit(_UNSEEN)).alias("code"), F.col("all").alias("n"), F.col("back").alias("ratio"))
    return one.select(F.explode(F.when(F.col("first"), F.array(node, behind)).otherwise(F.array(node))).alias("x")).select("x.*")


class NodeTable:
    """A hash table of the most frequent rows' ratios, at most half full, and a bit table of all other rows."""

    def __init__(self, codes: np.ndarray, ratio: np.ndarray, rest: bytes, log2: int):
        self.rest, self.log2 = rest, log2
        self.bits = max(1, int(2 * len(codes)).bit_length())
        self.codes, self.ratio = np.zeros(1 << self.bits, np.int64), np.zeros(1 << self.bits)
        place = self._places(codes)
        while len(codes):  # one code a place; the others try the next one
            free = np.flatnonzero(self.codes[place] == 0)
            _, first = np.unique(place[free], return_index=True)
            put = free[first]
            self.codes[place[put]], self.ratio[place[put]] = codes[put], ratio[put]
            codes, ratio, place = (np.delete(x, put) for x in (codes, ratio, place))
            place = (place + 1) & ((1 << self.bits) - 1)

    def _places(self, codes: np.ndarray) -> np.ndarray:
        mixed = codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def look_up(self, words: list[bytes]) -> tuple[np.ndarray, dict[int, list[int]]]:
        """Per word its score over the nodes known here, and the open codes of the words that have any."""
        scores, still = np.zeros(len(words)), {}
        for lo, hi in spelled(words):
            codes, word = spell(words[lo:hi])
            codes, word = np.concatenate([codes, backoff_code(codes)]), np.concatenate([word, word])
            values, seek = np.zeros(len(codes)), np.arange(len(codes))
            place, gone = self._places(codes), []
            while len(seek):
                held = self.codes[place]
                hit = held == codes[seek]
                values[seek[hit]] = self.ratio[place[hit]]
                gone.append(seek[held == 0])
                more = ~hit & (held != 0)
                seek, place = seek[more], (place[more] + 1) & ((1 << self.bits) - 1)
            absent = np.concatenate(gone)
            opened = absent[in_bit_table(self.rest, mixed(codes[absent]), self.log2)]
            scores[lo:hi] += np.bincount(word, values, hi - lo)
            for w, code in zip(word[opened].tolist(), codes[opened].tolist()):
                still.setdefault(lo + w, []).append(code)
        return scores, still

    def score_texts(self, texts: list[bytes]) -> list:
        """Per text: words, sum, highest, second and clear ones of the words scored here; the open words."""
        words, ends = normal_words(texts)
        vocabulary = dict.fromkeys(words)
        for i, w in enumerate(vocabulary):
            vocabulary[w] = i
        ids = np.fromiter(map(vocabulary.__getitem__, words), np.int64, len(words))
        scores, todo = self.look_up(list(vocabulary))
        wait = np.zeros(len(vocabulary), bool)
        wait[list(todo)] = True
        out = []
        for a, b in zip(ends[:-1], ends[1:]):
            own = ids[a:b]
            s = np.sort(scores[own[~wait[own]]])
            kinds, n = np.unique(own[wait[own]], return_counts=True)
            later = [{"n": int(k), "base": float(scores[w]), "nodes": todo[w]} for w, k in zip(kinds.tolist(), n)]
            out.append((int(b - a), float(s.sum()), max(float(s[-1]), 0.0) if len(s) else 0.0,
                        max(float(s[-2]), 0.0) if len(s) > 1 else 0.0, int((s > CLEAR).sum()), later))
        return list(zip(*out)) if out else [[]] * 6


def node_table(ratios: DataFrame, nodes: int, log2: int) -> NodeTable:
    """The most frequent nodes, ``nodes`` at most, and the bits of the others; both of bounded size."""
    level = F.floor(F.log2("n") * 8).cast("int")  # a few hundred levels of frequency
    sizes = sorted(((r["level"], r["count"]) for r in ratios.groupBy(level.alias("level")).count().collect()), reverse=True)
    least, held = (sizes[0][0] + 1 if sizes else 0), 0
    for lv, count in sizes:
        held += count
        if held > nodes:
            break
        least = lv
    rows = ratios.filter(level >= least).select("code", "ratio").toArrow()
    rest = bit_table(ratios.filter(level < least).select(mixed("code")), log2)
    return NodeTable(rows["code"].to_numpy(), rows["ratio"].to_numpy(), rest, log2)


_OPEN = T.ArrayType(T.StructType([T.StructField("n", T.LongType()), T.StructField("base", T.DoubleType()),
                                  T.StructField("nodes", T.ArrayType(T.LongType()))]))
_LOCAL = [T.StructField("words", T.LongType()), T.StructField("total", T.DoubleType()), T.StructField("top", T.DoubleType()),
          T.StructField("second", T.DoubleType()), T.StructField("sure", T.LongType()), T.StructField("todo", _OPEN)]


def text_features(rows: DataFrame, ratios: DataFrame, table: NodeTable) -> DataFrame:
    """``rows`` (columns beside ``text`` pass; none named like the new ones) with ``FEATURES`` instead of the text.

    The mean word score, the two highest, and log(1 + words clearly toxic).
    Rows of equal text share their open words, by the text's hash and length; their answer is
    dealt over the salts that stand in the written rows.
    """
    sent = ship(rows.sparkSession, table)

    def make():
        known = shipped(sent)
        return known.score_texts

    key = F.struct(F.xxhash64("text").alias("h"), F.length("text").alias("size")).alias("place")
    salt = F.pmod(F.xxhash64(*[c for c in rows.columns if c != "text"], F.spark_partition_id()), F.lit(SALTS)).alias("salt")
    local = materialize(add_text_columns(rows.select("*", key, salt), "text", _LOCAL, make, drop=("text",)), "toxicity_texts")
    waiting = local.filter(F.size("todo") > 0)
    todo = waiting.groupBy("place").agg(F.any_value("todo").alias("todo"))
    todo = todo.select("place", F.posexplode("todo").alias("word", "x")).select("place", "word", "x.n", "x.base", F.explode("x.nodes").alias("code"))
    found = todo.join(ratios.select("code", "ratio"), "code", "left")
    by_word = found.groupBy("place", "word").agg(
        F.any_value("n").alias("n"), (F.any_value("base") + F.coalesce(F.sum("ratio"), F.lit(0.0))).alias("s"))
    best = F.sort_array(F.flatten(F.collect_list(F.array_repeat(F.col("s"), F.least("n", F.lit(2)).cast("int")))), asc=False)
    by_text = by_word.groupBy("place").agg(
        F.sum(F.col("n") * F.col("s")).alias("more"), F.sum(F.when(F.col("s") > CLEAR, F.col("n")).otherwise(0)).alias("sure2"),
        F.slice(best, 1, 2).alias("best"))
    dealt = waiting.select("place", "salt").distinct().join(by_text, "place")  # SALTS rows a text at most
    dealt = dealt.withColumnsRenamed({"place": "place2", "salt": "salt2"})
    out = local.join(dealt, (F.col("place") == F.col("place2")) & (F.col("salt") == F.col("salt2")), "left")
    tops = F.sort_array(F.concat(F.array("top", "second"), F.coalesce("best", F.array().cast("array<double>"))), asc=False)
    features = {
        "mean": F.when(F.col("words") > 0, (F.col("total") + F.coalesce("more", F.lit(0.0))) / F.col("words")).otherwise(0.0),
        "top": tops[0], "second": tops[1], "clear": F.log1p(F.col("sure") + F.coalesce("sure2", F.lit(0)))}
    return out.select(*[F.col(c) for c in rows.columns if c != "text"], *[features[c].alias(c) for c in FEATURES])


class Calibration:
    """Ridge logistic regression on standardised features, by Newton's method."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.mean, self.spread = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
        z = np.column_stack([(x - self.mean) / self.spread, np.ones(len(x))])
        ridge = np.diag([0.1] * x.shape[1] + [1e-3])
        w = np.zeros(x.shape[1] + 1)
        for _ in range(25):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            w -= np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge, z.T @ (p - y) + ridge @ w)
        self.weights = w

    def score(self) -> Column:
        """The probability, of the feature columns."""
        z = F.lit(float(self.weights[-1]))
        for c, w, m, s in zip(FEATURES, self.weights, self.mean, self.spread):
            z += F.lit(float(w)) * (F.col(c) - float(m)) / float(s)
        return 1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(30.0)), F.lit(-30.0))))


def labelled_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(id, text, toxic) of labelled documents; docs (id, text), labels (id, toxic), one per id."""
    table = docs.sparkSession.sparkContext.broadcast(bit_table(labels.select(F.xxhash64("id")), FILTER_LOG2))

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = in_bit_table(table.value, batch.column(2).to_numpy(), FILTER_LOG2)
            yield batch.filter(pa.array(hit)).select([0, 1])

    placed = docs.select("id", "text", F.xxhash64("id").alias("place"))
    found = placed.mapInArrow(likely, docs.select("id", "text").schema)
    return found.join(labels.hint("merge"), "id")  # alike at every size


def count_nodes(texts: DataFrame) -> DataFrame:
    """(code, toxic, ordinary): occurrences of each spelling node in (text, toxic), over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A task adds up as it reads; what it holds grows with different words, so it gives rows out now and then.
        held: list[np.ndarray] = []  # rows: code, toxic, ordinary
        size = 0

        def add_up() -> np.ndarray:
            every = np.concatenate(held, axis=1)
            codes, at = np.unique(every[0], return_inverse=True)
            return np.stack([codes, *[np.bincount(at, every[k], len(codes)).astype(np.int64) for k in (1, 2)]])

        def rows(added: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x) for x in added], names=["code", "toxic", "ordinary"])

        for batch in batches:
            texts, toxic = text_bytes(batch.column(0)), batch.column(1).to_numpy(zero_copy_only=False)
            for label in (0, 1):
                kinds = Counter(normal_words([t for t, y in zip(texts, toxic) if y == label])[0])
                words, times = list(kinds), np.fromiter(kinds.values(), np.int64, len(kinds))
                for lo, hi in spelled(words):
                    codes, word = spell(words[lo:hi])
                    n = times[lo:hi][word]
                    held.append(np.stack([codes, n * (label == 1), n * (label == 0)]))
                    size += len(codes)
                    if size > 1 << 20:
                        held = [add_up()]
                        size = held[0].shape[1]
                        if size > 1 << 19:
                            yield rows(held[0])
                            held, size = [], 0
        if held:
            yield rows(add_up())

    counted = texts.select("text", "toxic").mapInArrow(run, "code bigint, toxic bigint, ordinary bigint")
    return counted.groupBy("code").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))


class Model:
    """Ratios of all nodes (a written table), the table sent to the tasks, and the calibration if there is one."""

    def __init__(self, ratios: DataFrame, table: NodeTable):
        self.ratios, self.table = ratios, table
        self.calibration: Calibration | None = None

    def features(self, rows: DataFrame) -> DataFrame:
        return text_features(rows, self.ratios, self.table)


def train(docs: DataFrame, labels: DataFrame, residue: Column, nodes: int = NODES, log2: int = REST_LOG2) -> Model:
    """docs (id, text) and labels (id, toxic): counts from residues 1 to 3, calibration from residue 4."""
    may = labels.withColumn("fold", residue).filter("fold <> 0").select("id", "toxic", "fold")
    texts = materialize(labelled_texts(docs, may), "toxicity_rows")
    counts = materialize(count_nodes(texts.filter("fold < 4")), "toxicity_counts")
    ratios = materialize(node_ratios(counts), "toxicity_ratios")
    model = Model(ratios, node_table(ratios, nodes, log2))
    # Different texts, so that copies don't outgrow the sample.
    aside = texts.filter("fold = 4").select("toxic", F.xxhash64("id", "text").alias("place"), "text")
    n = aside.agg(F.approx_count_distinct("place")).first()[0]
    near = F.pmod("place", F.lit(1_000_000)) / 1e6 < min(1.0, CALIBRATION / max(n, 1))
    picked = aside.filter(near).groupBy("place", "toxic").agg(F.min("text").alias("text")).select(F.col("toxic").alias("y"), "text")
    rows = model.features(picked).toArrow()
    y = rows["y"].to_numpy().astype(float)
    if len(y) and 0 < y.sum() < len(y):
        x = np.column_stack([rows[c].to_numpy() for c in FEATURES])
        order = np.lexsort([y, *x.T])
        model.calibration = Calibration(x[order], y[order])
    return model


def score_documents(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    toxic: str = "toxic", nodes: int = NODES, log2: int = REST_LOG2) -> DataFrame:
    """doc_id, held_out, score, predicted; labels are learned outside the held-out fifth."""
    known = labels.filter(F.col(toxic).isNotNull() & F.col(doc_id).isNotNull())
    known = known.groupBy(F.col(doc_id).alias("id")).agg(F.max(F.col(toxic).cast("int")).alias("toxic"))
    rows = docs.select(F.col(doc_id).alias("id"), F.coalesce(text, F.lit("")).alias("text"))
    model = train(rows, known, crc_mod(F.col("id"), 5), nodes, log2)
    score = model.calibration.score() if model.calibration else F.lit(0.0)
    out = model.features(rows) if model.calibration else rows
    return out.select(F.col("id").alias(doc_id), (crc_mod(F.col("id"), 5) == 0).alias("held_out"), score.alias("score"),
                      F.when(score >= 0.5, 1).otherwise(0).alias("predicted"))
