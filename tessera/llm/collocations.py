"""Phrase collocation mining with direct-address tiles over frequency-ranked ids.

Texts (A-Z lower-cased) are cut at ``[.,;:!?\\x0A-\\x0D]`` into pieces and those at
space and tab into words; every language counts on its own. Words of
``min_count`` places or more are ranked by frequency over all languages. Tasks
turn their texts into ids; the id pairs of neighbours are split into square
tiles of the rank table: a crowded tile is counted by a dense ``bincount``, the
rest as sorted coordinates. Spark adds the tasks' counts. Pairs of ``min_count``
or more are ranked again, and (pair, next word) is counted in the same tiles,
and so on up to ``max_words``: a phrase can only be that frequent if both
phrases one word shorter are.

Only the ``RANKS`` most frequent words (of at most ``WORD_BYTES`` bytes) and
phrases have a place in the tiles, which bounds what is shipped to a task; all
others carry 64-bit hashes as ids and are counted as sorted coordinates, so no
word or phrase is left out. The word hashes are proven free of collisions with a
frequent word on the whole vocabulary (else another seed is taken), phrases are
added up by the ids of all their words, and bit tables of fixed size only spare
the rows that can't be frequent. Scores are exact integers (decimals of 38
digits). The ranking takes each language's best within hashed shares first.

Defined cases: a null text is empty, a null language is ``und``; repeated rows
and null ids count like any other; equal scores go by count, then by the bytes of
the phrase; an empty table gives an empty table; extra columns are dropped; a
text is read whole, whatever its length.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import bit_table, in_bit_table, pieces, ship, shipped, text_bytes, tuned
from tessera.session import materialize

MIN_COUNT, MAX_WORDS, TOP, INSIDE_PERCENT = 10, 3, 2000, 50
NO_LANGUAGE = "und"
#: Ranked ids and the side of a tile; tile numbers fit 16 bits, so that they sort in linear time.
RANKS, TILE = 1 << 16, 256
#: Ids of a tile before it is worth a dense count.
DENSE = 4096
WORD_BYTES = 64
FILTER_LOG2 = 24
TOKENS_AT_ONCE = 2_000_000
SHARES = 64
#: Id of an end of a piece and of a word that can't be in any phrase.
_NONE = -1
_HASH_BITS = (1 << 62) - 1
_END = b"\xff"
_MAP = bytes.maketrans(bytes(range(65, 91)) + b".,;:!?\n\v\f\r\t", bytes(range(97, 123)) + _END * 10 + b" ")


def split_pieces(text: bytes) -> list[bytes]:
    """The words of a text, with ``_END`` (no byte of UTF-8) at the end of each piece."""
    return text.translate(_MAP).replace(_END, b" \xff ").split() + [_END]


def _language_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes]]]:
    """(language, some of its words with ends): pieces of bounded bytes of (lang, text) batches, but whole texts."""
    for batch in batches:
        langs, texts = batch.column(0).to_pylist(), text_bytes(batch.column(1))
        for lo, hi in pieces(texts):
            by: dict[str, list[bytes]] = {}
            for lang, text in zip(langs[lo:hi], texts[lo:hi]):
                by.setdefault(lang, []).extend(split_pieces(text))
            yield from by.items()


def language_seed(lang: str, seed: int) -> int:
    return xxhash.xxh64_intdigest(lang.encode(), xxhash.xxh64_intdigest(seed.to_bytes(4, "little"), 42))


def word_hash(lang_seed: int, word: bytes) -> int:
    """A word's id without a rank: 62 bits of Spark's ``xxhash64(seed, lang, word)``, negative and apart from ``_NONE``."""
    return (xxhash.xxh64_intdigest(word, lang_seed) & _HASH_BITS) - (1 << 63)


def word_counts(texts: DataFrame) -> DataFrame:
    """(lang, word, n): places of every word, added up in tasks first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}
        size = 0

        def rows():
            for lang, count in counts.items():
                count.pop(_END, None)
                words = list(count)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(words), pa.string()), pa.array(words, pa.binary()).cast(pa.string()),
                     pa.array([count[w] for w in words], pa.int64())], names=["lang", "word", "n"])
            counts.clear()

        for lang, words in _language_texts(batches):
            count = counts.setdefault(lang, Counter())
            size -= len(count)
            count.update(words)
            size += len(count)
            if size > TOKENS_AT_ONCE // 4:
                yield from rows()
                size = 0
        yield from rows()

    counted = texts.mapInArrow(run, "lang string, word string, n bigint")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _most_frequent(counts: DataFrame) -> DataFrame:
    """The rows with the highest ``n``: RANKS at most, all of one count or none, found from how often each count occurs."""
    often = counts.groupBy("n").count().orderBy(F.desc("n")).limit(RANKS).collect()
    least, taken = None, 0
    for n, rows in often:
        taken += rows
        if taken > RANKS:
            break
        least = n
    return counts.filter(F.lit(False) if least is None else F.col("n") >= least)


def _vocabulary(counts: DataFrame, min_count: int) -> tuple[pa.Table, DataFrame, int]:
    """The ranked words, (id, lang, word, n) of all frequent words, and the seed of the hashes that are the other ids."""
    ranked = _most_frequent(counts.filter((F.col("n") >= min_count) & (F.octet_length("word") <= WORD_BYTES)))
    rows = ranked.select("lang", "word", "n").toArrow().sort_by([("n", "descending"), ("lang", "ascending"), ("word", "ascending")])
    rows = rows.add_column(0, "id", pa.array(np.arange(rows.num_rows)))
    ranked = materialize(counts.sparkSession.createDataFrame(rows, "id long, lang string, word string, n long"), "collocation_ranked")
    for seed in range(8):
        h = F.xxhash64(F.lit(seed), "lang", "word").bitwiseAND(_HASH_BITS) + F.lit(-(1 << 63))
        hashed = counts.withColumn("id", h)
        # A collision between rare words is harmless: their phrases stay rare.
        clash = hashed.groupBy("id").agg(F.count("*").alias("words"), F.sum("n").alias("n"))
        if not clash.filter((F.col("words") > 1) & (F.col("n") >= min_count)).head(1):
            break
    else:
        raise RuntimeError("no hash without a collision found")
    known = ranked.select("lang", "word").hint("broadcast")  # RANKS words of WORD_BYTES at most
    rest = hashed.filter(F.col("n") >= min_count).join(known, ["lang", "word"], "left_anti")
    return rows, materialize(ranked.unionByName(rest.select("id", "lang", "word", "n")), "collocation_words"), seed


def phrase_hash(ids: list[np.ndarray]) -> np.ndarray:
    """A 64-bit hash of the phrases whose words' ids are given, column by column."""
    h = np.full(len(ids[0]), 0x9E3779B97F4A7C15, np.uint64)
    for column in ids:
        h = (h ^ column.astype(np.uint64)) * np.uint64(0xC2B2AE3D27D4EB4F)
        h ^= h >> np.uint64(29)
    return h.view(np.int64)


def tile_counts(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codes ``left * RANKS + right``, counts) of pairs of ranks, tile by tile."""
    tile = ((left // TILE) * (RANKS // TILE) + right // TILE).astype(np.uint16)
    order = np.argsort(tile, kind="stable")  # a radix sort
    sizes = np.bincount(tile, minlength=(RANKS // TILE) ** 2)
    code = left * RANKS + right
    made = []
    ends = np.cumsum(sizes)
    dense = np.flatnonzero(sizes >= DENSE)
    sparse = np.ones(len(left), bool)
    for t in dense.tolist():
        at = slice(int(ends[t] - sizes[t]), int(ends[t]))
        members = order[at]
        sparse[at] = False
        cells = np.bincount((left[members] % TILE) * TILE + right[members] % TILE, minlength=TILE * TILE)
        full = np.flatnonzero(cells)
        row, column = divmod(t, RANKS // TILE)
        made.append(((row * TILE + full // TILE) * RANKS + column * TILE + full % TILE, cells[full]))
    made.append(np.unique(code[order[sparse]], return_counts=True))
    return np.concatenate([m[0] for m in made]), np.concatenate([m[1] for m in made])


class _Ids:
    """Words of a language to ids, as a task needs them."""

    def __init__(self, words: dict[str, dict[bytes, int]], table: bytes, seed: int):
        self.words, self.table, self.seed = words, table, seed

    def __call__(self, lang: str, tokens: list[bytes]) -> np.ndarray:
        ids = dict.fromkeys(tokens, _NONE)
        known, lang_seed = self.words.get(lang, {}), language_seed(lang, self.seed)
        rest = []
        for word in ids:
            if (i := known.get(word)) is not None:
                ids[word] = i
            elif word != _END:
                rest.append(word)
        hashes = np.array([word_hash(lang_seed, w) for w in rest], np.int64)
        hit = in_bit_table(self.table, hashes, FILTER_LOG2)
        ids.update(zip([rest[k] for k in np.flatnonzero(hit)], hashes[hit].tolist()))
        return np.fromiter(map(ids.__getitem__, tokens), np.int64, len(tokens))


class Level:
    """The frequent phrases of one length, as a task needs them: a bit table of all, the ranks of the most frequent ones."""

    def __init__(self, codes: np.ndarray, ranks: np.ndarray, table: bytes):
        self.codes, self.ranks, self.table = codes, ranks, table
        self.place = np.argsort(ranks)

    def rank(self, prefix: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Rank of each phrase given as (rank of its prefix, id of its last word), or ``_NONE``."""
        if not len(self.codes):
            return np.full(len(prefix), _NONE)
        code = np.where((prefix >= 0) & (word >= 0), prefix * RANKS + word, _NONE)
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        return np.where(self.codes[at] == code, self.ranks[at], _NONE)

    def parts(self, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank of the prefix, id of the last word) of each rank."""
        code = self.codes[self.place[rank]]
        return code // RANKS, code % RANKS


def count_phrases(ids: np.ndarray, size: int, levels: list[Level]) -> list[np.ndarray]:
    """Columns w1..wk and n of the phrases of ``size`` words in a run of ids, tile by tile where they have ranks."""
    start = np.flatnonzero(np.lib.stride_tricks.sliding_window_view(ids != _NONE, size).all(1)) if len(ids) >= size else np.zeros(0, np.int64)
    rank = ids[start]
    for k, level in enumerate(levels, 2):
        for off in (0, size - k):
            keep = in_bit_table(level.table, phrase_hash([ids[start + off + j] for j in range(k)]), FILTER_LOG2)
            start, rank = start[keep], rank[keep]
        rank = level.rank(rank, ids[start + k - 1])
    last = ids[start + size - 1]
    ranked = (rank >= 0) & (last >= 0)
    codes, counts = tile_counts(rank[ranked], last[ranked])
    columns = [codes // RANKS, codes % RANKS]
    for level in reversed(levels):
        columns = [*level.parts(columns[0]), *columns[1:]]
    others = start[~ranked]
    if len(others):
        loose = np.stack([ids[others + j] for j in range(size)])
        loose = loose[:, np.lexsort(loose)]  # sorted coordinates
        new = np.flatnonzero(np.r_[True, (loose[:, 1:] != loose[:, :-1]).any(0)])
        columns = [np.r_[c, x] for c, x in zip(columns, loose[:, new])]
        counts = np.r_[counts, np.diff(np.r_[new, loose.shape[1]])]
    return [*columns, counts]


def _phrase_counts(texts: DataFrame, words: Broadcast, levels: list[Broadcast], size: int) -> DataFrame:
    """(w1..wk, n) of the phrases of ``size`` words whose shorter parts may all be frequent."""
    names = [f"w{k + 1}" for k in range(size)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to_ids, known = _Ids(*shipped(words)), [Level(*shipped(x)) for x in levels]
        held, tokens_held = [], 0

        def counted() -> pa.RecordBatch:
            made = count_phrases(np.concatenate(held), size, known)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in made], names=[*names, "n"])

        for lang, tokens in _language_texts(batches):
            held.append(to_ids(lang, tokens))
            tokens_held += len(tokens)
            if tokens_held >= TOKENS_AT_ONCE:
                yield counted()
                tokens_held = 0
        if held:
            yield counted()

    counted = texts.mapInArrow(run, ", ".join(f"{c} bigint" for c in [*names, "n"]))
    return counted.groupBy(*names).agg(F.sum("n").alias("n"))


def _hashes(phrases: DataFrame, names: list[str]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = phrase_hash([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            yield pa.RecordBatch.from_arrays([pa.array(h)], names=["h"])

    return phrases.select(*names).mapInArrow(run, "h bigint")


def _level(phrases: DataFrame, size: int, levels: list[tuple]) -> tuple[np.ndarray, np.ndarray, bytes]:
    """What ``Level`` needs: codes (rank of the prefix * RANKS + last word) in order, their ranks, and the bit table.

    Only a phrase whose prefix and last word are ranked can be; RANKS rows at most come to the driver.
    """
    names = [f"w{k + 1}" for k in range(size)]
    ranked = _most_frequent(phrases.filter(reduce(lambda a, b: a & b, [F.col(c) >= 0 for c in names])))
    top = ranked.select(*names, "n").toArrow().sort_by([("n", "descending"), *[(c, "ascending") for c in names]])
    columns = [top[c].to_numpy() for c in names]
    prefix = columns[0]
    for column, level in zip(columns[1:], levels):
        prefix = Level(*level).rank(prefix, column)
    codes = (prefix * RANKS + columns[-1])[prefix >= 0]
    order = np.argsort(codes)
    return codes[order], order, bit_table(_hashes(phrases, names), FILTER_LOG2)


def cut_score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (left * right)), exactly."""
    whole = lambda c: c.cast("decimal(18,0)")
    return F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * whole(a) * whole(a), whole(left) * whole(right))


def _with_words(phrases: DataFrame, size: int, words: DataFrame) -> DataFrame:
    """The phrases with the language, and the text and count of each word (t1.., f1..)."""
    for k in range(1, size + 1):
        table = words.select(F.col("id").alias("__id"), *[F.col("lang")] * (k == 1), F.col("word").alias(f"t{k}"), F.col("n").alias(f"f{k}"))
        phrases = phrases.join(table, F.col(f"w{k}") == F.col("__id")).drop("__id")
    return phrases


def _with_part(phrases: DataFrame, parts: DataFrame, size: int, first: int, out: str) -> DataFrame:
    """``out``: the count of the part of ``size`` words that begins at word ``first``."""
    names = [f"w{k + 1}" for k in range(size)]
    table = parts.select(*[F.col(c).alias(f"__{c}") for c in names], F.col("n").alias(out))
    on = [F.col(f"w{first + k}") == F.col(f"__w{k + 1}") for k in range(size)]
    return phrases.join(table, on).drop(*[f"__{c}" for c in names])


def candidates(docs: DataFrame, text: str = "text", lang: str = "lang", min_count: int = MIN_COUNT,
               max_words: int = MAX_WORDS) -> DataFrame:
    """(lang, phrase, a, l, r, n, score, longer) of every phrase of 2 to ``max_words`` words with ``min_count`` places.

    ``longer`` is the highest count of a longer candidate that holds the phrase (null if none does).
    """
    spark = tuned(docs.sparkSession)
    texts = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(NO_LANGUAGE)).alias("lang"), F.col(text).alias("text"))
    counts = materialize(word_counts(texts), "collocation_vocabulary")
    ranked, frequent, seed = _vocabulary(counts, min_count)
    by_lang: dict[str, dict[bytes, int]] = {}
    for i, of, word in zip(ranked["id"].to_pylist(), ranked["lang"].to_pylist(), ranked["word"].cast(pa.binary()).to_pylist()):
        by_lang.setdefault(of, {})[word] = i
    words = ship(spark, (by_lang, bit_table(frequent.filter("id < 0").select("id"), FILTER_LOG2), seed))
    del by_lang, ranked
    levels, sent, phrases = [], [], {}
    for size in range(2, max_words + 1):
        counted = _phrase_counts(texts, words, sent, size).filter(F.col("n") >= min_count)
        phrases[size] = materialize(counted, f"collocation_{size}")
        if size < max_words:
            levels.append(_level(phrases[size], size, levels))
            sent.append(ship(spark, levels[-1]))
    totals = counts.groupBy(F.col("lang").alias("__lang")).agg(F.sum("n").alias("total"))
    return reduce(DataFrame.unionByName, [
        _scored(phrases, size, frequent).join(totals, F.col("lang") == F.col("__lang"))
        .select("lang", "phrase", "a", "l", "r", F.col("total").alias("n"), "score", "longer") for size in phrases])


def _scored(phrases: dict[int, DataFrame], size: int, words: DataFrame) -> DataFrame:
    made = _with_words(phrases[size].withColumnRenamed("n", "a"), size, words)
    cuts = []
    for k in range(1, size):
        for first, part, side in ((1, k, "l"), (k + 1, size - k, "r")):
            made = (made.withColumn(f"{side}{k}", F.col(f"f{first}")) if part == 1
                    else _with_part(made, phrases[part], part, first, f"{side}{k}"))
        score = cut_score(F.col("a"), F.col(f"l{k}"), F.col(f"r{k}"))
        cuts.append(F.struct(score.alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")))
    # The least (score, first words) of the cuts.
    made = made.withColumn("cut", F.array_min(F.array(*cuts)))
    names = [f"w{k + 1}" for k in range(size)]
    inside = [longer.select(*[F.col(f"w{off + k + 1}").alias(f"__w{k + 1}") for k in range(size)], F.col("n").alias("longer"))
              for more, longer in phrases.items() if more > size for off in range(more - size + 1)]
    if inside:
        best = reduce(DataFrame.unionByName, inside).groupBy(*[f"__{c}" for c in names]).agg(F.max("longer").alias("longer"))
        made = made.join(best, [F.col(c) == F.col(f"__{c}") for c in names], "left")
    else:
        made = made.withColumn("longer", F.lit(None).cast("long"))
    phrase = F.concat_ws(" ", *[f"t{k + 1}" for k in range(size)])
    return made.select("lang", phrase.alias("phrase"), "a", "cut.l", "cut.r", "cut.score", "longer")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", min_count: int = MIN_COUNT,
                 max_words: int = MAX_WORDS, top: int = TOP, inside_percent: int = INSIDE_PERCENT) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases; those mostly inside a longer one go."""
    found = candidates(docs, text, lang, min_count, max_words)
    held = F.coalesce(100 * F.col("longer") >= inside_percent * F.col("a"), F.lit(False))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    best = found.filter(~held).withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(SHARES)))
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order))).filter(F.col("rank") <= top)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return best.filter(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


ORACLE = r"""
WITH texts AS (
  SELECT coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
pieces AS (SELECT lang, unnest(string_split_regex(text, '[.,;:!?
-
]')) AS piece FROM texts),
said AS (SELECT lang, list_filter(string_split_regex(piece, '[ 	]+'), lambda w: w <> '') AS w FROM pieces),
grams AS (
  SELECT lang, unnest(w) AS phrase, 1 AS size FROM said
  UNION ALL SELECT lang, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])), 2 FROM said
  UNION ALL SELECT lang, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])), 3 FROM said),
f AS (SELECT lang, phrase, size, count(*) AS n FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(n)::BIGINT AS n FROM f WHERE size = 1 GROUP BY lang),
found AS (SELECT lang, phrase, size, n AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND n >= 10),
cuts AS (
  SELECT lang, phrase, a, w, unnest(range(1, size)) AS k FROM found),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, x.n AS l, y.n AS r,
         ((1000000::HUGEINT * c.a * c.a) // (x.n::HUGEINT * y.n))::BIGINT AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[:c.k], ' ')
              JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.k + 1:], ' ')
  QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, c.k) = 1),
inner_parts AS (
  SELECT lang, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS phrase, a FROM found WHERE size = 3),
longer AS (SELECT lang, phrase, max(a) AS a FROM inner_parts GROUP BY ALL),
kept AS (
  SELECT s.* FROM scored s LEFT JOIN longer g ON g.lang = s.lang AND g.phrase = s.phrase
  WHERE coalesce(100 * g.a < 50 * s.a, true))
SELECT kept.lang, row_number() OVER (PARTITION BY kept.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, totals.n, score
FROM kept JOIN totals ON totals.lang = kept.lang
QUALIFY rank <= 2000"""
