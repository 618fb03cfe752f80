import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from llm_fixtures import DOCS, SF, no_docs, odd_docs  # noqa: F401
from pyspark.sql import functions as F
from tessera.llm import collocations as C
from tessera.llm import queries

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slow(rows, min_count=10, max_words=3, top=2000):
    """(lang, rank, phrase, a, l, r, n, score) by Python integers over all phrases."""
    f, n, out = Counter(), Counter(), []
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, max_words + 1):
                f.update((lang, tuple(words[i:i + k])) for i in range(len(words) - k + 1))
    found = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= min_count}
    inside = Counter()
    for (lang, w), a in found.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                inside[lang, w[i:i + k]] = max(inside[lang, w[i:i + k]], a)
    for lang in {key[0] for key in found}:
        best = []
        for (of, w), a in found.items():
            if of == lang and 100 * inside[of, w] < 50 * a:
                score, _, left, right = min((10**6 * a * a // (f[of, w[:k]] * f[of, w[k:]]), k, f[of, w[:k]], f[of, w[k:]])
                                            for k in range(1, len(w)))
                best.append((-score, -a, " ".join(w).encode(), left, right))
        out += [(lang, i, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(best)[:top], 1)]
    return sorted(out)


def zipf(n, seed, words=60, langs=("en", "de", None)):
    rng = random.Random(seed)
    vocabulary = [f"W{k}é" if k % 3 else f"w{k}" for k in range(words)]
    vocabulary[7:10] = ["Red Sea Port", "sea port", "port of"]
    weights = [1 / (k + 1) for k in range(words)]
    rows = []
    for _ in range(n):
        said = rng.choices(vocabulary, weights, k=rng.randint(0, 120))
        rows.append(("".join(w + rng.choice([" ", " ", "  ", "\t", ". ", "\n", "\xa0"]) for w in said), rng.choice(langs)))
    return rows


def got(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture(scope="module")
def texts(spark):
    return lambda rows: spark.createDataFrame([(k, t, lang, "s", 0) for k, (t, lang) in enumerate(rows)], DOCS)


def test_equal_brute_force(texts):
    rows = zipf(300, 1)
    want = slow(rows)
    assert len(want) > 100 and {len(w[2].split()) for w in want} >= {2, 3}
    assert got(C.collocations(texts(rows))) == want


def test_equal_whatever_has_a_rank(texts, monkeypatch):
    """Few ranks, small tiles and runs: dense tiles, sorted coordinates and unranked words give the same."""
    rows = zipf(200, 2)
    want = slow(rows, max_words=4, top=50)
    monkeypatch.setattr(C, "RANKS", 16)
    monkeypatch.setattr(C, "TILE", 4)
    monkeypatch.setattr(C, "DENSE", 20)
    monkeypatch.setattr(C, "TOKENS_AT_ONCE", 500)
    monkeypatch.setattr(C, "FILTER_LOG2", 10)
    assert got(C.collocations(texts(rows), max_words=4, top=50)) == want
    monkeypatch.setattr(C, "RANKS", 4)  # all of one count or none: no rank may be left
    assert got(C.collocations(texts(rows), max_words=4, top=50)) == want


def test_tiles_count_exactly():
    rng = np.random.default_rng(3)
    left = np.minimum(rng.zipf(1.3, 200_000) - 1, C.RANKS - 1)
    right = np.minimum(rng.zipf(1.3, 200_000) - 1, C.RANKS - 1)
    codes, counts = C.tile_counts(left, right)
    assert dict(zip(codes.tolist(), counts.tolist())) == Counter((left * C.RANKS + right).tolist())
    assert len(codes) == len(set(codes.tolist()))


def test_scores_beyond_64_bits(spark):
    rows = [(3 * 10**14 + 7, 5 * 10**15 + 3, 4 * 10**14 + 1), (10, 10, 10), (10**15, 10**15, 10**15), (999_999_999_999, 10**15 + 1, 10**12)]
    made = spark.createDataFrame(rows, "a long, l long, r long").select(C.cut_score(F.col("a"), F.col("l"), F.col("r"))).collect()
    assert [r[0] for r in made] == [10**6 * a * a // (x * y) for a, x, y in rows]


def test_hashes_equal_spark(spark):
    words = [("en", "the"), ("fr", "été"), ("", ""), ("und", "x" * 100)]
    rows = spark.createDataFrame(words, "lang string, word string").select(F.xxhash64(F.lit(3), "lang", "word")).collect()
    assert [(r[0] & C._HASH_BITS) - (1 << 63) for r in rows] == [C.word_hash(C.language_seed(a, 3), b.encode()) for a, b in words]


def test_query_equals_sql(spark):
    want = duckdb.sql(C.ORACLE.replace("FROM documents", f"FROM '{SF}/documents.parquet'"))
    made = queries.QUERIES["op11_collocations"](spark, SF)
    assert made.columns == want.columns and got(made) == sorted(want.fetchall())


def test_odd_rows(spark, odd_docs, no_docs, texts):
    rows = [(r["text"], r["lang"]) for r in odd_docs.collect()]
    assert got(C.collocations(odd_docs, min_count=2)) == slow(rows, min_count=2)
    assert C.collocations(no_docs).count() == 0
    long = "x" * 200  # a frequent word too long for a rank
    rows = [(f"{long} b {long} b!\x00 \x1c Ā b", "en")] * 12 + [("a " * 100_000, "de"), (None, None), ("b b b", "und")]
    assert got(C.collocations(texts(rows))) == slow(rows)
