import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_fixtures import no_docs, odd_docs, sf_docs  # noqa: F401
from tessera.llm import toxicity as X

SF = "/root/testdata/sf0.1"


def auc(score, y):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    p = y.sum()
    return (rank[y == 1].sum() - p * (p + 1) / 2) / (p * (len(y) - p))


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = X.score_documents(docs, labels).join(labels, "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    held = [r for r in got if r["held_out"]]
    score, y = np.array([r["score"] for r in held]), np.array([r["toxic"] for r in held])
    assert auc(score, y) > 0.96
    clean = [r for r in held if not r["toxic"]]
    assert sum(r["predicted"] for r in clean) <= 0.02 * len(clean)
    assert all(r["predicted"] == (r["score"] >= 0.5) for r in got)


class Brute:
    """The model as the docstring writes it, over plain strings: "^" starts a word, "$" ends it, digits are one letter."""

    def __init__(self, rows):
        self.count = {0: Counter(), 1: Counter()}
        for text, label in rows:
            for w in self.words(text):
                self.count[label].update(self.letters(w))
        self.nodes = set(self.count[0]) | set(self.count[1])
        self.grams = Counter(self.symbols(node) for node in self.nodes)
        self.known: dict = {}

    @staticmethod
    def words(text):
        return [re.sub("[0-9]", "0", w) + "$" for w in re.findall("[a-z0-9\x80-\U0010ffff]+", (text or "").lower())]

    @staticmethod
    def letters(word):
        word = "^" * (X.ORDER - 1) + word
        return [word[k:k + X.ORDER] for k in range(len(word) - X.ORDER + 1)]

    @staticmethod
    def symbols(node):
        def one(c):
            other = X._START if c == "^" else 28 + ord(c) % 994
            return 0 if c == "$" else 27 if c == "0" else ord(c) - 96 if "a" <= c <= "z" else 28 + (other - 28) % 36

        return tuple(map(one, node[-3:]))

    def shared(self, last):
        if not last:
            return 1 / X.SYMBOLS
        if last not in self.known:
            alike = [(g[-len(last):], n) for g, n in self.grams.items() if g[-len(last):-1] == last[:-1]]
            total, n = sum(n for _, n in alike), sum(n for g, n in alike if g == last)
            part = X.DISCOUNT * len({g for g, _ in alike}) / total * self.shared(last[1:]) if total else self.shared(last[1:])
            self.known[last] = max(n - X.DISCOUNT, 0) / total + part if total else part
        return self.known[last]

    def p(self, label, node):
        count = self.count[label]
        own = [count[x] for x in self.nodes if x[:-1] == node[:-1] and count[x]]
        s = self.shared(self.symbols(node))
        return max(count[node] - X.DISCOUNT, 0) / sum(own) + X.DISCOUNT * len(own) / sum(own) * s if own else s

    def score(self, word):
        """Letter by letter, each by its full probability in both classes."""
        return sum(np.log(self.p(1, x)) - np.log(self.p(0, x)) for x in self.letters(word))

    def features(self, text):
        scores = sorted(map(self.score, self.words(text)), reverse=True)
        tops = [max(x, 0.0) for x in scores] + [0.0, 0.0]
        return [np.mean(scores) if scores else 0.0, max(tops), sorted(tops)[-2], np.log1p(sum(x > X.CLEAR for x in scores))]


ROWS = [("Bad bad WORDS, é1 badly", 1), ("some words bad приворот", 0), (None, 0), ("", 1), ("internationalism goods 42 xyz", 0),
        ("internatfoo bid x1 привет", 1), ("good " * 9 + "abcdefghijklm " * 30, 0), ("abcdefghijkXX " * 30 + "语言 bad7", 1)]


def code_of(node):
    """The code of a node of ``Brute``."""
    code = 0
    for c in node:
        own = {"^": X._START, "$": X._END}.get(c)
        code = code << X.BITS | (int(X.spell([c.encode()])[0][0]) & X._START if own is None else own)
    return code


def test_counts_equal_brute_force(spark):
    got = X.count_nodes(spark.createDataFrame(ROWS, "text string, toxic int")).collect()
    want = Brute(ROWS)
    assert {r["code"]: (r["toxic"], r["ordinary"]) for r in got} == {code_of(x): (want.count[1][x], want.count[0][x]) for x in want.nodes}
    assert len(got) == len(want.nodes)


def test_ratios_equal_brute_force(spark):
    want = Brute(ROWS)
    rows = X.node_ratios(X.count_nodes(spark.createDataFrame(ROWS, "text string, toxic int"))).collect()
    got = {r["code"]: r["ratio"] for r in rows}
    assert len(rows) == len(got) == len(want.nodes) + len({x[:-1] for x in want.nodes})
    for x in want.nodes:
        code = code_of(x)
        back = got[int(X.backoff_code(np.array([code]))[0])]
        assert abs(got[code] + back - np.log(want.p(1, x)) + np.log(want.p(0, x))) < 1e-9
        other = x[:-1] + "\u0fff"  # seen nowhere
        assert abs(back - np.log(want.p(1, other)) + np.log(want.p(0, other))) < 1e-9


@pytest.mark.parametrize("nodes, log2", [(1 << 20, 24), (0, 7), (25, 7)])
def test_features_equal_brute_force(spark, nodes, log2):
    """Seen words, words that leave the tree at any letter, unseen scripts; with and without the join."""
    ratios = X.node_ratios(X.count_nodes(spark.createDataFrame(ROWS, "text string, toxic int"))).cache()
    texts = [t or "" for t, _ in ROWS] + ["bad", "b", "badx", "abcdefghijkl", "abcdefghijklmn abcdefghijkXX", "приве при приворо", "zzz ß", "7 77 4", "internatio"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts * 3)], "id int, text string")
    got = X.text_features(rows, ratios, X.node_table(ratios, nodes, log2)).collect()
    want = Brute(ROWS)
    assert len(got) == len(texts) * 3
    for r in got:
        assert np.allclose([r[c] for c in X.FEATURES], want.features(texts[r["id"] % len(texts)]), atol=1e-9), texts[r["id"] % len(texts)]
    ratios.unpersist()


def test_words_are_read_whole(spark):
    """Words equal in their first letters score apart, in any script."""
    rows = [("internatfoo приворот", 1), ("internationalism привет", 0)] * 20
    ratios = X.node_ratios(X.count_nodes(spark.createDataFrame(rows, "text string, toxic int")))
    pairs = ["internatfoo", "internationalism", "приворот", "привет"]
    got = X.text_features(spark.createDataFrame(list(enumerate(pairs)), "id int, text string"), ratios, X.node_table(ratios, 1000, 10))
    mean = {r["id"]: r["mean"] for r in got.collect()}
    assert mean[0] > 1 and mean[1] < -1 and mean[2] > 1 and mean[3] < -1


def test_very_long_words(spark):
    rows = [("a" * 300_000 + " bad " + "\U0001f600" * 50_000, 1), ("good", 0)]
    ratios = X.node_ratios(X.count_nodes(spark.createDataFrame(rows, "text string, toxic int")))
    table = X.node_table(ratios, 1000, 12)
    again = spark.createDataFrame([(0, "a" * 300_000), (1, "a" * 299_999 + "b")], "id int, text string")
    got = {r["id"]: r["top"] for r in X.text_features(again, ratios, table).collect()}
    assert got[0] > got[1] - 1e-9 and got[0] > 0


def test_small_tables_change_no_score(spark):
    """With few nodes in hand and few bits nearly all words take the join: the scores are the same."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    docs = docs.unionByName(docs.limit(50))
    get = lambda **k: sorted((r["doc_id"], r["score"]) for r in X.score_documents(docs, labels, **k).collect())
    want, got = get(), get(nodes=97, log2=8)
    assert [i for i, _ in got] == [i for i, _ in want] and len(want) == docs.count()
    assert np.allclose([x for _, x in got], [x for _, x in want], atol=1e-9)


def test_the_label_filter_loses_nothing(spark, sf_docs, monkeypatch):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet").select(F.col("doc_id").alias("id"), "toxic")
    docs = sf_docs.select(F.col("doc_id").alias("id"), "text")
    want = docs.join(labels, "id").count()
    assert X.labelled_texts(docs, labels).count() == want > 0
    monkeypatch.setattr(X, "FILTER_LOG2", 6)
    assert X.labelled_texts(docs, labels).count() == want


def test_labels_of_held_out_rows_are_not_learned(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    other = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    pick = lambda x: sorted((r["doc_id"], r["score"]) for r in X.score_documents(docs, x).collect())
    assert pick(labels) == pick(other)


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 0), (4, 1), (5, 0), (5, None), (None, 1), (6, 1), (6, 0)], "doc_id long, toxic int")
    got = X.score_documents(odd_docs, labels).collect()
    assert len(got) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in got)
    none = X.score_documents(odd_docs, labels.limit(0)).collect()
    assert {r["score"] for r in none} == {0.0} and {r["predicted"] for r in none} == {0}
    assert X.score_documents(no_docs, labels).count() == 0
