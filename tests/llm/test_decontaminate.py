import random

import numpy as np

from llm_fixtures import no_docs, odd_docs, sf_docs  # noqa: F401
from tessera.llm import decontaminate as D

ITEM = "Which river crosses the old town before it meets the sea near the northern harbour of the island kingdom"


def slow_align(item, passage):
    best, h = 0, [0] * (len(passage) + 1)
    for w in item:
        row = [0]
        for j, x in enumerate(passage):
            row.append(max(0, h[j] + (D.MATCH if w == x else D.MISMATCH), h[j + 1] + D.GAP, row[j] + D.GAP))
        h, best = row, max(best, *row)
    return best


def test_alignment_equals_plain_programming():
    rng = random.Random(2)
    for _ in range(60):
        item = [rng.randint(1, 6) for _ in range(rng.randint(1, 12))]
        passage = [rng.randint(1, 6) for _ in range(rng.randint(1, 20))]
        got, _ = D.align(np.array(item, np.uint64), np.array([passage, passage[::-1]], np.uint64))
        assert got.tolist() == [slow_align(item, passage), slow_align(item, passage[::-1])]


def docs_of(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_copies_edits_and_clean_texts(spark):
    rng = random.Random(4)
    filler = [" ".join(f"w{rng.randint(0, 400)}" for _ in range(80)) for _ in range(6)]
    edited = ITEM.replace("old town", "ancient little town").replace("island", "isle")
    texts = [f"{filler[0]} {ITEM} {filler[1]}", f"{filler[2]} {ITEM.upper()}!", f"{edited}. {filler[3]}",
             filler[4], f"{filler[5]} which river crosses the old {filler[0]}", None, ""]
    items = spark.createDataFrame([(7, ITEM), (8, "Two words"), (9, None), (9, "")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in D.contaminated_pairs(docs_of(spark, texts), items).collect()}
    assert set(got) == {(0, 7), (1, 7), (2, 7)} and got[0, 7] == got[1, 7] == 1.0 and 0.6 <= got[2, 7] < 1


def test_a_frequent_item_is_found_everywhere(spark):
    texts = [f"start{i} {ITEM} end{i}" for i in range(300)] + [f"nothing here {i}" for i in range(100)]
    items = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    got = D.contaminated_pairs(docs_of(spark, texts), items).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(300))


def test_crowded_bit_tables_change_nothing(spark, sf_docs, monkeypatch):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    texts = {r["doc_id"]: " ".join((r["text"] or "").lower().split()) for r in sf_docs.collect()}
    exact = {(d, r["item_id"]) for r in items.collect() for d, t in texts.items() if " ".join(r["text"].lower().split()) in t}
    rows = lambda: {(r["doc_id"], r["item_id"], r["score"]) for r in D.contaminated_pairs(sf_docs, items).collect()}
    whole = rows()
    monkeypatch.setattr(D, "TABLE_LOG2", 7)
    assert rows() == whole and exact <= {x[:2] for x in whole} and exact


def test_odd_rows(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, ITEM), (None, "the lazy dog near the river bank today")], "item_id long, text string")
    got = D.contaminated_pairs(odd_docs, items).collect()
    assert sorted((r["doc_id"] or -1) for r in got) == [-1, -1, 5, 6, 6]
    left = D.drop_contaminated(odd_docs, items)
    assert left.columns == odd_docs.columns and sorted(r["doc_id"] for r in left.collect()) == [1, 2, 3, 4, 7]
    assert D.contaminated_pairs(no_docs, items).count() == 0
    assert D.contaminated_pairs(odd_docs, items.limit(0)).count() == 0
    assert D.drop_contaminated(odd_docs, items.limit(0)).count() == odd_docs.count()


def test_every_pair_over_the_threshold_is_found(spark):
    """Copies with one word in every four to seven replaced, split or dropped, beside exact copies and clean texts."""
    rng = random.Random(9)
    items = {size: [f"item{size}x{rng.randint(0, 60)}" for _ in range(size)] for size in (4, 5, 6, 15, 40)}
    texts = []
    for words in items.values():
        for every in (2, 3, 4, 5, 6, 7, 99):
            for kind in range(3):
                copy = []
                for i, w in enumerate(words):
                    edit = i % every == every - 1
                    copy += [[f"other{rng.random()}"], [w, "extra"], []][kind] if edit else [w]
                start = [f"own{rng.randint(0, 9)}" for _ in range(rng.randint(0, 80))]
                texts.append(" ".join([*start, *copy, *start[::-1]]))
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in items.items()], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in D.contaminated_pairs(docs_of(spark, texts), bench).collect()}
    want = {}
    for d, t in enumerate(texts):
        for k, w in items.items():
            score = slow_align(w, t.split()) / (2 * k)
            if score >= D.MIN_SCORE:
                want[d, k] = score
    assert got == want
    assert all((d, 40) in want for d in range(4 * 21 + 9, 5 * 21))  # one edit in five or more, and the whole


def test_random_texts_equal_plain_programming(spark):
    """Items of 1 to 12 words and texts over few words, where nearly everything is a near match."""
    rng = random.Random(21)
    word = lambda: f"v{min(rng.randint(0, 30), rng.randint(0, 30))}"
    items = [[word() for _ in range(size)] for size in [*range(1, 13), *range(1, 13)]]
    items += [["tie", "tie", "tie"], ["tie", "v1", "tie", "v1"], items[4]]
    texts = [[word() for _ in range(rng.randint(0, 90))] for _ in range(90)]
    for i in range(30):
        own = list(rng.choice(items))
        for _ in range(rng.randint(0, 3)):
            own.insert(rng.randint(0, len(own)), rng.choice(["other", "tie", word()]))
        texts[i][rng.randint(0, len(texts[i])):0] = own
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in
           D.contaminated_pairs(docs_of(spark, [" ".join(t) for t in texts]), bench).collect()}
    want = {(d, k): s for d, t in enumerate(texts) for k, w in enumerate(items)
            if t and (s := slow_align(w, t) / (2 * len(w))) >= D.MIN_SCORE}
    assert got == want and len(want) > 200


def test_short_items_follow_the_threshold(spark):
    bench = spark.createDataFrame([(1, "alpha"), (2, "alpha beta"), (3, "alpha beta gamma")], "item_id long, text string")
    texts = ["x alpha y", "alpha zz beta", "alpha beta delta gamma", "alpha beta zz", "alpha x y gamma", "none"]
    got = {(r["doc_id"], r["item_id"]) for r in D.contaminated_pairs(docs_of(spark, texts), bench).collect()}
    want = {(d, k) for d, t in enumerate(texts) for k, w in ((1, 1), (2, 2), (3, 3))
            if slow_align("alpha beta gamma".split()[:w], t.split()) / (2 * w) >= D.MIN_SCORE}
    assert got == want and {(2, 3), (3, 3), (1, 2)} <= got and (4, 3) not in got


def test_repeated_rows_and_items_give_pairs_of_their_own(spark):
    docs = spark.createDataFrame([(1, f"so {ITEM}"), (1, f"so {ITEM}"), (1, f"{ITEM} end")], "doc_id long, text string")
    bench = spark.createDataFrame([(5, ITEM), (5, ITEM), (None, ITEM)], "item_id long, text string")
    got = sorted((r["item_id"] or 0, r["end_word"]) for r in D.contaminated_pairs(docs, bench).collect())
    assert got == [(0, 19), (0, 20), (0, 20)] + [(5, 19)] * 2 + [(5, 20)] * 4


def test_a_large_benchmark_aligns_few_pairs(spark):
    """Items of ten Zipf words: seeds and the counts of words leave a small share of all pairs to align."""
    rng = np.random.default_rng(5)
    share = 1 / np.arange(1, 50_001)
    line = lambda n: " ".join(f"z{x}" for x in rng.choice(50_000, n, p=share / share.sum()))
    docs = docs_of(spark, [line(400) for _ in range(50)])
    bench = spark.createDataFrame([(k, line(10)) for k in range(3200)], "item_id long, text string")
    slim = docs.selectExpr("doc_id as id", "xxhash64(text) as h", "text")
    found = D.candidate_pairs(slim, bench).select("id", "iid", "words", "item_words").collect()
    as_words = lambda x: np.frombuffer(x, np.uint32).astype(np.uint64)
    left = D.plausible([as_words(r["words"]) for r in found], [as_words(r["item_words"]) for r in found], D.MIN_SCORE)
    pairs = {(r["id"], r["iid"]) for r, ok in zip(found, left) if ok}
    assert len(pairs) < 0.05 * 50 * 3200
