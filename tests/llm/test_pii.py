import hashlib
import re

import pytest

from llm_fixtures import no_docs, odd_docs  # noqa: F401
from tessera.llm import pii as P
from tessera.llm.queries import op4_pii

SF = "/root/testdata/sf0.001"


def brute(text):
    """Base spans by the patterns alone, kind by kind."""
    out = []
    for k, kind in enumerate(P.KINDS):
        for m in re.finditer({"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
                              "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
                              "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}[kind], text):
            d = [int(c) for c in m.group() if c.isdigit()]
            if kind == "ip" and any(int(x) > 255 for x in m.group().split(".")):
                continue
            if kind == "card":
                check = sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(d[::-1]))
                if not 12 <= len(d) <= 19 or check % 10:
                    continue
            if kind == "phone" and not 9 <= len(d) <= 15:
                continue
            out.append((m.start(), k, m.end()))
    return sorted(out)


def test_query_equals_brute_force(spark):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op4_pii(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = brute(texts[r["doc_id"]])
        written = P._write(want)
        assert r["base_sha256"] == hashlib.sha256(written.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in P.KINDS] == [sum(s[1] == k for s in want) for k in range(4)]
        assert set(filter(None, written.split(","))) <= set(r["spans"].split(","))


@pytest.mark.parametrize("text", [
    "a.b@c.de, x@y (no), +1 (212) 555-0100; 4111 1111 1111 1111 or 4111-1111-1111-1112", "1.2.3.4.5.6.7.8 256.1.1.1 0255.1.1.1",
    "é" * 5 + " +49 30 1234567 ünd ä@b.c", "+1234567890123456 1@2.3.4.5", "", "4111  1111 1111 1111",
    "a@b.c@d.e a@@b.c x@y.@z.w a@b.c.@d.e.f .@-.-", "1.2.3 1..2.3.4 01.002.3.4.5.6.7.8.9 é1.2.3.4"])
def test_base_spans(text):
    assert P.base_spans(text) == brute(text)


@pytest.fixture(scope="module")
def model(spark):
    return P.fit(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))


def test_the_trees_add_forms_and_leave_plain_numbers(model):
    def added(text):
        base, every = model.spans(text)
        return [text[a:b] for a, k, b in every if (a, k, b) not in base]

    assert added("Thesan of rethe (487) 555-7209 nder hain is.") == ["(487) 555-7209"]
    assert added("write to bob.5 [at] mail3.example.com please") == ["bob.5 [at] mail3.example.com"]
    assert added("reach joe at example dot com now") == ["joe at example dot com"]
    assert added("tel 0487.555.7209 or so") == ["0487.555.7209"]
    assert added("two 4111111111111111 5500000000000004 in a row") == ["4111111111111111", "5500000000000004"]
    for plain in ("In 2021-03-04 12:30 it was.", "Released as 1.2.3.4.5 there.", "Row 12345678 of 87654321.",
                  "Seen at home.then again.", "no digits at all",
                  "order 9807915762804490 it is", "ip 256.1.1.300", "card 4111.1111.1111.1112 wrong"):
        assert added(plain) == []


@pytest.mark.parametrize("text, want", [
    ("pay 4111 1111 1111 1111 5500 0000 0000 0004 now", ["4111 1111 1111 1111", "5500 0000 0000 0004"]),
    ("in 2024 4111 1111 1111 1111 was", ["4111 1111 1111 1111"]),
    ("call 555-123-4567 555-987-6543 soon", ["555-123-4567", "555-987-6543"]),
    ("call (212) 555-0199 (212) 555-0198 today", ["(212) 555-0199", "(212) 555-0198"]),
    ("write " + "x" * 80 + " [at] a.b.c.d.e.f.g.h.com", ["x" * 80 + " [at] a.b.c.d.e.f.g.h.com"])])
def test_numbers_run_together_and_long_addresses(model, text, want):
    assert [text[a:b] for a, _, b in model.spans(text)[1]] == want


def test_candidates_are_all_sub_spans_of_a_plausible_length():
    """Against trying every pair of group borders."""
    import random

    rng = random.Random(5)
    for _ in range(300):
        text = "".join(rng.choice(["12", "345", "6789", "0", "12345678"]) + rng.choice([" ", "-", ". ", ") (", " x "]) for _ in range(rng.randrange(1, 14)))
        for kind, (least, most) in P.DIGITS.items():
            want = set()
            for run in P.GENERATORS[kind].finditer(text):
                groups = [m.span() for m in re.finditer("[0-9]+", run.group())]
                for i in range(len(groups)):
                    for j in range(i, len(groups)):
                        a, b = run.start() + groups[i][0], run.start() + groups[j][1]
                        if least <= sum(c.isdigit() for c in text[a:b]) <= most and (j - i < P.GROUPS or (i, j) == (0, len(groups) - 1)):
                            want.add((a - (kind == "phone" and text[a - 1:a] == "("), b))
            got = P.candidates(text, kind)
            assert set(got) == want and len(got) == len(want), (kind, text)
    assert P.candidates("a at b.c at d.e", "email") == [(0, 8), (5, 15)]


def test_recall_of_planted_forms(spark, model):
    """Rewritten forms of the base spans and numbers beside others, per kind, where no base span stands in the way."""
    hits, total = {}, {}
    texts = {r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect() if r["text"]}
    for text in sorted(texts):
        spans = P.base_spans(text)
        for start, k, end in spans:
            kind = P.KINDS[k]
            if kind == "ip" or any(a < end and start < b and (a, b) != (start, end) for a, _, b in spans):
                continue
            forms = [P.rewritten(text, kind, start, end)] + ([P.beside(text, kind, start, end)] if kind in P.DIGITS else [])
            for other, a, b in forms:
                base, found = model.spans(other)
                if any(u < b and a < v for u, _, v in base):
                    continue
                total[kind] = total.get(kind, 0) + 1
                hits[kind] = hits.get(kind, 0) + any((u, v) == (a, b) for u, _, v in found)
    assert set(total) == {"email", "card", "phone"}
    assert all(hits[kind] >= 0.9 * total[kind] for kind in total), (hits, total)


def test_clean_documents_stay(spark, model):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()
    clean = [r["text"] for r in docs if not brute(r["text"])]
    assert sum(bool(model.spans(t)[1]) for t in clean) <= 0.005 * len(clean)


def test_trees_learn():
    import numpy as np

    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(float)
    trees = P.Trees(x[:400], y[:400])
    assert ((trees.probability(x[400:]) > 0.5) == y[400:]).mean() > 0.93


def test_redaction():
    text = "mail a@b.co or +1 212 555 0100."
    assert P.redact(text, P.base_spans(text)) == "mail [EMAIL] or [PHONE]."


def test_odd_rows(odd_docs, no_docs):
    got = P.find_pii(odd_docs).collect()
    assert len(got) == odd_docs.count() and all(r["spans"] == "" for r in got)
    assert P.find_pii(no_docs).count() == 0


def test_random_strings_equal_the_patterns():
    import random

    rng = random.Random(3)
    for _ in range(4000):
        text = "".join(rng.choice("a1@.-+ (9") for _ in range(rng.randrange(40)))
        assert P.base_spans(text) == brute(text), text


def test_very_long_runs_are_read_in_linear_time(model):
    """Long runs of one kind of character, and texts of very many spans."""
    for text in ("a" * 300_000 + " @", "1" * 300_000, "1." * 100_000, "@" * 100_000, "+1(" * 100_000, "a.b@" * 100_000):
        model.spans(text)
    many = "call +1 212 555 0100 or (212) 555-0199 or a@b.co; " * 3000
    base, every = model.spans(many)
    assert len(base) == 6000 and len(every) >= 6000 and every == sorted(every)


def test_copies_do_not_outgrow_the_sample(spark, monkeypatch):
    text = "call +1 212 555 0100 or 4111 1111 1111 1111."
    docs = spark.range(2000).selectExpr(f"'{text}' AS text")
    seen = []
    monkeypatch.setattr(P, "train", lambda rows: seen.append(len(rows)) or P.Model())
    P.fit(docs)
    assert seen == [len(P._examples(text))]


@pytest.mark.parametrize("text", [
    "reach jane.doe at example.com now", "reach jane [at] example(dot)com now", "reach jane@example dot com now",
    "host fe:ab:cd:ef:ad:be answers", "reach jane{at}example.com now"])
def test_no_candidate_is_passed_over_without_a_digit(text, model):
    """Every generator's spans are scored, as they are beside an unrelated digit."""
    class Sure:
        def probability(self, x):
            import numpy as np

            return np.ones(len(x))

    assert any(P.candidates(text, kind) for kind in P.KINDS)
    every = P.Model()
    every.kinds = {kind: (Sure(), 0.5) for kind in P.KINDS}
    spans = every.spans(text)[1]
    assert spans and spans == [s for s in every.spans(text + ", row 7")[1] if s[2] <= len(text)]
    assert model.spans(text)[1] == [s for s in model.spans(text + ", row 7")[1] if s[2] <= len(text)]


def test_every_different_text_is_learned(spark, monkeypatch):
    """No sample: all candidates of more texts than one of a few thousand would hold, also of those without a digit."""
    texts = [f"call +1 212 555 {i:04d} or write to user{i}@example.com" for i in range(4000)] + ["reach jane.doe at example.com now"]
    seen = []
    monkeypatch.setattr(P, "train", lambda examples: seen.append(len(examples)) or P.Model())
    P.fit(spark.createDataFrame([(t,) for t in texts * 2] + [(None,)], "text string"))
    assert seen == [sum(len(P._examples(t)) for t in texts)]


def test_trees_and_thresholds_equal_those_of_all_rows_at_once(spark, monkeypatch):
    """Against arrays of all examples; blocks of a few rows and any number of tasks change nothing."""
    import numpy as np

    for name, size in (("ROUNDS", 3), ("BLOCK", 50), ("PACKED", 70)):
        monkeypatch.setattr(P, name, size)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    kept = []
    train = P.train
    monkeypatch.setattr(P, "train", lambda examples: kept.append(examples) or train(examples))
    model, again = P.fit(docs.repartition(7)), P.fit(docs.coalesce(1))
    rows = [(kind, bool(aside), f, v) for r in kept[0].blocks.toLocalIterator()
            for kind, aside, y, x in [(r["kind"], r["aside"], np.frombuffer(r["y"], np.uint8), np.frombuffer(r["x"]))]
            for f, v in zip(x.reshape(len(y), -1).tolist(), y.tolist())]
    texts = {r["text"] for r in docs.collect() if r["text"]}
    assert sorted((k, v, f) for k, _, f, v in rows) == sorted((k, int(y), f) for t in texts for k, y, f in P._examples(t))
    assert {"card", "phone"} <= set(model.kinds) == set(again.kinds)
    for kind, (trees, threshold) in model.kinds.items():
        x, y, side = (np.array([r[i] for r in rows if r[0] == kind]) for i in (2, 3, 1))
        want = P.Trees(x[~side], y[~side])
        for got in (trees, again.kinds[kind][0]):
            assert all(np.array_equal(a, b) for a, b in zip(got.cuts, want.cuts))
            assert np.array_equal(got.split, want.split) and np.array_equal(got.leaf, want.leaf)
        p, good = trees.probability(x[side]), y[side] > 0
        at = [q for q in set(p) if good[p >= q].sum() >= P.PRECISION * (p >= q).sum()]
        assert threshold == again.kinds[kind][1] == max(0.5, min(at))
