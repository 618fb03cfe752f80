import random
import re
from collections import defaultdict

from llm_fixtures import no_docs, odd_docs, sf_docs  # noqa: F401
from tessera.llm import line_dedup as L

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def brute(rows):
    """Texts without chunks whose bytes stand at an earlier (id, position), nor the equal lines beside them."""
    lines = {i: t.split("\n") for i, t in rows}
    places, cuts = defaultdict(list), {}
    for i, t in rows:
        cuts[i] = [0, *L.chunk_ends([x.encode() for x in lines[i]])]
        for a, b in zip(cuts[i], cuts[i][1:]):
            places["\n".join(lines[i][a:b])].append((i, a, b))
    cut = defaultdict(set)
    for at in places.values():
        (j, c, d), *others = sorted(at)
        for i, a, b in others:
            run = set(range(a, b))
            low, low0 = (max(0, [0, *(x for x in cuts[k] if x < s)][-1] - 1) for k, s in ((i, a), (j, c)))
            for k in range(1, min(a - low, c - low0) + 1):
                if lines[i][a - k] != lines[j][c - k]:
                    break
                run.add(a - k)
            high, high0 = (min((x for x in cuts[k] if x > s), default=s) for k, s in ((i, b), (j, d)))
            for k in range(min(high - b, high0 - d)):
                if lines[i][b + k] != lines[j][d + k]:
                    break
                run.add(b + k)
            if len(run) > 1:
                cut[i] |= run
    return {i: "\n".join(x for k, x in enumerate(t.split("\n")) if k not in cut[i]) for i, t in rows}


def test_equal_brute_force(sf_docs):
    rows = [(r["doc_id"], r["text"]) for r in sf_docs.collect()]
    assert {r["doc_id"]: r["text"] for r in L.dedup_lines(sf_docs).collect()} == brute(rows)


def test_boundaries_resist_shifts():
    rng = random.Random(5)
    lines = [f"line {rng.random()}".encode() for _ in range(400)]
    moved = lines[:7] + [b"new"] + lines[7:200] + lines[203:]

    def chunks(x):
        ends = L.chunk_ends(x)
        return {tuple(x[a:b]) for a, b in zip([0, *ends], ends)}

    assert ends_are_whole(lines) and len(chunks(lines) & chunks(moved)) > 0.9 * len(chunks(lines))


def ends_are_whole(lines):
    ends = L.chunk_ends(lines)
    return ends[-1] == len(lines) and all(0 < b - a <= L.MAX_LINES for a, b in zip([0, *ends], ends))


def test_passages_go_and_first_stays(spark):
    passage = "\n".join(f"Shared sentence {i} of a passage that many documents carry along." for i in range(30))
    rows = [(i, f"Own start {i}.\n{passage}\nOwn end {i}.", "en", "s", 0) for i in range(20)]
    got = {r["doc_id"]: r for r in L.dedup_lines(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[0]["text"] == rows[0][1]
    for i in range(1, 20):
        assert got[i]["n_removed_lines"] == 30 and f"Own start {i}." in got[i]["text"] and f"Own end {i}." in got[i]["text"]


def test_a_crowded_table_changes_nothing(spark, sf_docs, monkeypatch):
    want = {r["doc_id"]: r["text"] for r in L.dedup_lines(sf_docs).collect()}
    monkeypatch.setattr(L, "FILTER_LOG2", 6)
    assert {r["doc_id"]: r["text"] for r in L.dedup_lines(sf_docs).collect()} == want


def test_odd_rows(odd_docs, no_docs):
    got = L.dedup_lines(odd_docs).collect()
    assert len(got) == odd_docs.count()
    by_id = defaultdict(list)
    for r in got:
        by_id[r["doc_id"]].append(r)
    assert by_id[1][0]["text"] is None and by_id[2][0]["text"] == ""
    assert by_id[6][0]["text"] == by_id[6][1]["text"]  # repeated rows: one verdict
    assert by_id[None][0]["text"] == by_id[None][1]["text"]
    assert L.drop_repeats(odd_docs).columns == odd_docs.columns
    assert L.dedup_lines(no_docs).count() == 0 and L.drop_repeats(no_docs).count() == 0


def test_every_line_that_goes_stands_earlier(spark, sf_docs):
    """By (id, position): the smallest place of each line of the corpus is never cut."""
    before = {r["doc_id"]: r["text"].split("\n") for r in sf_docs.collect()}
    after = {r["doc_id"]: r["text"].split("\n") for r in L.dedup_lines(sf_docs).collect()}
    assert {x for t in before.values() for x in t} == {x for t in after.values() for x in t} - {""} | ({""} & {x for t in before.values() for x in t})


def test_many_spans_of_a_long_text(spark):
    """A text of very many lines is cut in linear time."""
    lines = [f"Line {i} of a very long text." for i in range(60_000)]
    rows = [(1, "\n".join(lines), "en", "s", 0), (2, "\n".join(lines[:30_000] + ["new"] + lines[30_000:]), "en", "s", 0)]
    got = {r["doc_id"]: r for r in L.dedup_lines(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[1]["text"] == rows[0][1] and got[2]["text"] == "new" and got[2]["n_removed_lines"] == 60_000


def slow_runs(rows):
    """Texts without neighbouring lines, long lines and longer chunks that stand at an earlier (id, position)."""
    seen, out = set(), {}
    for i, t in sorted(rows):
        lines, cut = t.split("\n"), set()
        ends = L.chunk_ends([x.encode() for x in lines])
        spans = [(k, k + 1) for k, x in enumerate(lines) if len(x.split()) >= 50 or len(x.encode()) >= 300]
        spans += [(k, k + 2) for k in range(len(lines) - 1)] + [(a, b) for a, b in zip([0, *ends], ends) if b - a > 2]
        for a, b in spans:
            run = tuple(lines[a:b])
            if b - a == 1 or sum(len(re.findall(r"[0-9A-Za-z\x80-\U0010ffff]+", x)) for x in run) >= 4:
                cut |= set(range(a, b)) if run in seen else set()
                seen.add(run)
        out[i] = "\n".join(x for k, x in enumerate(lines) if k not in cut)
    return out


def test_blank_lines_and_braces_stay(spark):
    """Doubled blank lines, braces and rules are no passage by themselves; a shared worded line and what it stands with is one."""
    texts = [f"Own start {k}.\n\n\nOwn line {k}.\n}}\n}}\nOwn rule {k}.\n---\n---\nOwn stop {k}.\nShared words stand here.\n\nend {k}" for k in "ab"]
    frame = spark.createDataFrame([(k, t, "en", "s", 0) for k, t in enumerate(texts)], SCHEMA)
    got = {r["doc_id"]: r["text"] for r in L.drop_repeats(frame).collect()}
    assert got == {0: texts[0], 1: texts[1].replace("Shared words stand here.\n\n", "")}


def test_the_query_cuts_content_defined_chunks(spark, sf_docs, monkeypatch):
    """Boundaries reach the query: a chunk of many short lines that no run proposes goes from its second place."""
    short = [f"{a}{b}" for a in "abcdefgh" for b in "12345"]
    ends = [0, *L.chunk_ends([x.encode() for x in short])]
    assert max(b - a for a, b in zip(ends, ends[1:])) > 3
    rows = [(k, "\n".join([f"own {k}", *short, f"end {k}"]), "en", "s", 0) for k in range(2)]
    got = {r["doc_id"]: r["n_removed_lines"] for r in L.dedup_lines(spark.createDataFrame(rows, SCHEMA), runs=True).collect()}
    assert got[0] == 0 and got[1] >= sum(b - a for a, b in list(zip(ends, ends[1:]))[1:-1] if b - a > 3)


def test_runs_equal_brute_force(spark, sf_docs):
    rows = [(r["doc_id"], r["text"]) for r in sf_docs.collect()]
    got = {r["doc_id"]: r["text"] for r in L.dedup_lines(sf_docs, runs=True).collect()}
    assert got == slow_runs(rows)


def test_passages_of_every_length_go(spark):
    """Shared passages of 1 to 8 lines and over 50 words, at different places of otherwise different documents."""
    rows = []
    for n in range(1, 9):
        for p in range(10):
            passage = [f"Passage {n} {p} line {k} " + " ".join(f"word{p}" for _ in range(60 // n)) for k in range(n)]
            for d in range(3):
                own = [[f"Own line {n} {p} {d} {k} {side}." for k in range((p + d) % 4 + 1)] for side in "ab"]
                rows.append((len(rows), "\n".join([*own[0], *passage, *own[1]]), "en", "s", 0))
    docs = spark.createDataFrame(rows, SCHEMA)
    got = {r["doc_id"]: r["text"].split("\n") for r in L.dedup_lines(docs, runs=True).collect()}
    left = {r["doc_id"]: r["text"].split("\n") for r in L.drop_repeats(docs).collect()}
    for i, t, *_ in rows:
        lines = t.split("\n")
        assert got[i] == left[i] == (lines if i % 3 == 0 else [x for x in lines if x.startswith("Own")])
