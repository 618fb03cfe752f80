import re

import pytest

from llm_fixtures import no_docs, odd_docs, sf_docs  # noqa: F401
from tessera.llm import quality_rules as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow_measures(text):
    words = WORD.findall(text)
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i:i + 8]), []).append(i)
    inside = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return [len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(inside)]


def test_measures_equal_brute_force(sf_docs):
    got = Q.judge_documents(sf_docs).collect()
    for r in got:
        assert [r[c] for c in Q.MEASURES] == slow_measures(r["text"] or "")
        failed = r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"]
        assert r["base_failed"] == failed and not (failed and r["kept"])


@pytest.mark.parametrize("line,bad", [
    ("Home | News | Sport | Contact", True),
    ("buy### now*** cheap$$$ words only", True),
    ("STOP!! READ!! THIS!! NOW!!", True),
    ("again again again again again again again", True),
    ("we use cookies, see our privacy policy", True),
    ("a line of many plain words that never comes to any stop whatever happens", True),
    ("An ordinary sentence, with a comma, and an end.", False),
    ("", False), ("Title", False), ("Released under the MIT License.", False)])
def test_line_rules(line, bad):
    assert Q.line_fails(line.encode()) is bad


def test_verdict_follows_labels(spark, sf_docs):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = Q.judge_documents(docs).join(labels, "doc_id").filter("not base_failed").select("quality", "kept").collect()
    assert sum(r["kept"] != (r["quality"] == 1) for r in got) <= 0.02 * len(got)


def test_bad_lines_go(spark):
    good = "\n".join(f"Sentence {i} says{i} of decent{i} text, and ends{i} well." for i in range(12))
    docs = spark.createDataFrame([(1, good + "\nHome | News | Sport | Contact", "en", "s", 0)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    row = Q.keep_clean(docs).first()
    assert row["text"] == good and row["n_chars"] == len(good)


def test_odd_rows(odd_docs, no_docs):
    got = Q.judge_documents(odd_docs).collect()
    assert len(got) == odd_docs.count()
    assert all(r["n_words"] == 0 and not r["kept"] for r in got if not (r["text"] or "").strip())
    assert Q.keep_clean(odd_docs).columns == odd_docs.columns
    assert [r["doc_id"] for r in Q.keep_clean(odd_docs).collect()] == [4] or Q.keep_clean(odd_docs).count() >= 1
    assert Q.judge_documents(no_docs).count() == 0 and Q.keep_clean(no_docs).count() == 0


@pytest.mark.parametrize("line,bad", [
    ("Cookie Policy", True), ("Privacy policy", True), ("Lorem ipsum", True), ("click here", True), ("Read more...", True),
    ("Home >", True), ("### ***", True), ("|", True), ("STOP!! NOW!!", True),
    ("Two words", False), ("Introduction", False), ("same same", False), (" \t", False), ("Chapter 2", False)])
def test_rules_hold_on_short_lines(line, bad):
    assert Q.line_fails(line.encode()) is bad


def test_documents_of_short_boilerplate_go(spark):
    good = "\n".join(f"Sentence {i} says{i} of decent{i} text, and ends{i} well." for i in range(6))
    menu = "\n".join(f"Section{i} >" for i in range(30))
    docs = spark.createDataFrame([(1, good + "\nCookie policy"), (2, good + "\n" + menu + "\nPrivacy policy")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in Q.judge_documents(docs).collect()}
    assert got[1]["kept"] and got[1]["clean_text"] == good and not got[2]["kept"] and not got[2]["base_failed"]
