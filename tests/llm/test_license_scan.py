import re

from llm_fixtures import no_docs, odd_docs, sf_docs  # noqa: F401
from tessera.llm import license_scan as L

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def slow_words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text))


def slow_base(words):
    places = []
    for phrase, label in L.PHRASES.items():
        p = phrase.split()
        places += [(i, label) for i in range(len(words) - len(p) + 1) if words[i:i + len(p)] == p]
    return places


def slow_containments(words, templates):
    """Best containment of each template over the half-overlapping blocks, by comparing all sets."""
    best = {}
    for at in range(0, max(1, len(words)), L.BLOCK_WORDS // 2):
        block = set(words[at:at + L.BLOCK_WORDS])
        for t, (_, text) in enumerate(templates):
            own = set(slow_words(text))
            best[t] = max(best.get(t, 0.0), len(own & block) / len(own))
    return best


def check(rows, texts):
    for r in rows:
        words = slow_words(texts[r["doc_id"]] or "")
        places = slow_base(words)
        best = slow_containments(words, L.TEMPLATES)
        found = {t: c for t, c in best.items() if c >= L.THRESHOLD - 1e-9}
        base = {label for _, label in places}
        assert (r["n_words"], r["n_base"]) == (len(words), len(places))
        assert r["first_word"] == min((i for i, _ in places), default=None)
        assert r["last_word"] == max((i for i, _ in places), default=None)
        assert r["base_labels"] == ",".join(sorted(base))
        assert r["labels"] == ",".join(sorted(base | {L.TEMPLATES[t][0] for t in found}))
        assert abs(r["score"] - (1.0 if places else max(found.values(), default=0.0))) < 1e-9


def test_query_equals_brute_force(spark, sf_docs):
    check(L.scan_licenses(sf_docs).collect(), {r["doc_id"]: r["text"] for r in sf_docs.collect()})


def test_notices_of_any_place_and_order(spark):
    filler = " ".join(f"word{i}" for i in range(200))
    texts = [f"{filler[:900]} {t} {filler}" for _, t in L.TEMPLATES]
    texts += [f"{filler} {' '.join(reversed(t.split()))} the of and" for _, t in L.TEMPLATES]
    texts += [" ".join(w for i, w in enumerate(t.split()) if i != 3) for _, t in L.TEMPLATES]
    texts += ["MIT License mit license, Mit-License; cc by by CC  by", "GNU\nGeneral.Public License", "the license under the"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = L.scan_licenses(docs).collect()
    check(rows, dict(enumerate(texts)))
    by_id = {r["doc_id"]: r["labels"].split(",") for r in rows}
    assert all(label in by_id[i] for i, (label, _) in enumerate(L.TEMPLATES))


def test_odd_rows(odd_docs, no_docs):
    got = L.scan_licenses(odd_docs).collect()
    assert len(got) == odd_docs.count() and all(r["score"] == 0 and r["labels"] == "" for r in got)
    assert {r["doc_id"]: r["n_words"] for r in got}[3] == 0
    assert L.scan_licenses(no_docs).count() == 0


def test_places_in_linear_time():
    """Very many places in one text: word numbers are counted on, not anew."""
    import time

    from tessera.llm.license_scan import phrase_places, words_of

    words = words_of(b"mit license, apache license of old. " * 80_000)
    began = time.time()
    places = phrase_places(words, {"mit license": "mit", "apache license": "apache"})
    assert time.time() - began < 5 and len(places) == 160_000
    assert sorted(places)[:3] == [(0, "mit"), (2, "apache"), (6, "mit")]
