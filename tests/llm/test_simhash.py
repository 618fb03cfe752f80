import numpy as np
import pytest
import xxhash

from llm_fixtures import no_docs, odd_docs, sf_docs  # noqa: F401
from tests_llm_helpers import brute_components
from tessera.llm import simhash


def slow_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text).encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("text", ["", " \t\x0b", "One", "a b", "a b c", "a b c d a b c d É é x", "x\x1cy z w", "A b " * 300])
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode()) == slow_fingerprint(text)


@pytest.mark.parametrize("node_rows", [simhash.NODE_ROWS, 3])
def test_components_equal_brute_force(spark, sf_docs, node_rows):
    got = simhash.near_duplicates(sf_docs, node_rows=node_rows).collect()
    texts = {r["doc_id"]: r["text"] for r in sf_docs.collect()}
    assert all(int(r["fingerprint"], 16) == slow_fingerprint(texts[r["doc_id"]] or "") for r in got)
    want = brute_components({r["doc_id"]: int(r["fingerprint"], 16) for r in got})
    assert {r["doc_id"]: r["component_id"] for r in got} == want and len(got) == len(texts)


@pytest.mark.parametrize("node_rows", [simhash.NODE_ROWS, 4])
def test_links_of_dense_and_chained_prints(spark, node_rows):
    """Long chains of single steps and a dense ball: one component each, none lost or joined."""
    rng = np.random.default_rng(3)
    prints = set(rng.integers(0, 1 << 63, 200, dtype=np.uint64).tolist())
    chain = int(rng.integers(0, 1 << 63, dtype=np.uint64))
    for step in range(40):
        prints.add(chain)
        chain ^= 0b111 << (step * 3 % 61)
    ball = int(rng.integers(0, 1 << 63, dtype=np.uint64))
    prints |= {ball ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(a)}
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    fps = spark.createDataFrame(signed, "fp long")
    got = {r["fp"] % (1 << 64): r["root"] % (1 << 64) for r in simhash.classes(fps, node_rows).collect()}
    want = brute_components({p: p for p in prints})
    groups = {}
    for p, root in got.items():
        groups.setdefault(root, set()).add(want[p])
    assert set(got) == prints and all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(want.values()))


def test_odd_rows(odd_docs, no_docs):
    got = simhash.near_duplicates(odd_docs).collect()
    assert len(got) == odd_docs.count()
    by_id = {r["doc_id"]: r["component_id"] for r in got}
    assert by_id[1] == by_id[2] == by_id[3] == 1  # null, empty and wordless texts link
    assert by_id[5] == by_id[6] == 5
    assert simhash.near_duplicates(no_docs).count() == 0
    kept = simhash.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    assert kept.count() == len({r["component_id"] for r in got})
    assert simhash.keep_one(no_docs).count() == 0
