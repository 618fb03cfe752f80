from math import ceil, floor

import pytest
from pyspark.sql import functions as F

from llm_fixtures import no_docs, odd_docs, sf_docs  # noqa: F401
from tessera.llm import mixing as M


def brute_schedule(n, w):
    """Slot by slot earliest deadline first; n, w: blocks and weight of each source."""
    total = sum(w)
    w = [x / total for x in w]
    fluid = lambda v: sum(min(v * a, b) for a, b in zip(w, n))
    window = lambda i, k: (floor(fluid(k / w[i]) + 1e-6), ceil(fluid((k + 1) / w[i]) - 1e-6))
    at, out = [0] * len(n), []
    for t in range(sum(n)):
        due = [(window(i, at[i])[1], i) for i in range(len(n)) if at[i] < n[i] and window(i, at[i])[0] <= t]
        _, i = min(due)
        out.append((i, at[i]))
        at[i] += 1
    return out, fluid, w


@pytest.mark.parametrize("sizes,weights", [
    ([90, 30, 30], [1, 1, 1]), ([50, 7, 1, 33], [0.5, 0.2, 0.2, 0.1]), ([10], [3]), ([40] * 9, list(range(1, 10)))])
def test_schedule(spark, sizes, weights):
    rows = [(i * 1000 + k, f"s{i}") for i, n in enumerate(sizes) for k in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, source string")
    target = spark.createDataFrame([(f"s{i}", float(w)) for i, w in enumerate(weights)], "source string, weight double")
    got = M.mix(docs, target, blocks=60).collect()
    size = -(-len(rows) // 60)
    n = [-(-x // size) for x in sizes]
    plan, fluid, w = brute_schedule(n, weights)
    slots = {r["mix_slot"]: (int(r["source"][1:]), r["mix_block"]) for r in got}
    assert [slots[t] for t in range(len(plan))] == plan
    assert sorted(r["mix_position"] for r in got) == list(range(len(rows)))
    assert [r["mix_slot"] for r in sorted(got, key=lambda r: r["mix_position"])] == sorted(r["mix_slot"] for r in got)
    live = floor(fluid(min(b / a for a, b in zip(w, n))))
    for i in range(len(n)):
        run = 0
        for t in range(live):
            assert abs(run - t * w[i]) < 1 + 1e-6
            run += slots[t][0] == i


def test_native(sf_docs):
    plan = M.mix(sf_docs, M.temperature_weights(sf_docs))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def test_same_again_whatever_the_partitions(sf_docs):
    a = M.mix(sf_docs, M.temperature_weights(sf_docs)).select("doc_id", "mix_position").collect()
    other = sf_docs.repartition(13)
    b = M.mix(other, M.temperature_weights(other)).select("doc_id", "mix_position").collect()
    assert sorted(a) == sorted(b)


def test_odd_rows(spark, odd_docs, no_docs):
    target = spark.createDataFrame([("a", 1.0), ("a", None), (None, -2.0), ("z", 5.0)], "source string, weight double")
    got = M.mix(odd_docs, target)
    assert got.columns == [c for c in odd_docs.columns if c not in M.MIX_COLUMNS] + list(M.MIX_COLUMNS)
    assert sorted(r["mix_position"] for r in got.collect()) == list(range(odd_docs.count()))
    assert M.mix(no_docs, target).count() == 0
    assert M.mix(no_docs, M.temperature_weights(no_docs)).count() == 0
    assert M.temperature_weights(odd_docs).filter(F.col("source").isNull()).count() == 1
