"""Print plan red flags for every registered query (nested loops, single
partitions, cartesian products, unbounded collects, Python row UDFs)."""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tessera.plans.registry import all_queries  # noqa: E402
from tessera.session import build_session  # noqa: E402

FLAGS = {
    "nested_loop": re.compile(r"BroadcastNestedLoopJoin"),
    "cartesian": re.compile(r"CartesianProduct"),
    "single_partition": re.compile(r"Exchange SinglePartition"),
    "collect": re.compile(r"collect_(list|set)"),
    "python_udf": re.compile(r"BatchEvalPython|ArrowEvalPython"),
    "python_map": re.compile(r"MapInPandas|FlatMapGroupsInPandas"),
}


def main(sf_dir: str) -> None:
    spark = build_session()
    for key, q in sorted(all_queries().items()):
        if q.area == "streaming":
            continue
        df = q.build(spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        hits = [name for name, rx in FLAGS.items() if rx.search(plan)]
        if hits:
            print(f"{key}: {', '.join(hits)}")


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01")
