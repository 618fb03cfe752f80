"""Compare the Arrow column types of every Spark query with its DuckDB oracle.

Usage: python tools/check_types.py [SF_DIR]   (default /root/testdata/sf0.001)
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from tessera.plans.registry import all_queries  # noqa: E402
from tessera.session import build_session  # noqa: E402
from tessera.sources.tables import TABLE_NAMES, table_path  # noqa: E402

ARROW_NAMES = [
    (T.LongType, "int64"), (T.IntegerType, "int32"), (T.ShortType, "int16"), (T.DoubleType, "double"),
    (T.FloatType, "float"), (T.StringType, "string"), (T.DateType, "date32[day]"),
    (T.TimestampNTZType, "timestamp[us]"), (T.BooleanType, "bool"),
]


def arrow_name(dt: T.DataType) -> str:
    for spark_type, name in ARROW_NAMES:
        if isinstance(dt, spark_type):
            return name
    if isinstance(dt, T.DecimalType):
        return f"decimal128({dt.precision}, {dt.scale})"
    return str(dt)


def main(sf_dir: str) -> int:
    spark = build_session()
    con = duckdb.connect()
    for name in TABLE_NAMES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{table_path(sf_dir, name)}')")
    bad = 0
    for key, q in sorted(all_queries().items()):
        if q.oracle is None or q.area == "streaming":
            continue
        spark_types = {f.name: arrow_name(f.dataType) for f in q.build(spark, sf_dir).schema.fields}
        duck_types = {f.name: str(f.type) for f in con.sql(q.oracle).to_arrow_table().schema}
        diff = {c: (spark_types.get(c), duck_types.get(c)) for c in set(spark_types) | set(duck_types)
                if spark_types.get(c) != duck_types.get(c)}
        if diff:
            bad += 1
            print(key, diff)
    print("mismatching queries:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"))
