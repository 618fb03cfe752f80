"""Every registered query against its DuckDB SQL oracle at sf0.001."""

import duckdb
import pytest

from tessera.plans.registry import all_queries
from tessera.sources.tables import TABLE_NAMES, table_path
from tools.check_oracle import _rows

SF = "/root/testdata/sf0.001"
QUERIES = all_queries()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLE_NAMES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{table_path(SF, name)}')")
    return con


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, key):
    q = QUERIES[key]
    df = q.build(spark, SF)
    got = [tuple(r) for r in df.collect()]
    if q.oracle is None:
        assert len(df.columns) > 0
        return
    res = duck.execute(q.oracle)
    cols = [c[0] for c in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert len(got) == len(want)
    assert _rows(df.columns, got, False) == _rows(cols, want, False)
