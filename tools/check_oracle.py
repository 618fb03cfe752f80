"""Run registered queries in Spark and their SQL oracles in DuckDB; compare.

Usage: python tools/check_oracle.py [--sf-dir DIR] [--keys k1,k2] [--area A]

Compares row count, sorted column names and the order-insensitive multiset of
rows. Values are compared exactly after type normalisation; a second verdict
allows a 1e-9 relative difference on floats to tell rounding from logic bugs.
"""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import json
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from tessera.plans.registry import all_queries  # noqa: E402
from tessera.session import build_session  # noqa: E402
from tessera.sources.tables import TABLE_NAMES, table_path  # noqa: E402


def _norm(v, approx: bool):
    if v is None:
        return None
    if isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        if approx:
            return float(f"{v:.9g}")
        return repr(v)
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return v
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return json.dumps([_norm(x, approx) for x in v], default=str)
    if isinstance(v, dict):
        return json.dumps({k: _norm(x, approx) for k, x in v.items()}, default=str)
    return str(v)


def _rows(columns, rows, approx):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i], approx) for i in order) for r in rows]
    return sorted(out, key=lambda r: json.dumps(r, default=str))


def run(sf_dir: str, keys: list[str] | None, area: str | None) -> int:
    spark = build_session()
    con = duckdb.connect()
    for name in TABLE_NAMES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{table_path(sf_dir, name)}')")
    registry = all_queries()
    selected = [k for k in sorted(registry) if (not keys or k in keys)
                and (not area or registry[k].area == area)]
    bad = 0
    for key in selected:
        q = registry[key]
        t0 = time.time()
        try:
            sdf = q.build(spark, sf_dir)
            s_cols = sdf.columns
            s_rows = [tuple(r) for r in sdf.collect()]
        except Exception as exc:  # noqa: BLE001
            print(f"FAIL  {key}: spark error {type(exc).__name__}: {str(exc)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if q.oracle is None:
            print(f"ROWS  {key}: {len(s_rows)} rows (no oracle) {ts:.1f}s")
            continue
        try:
            res = con.execute(q.oracle)
            d_cols = [c[0] for c in res.description]
            d_rows = res.fetchall()
        except Exception as exc:  # noqa: BLE001
            print(f"FAIL  {key}: duckdb error {str(exc)[:400]}")
            bad += 1
            continue
        problems = []
        if sorted(s_cols) != sorted(d_cols):
            problems.append(f"columns spark={sorted(s_cols)} duck={sorted(d_cols)}")
        if len(s_rows) != len(d_rows):
            problems.append(f"rows spark={len(s_rows)} duck={len(d_rows)}")
        if not problems:
            if _rows(s_cols, s_rows, False) != _rows(d_cols, d_rows, False):
                if _rows(s_cols, s_rows, True) == _rows(d_cols, d_rows, True):
                    problems.append("values equal only approximately")
                else:
                    a = _rows(s_cols, s_rows, True)
                    b = _rows(d_cols, d_rows, True)
                    diff = [(x, y) for x, y in zip(a, b) if x != y][:2]
                    problems.append(f"values differ, e.g. {diff}")
        if problems:
            bad += 1
            print(f"FAIL  {key}: {'; '.join(problems)}")
        else:
            print(f"OK    {key}: {len(s_rows)} rows {ts:.1f}s")
    print(f"{len(selected) - bad}/{len(selected)} ok")
    return 1 if bad else 0


if __name__ == "__main__":
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    ap.add_argument("--keys", default="")
    ap.add_argument("--area", default="")
    a = ap.parse_args()
    sys.exit(run(a.sf_dir, [k for k in a.keys.split(",") if k] or None, a.area or None))
