"""Compare registered queries with their oracle text: python tests/check_oracle.py [sf_dir] [name ...]."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from geonet.fixtures import BASE  # noqa: E402


def database(sf_dir: str):
    con = duckdb.connect()
    for t in BASE:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def canon(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]
    rows = []
    for row in df.itertuples(index=False, name=None):
        rows.append(tuple(None if v is None or (isinstance(v, float) and v != v) or v is pd.NA else
                          (float(v) if isinstance(v, float) else (int(v) if hasattr(v, "__index__") and not isinstance(v, bool) else v)) for v in row))
    return sorted(rows, key=repr)


def compare(spark, con, sf_dir: str, fn, sql: str | None):
    """Differences between a query and its oracle: (rows, problem or None)."""
    got = fn(spark, sf_dir).toPandas()
    if sql is None:
        return len(got), None if len(got) else "no rows"
    want = con.execute(sql).df()
    if sorted(got.columns) != sorted(want.columns):
        return len(got), f"columns {sorted(got.columns)} / {sorted(want.columns)}"
    a, b = canon(got), canon(want)
    if a == b:
        return len(a), None
    only_a, only_b = sorted(set(a) - set(b), key=repr), sorted(set(b) - set(a), key=repr)
    return len(a), f"{len(a)} / {len(b)} rows; only spark {len(only_a)} {only_a[:3]}; only oracle {len(only_b)} {only_b[:3]}"


if __name__ == "__main__":
    from geonet.queries import registry
    from geonet.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = local_session("8")
    con = database(sf_dir)
    bad = 0
    for name, (fn, sql) in registry().items():
        if names and not any(name == n or (n.endswith("*") and name.startswith(n[:-1])) for n in names):
            continue
        start = time.time()
        try:
            rows, problem = compare(spark, con, sf_dir, fn, sql)
        except Exception as exc:  # report and go on with the next query
            rows, problem = -1, f"{type(exc).__name__}: {str(exc)[:600]}"
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name:28s} {rows:8d} {time.time() - start:6.1f}s {'' if sql else '(rows only)'} {problem or ''}", flush=True)
    print("failures:", bad)
