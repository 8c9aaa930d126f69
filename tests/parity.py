"""Run checks in Spark and DuckDB and compare them.

Usage: python tests/parity.py [sf] [name ...]
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return 0.0 if v == 0 else v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def compare(spark, con, fn, sql, sf) -> tuple[str, int]:
    """Empty text when both sides agree, else what differs; and the row count."""
    frame = fn(spark, sf)
    names = sorted(frame.columns)
    left = [tuple(plain(v) for v in row) for row in frame.select(*[f"`{c}`" for c in names]).collect()]
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    if sorted(columns) != names:
        return f"columns {names} against {sorted(columns)}", len(left)
    order = [columns.index(c) for c in names]
    right = [tuple(plain(row[i]) for i in order) for row in result.fetchall()]
    for a, b in zip(left[:50], right[:50]):
        for name, x, y in zip(names, a, b):
            if x is not None and y is not None and type(x) is not type(y):
                return f"type of {name}: {type(x).__name__} against {type(y).__name__}", len(left)
    a, b = Counter(left), Counter(right)
    if a != b:
        lone, other = list((a - b).elements()), list((b - a).elements())
        key = lambda r: tuple(str(v) for v in r)
        text = f"{len(lone)}/{len(other)} rows differ of {len(left)}/{len(right)}: {names}"
        return text + f"\n   spark {sorted(lone, key=key)[:3]}\n   sql   {sorted(other, key=key)[:3]}", len(left)
    return "", len(left)


def main() -> None:
    from freshet.checks import QUERIES, SQL
    from freshet.session import local_session

    sf = f"/root/testdata/sf{sys.argv[1] if len(sys.argv) > 1 else '0.01'}"
    wanted = sys.argv[2:]
    spark, con = local_session(8), connect(sf)
    bad = 0
    for name, fn in QUERIES.items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            text, n = compare(spark, con, fn, SQL[name], sf)
        except Exception as e:  # report and go on
            text, n = f"{type(e).__name__}: {str(e)[:1500]}", -1
        bad += bool(text)
        print(f"{'FAIL' if text else 'ok  '} {name} {n} rows {time.time() - start:.2f}s {text}", flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main()
