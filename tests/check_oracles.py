"""Compare registered queries with their SQL: python tests/check_oracles.py [sf] [name ...]"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from millrace.plans.registry import all_queries  # noqa: E402
from millrace.session import build_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def normal(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, float)) or type(value).__name__ == "Decimal":
        number = float(value)
        return "nan" if math.isnan(number) else f"{number:.12g}"
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(normal(r[i]) for i in order) for r in rows], key=repr)


def compare(spark, con, query, folder):
    """None when equal, else a short description of the difference."""
    df = query.run(spark, folder)
    ours = rows_of(df.columns, df.collect())
    result = con.execute(query.sql)
    names = [d[0] for d in result.description]
    theirs = rows_of(names, result.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    if ours != theirs:
        extra = [r for r in ours if r not in set(theirs)][:3]
        lacking = [r for r in theirs if r not in set(ours)][:3]
        return f"rows {len(ours)} vs {len(theirs)}; only ours {extra}; only theirs {lacking}"
    return None if ours else "both empty"


def connect(folder):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return con


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    folder = f"/root/testdata/sf{sf}"
    spark = build_session("oracles", "local[8]", spark__ui__enabled="false", spark__sql__shuffle__partitions="8")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name, query in all_queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            problem = compare(spark, con, query, folder) if query.sql else f"rows {query.run(spark, folder).count()}"
        except Exception as exc:
            problem = f"{type(exc).__name__}: {str(exc)[:600]}"
        bad += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print("failures:", bad)
