"""Compare registered queries with their SQL in DuckDB: python tests/check_oracle.py [sf] [name ...]"""

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


SAME = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def key(value):
    if value is None:
        return (0, "")
    if isinstance(value, float):
        return (1, "nan" if math.isnan(value) else repr(value))
    return (1, repr(value))


def compare(df, con, sql):
    """Empty text if both give the same columns, types of value and rows, else what differs."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    types = {d[0]: str(d[1]) for d in cursor.description}
    odd = {f.name: (f.dataType.simpleString(), types[f.name]) for f in df.schema if SAME[f.dataType.simpleString()] != types[f.name]}
    if odd:
        return f"types {odd}"
    order = sorted(df.columns)
    got = sorted(tuple(key(r[c]) for c in order) for r in df.collect())
    at = [names.index(c) for c in order]
    want = sorted(tuple(key(r[i]) for i in at) for r in expected)
    if len(got) != len(want):
        return f"{len(got)} rows vs {len(want)}"
    wrong = [(a, b) for a, b in zip(got, want) if a != b]
    return f"{len(wrong)} of {len(got)} rows differ, first {wrong[0]}" if wrong else ""


if __name__ == "__main__":
    from conftest import make_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    spark = make_session()
    con = connect(sf_dir)
    queries, oracle = entry.queries(), entry.oracle_sql()
    for name in sys.argv[2:] or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in oracle:
                problem = compare(df, con, oracle[name])
                print(f"{name:24} {'ok' if not problem else 'DIFFERS ' + problem[:600]}  {time.time() - start:.1f}s", flush=True)
            else:
                print(f"{name:24} rows {df.count()}  {time.time() - start:.1f}s", flush=True)
        except Exception as error:
            print(f"{name:24} ERROR {str(error)[:600]}", flush=True)
