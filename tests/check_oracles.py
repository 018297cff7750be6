"""Compare registered queries with their SQL: python tests/check_oracles.py [sf_dir] [names...]."""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb

import __spark_entry__ as entry

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canonical(value):
    if isinstance(value, float):
        return round(value, 6) + 0.0
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(canonical(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, sf_dir, name, df=None):
    df = entry.queries()[name](spark, sf_dir) if df is None else df
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return f"rows only: {len(got)}"
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    want = rows_of(columns, result.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"DIFF columns {sorted(df.columns)} vs {sorted(columns)}"
    if got != want:
        extra = [r for r in got if r not in set(want)][:2]
        missing = [r for r in want if r not in set(got)][:2]
        return f"DIFF rows {len(got)} vs {len(want)}\n   spark: {str(extra)[:700]}\n   sql:   {str(missing)[:700]}"
    return f"ok {len(got)} rows"


if __name__ == "__main__":
    from session_for_tests import make_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark, con = make_session(), connect(sf)
    for n in names:
        start = time.time()
        try:
            outcome = compare(spark, con, sf, n)
        except Exception as error:
            outcome = f"FAILED {type(error).__name__}: {str(error)[:1500]}"
        print(f"{n:28s} {time.time() - start:6.1f}s {outcome}", flush=True)
