"""Run the named queries and their SQL side by side: ``python tests/check_oracle.py [sf_dir] [name ...]``."""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from loomwork.session import build_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def norm(value):
    if isinstance(value, float):
        return f"{value:.9g}"
    return str(value)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(norm(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir, name):
    df = entry.queries()[name](spark, sf_dir)
    got = table(df.columns, [tuple(r) for r in df.collect()])
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return len(got[1]), "no SQL"
    cur = con.execute(sql)
    want = table([d[0] for d in cur.description], cur.fetchall())
    if got == want:
        return len(got[1]), "same"
    if got[0] != want[0]:
        return len(got[1]), f"columns differ: {got[0]} / {want[0]}"
    a, b = set(got[1]) - set(want[1]), set(want[1]) - set(got[1])
    return len(got[1]), f"DIFFERENT: {len(got[1])} / {len(want[1])} rows; only Spark {str(sorted(a)[:2])[:700]} only SQL {str(sorted(b)[:2])[:700]}"


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


if __name__ == "__main__":
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark = build_session("check", master="local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    for name in names:
        start = time.time()
        try:
            n, verdict = compare(spark, con, sf_dir, name)
        except Exception as e:  # report and go on with the other queries
            n, verdict = -1, f"ERROR {type(e).__name__}: {str(e)[:900]}"
        bad += verdict not in ("same", "no SQL")
        print(f"{name:26s} {n:7d} rows {time.time() - start:6.1f}s  {verdict}", flush=True)
    print("not matching:", bad)
