"""Run registered queries against their SQL counterparts: python check.py [sf] [name-prefix ...]."""

import math
import sys
import time

import duckdb

from stallmetrics.plans import ORACLES, QUERIES
from stallmetrics.session import build_session

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def cell(v):
    if v is None:
        return "~"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(cell(r[i]) for i in order) for r in rows)


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def compare(spark, con, sf_dir, name):
    started = time.time()
    df = QUERIES[name](spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    took = time.time() - started
    if name not in ORACLES:
        return f"rows-only {len(got[1])} rows", True, took
    rel = con.execute(ORACLES[name])
    want = rows_of([d[0] for d in rel.description], rel.fetchall())
    if got[0] != want[0]:
        return f"COLUMNS {got[0]} != {want[0]}", False, took
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
             "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}
    ours = {c: kinds.get(t, t) for c, t in df.dtypes}
    theirs = {d[0]: str(d[1]) for d in rel.description}
    if ours != theirs:
        wrong = {c: (ours[c], theirs[c]) for c in ours if ours[c] != theirs[c]}
        return f"TYPES {wrong}", False, took
    if got[1] != want[1]:
        extra = [r for r in got[1] if r not in set(want[1])][:2]
        lost = [r for r in want[1] if r not in set(got[1])][:2]
        return f"VALUES {len(got[1])} vs {len(want[1])} rows; only here {extra}; only there {lost}", False, took
    return f"ok {len(got[1])} rows", True, took


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "sf0.01"
    wanted = sys.argv[2:]
    sf_dir = f"/root/testdata/{sf}"
    spark = build_session("check", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = duck(sf_dir), 0
    for name in QUERIES:
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        try:
            message, good, took = compare(spark, con, sf_dir, name)
        except Exception as e:  # report and go on with the next query
            message, good, took = f"ERROR {type(e).__name__}: {str(e)[:600]}", False, 0
        bad += not good
        print(f"{'  ' if good else '!!'} {name:40s} {took:6.2f}s {message}", flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main()
