"""Run registered queries and their SQL on the same tables and compare the values.

usage: python tools/check_oracle.py SF_DIR [name ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from lumentab.plans import ORACLES, PLANS  # noqa: E402
from lumentab.session import local_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def compare(spark, con, name, sf):
    start = time.time()
    df = PLANS[name](spark, sf)
    rows = [tuple(r) for r in df.collect()]
    took = time.time() - start
    if name not in ORACLES:
        return f"rows={len(rows)}", took, True
    start = time.time()
    rel = con.sql(ORACLES[name])
    want = rel.fetchall()
    sql_took = time.time() - start
    problems = []
    if sorted(df.columns) != sorted(rel.columns):
        problems.append(f"columns {sorted(df.columns)} != {sorted(rel.columns)}")
    else:
        types = dict(zip(rel.columns, map(str, rel.types)))
        simple = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string"}
        for c, t in df.dtypes:
            if simple.get(types[c], types[c]) != t:
                problems.append(f"type {c}: {t} != {types[c]}")
        a, b = canonical(df.columns, rows), canonical(rel.columns, want)
        if len(a) != len(b):
            problems.append(f"rows {len(a)} != {len(b)}")
        elif repr(a) != repr(b):
            bad = [(x, y) for x, y in zip(a, b) if repr(x) != repr(y)]
            problems.append(f"{len(bad)} rows differ, e.g. {bad[0]}")
    text = "; ".join(problems) or f"ok rows={len(rows)} sql={sql_took:.1f}s"
    return text, took, not problems


def main():
    sf, names = sys.argv[1], sys.argv[2:] or list(PLANS)
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    failed = []
    for name in names:
        try:
            text, took, ok = compare(spark, con, name, sf)
        except Exception as e:  # report and go on with the next query
            text, took, ok = f"ERROR {type(e).__name__}: {str(e)[:600]}", 0.0, False
        if not ok:
            failed.append(name)
        print(f"{'ok ' if ok else 'BAD'} {name:24s} {took:6.2f}s {text[:900]}", flush=True)
    print(f"{len(names) - len(failed)}/{len(names)} ok; failed: {failed}")


if __name__ == "__main__":
    main()
