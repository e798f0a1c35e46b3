"""Run registered queries against their SQL twins in DuckDB.

usage: python tools/compare.py [sf_dir] [name-prefix ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb

from landloom.checks import registry
from landloom.checks.fixtures import TABLES
from landloom.session import local_session

registry.load()


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def norm(v):
    if isinstance(v, float):
        return round(v, 6) + 0.0
    return v


def rows(columns, data):
    idx = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(norm(r[i]) for i in idx) for r in data), key=repr), [columns[i] for i in idx]


TYPES = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean"}


def compare(spark, con, name: str, sf_dir: str) -> tuple[bool, str]:
    t = time.time()
    df = registry.QUERIES[name](spark, sf_dir)
    got, gcols = rows(df.columns, [tuple(r) for r in df.collect()])
    took = time.time() - t
    sql = registry.ORACLES.get(name)
    if sql is None:
        return len(got) > 0, f"{len(got)} rows, no SQL twin, {took:.1f}s"
    rel = con.sql(sql)
    want, wcols = rows(rel.columns, rel.fetchall())
    types = {c: TYPES.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types)}
    mine = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    if gcols != wcols:
        return False, f"columns {gcols} != {wcols}"
    if types != mine:
        return False, f"types {[(c, mine[c], types[c]) for c in mine if mine[c] != types[c]]}"
    if got != want:
        a, b = [r for r in got if r not in set(want)][:3], [r for r in want if r not in set(got)][:3]
        return False, f"rows {len(got)} vs {len(want)}; only spark {a}; only sql {b}"
    return len(got) > 0, f"{len(got)} rows, {took:.1f}s"


def main(argv):
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = local_session(cores="8")
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    bad = 0
    for name in registry.QUERIES:
        if len(argv) > 1 and not any(name.startswith(p) for p in argv[1:]):
            continue
        try:
            ok, msg = compare(spark, con, name, sf_dir)
        except Exception as e:  # report and go on with the next query
            ok, msg = False, f"{type(e).__name__}: {str(e)[:1500]}"
        bad += not ok
        print("ok  " if ok else "FAIL", name, msg, flush=True)
    print(f"{bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
