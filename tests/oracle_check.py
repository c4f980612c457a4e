"""Run registered queries in Spark and their DuckDB twins; compare names, types, rows, values.

    python tests/oracle_check.py [sf_dir] [key ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]

SPARK_TO_DUCK = {"StringType": "VARCHAR", "IntegerType": "INTEGER", "LongType": "BIGINT", "DoubleType": "DOUBLE",
                 "BooleanType": "BOOLEAN", "DateType": "DATE", "TimestampType": "TIMESTAMP"}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 9))
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    if hasattr(v, "asDict"):
        return norm(tuple(v))
    return repr(v)


def spark_type(dt) -> str:
    name = type(dt).__name__
    if name == "ArrayType":
        return spark_type(dt.elementType) + "[]"
    return SPARK_TO_DUCK.get(name, name)


def compare(spark, con, sf_dir, key, fn, sql):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = sdf.collect()
    t1 = time.time()
    scols = sdf.columns
    stypes = {f.name: spark_type(f.dataType) for f in sdf.schema.fields}
    if sql is None:
        return f"RUN {key:28s} rows={len(srows):6d} spark={t1 - t0:5.1f}s (rows-only: no SQL twin)"
    con.execute(f"CREATE OR REPLACE VIEW twin AS {sql}")  # as the driver does: one plain statement
    rel = con.sql("SELECT * FROM twin")
    dcols = rel.columns
    dtypes = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    drows = rel.fetchall()
    problems = []
    if sorted(scols) != sorted(dcols):
        problems.append(f"columns spark-only={sorted(set(scols) - set(dcols))} duck-only={sorted(set(dcols) - set(scols))}")
    else:
        bad = {c: (stypes[c], dtypes[c]) for c in scols if stypes[c] != dtypes[c]}
        if bad:
            problems.append(f"types {bad}")
    if len(srows) != len(drows):
        problems.append(f"rows spark={len(srows)} duck={len(drows)}")
    if not problems:
        order = sorted(scols)
        si = [scols.index(c) for c in order]
        di = [dcols.index(c) for c in order]
        sv = sorted(tuple(norm(r[i]) for i in si) for r in srows)
        dv = sorted(tuple(norm(r[i]) for i in di) for r in drows)
        if sv != dv:
            diff = [(a, b) for a, b in zip(sv, dv) if a != b][:2]
            problems.append(f"values differ, e.g. {diff}")
    status = "OK " if not problems else "BAD"
    return f"{status} {key:28s} rows={len(srows):6d} spark={t1 - t0:5.1f}s " + "; ".join(problems)


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and os.path.isdir(argv[1]) else "/root/testdata/sf0.01"
    keys = [a for a in argv[1:] if a != sf_dir]
    import __spark_entry__ as E
    from attrition.session import local_session

    spark = local_session(8, 8)
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for k in keys or list(qs):
        try:
            line = compare(spark, con, sf_dir, k, qs[k], sqls.get(k))
        except Exception as e:  # report and continue
            line = f"ERR {k:28s} {type(e).__name__}: {str(e)[:400]}"
        bad += line.startswith(("BAD", "ERR"))
        print(line, flush=True)
    print(f"done: {len(keys or qs)} keys, {bad} mismatched or failed")


if __name__ == "__main__":
    main(sys.argv)
