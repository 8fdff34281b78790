"""Run registered queries in Spark and their DuckDB twins, compare results.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck_connection(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return repr(v)


def rows_of_spark(df):
    cols = sorted(df.columns)
    rows = [tuple(_norm(r[c]) for c in cols) for r in df.select(*cols).collect()]
    return cols, sorted(rows), {f.name: f.dataType.simpleString() for f in df.schema.fields}


def rows_of_duck(con, sql):
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    data = rel.fetchall()
    order = sorted(range(len(names)), key=lambda i: names[i])
    cols = [names[i] for i in order]
    rows = [tuple(_norm(r[i]) for i in order) for r in data]
    types = {d[0]: str(d[1]) for d in rel.description}
    return cols, sorted(rows), types


def in_order_spark(df, keys):
    """The sort keys' values in the order of the result."""
    return [tuple(_norm(r[k]) for k, _ in keys) for r in df.collect()]


def in_order_duck(con, sql, keys):
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    return [tuple(_norm(r[names.index(k)]) for k, _ in keys) for r in rel.fetchall()]


def compare(spark, name, query, sql, sf_dir, con):
    t0 = time.time()
    df = query(spark, sf_dir)
    s_cols, s_rows, s_types = rows_of_spark(df)
    t1 = time.time()
    d_cols, d_rows, d_types = rows_of_duck(con, sql)
    ok_cols = s_cols == d_cols
    ok_n = len(s_rows) == len(d_rows)
    ok_v = s_rows == d_rows
    from mercato.plans.oracle import SORTED
    if ok_v and name in SORTED:
        ok_v = in_order_spark(df, SORTED[name]) == in_order_duck(con, sql, SORTED[name])
    status = "OK" if (ok_cols and ok_n and ok_v) else "MISMATCH"
    print(f"{status:8s} {name:40s} rows spark={len(s_rows)} duck={len(d_rows)} "
          f"cols={'ok' if ok_cols else 'DIFF'} values={'ok' if ok_v else 'DIFF'} spark_s={t1 - t0:.2f}")
    if not ok_cols:
        print("   spark cols:", s_cols)
        print("   duck  cols:", d_cols)
    if ok_cols and not ok_v:
        sd, dd = set(s_rows), set(d_rows)
        print("   only spark:", sorted(sd - dd)[:3])
        print("   only duck :", sorted(dd - sd)[:3])
    if ok_cols:
        print("   types spark:", s_types)
        print("   types duck :", d_types) if status != "OK" else None
    return status == "OK"


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as entry
    from mercato.session import build_session
    spark = build_session("local[8]", shuffle_partitions=8)
    qs, sqls = entry.queries(), entry.oracle_sql()
    con = duck_connection(sf_dir)
    bad = []
    for name, q in qs.items():
        if names and name not in names:
            continue
        if name not in sqls:
            n = q(spark, sf_dir).count()
            print(f"{'ROWS':8s} {name:40s} rows spark={n} (no oracle)")
            continue
        try:
            if not compare(spark, name, q, sqls[name], sf_dir, con):
                bad.append(name)
        except Exception as e:  # noqa: BLE001
            print(f"ERROR    {name}: {type(e).__name__}: {str(e)[:800]}")
            bad.append(name)
    print("FAILED:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
