"""Run a query key in Spark and its oracle SQL in DuckDB; compare results.

Comparison: same column names (sorted), same row count, same multiset of
rows after light normalisation (floats rounded to 6 places, Decimal as float).
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, bool):
        return (1, str(v))
    if isinstance(v, (int,)):
        return (2, str(v))
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return (3, "nan")
        return (2, repr(round(v, 6)) if v != int(v) or abs(v) > 1e15 else str(int(v)))
    if isinstance(v, dt.datetime):
        return (4, v.replace(tzinfo=None).isoformat())
    if isinstance(v, dt.date):
        return (5, v.isoformat())
    if isinstance(v, (list, tuple)):
        return (6, repr([_norm(x) for x in v]))
    return (7, str(v))


def rows_key(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


_DUCK = {"INTEGER": "int", "BIGINT": "bigint", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean",
         "TIMESTAMP": "timestamp", "DATE": "date", "SMALLINT": "smallint", "FLOAT": "float"}


def type_mismatches(df, con, sql):
    """Column types: Spark simple type vs DuckDB DESCRIBE (timestamp_ntz ~ TIMESTAMP).
    An all-NULL DuckDB column (type "NULL") matches anything."""
    desc = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    out = []
    for f in df.schema.fields:
        st = f.dataType.simpleString().replace("timestamp_ntz", "timestamp")
        dtype = desc.get(f.name)
        if dtype is None or dtype == '"NULL"' or dtype == "NULL":
            continue
        if _DUCK.get(dtype, dtype.lower()) != st:
            out.append((f.name, st, dtype))
    return out


def compare(spark, key, fn, sql, sf_dir, con=None):
    """Return (ok, message)."""
    df = fn(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    if sql is None:
        return True, f"{key}: spark rows={len(s_rows)} (no oracle)"
    con = con or duck(sf_dir)
    res = con.execute(sql)
    d_cols = [x[0] for x in res.description]
    d_rows = res.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        return False, f"{key}: columns differ\n spark={sorted(s_cols)}\n duck ={sorted(d_cols)}"
    if len(s_rows) != len(d_rows):
        return False, f"{key}: row count spark={len(s_rows)} duck={len(d_rows)}"
    tmis = type_mismatches(df, con, sql)
    if tmis:
        return False, f"{key}: types differ {tmis}"
    a, b = rows_key(s_cols, s_rows), rows_key(d_cols, d_rows)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        return False, f"{key}: values differ ({len(s_rows)} rows); first diffs: {diff}"
    return True, f"{key}: ok rows={len(s_rows)}"


def main(argv):
    import os
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from rosterline.session import get_spark
    import __spark_entry__ as E
    sf_dir = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
    spark = get_spark("local[8]", shuffle_partitions=8)
    qs, os_ = E.queries(), E.oracle_sql()
    keys = argv or list(qs)
    con = duck(sf_dir)
    bad = 0
    for k in keys:
        try:
            ok, msg = compare(spark, k, qs[k], os_.get(k), sf_dir, con)
        except Exception as e:  # report and go on
            ok, msg = False, f"{k}: ERROR {type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(("PASS " if ok else "FAIL ") + msg, flush=True)
    print(f"{len(keys) - bad}/{len(keys)} passed; oracle for {sum(1 for k in keys if k in os_)}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
