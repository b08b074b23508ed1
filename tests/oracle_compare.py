"""Run catalogue queries in Spark and their oracle SQL in DuckDB; compare like the driver does.

Usage: python tests/oracle_compare.py [sf_dir] [key ...]
"""

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in records), key=repr)


def compare_pandas(spark, sf, key, q, sql, con):
    """The same check through pandas frames with every value stringified (another way a driver may compare)."""
    s = q(spark, sf).toPandas()
    d = con.execute(sql).df()
    if sorted(s.columns) != sorted(d.columns):
        return dict(key=key, cols=False, values=False)
    cols = sorted(s.columns)

    def norm_frame(df):
        return sorted(tuple("None" if v is None or (isinstance(v, float) and v != v) else str(v) for v in row)
                      for row in df[cols].astype(object).itertuples(index=False))
    a, b = norm_frame(s), norm_frame(d)
    out = dict(key=key, rows=len(a), cols=True, values=a == b)
    if a != b:
        out["spark_only"] = [x for x in a if x not in set(b)][:2]
        out["oracle_only"] = [x for x in b if x not in set(a)][:2]
    return out


def compare(spark, sf, key, q, sql, con):
    t0 = time.time()
    sdf = q(spark, sf)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    if sql is None:
        return dict(key=key, rows=len(s_rows), oracle=None, secs=round(t1 - t0, 2))
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    ok_cols = sorted(s_cols) == sorted(d_cols)
    ok_n = len(s_rows) == len(d_rows)
    ok_v = ok_cols and rows_of(s_cols, s_rows) == rows_of(d_cols, d_rows)
    out = dict(key=key, rows=len(s_rows), oracle_rows=len(d_rows), cols=ok_cols, values=ok_v, secs=round(t1 - t0, 2))
    if not ok_cols:
        out["spark_cols"], out["oracle_cols"] = s_cols, d_cols
    elif not ok_v:
        a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
        sa, sb = set(a), set(b)
        out["spark_only"] = [x for x in a if x not in sb][:3]
        out["oracle_only"] = [x for x in b if x not in sa][:3]
        out["cols_sorted"] = sorted(s_cols)
    return out


def main():
    from __spark_entry__ import oracle_sql, queries
    from abacus.session import get_session
    args = [a for a in sys.argv[1:] if a != "--pandas"]
    check = compare_pandas if "--pandas" in sys.argv else compare
    sf = args[0] if args else "/root/testdata/sf0.01"
    keys = args[1:]
    spark = get_session("local[8]", 8, extra={"spark.driver.memory": "8g"})
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for key in keys or list(qs):
        try:
            r = check(spark, sf, key, qs[key], sqls.get(key), con)
        except Exception as e:  # noqa: BLE001
            r = dict(key=key, error=f"{type(e).__name__}: {str(e)[:600]}")
        ok = r.get("values") is True or (r.get("oracle") is None and "error" not in r and "values" not in r)
        bad += 0 if ok else 1
        print(("OK  " if ok else "BAD ") + str(r), flush=True)
    print(f"{bad} bad of {len(keys or qs)}")


if __name__ == "__main__":
    main()
